"""Sharding by histogram sort: shards of nearly equal bytes, found by counting, filled by one exchange.

Rows are ordered by a hash of their text and then by their place in the input, so copies of a text
stand together and shards are a random mix. The boundaries between shards are found by probing: every
partition counts its bytes and rows below each candidate key exactly, and names keys of its own that
divide what lies between the two nearest candidates. The sums tell which candidates enclose each
wanted boundary; new candidates come from the named keys between them. Each round divides the bytes
in doubt by a constant factor, whatever the keys look like. A boundary is found when it lies within
the tolerance, at the border of a group of equal texts if there is one, or when no key is left
between its candidates.

With the counts at the final boundaries known, every row's shard follows from its key, and the number
of rows before each piece of a shard is known too. So one exchange, by piece, moves each row to where
it is numbered. A piece holds about ``PIECE_BYTES``; a shard has up to ``PIECES`` pieces, and from there
on they are larger: sorting one spills to disk and needs no more memory.

Defined results: a null text has no bytes and is sorted with the empty ones; repeated rows and rows
without a key are placed one by one, so a text that a third of all rows share is spread over shards;
an empty table gives an empty table; further columns, clashing names too, are kept out of the way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.common import in_one, out_of_one
from tunelake.session import ship_package, written

SHARDS = 40
#: Bytes that every row counts beside its text.
ROW_BYTES = 16
#: How far a boundary may lie from an exact share, as a part of the share.
TOLERANCE = 0.002
#: Keys that a partition names in a gap, and keys that are fetched for one gap at most.
NAMED, FETCHED = 8, 384
#: Bytes that are moved and sorted together, and such pieces of a shard at most.
PIECE_BYTES, PIECES = 32 << 20, 64

Key = tuple[int, int]  # hash of the text, place in the input
#: With a hash: the border before all rows of that hash.
_BORDER = -(2**63)
_LOWEST, _HIGHEST = (-(2**63), _BORDER), (2**63 - 1, 2**63 - 1)


@dataclass(frozen=True)
class Boundary:
    """All rows below ``key`` lie before it: so many bytes and rows."""

    key: Key
    size: int
    rows: int


class _Rows:
    """The keys of some rows in order, with running totals of their bytes."""

    def __init__(self, batch: pd.DataFrame) -> None:
        hashes, places, sizes = (batch[c].to_numpy(np.int64) for c in ("_hash", "_place", "_size"))
        order = np.lexsort((places, hashes))
        self.hashes, self.places = hashes[order], places[order]
        self.total = np.concatenate([[0], np.cumsum(sizes[order])])

    def below(self, keys: list[Key]) -> np.ndarray:
        """For each key the number of rows below it."""
        hashes = np.array([h for h, _ in keys], np.int64)
        rows = np.searchsorted(self.hashes, hashes, "left")
        ends = np.searchsorted(self.hashes, hashes, "right")
        for i in np.flatnonzero(rows < ends):
            if keys[i][1] != _BORDER:
                rows[i] += np.searchsorted(self.places[rows[i] : ends[i]], keys[i][1], "left")
        return rows

    def named(self, low: Key, high: Key) -> Iterator[tuple[Key, int]]:
        """Keys between ``low`` and ``high`` that cut the rows there into parts of equal bytes.

        The border of a group of equal texts stands for the keys in the group if it lies between.
        """
        first, end = self.below([low, high])
        if first < end and (self.hashes[first], self.places[first]) == low:
            first += 1
        if first == end:
            return
        size = self.total[end] - self.total[first]
        marks = self.total[first] + size * np.arange(1, NAMED + 1) // (NAMED + 1)
        rows = np.clip(np.searchsorted(self.total, marks, "right") - 1, first, end - 1)
        for row in rows:
            key = (int(self.hashes[row]), int(self.places[row]))
            yield ((key[0], _BORDER) if (key[0], _BORDER) > low else key), int(size) // NAMED


def _count(slim: DataFrame, probes: list[Key]) -> dict[Key, tuple[int, int]]:
    """Exact bytes and rows below every probe: counted in each partition, then added up."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = np.zeros(len(probes), np.int64)
        rows = np.zeros(len(probes), np.int64)
        for batch in batches:
            part = _Rows(batch)
            below = part.below(probes)
            rows += below
            size += part.total[below]
        yield pd.DataFrame({"probe": np.arange(len(probes)), "size": size, "rows": rows})

    counted = slim.mapInPandas(run, "probe int, size long, rows long")
    sums = counted.groupBy("probe").agg(F.sum("size").alias("size"), F.sum("rows").alias("rows"))
    return {probes[r["probe"]]: (r["size"], r["rows"]) for r in sums.collect()}


def _name(slim: DataFrame, gaps: list[tuple[Key, Key]]) -> list[list[tuple[Key, int]]]:
    """For every gap some keys in it, in order, with about the bytes that each stands for.

    Every batch of rows names a few. They fall into a bounded number of classes by a hash; of each
    class one key is fetched, with the weight of all.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            part = _Rows(batch)
            found = [
                (gap, *key, weight)
                for gap, (low, high) in enumerate(gaps)
                for key, weight in part.named(low, high)
            ]
            yield pd.DataFrame(found, columns=["gap", "hash", "place", "weight"])

    named = slim.mapInPandas(run, "gap int, hash long, place long, weight long")
    fetched = (
        named.groupBy("gap", F.pmod(F.xxhash64("hash", "place"), F.lit(FETCHED)).alias("class"))
        .agg(F.any_value(F.struct("hash", "place")).alias("key"), F.sum("weight").alias("weight"))
        .collect()
    )
    keys: list[list[tuple[Key, int]]] = [[] for _ in gaps]
    for row in fetched:
        keys[row["gap"]].append(((row["key"]["hash"], row["key"]["place"]), row["weight"]))
    return [sorted(found) for found in keys]


def _around(named: list[tuple[Key, int]], share: float) -> set[Key]:
    """Of the named keys the one at a share (0 to 1) of their weight, and some on either side."""
    reached = np.cumsum([weight for _, weight in named])
    middle = int(np.searchsorted(reached, share * reached[-1]))
    steps = [0, *(sign << i for i in range(9) for sign in (1, -1))]
    return {named[min(max(middle + step, 0), len(named) - 1)][0] for step in steps}


def find_boundaries(slim: DataFrame, shares: int, tolerance: float = TOLERANCE) -> list[Boundary]:
    """The ``shares - 1`` boundaries between parts of equal bytes, and last the end of everything.

    ``slim`` has ``_hash``, ``_place`` (unique) and ``_size``; each round reads it twice.
    """
    size, rows = slim.agg(
        F.coalesce(F.sum("_size"), F.lit(0)), F.count(F.lit(1))
    ).first()
    known: dict[Key, tuple[int, int]] = {_LOWEST: (0, 0), _HIGHEST: (size, rows)}
    wanted = [size * i / shares for i in range(1, shares)]
    slack = tolerance * size / shares
    exhausted: set[tuple[Key, Key]] = set()
    while True:
        ordered = sorted(known)
        sizes = [known[key][0] for key in ordered]
        doubtful: dict[tuple[Key, Key], list[float]] = {}
        for want in wanted:
            at = min(max(int(np.searchsorted(sizes, want, "right")), 1), len(sizes) - 1)
            gap = (ordered[at - 1], ordered[at])
            near = min(abs(sizes[at - 1] - want), abs(sizes[at] - want))
            if near > slack and gap not in exhausted:
                low = sizes[at - 1]
                doubtful.setdefault(gap, []).append((want - low) / max(1, sizes[at] - low))
        if not doubtful:
            break
        gaps = list(doubtful)
        fresh: set[Key] = set()
        for gap, named in zip(gaps, _name(slim, gaps)):
            if not named:
                exhausted.add(gap)
            for share in doubtful[gap] if named else ():
                fresh |= _around(named, share)
        if fresh:
            known.update(_count(slim, sorted(fresh)))
    ends = np.array(sizes)
    found = []
    for want in wanted:
        at = min(max(int(np.searchsorted(ends, want, "right")), 1), len(sizes) - 1)
        key = ordered[at - 1 if want - ends[at - 1] <= ends[at] - want else at]
        found.append(Boundary(key, *known[key]))
    return [*found, Boundary(_HIGHEST, size, rows)]


def text_size(text: str) -> Column:
    """UTF-8 bytes of the text, none for null, plus what every row counts."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def shard(
    df: DataFrame, shards: int = SHARDS, text: str = "text", tolerance: float = TOLERANCE
) -> DataFrame:
    """``df`` with ``size``, ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    The rows are stored once with their keys, so that boundaries and exchange see the same ones
    whatever is computed again. Columns of ``df`` with the names of new ones are left out.
    """
    ship_package(df.sparkSession)
    kept = [c for c in df.columns if c.lower() not in ("size", "shard", "slot")]
    rows = written(
        df.select(
            in_one(kept),
            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_hash"),
            F.monotonically_increasing_id().alias("_place"),
            text_size(text).alias("_size"),
        ),
        "sharding",
    )
    slim = rows.select("_hash", "_place", "_size")
    total = slim.agg(F.sum("_size")).first()[0] or 0
    pieces = min(PIECES, max(1, -(-total // (shards * PIECE_BYTES))))
    bounds = find_boundaries(slim, shards * pieces, tolerance)
    starts = [0] + [b.rows for b in bounds[:-1]]  # rows before each piece
    inner = bounds[:-1]
    hashes = np.array([b.key[0] for b in inner], np.int64)
    places = np.array([b.key[1] for b in inner], np.int64)
    slots = np.array([starts[i] - starts[i - i % pieces] for i in range(len(starts))], np.int64)

    @F.pandas_udf("piece int, shard int, first long")
    def find(row_hash: pd.Series, row_place: pd.Series) -> pd.DataFrame:
        of, at = row_hash.to_numpy(np.int64), row_place.to_numpy(np.int64)
        piece = np.searchsorted(hashes, of, "left")
        end = np.searchsorted(hashes, of, "right")
        for i in np.flatnonzero(piece < end):  # boundaries in the row's own group
            piece[i] += np.searchsorted(places[piece[i] : end[i]], at[i], "right")
        return pd.DataFrame({"piece": piece, "shard": piece // pieces, "first": slots[piece]})

    in_piece = Window.partitionBy("_at.piece").orderBy("_hash", "_place")
    return rows.withColumn("_at", find("_hash", "_place")).select(
        "own",
        F.col("_size").alias("size"),
        F.col("_at.shard").alias("shard"),
        (F.row_number().over(in_piece) - 1 + F.col("_at.first")).alias("slot"),
    ).select(*out_of_one(kept), "size", "shard", "slot")
