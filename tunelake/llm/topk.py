"""Exact top-k search by inner product with a bit-sliced index.

Vectors are turned into whole numbers, ``floor(1024 * x)`` for each component. Blocks of rows are
indexed: each component is cut to a few bits, and bit ``b`` of component ``d`` of all rows is one
bitmap, a slice. A query's components are cut to small whole weights. Adding the slices that the bits
of the weights select, shifted by their place, gives the slices of an approximate score of all rows
at once: carry-save adders over bitmaps, a negative weight by the complement of the slices. From the
most significant score slice downward, one pass finds the k-th largest approximate score. What was cut
off is bounded on both sides, so every row that could belong to the top k has an approximate score
above a known limit; a second pass over the slices selects these boundary rows, and their scores are
computed exactly. Results are exact for any number of bits; more bits leave fewer boundary rows.

Queries go in blocks of bounded size against all rows. A task keeps k rows for each query.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part, nor do
rows without an id and empty vectors; a query meets vectors of its own length only; ties go to the
smaller id; a repeated row is a candidate as often as it is there, but a repeated query asks once;
rows with the query's id are its own and no candidates of it; an empty table gives an empty table;
other columns are left out. A component beyond 2**61 or a score beyond 64 bits is held at the border.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.session import ship_package, written

SCALE = 1024
#: Bits of a component, bits of a query's weight, rows in a block, queries in a block.
SLICE_BITS, WEIGHT_BITS, BLOCK_ROWS, BLOCK_QUERIES = 6, 6, 1 << 16, 2048

_RESULT = "query int, query_id long, vec_id long, score long"


def whole_numbers(ids: pa.Array, vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: the ids and components (rows of whole numbers) of the rows that take part."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False)  # a null becomes NaN
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    usable = (lengths > 0) & (bad[ends] == bad[ends - lengths]) & ids.is_valid().to_numpy(
        zero_copy_only=False
    )
    keys = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    found = {}
    for length in np.unique(lengths[usable]):
        rows = np.flatnonzero(usable & (lengths == length))
        own = values[(ends[rows] - length)[:, None] + np.arange(length)]
        scaled = np.clip(np.floor(own * SCALE), -(2.0**61), 2.0**61)
        found[int(length)] = (keys[rows], scaled.astype(np.int64))
    return found


def _exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products; with arbitrary whole numbers where 64 bits might not do."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(query).max(initial=0)) * len(query)
    if most < 2.0**62:
        return rows @ query
    full = rows.astype(object) @ query.astype(object)
    return np.array([min(max(int(x), -(2**63)), 2**63 - 1) for x in full], np.int64)


def add_slices(by_weight: list[np.ndarray], words: int) -> np.ndarray:
    """The slices of the sum: ``by_weight[i]`` holds bitmaps that each count 2**i."""
    total = []
    waiting = [list(part) if isinstance(part, list) else [part] for part in by_weight]
    level = 0
    while level < len(waiting):
        maps = np.concatenate([np.zeros((0, words), np.uint64), *waiting[level]])
        while len(maps) > 1:
            third = max(1, len(maps) // 3)
            a, b = maps[:third], maps[third : 2 * third]
            both = a ^ b
            if len(maps) == 2:
                carry, maps = a & b, both
            else:
                c = maps[2 * third : 3 * third]
                carry = (a & b) | (c & both)
                maps = np.concatenate([both ^ c, maps[3 * third :]])
            if level + 1 == len(waiting):
                waiting.append([])
            waiting[level + 1].append(carry)
        total.append(maps[0] if len(maps) else np.zeros(words, np.uint64))
        level += 1
    return np.array(total, np.uint64).reshape(-1, words)


def kth_largest(slices: np.ndarray, rows: np.ndarray, k: int) -> int:
    """The k-th largest value among ``rows`` (a bitmap with k rows at least), by counting."""
    value, among = 0, rows
    for level in range(len(slices) - 1, -1, -1):
        ones = among & slices[level]
        count = int(np.bitwise_count(ones).sum())
        if count >= k:
            value |= 1 << level
            among = ones
        else:
            k -= count
            among = among & ~slices[level]
    return value


def at_least(slices: np.ndarray, rows: np.ndarray, limit: int) -> np.ndarray:
    """Bitmap of the ``rows`` whose value is ``limit`` or more."""
    if limit <= 0:
        return rows
    if limit >> len(slices):
        return np.zeros_like(rows)
    above, equal = np.zeros_like(rows), rows
    for level in range(len(slices) - 1, -1, -1):
        if limit >> level & 1:
            equal = equal & slices[level]
        else:
            above = above | (equal & slices[level])
            equal = equal & ~slices[level]
    return above | equal


class SlicedBlock:
    """A block of rows with the slices of their components."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.rows = ids, rows
        count = len(ids)
        self.words = -(-count // 64)
        low = rows.min(axis=0)
        spans = [int(high) - int(least) for high, least in zip(rows.max(axis=0), low)]
        self.shift = np.array([max(0, s.bit_length() - SLICE_BITS) for s in spans], np.int64)
        cut = (rows - low) >> self.shift
        self.most = cut.max(axis=0).astype(np.float64)
        bits = np.zeros((rows.shape[1], SLICE_BITS, self.words * 64), np.uint8)
        for bit in range(SLICE_BITS):
            bits[:, bit, :count] = (cut >> bit & 1).T
        self.slices = np.packbits(bits, axis=2, bitorder="little").view(np.uint64)
        present = np.zeros(self.words * 64, np.uint8)
        present[:count] = 1
        self.present = np.packbits(present, bitorder="little").view(np.uint64)

    def candidates(self, query: np.ndarray, k: int) -> np.ndarray:
        """Row numbers that surely contain the top ``k``."""
        if k >= len(self.ids):
            return np.arange(len(self.ids))
        weight = query.astype(np.float64) * 2.0 ** self.shift
        unit = max(np.abs(weight).max() / ((1 << WEIGHT_BITS) - 1), 1e-300)
        small = np.rint(weight / unit).astype(np.int64)
        parts: list[list[np.ndarray]] = [[] for _ in range(SLICE_BITS + WEIGHT_BITS - 1)]
        flip = np.where(small < 0, np.uint64(2**64 - 1), np.uint64(0))
        for place in range(WEIGHT_BITS):
            chosen = np.flatnonzero(np.abs(small) >> place & 1)
            if len(chosen):
                taken = self.slices[chosen] ^ flip[chosen, None, None]
                for bit in range(SLICE_BITS):
                    parts[place + bit].append(taken[:, bit])
        score = add_slices(parts, self.words)
        rest = weight - unit * small
        spread = np.abs(rest) @ self.most + np.abs(query.astype(np.float64)) @ (2.0**self.shift - 1)
        slack = spread / unit * (1 + 1e-9) + 1
        limit = int(np.floor(kth_largest(score, self.present, k) - slack))
        chosen = at_least(score, self.present, limit)
        return np.flatnonzero(np.unpackbits(chosen.view(np.uint8), bitorder="little"))

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the top ``k`` rows with another id, best first."""
        own = int((self.ids == query_id).sum())
        rows = self.candidates(query, k + own)
        rows = rows[self.ids[rows] != query_id]
        scores = _exact(self.rows[rows], query)
        ids = self.ids[rows]
        order = np.lexsort((ids, -scores.astype(object) if (scores == -(2**63)).any() else -scores))
        return ids[order[:k]], scores[order[:k]]


def _search(
    batches: Iterator[pa.RecordBatch], queries: list[tuple[int, np.ndarray]], k: int
) -> Iterator[pa.RecordBatch]:
    """The top ``k`` rows of each block of rows for every query of the same length."""
    waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def results(length: int) -> pa.RecordBatch:
        parts = waiting.pop(length)
        block = SlicedBlock(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        numbers, of, ids, scores = [], [], [], []
        for number, (query_id, query) in enumerate(queries):
            if len(query) == length:
                found, points = block.best(query_id, query, k)
                numbers.append(np.full(len(found), number, np.int32))
                of.append(np.full(len(found), query_id, np.int64))
                ids.append(found)
                scores.append(points)
        empty = [np.zeros(0, np.int64)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(numbers or empty).astype(np.int32)),
                *(pa.array(np.concatenate(x or empty)) for x in (of, ids, scores)),
            ],
            names=["query", "query_id", "vec_id", "score"],
        )

    for batch in batches:
        for length, part in whole_numbers(batch.column(0), batch.column(1)).items():
            waiting.setdefault(length, []).append(part)
            if sum(len(p[0]) for p in waiting[length]) >= BLOCK_ROWS:
                yield results(length)
    for length in list(waiting):
        yield results(length)


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` best rows of ``vectors`` for each row of ``queries``: query_id, rank, vec_id, score.

    Both have ``key`` and ``vector``. One pass over ``vectors`` for each block of queries; a block has
    a bounded size, and it alone is held by the driver and the tasks.
    """
    ship_package(vectors.sparkSession)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    asked = (
        queries.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
        .filter("id is not null and v is not null")
        .distinct()
    )
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    found = None
    for number in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("id", "v"), F.lit(blocks)) == number).toArrow()
        block = [
            (int(i), components)
            for ids, all_components in whole_numbers(
                part.column(0).combine_chunks(), part.column(1)
            ).values()
            for i, components in zip(ids, all_components)
        ]
        top = rows.mapInArrow(lambda batches, block=block: _search(batches, block, k), _RESULT)
        order = Window.partitionBy("query", "query_id").orderBy(F.desc("score"), "vec_id")
        top = (
            top.withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score")
        )
        if blocks > 1:
            top = written(top, "topk")
        found = top if found is None else found.unionByName(top)
    return found
