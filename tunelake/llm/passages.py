"""Repeated passages by compaction of a de Bruijn graph over words, and texts without them.

Words are what stands between white space. A window of ``WINDOW`` words is an edge of the graph, from
its first ``WINDOW - 1`` words to its last ones. An edge is repeated if its words start at two places
of the corpus, in two texts or in one.

Edges are not counted one by one. Windows in a row whose smallest (by hash) run of ``SEED`` words is the
same form a bundle, a piece of a path; equal windows have equal seeds, so only bundles of one seed can
share edges. Bundles are counted by seed, and those with a seed of their own drop out. Equal bundles
under one seed are one piece, and all edges of a piece that occurs twice are repeated.

Pieces of which one always follows the other, and the other one always comes after it, are joined to
longer paths (by pointers that double their reach in each round of joins): a passage. What is left are
pieces that occur once beside others of their seed, mostly where copies begin, end or differ. Their
source coordinates, text and place, say where to read their words again, together with one source of
each other piece of the seed; their edges are then counted one by one.

A text is known by a 128-bit digest, so copies are read again once. Equality of edges rests on two
hashes of 64 bits each, of the seed and of the window.

Defined results: a null text has no words; texts with fewer than ``WINDOW`` words keep all; repeated
rows are copies of each other like other equal texts; windows overlap, and a word goes if any repeated
window covers it, the first place of a passage not spared; an empty table gives an empty table; other
columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelake.session import ship_package, written

WINDOW, SEED = 35, 8
#: Bytes of text that are worked on at a time; a longer text is worked on alone.
CHUNK_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xBF58476D1CE4E5B9)
_THREE = np.uint64(3)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _ODD
    x ^= x >> np.uint64(31)
    x *= _OTHER
    x ^= x >> np.uint64(29)
    return x


def _powers(base: int, count: int) -> np.ndarray:
    """``base`` to the power of 0, 1, ... modulo 2**64."""
    powers = np.ones(1, np.uint64)
    while len(powers) < count:
        powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), 1 << 64))])
    return powers[:count]


_BASE = 0xD6E8FEB86659FD93
_UP = _powers(_BASE, CHUNK_BYTES)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), CHUNK_BYTES)


def word_hashes(raw: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of texts that lie one after the other, and the number of words of each text.

    ``borders``: where the texts begin, and the end of the last one.
    """
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(borders) - 1, np.int64)
    letters = ~_SPACE[raw]
    first = letters.copy()
    first[1:] &= ~letters[:-1]
    inner = borders[1:-1][borders[1:-1] < len(raw)]
    first[inner] = letters[inner]
    starts = np.flatnonzero(first)
    last = letters.copy()
    last[:-1] &= ~letters[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    up, down = (_UP, _DOWN) if len(raw) <= CHUNK_BYTES else (
        _powers(_BASE, len(raw)), _powers(pow(_BASE, -1, 1 << 64), len(raw))
    )
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=sums[1:])
    hashes = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.diff(np.searchsorted(starts, borders))


def _joined(a: np.ndarray, b: np.ndarray, apart: int) -> np.ndarray:
    """Hashes of two runs of words, the second ``apart`` words after the first."""
    count = max(0, min(len(a), len(b) - apart))
    return _mix(a[:count] * _THREE + b[apart : apart + count])


def run_hashes(words: np.ndarray, seed: int = SEED, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """A hash of the run of ``seed`` words (a power of two) and of ``window`` words from each word on."""
    power, size, seeds, whole, covered = words, 1, words, None, 0
    while True:
        if size == seed:
            seeds = power
        if window & size:
            whole = power if whole is None else _joined(whole, power, covered)
            covered += size
        if 2 * size > window:
            return seeds, whole
        power, size = _joined(power, power, size), 2 * size


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    least, size = values, 1
    while 2 * size <= width:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    rest = width - size
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def bundles(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts with so many words each: text, place, windows, seed, content and inner repetition."""
    if len(hashes) < WINDOW:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int32, np.int32, np.int64, np.int64, bool))
    seeds, windows = run_hashes(hashes)
    least = _least(seeds, WINDOW - SEED + 1)[: len(windows)]
    begins = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)[: len(windows)]
    place = np.arange(len(windows)) - begins[text]
    whole = place + WINDOW <= counts[text]
    text, place, least, windows = text[whole], place[whole], least[whole], windows[whole]
    if not len(windows):
        return bundles(hashes[:0], counts[:0])
    new = np.ones(len(windows), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(windows)))
    number = np.repeat(np.arange(len(starts)), sizes)
    inside = (np.arange(len(windows)) - starts[number]).astype(np.uint64)
    content = _mix(np.add.reduceat(_mix(windows ^ _mix(inside + _OTHER)), starts) + sizes.astype(np.uint64))
    again = np.zeros(len(starts), bool)
    for apart in range(1, min(WINDOW - SEED + 1, len(windows))):
        same = np.flatnonzero(windows[apart:] == windows[:-apart])
        again[number[same][number[same] == number[same + apart]]] = True
    long = np.flatnonzero(sizes[number] > WINDOW - SEED + 1)  # what lies further apart needs so many windows
    if len(long):
        order = long[np.lexsort((windows[long], number[long]))]
        same = (windows[order][1:] == windows[order][:-1]) & (number[order][1:] == number[order][:-1])
        again[number[order][1:][same]] = True
    return (text[starts], place[starts].astype(np.int32), sizes.astype(np.int32),
            least[starts].view(np.int64), content.view(np.int64), again)


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def _chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[list[bytes]]:
    """The texts of a column as bytes, about ``CHUNK_BYTES`` at a time."""
    chunk, size = [], 0
    for batch in batches:
        for value in batch.column(column):
            raw = _raw(value.as_py())
            if chunk and size + len(raw) > CHUNK_BYTES:
                yield chunk
                chunk, size = [], 0
            chunk.append(raw)
            size += len(raw)
    if chunk:
        yield chunk


def _digests(texts: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """Two long columns: the digest of each text."""
    raw = b"".join(xxhash.xxh3_128_digest(t) for t in texts)
    halves = np.frombuffer(raw, ">i8").astype(np.int64).reshape(-1, 2)
    return pa.array(halves[:, 0]), pa.array(halves[:, 1])


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    borders = np.cumsum([0, *map(len, texts)])
    return word_hashes(np.frombuffer(b"".join(texts), np.uint8), borders)


def _map(df: DataFrame, function, schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


_TEXT = ["t1", "t2"]


def pieces(df: DataFrame, text: str = "text") -> DataFrame:
    """The bundles of all texts: digest of the text, place, windows, seed, content, inner repetition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _chunks(batches, 0):
            own, *columns = bundles(*_hashed(texts))
            digests = [d.take(pa.array(own)) for d in _digests(texts)]
            yield pa.RecordBatch.from_arrays(
                [*digests, *map(pa.array, columns)], names=[*_TEXT, "place", "windows", "seed", "content", "again"]
            )

    kind = "t1 long, t2 long, place int, windows int, seed long, content long, again boolean"
    return _map(df.select(text), run, kind)


def different_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """Each text once, packed, by its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3).compress
        for texts in _chunks(batches, 0):
            yield pa.RecordBatch.from_arrays(
                [*_digests(texts), pa.array(map(pack, texts), pa.binary())], names=[*_TEXT, "packed"]
            )

    packed = _map(df.select(text), run, "t1 long, t2 long, packed binary")
    return packed.groupBy(*_TEXT).agg(F.first("packed").alias("packed"))


def keyed(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key of each row with the digest of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = _digests([_raw(v.as_py()) for v in batch.column(1)])
            yield pa.RecordBatch.from_arrays([batch.column(0), *digests], names=["key", *_TEXT])

    kind = df.select(F.col(key).alias("key")).schema["key"].dataType.simpleString()
    return _map(df.select(F.col(key).alias("key"), F.col(text).alias("text")), run, f"key {kind}, t1 long, t2 long")


def paths(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nonbranching paths compacted: ``node, path, steps`` from the first node of its path.

    ``links``: ``node, following``, all of them. Where a node has one follower and that one has no
    other node before it, the two are on one path. Pointers to earlier nodes double their reach in each
    round, which ends when all have reached a first node. A ring has none; it ends where pointers have
    reached around all nodes there are, and is then named by its least node.
    """
    links = links.distinct()
    follower = links.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("following").alias("following"))
    before = links.groupBy("following").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("before"))
    simple = (
        follower.filter("n = 1")
        .join(before.filter("m = 1"), "following")
        .filter("node <> following")
        .select(F.col("following").alias("node"), F.col("before").alias("pointer"))
    )
    start = simple.select(
        "node", "pointer", F.lit(1).cast("long").alias("steps"), F.col("node").alias("least"),
        F.lit(True).alias("open"),
    )
    current = written(start, "links")
    opened, closed, reach, most = current, None, 1, current.count()
    while not opened.isEmpty() and reach <= 2 * most:
        target = opened.select(
            F.col("node").alias("pointer"), F.col("pointer").alias("further"), F.col("steps").alias("more"),
            F.col("least").alias("other"), F.lit(True).alias("goes_on"),
        )
        if closed is not None:  # it ends on a path that has reached its first node
            target = target.unionByName(
                closed.select(
                    F.col("node").alias("pointer"), F.col("path").alias("further"), F.col("steps").alias("more"),
                    F.col("node").alias("other"), F.lit(False).alias("goes_on"),
                )
            )
        moved = opened.join(target, "pointer", "left").select(
            "node",
            F.coalesce("further", "pointer").alias("pointer"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.least("least", "other").alias("least"),
            F.coalesce("goes_on", F.lit(False)).alias("open"),
        )
        current = written(moved, "links")
        done = current.filter("not open").select("node", F.col("pointer").alias("path"), "steps")
        closed = done if closed is None else closed.unionByName(done)
        opened = current.filter("open")
        reach *= 2
    rings = opened.select("node", F.col("least").alias("path"), F.lit(0).cast("long").alias("steps"))
    found = rings if closed is None else closed.unionByName(rings)
    return nodes.join(found, "node", "left").select(
        "node", F.coalesce("path", "node").alias("path"), F.coalesce("steps", F.lit(0)).alias("steps")
    )


def repeated(df: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Pieces with repeated edges (``t1, t2, place, windows, path, steps``), and pieces to read again.

    The latter are ``t1, t2, place, windows, seed, times``.
    """
    found = written(pieces(df, text), "bundles")
    seeds = found.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("again"))
    shared = written(found.join(seeds.filter("n > 1 or again").select("seed"), "seed"), "shared")
    kinds = shared.groupBy("seed", "content").agg(
        F.count(F.lit(1)).alias("times"),
        F.max("again").alias("again"),
        *(F.first(c).alias(c) for c in (*_TEXT, "place", "windows")),  # all of one row
    )
    kinds = written(kinds.withColumn("node", F.xxhash64("seed", "content")), "kinds")
    variants = kinds.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("again"))
    doubtful = kinds.drop("again").join(variants.filter("n > 1 or again").select("seed"), "seed")
    copied = kinds.filter("times > 1").select("seed", "content", "node")
    placed = written(
        shared.join(copied, ["seed", "content"])
        .groupBy(*_TEXT, "place")
        .agg(F.max("windows").alias("windows"), F.max("node").alias("node")),
        "placed",
    )
    in_text = Window.partitionBy(*_TEXT).orderBy("place")
    after = F.lead("place").over(in_text) == F.col("place") + F.col("windows")
    links = placed.select("node", F.when(after, F.lead("node").over(in_text)).alias("following"))
    compacted = paths(links.filter("following is not null"), copied.select("node").distinct())
    on_paths = placed.join(compacted, "node").select(*_TEXT, "place", "windows", "path", "steps")
    return on_paths, doubtful.select(*_TEXT, "place", "windows", "seed", "times")


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the bundles that are to be read again, one row each."""
    unpack = zstandard.ZstdDecompressor().decompress
    columns: list[list[np.ndarray]] = [[] for _ in range(6)]

    def made() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in columns], names=[*_TEXT, "place", "seed", "hash", "times"]
        )
        for column in columns:
            column.clear()
        return batch

    for batch in batches:
        for row in range(batch.num_rows):
            t1, t2, packed, again = (batch.column(c)[row].as_py() for c in range(4))
            _, hashes = run_hashes(_hashed([unpack(packed)])[0])
            sizes = np.array([b["windows"] for b in again])
            place = np.concatenate([np.arange(b["place"], b["place"] + b["windows"]) for b in again])
            seeds, times = (np.repeat(np.array([b[c] for b in again]), sizes) for c in ("seed", "times"))
            found = (np.full(len(place), t1), np.full(len(place), t2), place.astype(np.int32),
                     seeds, hashes[place].view(np.int64), times)
            for column, part in zip(columns, found):
                column.append(part)
            if sum(map(len, columns[0])) >= 1 << 14:
                yield made()
    if columns[0]:
        yield made()


def covered(spans: list[dict]) -> list[tuple[int, int]]:
    """The words that repeated windows cover: starts and ends of stretches that do not touch."""
    stretches: list[list[int]] = []
    for span in sorted(spans, key=lambda s: s["place"]):
        start, end = span["place"], span["place"] + span["windows"] + WINDOW - 1
        if stretches and start <= stretches[-1][1]:
            stretches[-1][1] = max(stretches[-1][1], end)
        else:
            stretches.append([start, end])
    return [(a, b) for a, b in stretches]


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    span = pa.struct([("start", pa.int32()), ("words", pa.int32())])
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(span), pa.string())
    columns: list[list] = [[] for _ in kinds]
    size = 0

    def made() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)], names=[*_TEXT, "n_words", "spans", "kept"]
        )
        for column in columns:
            column.clear()
        return batch

    for batch in batches:
        for row in range(batch.num_rows):
            t1, t2, packed, spans = (batch.column(c)[row].as_py() for c in range(4))
            words = unpack(packed).split()
            kept, end, cut = [], 0, covered(spans or [])
            for start, stop in cut:
                kept += words[end:start]
                end = stop
            kept += words[end:]
            text = b" ".join(kept).decode("utf-8", "replace")
            shown = [{"start": a, "words": b - a} for a, b in cut]
            for column, cell in zip(columns, (t1, t2, len(words), shown, text)):
                column.append(cell)
            size += len(text)
            if size >= CHUNK_BYTES:
                yield made()
                size = 0
    if columns[0]:
        yield made()


def clean(df: DataFrame, text: str = "text") -> DataFrame:
    """Each different text by its digest: its words, the spans of repeated passages, what is kept."""
    on_paths, doubtful = repeated(df, text)
    texts = different_texts(df, text)
    again = (
        written(doubtful, "doubtful")
        .groupBy(*_TEXT)
        .agg(F.collect_list(F.struct("place", "windows", "seed", "times")).alias("again"))
    )
    windows = _map(
        texts.join(again, _TEXT).select(*_TEXT, "packed", "again"),
        _windows,
        "t1 long, t2 long, place int, seed long, hash long, times long",
    )
    counted = windows.groupBy("seed", "hash").agg(F.sum("times").alias("all")).filter("all > 1")
    verified = windows.filter("times = 1").join(counted.select("seed", "hash"), ["seed", "hash"])
    spans = (
        written(on_paths, "on_paths")
        .select(*_TEXT, "place", "windows")
        .unionByName(verified.select(*_TEXT, "place", F.lit(1).alias("windows")))
        .groupBy(*_TEXT)
        .agg(F.collect_list(F.struct("place", "windows")).alias("spans"))
    )
    return _map(
        texts.join(spans, _TEXT, "left").select(*_TEXT, "packed", "spans"),
        _cleaned,
        "t1 long, t2 long, n_words long, spans array<struct<start: int, words: int>>, kept string",
    )


def remove(df: DataFrame, key: str = "doc_id", text: str = "text", result: list | None = None) -> DataFrame:
    """For each row of ``df`` its key and what ``result`` makes of ``clean`` (by default spans and kept text)."""
    result = result or ["n_words", "spans", "kept"]
    cleaned = clean(df, text).select(*_TEXT, *result)
    return keyed(df, key, text).join(cleaned, _TEXT).drop(*_TEXT).withColumnRenamed("key", key)
