"""Near-duplicates by Order MinHash, verified by banded alignment.

Words are what stands between white space. A text's k-mers are its windows of five words, each
labelled with its occurrence (the first, second, ... of its kind). For each of ``SKETCHES`` hashes the
``SAMPLED`` smallest labelled k-mers, in the order of the text, make one value. Two texts share a value
if the same k-mers are smallest and come in the same order, which is likely for a small edit distance
and unlikely for a shuffled text; at a similarity of 0.8 all values differ for one pair of long texts in
10 million, but for one in 1,260 where two texts have five different windows between them, and for one
in 430,000 where they have ten.

Similarity of two texts: of the labelled k-mers, those that an alignment of the two sequences pairs in
order, divided by those in either text. Texts are near-duplicates from 0.8 on. An alignment that good
leaves at most a ninth of both sequences unpaired, so it stays in a band of that width around the
diagonal; within the band the longest common subsequence is computed. A text with fewer than five
words has one k-mer, all its words.

Texts with the same words are one node, by a digest of 128 bits. Nodes that share a value are in one
bucket. In a bucket everything is compared with its hub, the node that shares most buckets with
others: a group of copies of any size costs as many comparisons as it has members, no pairs are
formed. Nodes that a hub links are one class (connected components, by joins). Hubs that have been
compared leave their buckets; buckets that still hold several classes get a new hub, and rounds go on
until one finds no link any more.

Buckets that hold several classes even then are compared in full, without forming their pairs, by an
exact filter on prefixes: with the k-mers of each node in one order for all, rarest first, two nodes of
0.8 share a k-mer that has as many k-mers from it on, in both, as they must pair. K-mers of one class
only come first and drop out; of those in several classes only such rare ones meet.

Defined results: null, empty and blank texts have no words and are copies of each other; repeated rows
are copies; of a class the smallest id names it and its first row stays (a null id comes last); an empty
table gives an empty table; ``classes`` leaves other columns out, ``keep_one`` keeps them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake.llm.common import BoundedCache, in_one, map_batches, out_of_one, small_batches
from tunelake.session import ship_package, written

WORDS, SIMILARITY = 5, 0.8
SKETCHES, SAMPLED = 32, 4
#: Words whose hash a worker keeps, and k-mers that are hashed at a time.
CACHED_WORDS, AT_ONCE = 100_000, 1 << 13

_ODD = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xBF58476D1CE4E5B9)
_SEEDS = np.arange(1, SKETCHES + 1, dtype=np.uint64) * _OTHER


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _ODD
    x ^= x >> np.uint64(31)
    x *= _OTHER
    x ^= x >> np.uint64(29)
    return x


@lru_cache(maxsize=1)
def _word_hashes() -> BoundedCache:
    return BoundedCache(
        lambda word: xxhash.xxh32_intdigest(word.encode("utf-8", "replace")), CACHED_WORDS, 64
    )


def _forget() -> None:
    _word_hashes.cache_clear()


def word_ids(text: str | None) -> np.ndarray:
    """A 32-bit hash of each word."""
    words = (text or "").split()
    return np.fromiter(map(_word_hashes().__getitem__, words), np.uint32, len(words))


def labelled_kmers(words: np.ndarray) -> np.ndarray:
    """Hashes of the windows of five words with their occurrence; they differ within a text."""
    if not len(words):
        return np.zeros(0, np.uint64)
    width = min(WORDS, len(words))
    wide = words.astype(np.uint64)
    kmers = np.full(len(words) - width + 1, width, np.uint64)
    for place in range(width):
        kmers += _mix(wide[place : len(words) - width + 1 + place] + _SEEDS[place])
    kmers = _mix(kmers)
    order = np.argsort(kmers, kind="stable")
    in_order = kmers[order]
    again = np.concatenate([[False], in_order[1:] == in_order[:-1]])
    if again.any():
        at = np.arange(len(kmers))
        occurrence = at - np.maximum.accumulate(np.where(again, 0, at))
        kmers[order] = _mix(in_order + occurrence.astype(np.uint64) * _OTHER)
    return kmers


def sketch(kmers: np.ndarray) -> np.ndarray:
    """One value for each hash, from the smallest k-mers in the order of the text."""
    count = min(SAMPLED, len(kmers))
    if not count:
        return np.zeros(SKETCHES, np.int64)
    least = np.zeros((SKETCHES, 0), np.uint64)
    places = np.zeros((SKETCHES, 0), np.int64)
    for start in range(0, len(kmers), AT_ONCE):  # part by part: memory does not grow with the text
        hashed = _mix(kmers[None, start : start + AT_ONCE] ^ _SEEDS[:, None])
        kept = min(count, hashed.shape[1])
        chosen = np.argpartition(hashed, kept - 1, axis=1)[:, :kept]
        least = np.concatenate([least, np.take_along_axis(hashed, chosen, 1)], axis=1)
        places = np.concatenate([places, chosen + start], axis=1)
        if least.shape[1] > count:
            best = np.argpartition(least, count - 1, axis=1)[:, :count]
            least = np.take_along_axis(least, best, 1)
            places = np.take_along_axis(places, best, 1)
    in_text = kmers[np.sort(places, axis=1)]
    value = np.arange(SKETCHES, dtype=np.uint64) * _ODD  # a value belongs to its hash
    for place in range(count):
        value = _mix(value + in_text[:, place])
    return value.astype(np.int64)


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Similarity of two sequences of labelled k-mers; 0.0 where it is below ``least``."""
    both = len(a) + len(b)
    if not both:
        return 1.0
    needed = least * both / (1 + least) - 1e-9
    if min(len(a), len(b)) < needed:
        return 0.0
    _, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(in_a) < needed:
        return 0.0
    band = both - 2 * needed + 1
    inside = np.abs(in_a - in_b) <= band
    order = np.argsort(in_a[inside])
    positions = in_b[inside][order]
    if len(positions) and (np.diff(positions) < 0).any():
        tails: list[int] = []  # smallest ends of rising runs, by length
        for position in positions.tolist():
            at = bisect_left(tails, position)
            tails[at : at + 1] = [position]
        paired = len(tails)
    else:
        paired = len(positions)
    return paired / (both - paired) if paired >= needed else 0.0


def _digest(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "replace"))


def _with_digest(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``_digest`` of its words."""
    kept = list(df.columns)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests = [_digest((value or "").split()) for value in batch.column(text).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(digests, pa.binary())],
            names=[*kept, "_digest"],
        )

    return map_batches(df, run, T.StructType([*df.schema.fields, T.StructField("_digest", T.BinaryType())]), _forget)


def _sketched(df: DataFrame, key: str, text: str) -> DataFrame:
    """For each row its id, digest and sketch."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests, sketches = [], []
        for value in batch.column(1).to_pylist():
            digests.append(_digest((value or "").split()))
            sketches.append(sketch(labelled_kmers(word_ids(value))))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(digests, pa.binary()),
             pa.array(sketches, pa.list_(pa.int64()))],
            names=["id", "digest", "sketch"],
        )

    return map_batches(
        df.select(F.col(key).cast("long"), F.col(text)),
        run,
        "id long, digest binary, sketch array<long>",
        _forget,
    )


def _sequences(df: DataFrame, text: str) -> DataFrame:
    """Digest and word hashes of each row with words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [value for value in batch.column(0).to_pylist() if value and not value.isspace()]
        return pa.RecordBatch.from_arrays(
            [pa.array([_digest(t.split()) for t in texts], pa.binary()),
             pa.array([word_ids(t).tobytes() for t in texts], pa.binary())],
            names=["digest", "words"],
        )

    return map_batches(df.select(text), run, "digest binary, words binary", _forget)


def _buckets(nodes: DataFrame) -> DataFrame:
    """``bucket``, ``node`` for every value that two nodes share, and ``weight`` of the node.

    The weight is the number of nodes in all its buckets.
    """
    values = nodes.filter(~F.forall("sketch", lambda v: v == 0)).select(
        "node", F.explode("sketch").alias("bucket")
    )
    shared = values.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    # Written first: a join of two tables can be split where one bucket is large, one with an
    # aggregate under it cannot.
    members = written(values.join(written(shared, "shared"), "bucket"), "buckets")
    weights = members.groupBy(F.col("node").alias("_n")).agg(F.sum("size").alias("weight"))
    return written(
        members.join(weights, F.col("node") == F.col("_n")).select("bucket", "node", "weight"),
        "members",
    )


def _linked(pairs: DataFrame, sequences: DataFrame) -> DataFrame:
    """Those of the ``pairs`` (a, b) that are similar enough, by their ``sequences`` (node, words)."""
    of_a = sequences.select(F.col("node").alias("a"), F.col("words").alias("words_a"))
    of_b = sequences.select(F.col("node").alias("b"), F.col("words").alias("words_b"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        similar = [
            aligned(*(labelled_kmers(np.frombuffer(w, np.uint32)) for w in words)) >= SIMILARITY
            for words in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        ]
        chosen = batch.filter(pa.array(similar, pa.bool_()))
        return pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1)], names=["a", "b"])

    joined = pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "words_a", "words_b")
    return map_batches(joined, run, "a long, b long", _forget)


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``node`` and ``label``, the smallest node that links lead to, for all nodes with links.

    Smallest labels pass over the links, and labels are replaced by their own label, until nothing
    changes: a few rounds for the flat groups that hubs make. ``labels``: known labels to start from.
    """
    edges = links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    if labels is not None:
        known = labels.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
        edges = edges.unionByName(known).unionByName(
            known.select(F.col("b").alias("a"), F.col("a").alias("b"))
        )
    edges = written(edges.distinct(), "edges")
    current = written(
        edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")),
        "labels",
    )
    while True:
        of = current.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
        passed = (
            edges.join(of, F.col("b") == F.col("_node"))
            .groupBy("a")
            .agg(F.min("_label").alias("least"))
        )
        lower = current.join(passed, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("before"), F.least("label", "least").alias("via")
        )
        following = written(
            lower.join(of, F.col("via") == F.col("_node")).select(
                "node", F.least("via", "_label").alias("label"), "before"
            ),
            "labels",
        )
        changed = not following.filter("label <> before").isEmpty()
        current = following.select("node", "label")
        if not changed:
            return current


def _kmers(nodes: DataFrame, sequences: DataFrame) -> DataFrame:
    """For each labelled k-mer of the ``nodes`` (node, label): ``node``, ``label``, ``size``, ``kmer``."""
    ship_package(nodes.sparkSession)
    names = ["node", "label", "size", "kmer"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, label, words in zip(*(column.to_pylist() for column in batch.columns)):
                found = labelled_kmers(np.frombuffer(words, np.uint32)).astype(np.int64)
                for start in range(0, len(found), AT_ONCE):
                    part = found[start : start + AT_ONCE]
                    same = (np.full(len(part), x, np.int64) for x in (node, label, len(found)))
                    yield pa.RecordBatch.from_arrays([*map(pa.array, (*same, part))], names=names)

    return (
        sequences.join(nodes, "node")
        .select("node", "label", "words")
        .mapInArrow(lambda batches: run(small_batches(batches)), "node long, label long, size long, kmer long")
    )


def _near_by_prefix(nodes: DataFrame, sequences: DataFrame) -> DataFrame:
    """Pairs (a, b) of the ``nodes`` (node, label), among them all similar ones of different labels."""
    kmers = _kmers(nodes, sequences)
    often = (
        kmers.groupBy("kmer")
        .agg(F.count(F.lit(1)).alias("often"), F.min("label").alias("_low"), F.max("label").alias("_high"))
        .filter("_low <> _high")
        .select(F.col("kmer").alias("_k"), "often")
    )
    # Written first, so that the join can be split where a k-mer is in very many nodes.
    shared = kmers.join(written(often, "often"), F.col("kmer") == F.col("_k"))
    # ``onward``: k-mers of the node from this one on, of which a pair may share no more.
    order = Window.partitionBy("node").orderBy(F.desc("often"), "kmer")
    ends = written(
        shared.withColumn("onward", F.row_number().over(order).cast("long"))
        .filter(F.col("onward") >= F.lit(SIMILARITY) * F.col("size") - 1e-6)
        .select("node", "label", "size", "kmer", "onward"),
        "prefixes",
    )
    part = 2 * SIMILARITY / (1 + SIMILARITY)
    small, large = (
        ends.select(
            "kmer", *(F.col(c).alias(f"{c}_{side}") for c in ("node", "label", "size", "onward"))
        )
        for side in ("a", "b")
    )
    needed = F.lit(part / 2) * (F.col("size_a") + F.col("size_b")) - 1e-6
    first = (F.col("size_a") < F.col("size_b")) | (
        (F.col("size_a") == F.col("size_b")) & (F.col("node_a") < F.col("node_b"))
    )
    return (
        small.filter(F.col("onward_a") >= F.lit(part) * F.col("size_a") - 1e-6)
        .join(large, "kmer")
        .filter(first & (F.col("label_a") != F.col("label_b")))
        .filter(F.least("onward_a", "onward_b") >= needed)
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        .distinct()
    )


def _nodes(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, digest); nodes (node, digest, first id, sketch)."""
    rows = written(_sketched(df, key, text), "sketched")
    nodes = rows.groupBy("digest").agg(
        F.min("id").alias("first"), F.any_value("sketch").alias("sketch")
    )
    return rows.select("id", "digest"), written(
        nodes.withColumn("node", F.monotonically_increasing_id()), "nodes"
    )


def _rest_compared(rest: DataFrame, sequences: DataFrame, labels: DataFrame | None) -> DataFrame | None:
    """``labels`` with the links inside the buckets of ``rest`` that hold several classes."""
    several = (
        rest.groupBy(F.col("bucket").alias("_b"))
        .agg(F.min("label").alias("_low"), F.max("label").alias("_high"))
        .filter("_low <> _high")
    )
    # Written first, as the hubs are.
    several = written(several.select("_b"), "several")
    left = written(
        rest.join(several, F.col("bucket") == F.col("_b")).select("node", "label").distinct(), "left"
    )
    if left.isEmpty():
        return labels
    pairs = written(_near_by_prefix(left, sequences), "pairs")
    links = written(_linked(pairs, sequences), "links")
    return labels if links.isEmpty() else components(links, labels)


def _classes_of_nodes(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, digest); digest, its first id, class id and whether the digest stays for its class."""
    rows, nodes = _nodes(df, key, text)
    members = _buckets(nodes)
    named = nodes.select("node", "digest")
    wanted = named.join(members.select("node").distinct(), "node")
    sequences = written(
        _sequences(df, text)
        .groupBy("digest")
        .agg(F.any_value("words").alias("words"))
        .join(wanted, "digest")
        .select("node", "words"),
        "sequences",
    )
    labels: DataFrame | None = None
    compared: DataFrame | None = None
    while True:
        if labels is None:
            state = members.withColumn("label", F.col("node"))
        else:
            of = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
            state = members.join(of, F.col("node") == F.col("_n"), "left").select(
                "bucket", "node", "weight", F.coalesce("_l", "node").alias("label")
            )
        hubs = (
            state.groupBy("bucket")
            .agg(
                F.max(F.struct("weight", "node", "label")).alias("hub"),
                F.min("label").alias("_low"),
                F.max("label").alias("_high"),
            )
            .filter("_low <> _high")
            .select(F.col("bucket").alias("_b"), "hub")
        )
        state = written(
            state.join(written(hubs, "hubs"), F.col("bucket") == F.col("_b")).drop("_b"), "rounds"
        )
        rest = state.filter(F.col("node") != F.col("hub.node"))
        pairs = (
            rest.filter(F.col("label") != F.col("hub.label"))
            .select(F.col("hub.node").alias("a"), F.col("node").alias("b"))
            .distinct()
        )
        if compared is not None:
            for one, other in (("a", "b"), ("b", "a")):
                done = compared.select(F.col(one).alias("_a"), F.col(other).alias("_b"))
                pairs = pairs.join(
                    done, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left_anti"
                )
        pairs = written(pairs, "pairs")
        links = written(_linked(pairs, sequences), "links")
        if links.isEmpty():
            labels = _rest_compared(rest, sequences, labels)
            break
        labels = components(links, labels)
        compared = pairs if compared is None else compared.unionByName(pairs)
        members = rest.select("bucket", "node", "weight")
    if labels is None:
        labelled = nodes.withColumn("label", F.col("node"))
    else:
        of = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        labelled = nodes.join(of, F.col("node") == F.col("_n"), "left").withColumn(
            "label", F.coalesce("_l", "node")
        )
    labelled = labelled.select("digest", "first", "label", "node")
    # The first id names the class; nulls last, and the node settles ties.
    order = F.struct(F.col("first").isNull(), F.col("first"), F.col("node"))
    leaders = labelled.groupBy(F.col("label").alias("_of")).agg(
        F.min("first").alias("class_id"), F.min(order).alias("_least")
    )
    return rows, written(
        labelled.join(leaders, F.col("label") == F.col("_of")).select(
            "digest", "first", "class_id", (F.col("node") == F.col("_least.node")).alias("stays")
        ),
        "classes",
    )


def classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row its id and ``class_id``, the smallest id among its copies and near-copies."""
    rows, found = _classes_of_nodes(df, key, text)
    return rows.join(found.select("digest", "class_id"), "digest").select(
        F.col("id").alias(key), "class_id"
    )


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class: the one that names it; of rows with that id and text, any one."""
    _, found = _classes_of_nodes(df, key, text)
    staying = found.filter("stays").select(F.col("digest").alias("_d"), F.col("first").alias("_first"))
    others = [c for c in df.columns if c != text]
    rows = df.select(in_one(others), F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    same = (F.col("_digest") == F.col("_d")) & F.col("id").eqNullSafe(F.col("_first"))
    # At most the rows that repeat an id and a text meet here; one of them is kept.
    single = _with_digest(rows, "text").join(staying, same).dropDuplicates(["_digest"])
    return single.select(*out_of_one(df.columns, text=text))
