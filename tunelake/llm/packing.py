"""Best-fit packing of documents into token sequences, after a Martello-Toth reduction.

Lengths are whole numbers up to the sequence length, so the instance is the number of pieces of each
length: a table of at most ``capacity`` rows, however many documents there are. It alone goes to the
driver. There the reduction fixes sets that dominate every other set holding their longest piece:

- a piece that nothing left fits beside is alone;
- two pieces that fill a sequence exactly: whatever else could stand beside the one fits in the place
  of the other;
- where one further piece at most fits beside the longest, the longest that fits;
- where two at most fit, the longest single one or the best pair, if it dominates all other choices.

Each fixing removes pieces and leaves an instance with an optimum smaller by exactly the fixed
sequences. What remains is packed by best fit, longest first, equal pieces together. The plan is a
list of runs: pieces of one length from one number to another go to sequences from one number on. It
has a few thousand runs at any scale (a run at least halves the room left in its sequences). Rows find
their place by (length, number within the length); a frequent length is numbered in many salted parts.

Defined results: a null text counts as empty, and an empty document is its end token alone; repeated
rows are packed each for itself; ties (pieces of one length) go in the order in which rows were read;
an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tunelake.llm.common import give_back, small_batches
from tunelake.session import ship_package, written

CAPACITY, END_ID = 4096, 1
#: Rows of one length that are numbered together.
NUMBERED_TOGETHER = 2000
#: Words that a worker remembers, the longest one, and the characters that are worked on at a time.
CACHED_WORDS, LONGEST_WORD, CHARACTERS = 600_000, 48, 2_000_000

# Characters that normalisation leaves alone but for lower case, with plain white space between them.
_SPECIAL = re.compile("[^\t\n\r -~¡-¬®-įı-ɏ‐-‧€]")


class WordTokens:
    """Ids of whole texts as little-endian unsigned 32-bit numbers.

    The tokenizer never joins characters across white space, so stretches between white space are
    encoded once and remembered; new ones go to the library many at a time. Texts with characters
    outside a plain range, or with the strings of special tokens, go to the library whole.
    """

    def __init__(self, file: str, cached_words: int = CACHED_WORDS) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._tokenizer = Tokenizer.from_file(file)
        special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._reserved = [content.lower() for content in special]
        self._divider = special[-1]
        self._divider_id = self._tokenizer.token_to_id(self._divider)
        suffix = self._tokenizer.model.end_of_word_suffix
        vocabulary = self._tokenizer.get_vocab()
        self._ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._known: dict[str, bytes] = {}
        self._cached_words = cached_words

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _cut_at(self, words: list[str], joined: str, dividers: bool) -> dict[str, bytes]:
        """The library's ids of ``joined``, cut into those of its ``words``.

        At the tokens that end a word; or at the special tokens between words, which are dropped.
        """
        if not words:
            return {}
        encoded = self._tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0]
        ids = np.array(encoded.ids, "<u4")
        if dividers:
            ends = [*np.flatnonzero(ids == self._divider_id).tolist(), len(ids)]
            starts = [0, *(end + 1 for end in ends[:-1])]
        else:
            ends = (np.flatnonzero(self._ends_word[ids]) + 1).tolist()
            starts = [0, *ends[:-1]]
        if len(ends) != len(words):
            raise ValueError("the tokenizer joins characters across words")
        raw = ids.tobytes()
        return {w: raw[4 * start : 4 * end] for w, start, end in zip(words, starts, ends)}

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of new words.

        Letters with marks behind them are two parts for the tokenizer, so only the letters may be
        new. Words of letters are told apart by the tokens that end them, others by a special token.
        """
        known, learnt = self._known, {}
        letters, others, joined = set(), set(), []
        for word in words:
            core = word.rstrip(string.punctuation)
            if not core.isalpha():
                others.add(word)
                continue
            if core not in known:
                letters.add(core)
            if core != word:
                joined.append((word, core))
                if (marks := word[len(core) :]) not in known:
                    others.add(marks)
        letters, others = list(letters), list(others)
        learnt = self._cut_at(letters, " ".join(letters), False)
        learnt |= self._cut_at(others, self._divider.join(others), True)
        for word, core in joined:
            marks = word[len(core) :]
            learnt[word] = (learnt.get(core) or known[core]) + (learnt.get(marks) or known[marks])
        return learnt

    def encode(self, texts: list[str]) -> list[bytes]:
        plain: list[list[str] | None] = []
        new: set[str] = set()
        for text in texts:
            lower = text.lower()
            if _SPECIAL.search(text) or any(s in lower for s in self._reserved):
                plain.append(None)
                continue
            words = lower.split()
            plain.append(words)
            new.update(set(words).difference(self._known))
        learnt = self._learn(new)
        if len(self._known) + len(learnt) > self._cached_words:
            used = {w for words in plain if words for w in words}
            self._known = {w: self._known[w] for w in used.intersection(self._known)}
        self._known.update(learnt)
        ids = [b"".join(map(self._known.__getitem__, w)) if w is not None else b"" for w in plain]
        others = [i for i, words in enumerate(plain) if words is None]
        for i, raw in zip(others, self._library([texts[i] for i in others])):
            ids[i] = raw
        for word in [w for w in learnt if len(w) > LONGEST_WORD]:
            del self._known[word]
        return ids


@lru_cache(maxsize=1)
def _worker_tokens(file: str, cached_words: int) -> WordTokens:
    return WordTokens(file, cached_words)


def _portions(texts: list[str], characters: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about so many characters."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= characters:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def token_pieces(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer_file: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    cached_words: int = CACHED_WORDS,
    release: bool = False,
    characters: int = CHARACTERS,
) -> DataFrame:
    """One row for each piece: key, piece, start, length, ids (little-endian unsigned 32 bit).

    A worker keeps the ids of ``cached_words`` words, about 250 bytes each, and works on ``characters`` of
    text at a time, which take about 60 bytes each when their words are new: fewer take longer. With
    ``release`` it gives them and the tokenizer up after each task, for jobs that follow in the same
    workers.
    """
    file = tokenizer_file or public_tokenizers.path("word_bpe_49k.json")
    schema = T.StructType(
        [
            df.schema[key],
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    end = np.array([end_id], "<u4").tobytes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens = _worker_tokens(file, cached_words)
        texts = [value or "" for value in batch.column(text).to_pylist()]
        rows, pieces, starts, lengths, ids = [], [], [], [], []
        for low, high in _portions(texts, characters):
            for row, raw in enumerate(tokens.encode(texts[low:high]), low):
                raw += end
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    ids.append(part)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(key).take(pa.array(rows, pa.int64())),
                pa.array(pieces, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(ids, pa.binary()),
            ],
            names=[key, "piece", "start", "length", "ids"],
        )

    def run_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(run, small_batches(batches))
        if release:
            _worker_tokens.cache_clear()
            give_back()

    ship_package(df.sparkSession)
    return df.select(F.col(key), F.col(text)).mapInArrow(run_task, schema)


@dataclass(frozen=True)
class Run:
    """Pieces ``first`` to ``first + count - 1`` of a length: ``each`` to a sequence from ``sequence``."""

    length: int
    first: int
    count: int
    sequence: int
    each: int
    offset: int


class _Plan:
    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.left = {s: n for s, n in counts.items() if n}
        self.used = dict.fromkeys(counts, 0)
        self.sequences = 0
        self.runs: list[Run] = []

    def put(self, length: int, count: int, sequence: int, each: int, offset: int) -> None:
        self.runs.append(Run(length, self.used[length], count, sequence, each, offset))
        self.used[length] += count
        self.left[length] -= count
        if not self.left[length]:
            del self.left[length]

    def fix(self, lengths: tuple[int, ...], times: int) -> None:
        """``times`` sequences that each hold these lengths."""
        offset = 0
        for length in lengths:
            self.put(length, times, self.sequences, 1, offset)
            offset += length
        self.sequences += times

    def times(self, lengths: tuple[int, ...]) -> int:
        """How often the lengths can be taken together from what is left."""
        return min(self.left.get(s, 0) // lengths.count(s) for s in lengths)


def _dominating_pair(left: list[int], room: int, single: int) -> tuple[int, ...] | None:
    """The set that dominates all sets of one or two lengths within ``room``, if there is one.

    ``left``: what is left, shortest first, a length twice if it is there twice or more. ``single``:
    the longest that fits alone.
    """
    best_sum = second_most = 0
    low, high = 0, len(left) - 1
    while low < high:
        total = left[low] + left[high]
        if total > room:
            high -= 1
            continue
        best_sum, second_most = max(best_sum, total), max(second_most, left[low])
        low += 1
    if best_sum <= single:
        return (single,)
    beside = [s for s in left if s <= room - single]
    if left.count(single) == 1 and single in beside:
        beside.remove(single)
    if beside and beside[-1] >= second_most:
        return (single, beside[-1])
    return None


def reduce_by_dominance(plan: _Plan) -> None:
    """Fix the sets that provably dominate all others with the same longest piece."""
    capacity = plan.capacity
    for length in sorted(plan.left, reverse=True):
        if length == capacity:
            plan.fix((length,), plan.left[length])
        elif 2 * length >= capacity:
            if n := plan.times((length, capacity - length)):
                plan.fix((length, capacity - length), n)
    while plan.left:
        lengths = sorted(plan.left)
        longest = lengths[-1]
        room = capacity - longest
        rest = [s for s in lengths for _ in range(min(plan.left[s] - (s == longest), 3))]
        fitting = [s for s in rest if s <= room]
        if not fitting:
            plan.fix((longest,), plan.left[longest])
            continue
        if sum(fitting[:3]) <= room and len(fitting) > 2:
            return  # three further pieces could stand beside it: no bound on the sets to compare
        if len(fitting) == 1 or sum(fitting[:2]) > room:
            chosen: tuple[int, ...] | None = (fitting[-1],)
        else:
            chosen = _dominating_pair(fitting, room, fitting[-1])
        if chosen is None:
            return
        # Once for each round where the counts can change the choice; else as often as possible.
        alike = all(plan.left[s] > 3 for s in {longest, *chosen, *lengths[:3]})
        plan.fix((longest, *chosen), max(1, plan.times((longest, *chosen)) - 3) if alike else 1)


def best_fit(plan: _Plan) -> None:
    """Pack what is left, longest first, each piece where it leaves the least room."""
    capacity = plan.capacity
    open_by_room: dict[int, list[tuple[int, int]]] = {}  # room: runs of sequences (first, count)
    rooms = 0  # bitmap of the rooms that any open sequence has

    def keep(room: int, first: int, count: int) -> None:
        nonlocal rooms
        if room and count:
            open_by_room.setdefault(room, []).append((first, count))
            rooms |= 1 << room

    for length in sorted(plan.left, reverse=True):
        while waiting := plan.left.get(length, 0):
            enough = rooms >> length << length
            if enough:
                room = (enough & -enough).bit_length() - 1
                first, count = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room]
                    rooms ^= 1 << room
            else:
                room, each = capacity, capacity // length
                first, count = plan.sequences, -(-waiting // each)
                plan.sequences += count
            each = room // length
            filled = min(count, waiting // each)
            if filled:
                plan.put(length, filled * each, first, each, capacity - room)
                keep(room - each * length, first, filled)
            rest = 0
            if filled < count and (rest := min(plan.left.get(length, 0), each)):
                plan.put(length, rest, first + filled, rest, capacity - room)
                keep(room - rest * length, first + filled, 1)
            keep(room, first + filled + (rest > 0), count - filled - (rest > 0))


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """Where the pieces of each length go, and the number of sequences."""
    plan = _Plan(counts, capacity)
    reduce_by_dominance(plan)
    best_fit(plan)
    return plan.runs, plan.sequences


def _numbered(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Add ``_number``: 0, 1, 2 … within a length, a frequent length in many parts."""
    spark = pieces.sparkSession
    parts = spark.createDataFrame(
        [(s, -(-n // NUMBERED_TOGETHER)) for s, n in counts.items()], "_s long, _parts long"
    )
    # One row for each length, at most as many as a sequence has tokens.
    salted = pieces.join(F.broadcast(parts), F.col("length") == F.col("_s")).withColumn(
        "_part", F.pmod(F.xxhash64("_row"), "_parts")
    )
    sizes = salted.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        F.col("length").alias("_s"),
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
    )
    within = Window.partitionBy("length", "_part").orderBy("_row")
    return (
        salted.drop("_s", "_parts")
        .withColumn("_within", F.row_number().over(within) - 1)
        .join(bases, (F.col("length") == F.col("_s")) & (F.col("_part") == F.col("_p")))
        .withColumn("_number", F.col("_within") + F.col("_base"))
        .drop("_s", "_p", "_part", "_within", "_base")
    )


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length`` and a unique ``_row``) with ``sequence_id`` and ``offset``."""
    ship_package(pieces.sparkSession)
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, _ = plan_packing(counts, capacity)
    runs = sorted(runs, key=lambda r: (r.length, r.first))
    starts = np.array([(r.length << 44) + r.first for r in runs], np.int64)
    columns = np.array(
        [(r.first, r.sequence, r.each, r.offset) for r in runs], np.int64
    ).reshape(-1, 4).T
    plan = pieces.sparkSession.sparkContext.broadcast((starts, columns))

    @F.pandas_udf("sequence_id long, offset long")
    def find(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        starts, (first, sequence, each, offset) = plan.value
        size, nth = length.to_numpy(np.int64), number.to_numpy(np.int64)
        run = np.searchsorted(starts, (size << 44) + nth, side="right") - 1
        past = nth - first[run]
        return pd.DataFrame(
            {
                "sequence_id": sequence[run] + past // each[run],
                "offset": offset[run] + past % each[run] * size,
            }
        )

    return (
        _numbered(pieces, counts)
        .withColumn("_place", find("length", "_number"))
        .select(
            *[c for c in pieces.columns if c != "_row"],
            F.col("_place.sequence_id").alias("sequence_id"),
            F.col("_place.offset").alias("offset"),
        )
    )


def store_pieces(df: DataFrame, **options) -> DataFrame:
    """The pieces with their ids, written once to the shared folder, with a unique ``_row``."""
    pieces = token_pieces(df, **options).withColumn("_row", F.monotonically_increasing_id())
    return written(pieces, "pieces")


def pack(df: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, **options) -> DataFrame:
    """Where each piece of each document goes, with a digest of its ids.

    The ids themselves stay in the stored pieces; the numbering moves the digest only.
    """
    pieces = store_pieces(df, key=key, capacity=capacity, **options)
    slim = pieces.select(
        key, "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "_row"
    )
    return place(slim, capacity)
