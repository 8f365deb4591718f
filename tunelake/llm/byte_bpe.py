"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is cut into pre-tokens by a pattern; each one is merged on its own. Its symbols are a linked
list over byte positions. Every adjacent pair that the vocabulary can merge waits in the bucket of its
merge rank. Two levels of bitmaps say which buckets hold anything; find-first-set gives the lowest
rank, and its leftmost position goes first. An entry whose pair has changed meanwhile is stale and is
skipped. A pre-token of n bytes costs O(n log n), also when it is a megabyte without a space.

Defined results: a null text counts as empty and has no ids; rows are independent, so repeated rows
and ties give equal results; an empty table gives an empty table; other columns are left out by
``round_trip`` and kept by ``encode`` and ``decode``.
"""

from __future__ import annotations

import base64
import hashlib
import string
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake.llm.common import BoundedCache, map_batches

#: Entries that a worker keeps for stretches between spaces and for pre-tokens, and the longest kept.
CACHED_STRETCHES, CACHED_PIECES, CACHE_LONGEST = 900_000, 500_000, 48

def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: always the lowest-ranked pair first, the leftmost among equals.

    A bucket is a position, or a heap of positions once it has had two.
    """
    size, rank_of = len(piece), ranks.get
    ends = list(range(1, size + 1))  # where the symbol that starts here ends: the next one's start
    starts = list(range(-1, size))  # the start of the symbol before
    waiting = [rank_of(piece[at : at + 2], -1) for at in range(size - 1)]  # of the pair from here on
    waiting.append(-1)
    buckets: dict[int, int | list[int]] = {}
    words: dict[int, int] = {}  # bitmaps of the filled buckets, for 256 ranks each
    top = 0  # bitmap of the words that are not zero

    def push(rank: int, at: int) -> None:
        nonlocal top
        bucket = buckets.get(rank)
        if bucket is None:
            buckets[rank] = at
            word = rank >> 8
            words[word] = words.get(word, 0) | 1 << (rank & 255)
            top |= 1 << word
        elif type(bucket) is int:
            buckets[rank] = [bucket, at] if bucket < at else [at, bucket]
        else:
            heappush(bucket, at)

    for at, rank in enumerate(waiting):
        if rank >= 0:
            push(rank, at)
    while top:
        word = (top & -top).bit_length() - 1
        bits = words[word]
        low = bits & -bits
        rank = word << 8 | low.bit_length() - 1
        bucket = buckets[rank]
        if type(bucket) is int:
            at = bucket
            del buckets[rank]
            words[word] = bits = bits ^ low
            if not bits:
                top ^= 1 << word
        else:
            at = heappop(bucket)
            if not bucket:
                del buckets[rank]
                words[word] = bits = bits ^ low
                if not bits:
                    top ^= 1 << word
        if waiting[at] != rank:
            continue  # stale
        gone = ends[at]
        end = ends[at] = ends[gone]
        waiting[gone] = -1
        before = starts[at]
        if before >= 0:
            rank = waiting[before] = rank_of(piece[before:end], -1)
            if rank >= 0:
                push(rank, before)
        if end < size:
            starts[end] = at
            rank = waiting[at] = rank_of(piece[at : ends[end]], -1)
            if rank >= 0:
                push(rank, at)
        else:
            waiting[at] = -1
    ids, at = [], 0
    while at < size:
        ids.append(ranks[piece[at : ends[at]]])
        at = ends[at]
    return ids


class _NotAlone(Exception):
    """A stretch after a space starts with white space: its cut depends on what stands before."""


class ByteBpe:
    """Encoder and decoder over one rank file."""

    def __init__(self, rank_file: str, pattern: str) -> None:
        with open(rank_file, "rb") as file:
            pairs = (line.split() for line in file if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self._cut = regex.compile(pattern).findall
        self._plain = pattern == public_tokenizers.PATTERN
        self._pieces = BoundedCache(self._piece, CACHED_PIECES, CACHE_LONGEST)
        self._stretches = BoundedCache(self._stretch, CACHED_STRETCHES, CACHE_LONGEST)

    def _piece(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        rank = self.ranks.get(raw)
        return (rank,) if rank is not None else tuple(merge(raw, self.ranks))

    def _whole(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self._pieces.__getitem__, self._cut(text))))

    def _stretch(self, stretch: str) -> tuple[int, ...]:
        if not stretch or stretch[0].isspace():
            raise _NotAlone
        word = stretch.rstrip(string.punctuation)
        if self._plain and word.isalpha():  # a word is one pre-token, marks behind it are another
            ids = self._pieces[" " + word]
            return ids if word == stretch else ids + self._pieces[stretch[len(word) :]]
        return tuple(self._whole(" " + stretch))

    def encode(self, text: str) -> list[int]:
        """Ids of the whole text.

        The pattern always cuts before a space that a character other than white space follows, so
        such stretches can be encoded one by one and remembered. A text with any other space is cut
        as a whole.
        """
        first, *stretches = text.split(" ")
        try:
            ids = self._whole(first)
            ids.extend(chain.from_iterable(map(self._stretches.__getitem__, stretches)))
            return ids
        except _NotAlone:
            return self._whole(text)

    def decode(self, ids) -> bytes:
        """The bytes that the ids stand for; an unknown id is an error."""
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def _worker_bpe(rank_file: str, pattern: str) -> ByteBpe:
    return ByteBpe(rank_file, pattern)


def _default_file() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode(
    df: DataFrame,
    text: str = "text",
    into: str = "ids",
    rank_file: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``df`` with the token ids of ``text``; a column named ``into`` is replaced."""
    rank_file = rank_file or _default_file()
    kept = [name for name in df.columns if name != into]
    schema = T.StructType([df.schema[name] for name in kept]).add(into, T.ArrayType(T.IntegerType()))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = _worker_bpe(rank_file, pattern)
        ids = [bpe.encode(value or "") for value in batch.column(text).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in kept), pa.array(ids, pa.list_(pa.int32()))],
            names=[*kept, into],
        )

    return map_batches(df, run, schema)


def decode(
    df: DataFrame,
    ids: str = "ids",
    into: str = "decoded",
    rank_file: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``df`` with the bytes of the token ids in ``ids``; a column named ``into`` is replaced."""
    rank_file = rank_file or _default_file()
    kept = [name for name in df.columns if name != into]
    schema = T.StructType([df.schema[name] for name in kept]).add(into, T.BinaryType())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = _worker_bpe(rank_file, pattern)
        texts = [bpe.decode(value or ()) for value in batch.column(ids).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in kept), pa.array(texts, pa.binary())],
            names=[*kept, into],
        )

    return map_batches(df, run, schema)


def round_trip(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    rank_file: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Encode every text, decode its ids, and give the number of ids and a digest of both.

    Ids and bytes stay in the worker that made them: only digests leave it.
    """
    rank_file = rank_file or _default_file()
    schema = T.StructType(
        [
            df.schema[key],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = _worker_bpe(rank_file, pattern)
        decimals = _decimals(rank_file, pattern)
        counts, ids_digests, byte_digests = [], [], []
        for value in batch.column(text).to_pylist():
            ids = bpe.encode(value or "")
            counts.append(len(ids))
            listed = " ".join(map(decimals.__getitem__, ids))
            ids_digests.append(hashlib.sha256(listed.encode()).hexdigest())
            byte_digests.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(key), pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()),
             pa.array(byte_digests, pa.string())],
            names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return map_batches(df.select(F.col(key), F.col(text)), run, schema)


@lru_cache(maxsize=2)
def _decimals(rank_file: str, pattern: str) -> dict[int, str]:
    return {rank: str(rank) for rank in _worker_bpe(rank_file, pattern).tokens}
