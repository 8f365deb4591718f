import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tunelake.llm import byte_bpe

FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(FILE, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe(FILE, public_tokenizers.PATTERN)


def test_random_texts_as_the_library(library, bpe):
    pick = random.Random(5)
    letters = " \t\n\r\x1c\x85\xa0 aAbeé'stre0123²Ⅷ.,!-_🙂漢́\x00"
    for _ in range(4000):
        text = "".join(pick.choice(letters) for _ in range(pick.randint(0, 40)))
        assert bpe.encode(text) == library.encode_ordinary(text)
        assert bpe.decode(bpe.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 50_000, "ab" * 30_000, "=" * 20_000 + "x", " " * 10_000])
def test_very_long_pieces(library, bpe, text):
    assert bpe.encode(text) == library.encode_ordinary(text)


def test_cache_starts_afresh(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_STRETCHES", 3)
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 2)
    small = byte_bpe.ByteBpe(FILE, public_tokenizers.PATTERN)
    text = "several words more than the memory holds, several words more"
    assert small.encode(text) == library.encode_ordinary(text)
    assert len(small._stretches) <= 3


def test_round_trip_rows(make, rows, library):
    given = [(1, "Hello there, world", 7), (1, "Hello there, world", 7), (2, None, 8), (None, "", 9),
             (3, "tab\tand  two", 1)]
    got = rows(byte_bpe.round_trip(make(given, "doc_id long, text string, n_tokens int")))

    def expected(key, text):
        ids = library.encode_ordinary(text or "")
        listed = " ".join(map(str, ids)).encode()
        return (key, len(ids), hashlib.sha256(listed).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest())

    assert got == sorted((expected(k, t) for k, t, _ in given), key=repr)


def test_encode_and_decode_columns(make, rows, library):
    df = make([(1, "one two", "x"), (2, None, None)], "doc_id long, text string, ids string")
    encoded = byte_bpe.encode(df)
    assert rows(encoded, "doc_id", "ids") == [(1, library.encode_ordinary("one two")), (2, [])]
    assert rows(byte_bpe.decode(encoded), "doc_id", "decoded") == [(1, b"one two"), (2, b"")]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.round_trip(empty).collect() == []
    assert byte_bpe.decode(byte_bpe.encode(empty)).collect() == []
