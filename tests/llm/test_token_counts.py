import base64
import random

import public_tokenizers
import pytest
import tiktoken

from tunelake.llm import token_counts

FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def count():
    with open(FILE, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return lambda text: len(library.encode_ordinary(text or ""))


def expected(lengths, asked=()):
    found = []
    for limit in sorted({*lengths, *asked}):
        within = [x for x in lengths if x <= limit]
        beyond = [x for x in lengths if x > limit]
        found.append((limit, lengths.count(limit), limit * lengths.count(limit), len(within), sum(within),
                      len(beyond), sum(beyond), sum(min(x, limit) for x in lengths),
                      len(within) / len(lengths) if lengths else None))
    return found


def test_limits_by_brute_force(make, rows, count, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK_BITS", 3)
    pick = random.Random(2)
    texts = [" ".join(pick.choice(["alpha", "beta,", "γ", "12345"]) for _ in range(pick.randint(0, 40)))
             for _ in range(150)] + [None, "", "word " * 5000, "again", "again"]
    df = make([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, length int")
    histogram = token_counts.length_histogram(df)
    lengths = [count(t) for t in texts]
    assert rows(token_counts.limits(histogram)) == sorted(expected(lengths), key=repr)
    asked = [0, 1, 2, 17, 100, 4096, 10**9]
    table = token_counts.limits(histogram, asked)
    assert rows(table) == sorted(expected(lengths, asked), key=repr)
    got = token_counts.quantiles(table, [0.0, 0.5, 0.9, 1.0]).first()
    ordered = sorted(lengths)
    need = [0.5 * len(ordered), 0.9 * len(ordered), len(ordered)]
    assert list(got)[1:] == [ordered[-(-int(n * 1000) // 1000) - 1 if n == int(n) else int(n)] for n in need]
    shares = [0.001, 0.1, 0.5, 0.9, 0.99, 1.0]
    marked = token_counts.with_quantiles(table, shares).filter("quantiles is not null").collect()
    found = {float(s): r["length"] for r in marked for s in r["quantiles"].split(",")}
    assert found == {s: next(x for n, x in enumerate(ordered, 1) if n / len(ordered) >= s) for s in shares}
    assert all(r["documents"] > 0 for r in marked)


def test_empty_table(spark, rows):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.limits(token_counts.length_histogram(empty)).collect() == []
    got = token_counts.limits(token_counts.length_histogram(empty), [8])
    assert rows(got) == [(8, 0, 0, 0, 0, 0, 0, 0, None)]
