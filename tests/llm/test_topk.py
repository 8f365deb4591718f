import math
import random

import numpy as np
import pytest

from tunelake.llm import topk


def brute(rows, queries, k):
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v)

    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    asked = {(i, tuple(math.floor(1024 * x) for x in v)) for i, v in queries
             if i is not None and usable(v)}
    found = []
    for i, q in asked:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole
                        if j != i and len(v) == len(q))
        found += [(i, n, j, -s) for n, (s, j) in enumerate(scored[:k], 1)]
    return sorted(found)


def vectors(pick, count, dims, spread=1.0):
    return [[np.float32(pick.gauss(0, spread)).item() for _ in range(dims)] for _ in range(count)]


@pytest.mark.parametrize("dims,spread,k", [(1, 1, 3), (7, 0.2, 10), (16, 30, 5), (3, 0.001, 4)])
def test_blocks_against_brute_force(dims, spread, k):
    pick = random.Random(dims)
    rows = [(i % 150, v) for i, v in enumerate(vectors(pick, 200, dims, spread))]
    ids = np.array([i for i, _ in rows])
    whole = np.array([[math.floor(1024 * x) for x in v] for _, v in rows])
    block = topk.SlicedBlock(ids, whole)
    for i, q in rows[:60]:
        own = np.array([math.floor(1024 * x) for x in q])
        got = list(zip(*(x.tolist() for x in block.best(i, own, k))))
        scored = sorted((-int(v @ own), j) for j, v in zip(ids.tolist(), whole) if j != i)
        assert got == [(j, -s) for s, j in scored[:k]]


def test_bitmap_arithmetic():
    pick = np.random.default_rng(3)
    values = pick.integers(0, 1 << 9, 300)
    padded = np.zeros(320, np.int64)
    padded[:300] = values
    maps = [
        np.packbits((padded >> b & 1).astype(np.uint8), bitorder="little").view(np.uint64)
        for b in range(9)
    ]
    total = topk.add_slices([[np.array([m, m, m])] for m in maps], 5)
    bits = [np.unpackbits(s.view(np.uint8), bitorder="little").astype(np.int64) for s in total]
    assert (sum(b << i for i, b in enumerate(bits))[:300] == 3 * values).all()
    present = np.packbits(np.arange(320) < 300, bitorder="little").view(np.uint64)
    for k in (1, 7, 150, 300):
        assert topk.kth_largest(total, present, k) == sorted(3 * values, reverse=True)[k - 1]
    for limit in (-4, 0, 500, 10**6):
        chosen = np.unpackbits(topk.at_least(total, present, limit).view(np.uint8), bitorder="little")
        assert (chosen[:300] == (3 * values >= limit)).all()


def test_search(make, rows, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3)
    pick = random.Random(9)
    given = list(enumerate(vectors(pick, 120, 5)))
    given += given[:4] + given[:2] + [(7, [0.5] * 5)]
    given += [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [math.nan] * 5),
              (204, [1.0, math.inf, 1, 1, 1]), (None, [1.0] * 5), (300, [1.0, 2.0]), (301, [2.0, 1.0]),
              (400, [1e30] * 5)]
    given = [(i, None if v is None else [x if x is None else float(x) for x in v]) for i, v in given]
    schema = "vec_id long, embedding array<double>"
    asked = [r for r in given if r[0] is not None and (r[0] % 20 == 0 or r[0] in (7, 301))]
    # a repeated query asks once; two vectors under one id ask twice
    clean, few = ([r for r in part if r[0] != 400] for part in (given, asked))
    got = rows(topk.search(make([(*r, 1) for r in clean], schema + ", score int"),
                           make(few, schema), 10))
    assert got == sorted(brute(clean, few, 10), key=repr)
    # components at the border of what is counted do no harm
    got = rows(topk.search(make(given, schema), make(asked, schema), 10))
    assert {r[0] for r in got} == {r[0] for r in brute(given, asked, 10)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.search(empty, empty).collect() == []
