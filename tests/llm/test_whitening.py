import math
from fractions import Fraction

import numpy as np
import pytest

from tunelake.llm import whitening as w


@pytest.mark.parametrize("dims", [1, 2, 5, 24])
@pytest.mark.parametrize("kind", ["normal", "few values", "axes", "scales", "equal", "falling"])
def test_rank_one_updates(dims, kind):
    pick = np.random.default_rng(dims)
    scatter, values, vectors = np.zeros((dims, dims)), np.zeros(dims), np.eye(dims)
    for _ in range(3 * dims + 4):
        v = {
            "normal": lambda: pick.normal(size=dims),
            "few values": lambda: pick.integers(-2, 3, dims).astype(float),
            "axes": lambda: np.eye(dims)[pick.integers(dims)],
            "scales": lambda: pick.normal(size=dims) * 10.0 ** pick.integers(-8, 8),
            "equal": lambda: np.ones(dims),
            "falling": lambda: pick.normal(size=dims) * np.logspace(0, -12, dims),
        }[kind]()
        scatter += np.outer(v, v)
        values, vectors = w.rank_one(values, vectors, v)
        assert (np.diff(values) >= 0).all()
    assert np.abs(vectors @ np.diag(values) @ vectors.T - scatter).max() <= 1e-12 * np.abs(scatter).max()
    assert np.abs(vectors.T @ vectors - np.eye(dims)).max() < 1e-12


@pytest.mark.parametrize("sizes", [[40], [3, 1, 90], [30, 0, 5, 17]])
def test_spectra_grow_and_meet(sizes):
    pick = np.random.default_rng(7)
    parts = [pick.normal(size=(n, 6)) * np.linspace(1, 9, 6) + 1e4 for n in sizes]
    total = w.Spectrum.empty(6)
    for rows in parts:
        own = w.Spectrum.empty(6)
        if len(rows):
            own.add(rows)
        total.merge(w.Spectrum.unpacked(own.n, own.packed(), 6))
    rows = np.concatenate(parts)
    centred = rows - rows.mean(axis=0)
    found = total.vectors @ np.diag(total.values) @ total.vectors.T
    assert total.n == len(rows) and np.allclose(total.mean, rows.mean(axis=0), rtol=1e-13)
    assert np.abs(found - centred.T @ centred).max() < 1e-10 * np.abs(centred.T @ centred).max()


def check(got, given, components=8):
    """All rows of the result against plain numpy and whole numbers; signs are free."""
    usable = [(i, v) for i, v in given if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * np.float64(c)) + 100_000 for c in v] for _, v in usable])
    n, dims = x.shape
    sums = [int(s) for s in x.sum(axis=0)]
    centred = np.array([[float(Fraction(int(e)) - Fraction(s, n)) for e, s in zip(row, sums)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    by_component = {}
    for r in got:
        by_component.setdefault(r.component, []).append(r)
    assert sorted(by_component) == list(range(1, min(dims, components) + 1))
    for component, rows in by_component.items():
        expected = centred @ vectors[:, component - 1] / np.sqrt(values[component - 1])
        whole = [sum((n * int(e) - s) ** 2 for e, s in zip(row, sums)) for row in x]
        mine = sorted((r.vec_id, r.deviation, r.whitened) for r in rows)
        best = min(
            max(abs(a[2] - b[2]) if a[:2] == b[:2] else 9 for a, b in zip(mine, sorted(zip([i for i, _ in usable], whole, sign * expected))))
            for sign in (1, -1)
        )
        assert len(rows) == n and best < 1e-7
        for r in rows:
            assert r.n == n and r.explained == pytest.approx(values[component - 1] / values.sum(), rel=1e-9)
            assert 0 <= r.identity_error <= 1e-8


def test_many_partitions(spark, monkeypatch):
    pick = np.random.default_rng(3)
    turn = np.linalg.qr(pick.normal(size=(12, 12)))[0]
    rows = (pick.normal(size=(900, 12)) * np.linspace(0.1, 2, 12)) @ turn
    given = [(i, [float(c) for c in row]) for i, row in enumerate(rows)]
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>").repartition(19)
    check(w.whiten(df).collect(), given)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check(w.whiten(df).collect(), [(r.vec_id, r.embedding) for r in df.collect()])


def test_odd_rows(spark):
    pick = np.random.default_rng(5)
    good = [(i, [float(np.float32(c)) for c in pick.normal(size=3)]) for i in range(40)]
    good += good[:3] + [(7, [9.0, 9.0, -9.0]), (None, [0.5, 1.5, 2.5])]
    bad = [(100, None), (101, []), (102, [1.0, None, 1.0]), (103, [math.nan] * 3), (104, [1.0, -math.inf, 1.0]),
           (105, [1.0, 2.0]), (106, [1.0] * 4)]
    schema = "vec_id long, embedding array<float>, n int, component string, part int, state int"
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in good + bad], schema).repartition(5)
    got = w.whiten(df).collect()
    assert df.columns[:2] == ["vec_id", "embedding"]
    assert sorted({r.vec_id for r in got}, key=repr) == sorted({i for i, _ in good}, key=repr)
    keyed = [(-1 if i is None else i, v) for i, v in good]
    check(w.whiten(df.fillna({"vec_id": -1})).collect(), keyed)


def test_without_variance(spark):
    schema = "vec_id long, embedding array<double>"
    assert w.whiten(spark.createDataFrame([], schema)).collect() == []
    assert w.whiten(spark.createDataFrame([(1, None)], schema)).collect() == []
    one = w.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).collect()
    assert [tuple(r) for r in one] == [(1, c, 3, 0, None, None, 0.0) for _ in range(3) for c in (1, 2)]
    line = w.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], schema)).collect()
    assert {(r.component, r.whitened is None) for r in line} == {(1, False), (2, True)}
    assert all(r.identity_error < 1e-9 for r in line)


def test_deviations_are_exact():
    x = np.array([[2**53, -(2**53)], [5, 6]])
    assert w.deviations(x, 3, [7, 11]).tolist() == [2**63 - 1, (15 - 7) ** 2 + (18 - 11) ** 2]
    x = np.array([[3_000_000, 1]])
    assert w.deviations(x, 900, [2, 3]).tolist() == [(900 * 3_000_000 - 2) ** 2 + 897**2]
