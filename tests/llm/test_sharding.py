import random

import pytest

from tunelake.llm import sharding
from tunelake.session import written


def test_shards_of_a_skewed_table(make, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE_BYTES", 2000)
    pick = random.Random(1)
    given = [(i, "x" * pick.randint(0, 60) + str(i), "s") for i in range(600)]
    given += [(1000 + i, "one text that a third of all rows share", "t") for i in range(300)]
    given += [(7, "x7", None)] * 5 + [(None, None, None), (None, "", None)]
    got = sharding.shard(make(given, "doc_id long, text string, shard string"), shards=10)
    assert got.columns == ["doc_id", "text", "size", "shard", "slot"]
    got = got.collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got))) == sorted(
        repr(g[:2]) for g in given
    )
    sizes = [0] * 10
    slots = [[] for _ in range(10)]
    for r in got:
        assert r.size == len(r.text or "") + 16
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    longest = max(r.size for r in got)
    assert max(sizes) - min(sizes) <= 2 * longest
    # copies that fit in a shard stay together but where a boundary must cut their group
    assert len({r.shard for r in got if r.text == "x7"}) == 1


def test_boundaries_against_sorting(spark):
    pick = random.Random(3)
    rows = [(pick.randint(-50, 50), i, pick.randint(1, 400)) for i in range(2000)]
    rows += [(77, 5000 + i, 100) for i in range(1500)]
    slim = written(
        spark.createDataFrame(rows, "_hash long, _place long, _size long").repartition(7), "slim"
    )
    total = sum(size for _, _, size in rows)
    for shares in (1, 2, 13):
        found = sharding.find_boundaries(slim, shares, 0.01)
        assert len(found) == shares and (found[-1].size, found[-1].rows) == (total, len(rows))
        for i, bound in enumerate(found[:-1], 1):
            below = [row for row in rows if row[:2] < bound.key]
            assert (bound.size, bound.rows) == (sum(r[2] for r in below), len(below))
            assert abs(bound.size - total * i / shares) <= max(0.01 * total / shares, 400)


def test_group_border_within_tolerance(spark):
    rows = [(h, 10 * h + i, 10) for h in range(100) for i in range(10)]
    slim = written(spark.createDataFrame(rows, "_hash long, _place long, _size long"), "slim")
    (bound, _) = sharding.find_boundaries(slim, 2, 0.1)
    assert bound.key[1] == -(2**63)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a"), (2, "b")]])
def test_fewer_rows_than_shards(spark, rows):
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and all(0 <= r.shard < 40 for r in got)
