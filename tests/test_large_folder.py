import os

from pyspark.sql import functions as F

from tunelake.sources import artifacts as A


def test_a_folder_of_very_many_names(spark, tmp_path, rows):
    flat = tmp_path / "flat"
    (flat / "inner").mkdir(parents=True)
    for n in range(100_000):
        (flat / f"f{n:06d}").touch()
    (flat / "inner" / "last").write_text("x")
    (flat / ".hidden").write_text("abc")
    os.symlink("nowhere", flat / "broken")
    listed = A.list_artifacts(spark, str(tmp_path))
    assert listed.columns == ["path", "length", "modificationTime"]
    found = {r.path: r.length for r in listed.collect()}
    base = f"file:{flat}"
    assert len(found) == 100_002 == listed.count()
    assert found[f"{base}/inner/last"] == 1 and found[f"{base}/.hidden"] == 3
    assert {p for p in found if "/flat/f" in p} == {f"{base}/f{n:06d}" for n in range(100_000)}
    assert listed.filter(F.col("modificationTime").isNull()).count() == 0


def test_parts_are_listed_in_bounded_batches(tmp_path, monkeypatch):
    monkeypatch.setattr(A, "LARGE_FOLDER", 50)
    monkeypatch.setattr(A, "PARTS", 4)
    monkeypatch.setattr(A, "LISTED_ROWS", 30)
    for n in range(400):
        (tmp_path / f"é{n}").touch()
    given = A.pa.RecordBatch.from_pydict({"path": [f"file:{tmp_path}"], "part": [0], "parts": [1]})
    (first,) = A._list_folders([given])
    assert first.column("parts").to_pylist() == [4] * 4 and first.column("part").to_pylist() == [0, 1, 2, 3]
    seen = []
    for part in range(4):
        own = A.pa.RecordBatch.from_pydict({"path": [f"file:{tmp_path}"], "part": [part], "parts": [4]})
        batches = list(A._list_folders([own]))
        assert len(batches) > 2 and all(b.num_rows <= 30 for b in batches)
        seen += [p for b in batches for p in b.column("path").to_pylist()]
    assert sorted(seen) == sorted(f"file:{tmp_path}/é{n}" for n in range(400))
