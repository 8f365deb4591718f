import gzip
import json

from tunelake.sources.examples import read_placed_lines, read_rejects, with_line_numbers


def test_numbers_in_files_of_many_splits(spark, tmp_path):
    good = json.dumps({"instruction": "i", "input": "x", "output": None})
    files = {
        "a.jsonl": [good if n % 7 else "{bad" * (n % 50) for n in range(4000)],
        "b.jsonl": ["" if n % 100 == 3 else good + "x" * (n % 3) for n in range(900)],
        "c.jsonl": ["y" * 60_000, good, "[1]"],
        "d.jsonl": [],
    }
    for name, lines in files.items():
        (tmp_path / name).write_text("".join(line + "\n" for line in lines))
    (tmp_path / "b.jsonl").write_text("\r\n".join(files["b.jsonl"]))  # no break at the end
    with gzip.open(tmp_path / "e.jsonl.gz", "wt") as f:
        f.write(f"{good}\n\n{good}\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        placed = read_placed_lines(spark, str(tmp_path))
        assert placed.select("file_path", "block").distinct().count() > 30
        found = {}
        for r in with_line_numbers(placed, placed).collect():
            found[r.file_path.rsplit("/", 1)[1], r.line_no] = r.value
        expected = {(name, n): line for name, lines in files.items() for n, line in enumerate(lines, 1)}
        expected |= {("e.jsonl.gz", n): line for n, line in enumerate([good, "", good], 1)}
        assert found == expected
        rejects = read_rejects(spark, str(tmp_path)).collect()
        assert {(r.file_path.rsplit("/", 1)[1], r.line_no) for r in rejects} == {
            place for place, line in expected.items() if line != good
        }
        reasons = {(r.file_path.rsplit("/", 1)[1], r.line_no): r.reason for r in rejects}
        assert reasons["c.jsonl", 3] == "not_object" and reasons["e.jsonl.gz", 2] == "blank"
        assert "block" not in read_rejects(spark, str(tmp_path)).columns
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
