import io
import os
import random

import pytest

from tunelake.streaming import follow, tail


def test_ranges_hold_every_line_once():
    pick = random.Random(3)
    for _ in range(300):
        lines = [bytes(pick.choice(b"abc") for _ in range(pick.randrange(0, 9))) for _ in range(pick.randrange(0, 12))]
        whole = b"".join(line + b"\n" for line in lines)
        source = io.BytesIO(whole + b"unfinished")
        assert tail.last_break(source, len(whole) + 10) == len(whole)
        breaks = [0, *(i + 1 for i, b in enumerate(whole) if b == 10)]
        start = pick.choice(breaks)
        step = pick.randrange(1, 7)
        found = []
        for low in range(start, len(whole), step):
            found += tail.lines_between(source, start, low, min(low + step, len(whole)), len(whole))
        expected, at = [], 0
        for line in lines:
            if at >= start:
                expected.append((at, line))
            at += len(line) + 1
        assert found == expected


def test_long_lines(monkeypatch):
    monkeypatch.setattr(tail, "STEP_BYTES", 5)
    whole = b"x" * 40 + b"\n" + b"y" * 23 + b"\n\nz\n"
    source = io.BytesIO(whole)
    assert tail.last_break(source, 40) == 0 and tail.last_break(source, 60) == 41
    found = []
    for low in range(0, len(whole), 7):
        found += tail.lines_between(source, 0, low, min(low + 7, len(whole)), len(whole))
    assert found == [(0, b"x" * 40), (41, b"y" * 23), (65, b""), (66, b"z")]


@pytest.fixture
def log(spark, tmp_path):
    folder, base = tmp_path / "logs", str(tmp_path / "state")
    folder.mkdir()

    def read():
        """All lines that have arrived, over all calls; each call starts the stream anew."""
        out = follow.append_available(tail.tail_log(spark, f"file://{folder}"), base)
        return sorted(r.value for r in out.collect())

    return folder, read


def write(path, text, mode="a"):
    with open(path, mode) as f:
        f.write(text)


def test_appended_lines_arrive_once(log):
    folder, read = log
    write(folder / "app.log", "one\ntwo\nthr")
    assert read() == ["one", "two"]
    assert read() == ["one", "two"]
    write(folder / "app.log", "ee\nfour\n")
    write(folder / "other.log", "é\r\n")
    write(folder / "old.log.gz", "packed\n")
    write(folder / "_hidden", "hidden\n")
    assert read() == sorted(["one", "two", "three", "four", "é"])


def test_moved_and_cut_off_files(log):
    folder, read = log
    write(folder / "app.log", "a1\na2\n")
    assert read() == ["a1", "a2"]
    write(folder / "app.log", "a3\n")  # not read yet when the log is moved aside
    os.rename(folder / "app.log", folder / "app.log.1")
    write(folder / "app.log", "b1\n")
    assert read() == ["a1", "a2", "a3", "b1"]
    os.rename(folder / "app.log.1", folder / "app.log.2")
    os.rename(folder / "app.log", folder / "app.log.1")
    write(folder / "app.log.1", "b2\n")
    write(folder / "app.log", "c1\nc2\nc3\n")
    assert read() == ["a1", "a2", "a3", "b1", "b2", "c1", "c2", "c3"]
    write(folder / "app.log", "d1\n", "w")  # cut off and written anew
    assert read() == ["a1", "a2", "a3", "b1", "b2", "c1", "c2", "c3", "d1"]


def test_large_file_in_many_ranges(log, monkeypatch):
    folder, read = log
    lines = [f"line {i} " + "x" * (i % 300) for i in range(60_000)]
    write(folder / "app.log", "\n".join(lines) + "\n")
    sizes = list(tail.ranges({}, tail.whole_lines(f"file://{folder}", {})))
    assert [(n, s) for n, s, _, _ in sizes] == [("app.log", 0)]
    monkeypatch.setattr(tail, "CHUNK_BYTES", 1 << 20)
    assert len(tail._Reader(f"file://{folder}").partitions({"files": {}}, tail._Reader(f"file://{folder}").latestOffset())) > 8
    assert read() == sorted(lines)


def test_a_batch_that_runs_again_finds_its_file(tmp_path):
    write(tmp_path / "app.log", "a1\na2\n")
    reader = tail._Reader(f"file://{tmp_path}")
    (part,) = reader.partitions(reader.initialOffset(), reader.latestOffset())
    os.rename(tmp_path / "app.log", tmp_path / "app.log.1")
    write(tmp_path / "app.log", "b1\nb2\nb3\n")
    assert [v for b in reader.read(part) for v in b.column("value").to_pylist()] == ["a1", "a2"]


def test_empty_folder(log):
    _, read = log
    assert read() == []


def test_a_batch_opens_each_file_once(tmp_path, monkeypatch):
    from tunelake.checks import fixtures

    opened = []
    monkeypatch.setattr(fixtures, "open", lambda *given: opened.append(given[0]) or open(*given), raising=False)
    for turn in range(2):
        fixtures.append_batch(str(tmp_path), [0, 1] * 500, [f"{turn} {n}" for n in range(1000)])
    assert len(opened) == 4
    for number in range(2):
        written = (tmp_path / f"app-{number}.log").read_text().splitlines()
        assert written == [f"{turn} {n}" for turn in range(2) for n in range(number, 1000, 2)]
