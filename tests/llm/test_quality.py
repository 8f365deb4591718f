import random
import re

import pytest

from tunelake.llm import quality


def plain(text):
    """The base counts by brute force."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def random_texts():
    pick = random.Random(6)
    pieces = ["a", "bc", "the", "é", "漢字🙂", "#", "a|b", "<x>", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\xa0",
              "\x85", " ", "\x1c", "same line\n", "one two three "]
    texts = ["".join(pick.choice(pieces) + pick.choice([" ", "", "\n"])
                     for _ in range(pick.randint(0, 120))) for _ in range(400)]
    return [*texts, None, "", " ", "a " * 30_000, "x" * 200_000, "l\n" * 5000, "w w", "w w w", "w w w w"]


def test_base_counts(make, rows):
    given = list(enumerate(random_texts())) + [(3, "again"), (3, "again"), (None, "again")]
    df = make([(*g, 5) for g in given], "doc_id long, text string, N_WORDS int")
    got = rows(quality.score(df, keep=["doc_id"]), "doc_id", *quality.Counts, "base_failed")
    expected = []
    for key, text in given:
        counts = plain(text)
        expected.append((key, *counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0]))
    assert got == sorted(expected, key=repr)


def test_clashing_columns_go(make):
    df = make([(1, "a", 2, 3)], "doc_id long, text string, kept int, extra int")
    assert quality.score(df).columns == [
        "doc_id", "text", "extra", *quality.Counts, "base_failed", "good", "kept"
    ]


def test_accuracies_are_recovered():
    pick = random.Random(8)
    counts, truth = {}, []
    right = [0.95, 0.9, 0.85, 0.8, 0.75]
    for _ in range(20_000):
        good = pick.random() < 0.7
        votes = tuple(
            0 if pick.random() < 0.3 else (1 if good else -1) * (1 if pick.random() < r else -1)
            for r in right
        )
        truth.append((votes, good))
        counts[votes] = counts.get(votes, 0) + 1
    prior, worth = quality.estimate(counts, len(right))
    assert abs(prior - 0.7) < 0.03
    for rule in range(len(right)):
        for side, vote in ((0, -1), (1, 1)):
            cast = [good for votes, good in truth if votes[rule] == vote]
            assert abs(worth[rule][side] - sum(cast) / len(cast)) < 0.06
    hits = sum((quality._posterior(votes, prior, worth) >= 0.5) == good for votes, good in truth)
    simple = sum((sum(votes) > 0) == good for votes, good in truth)
    assert hits >= simple and hits > 0.9 * len(truth)


def test_no_documents():
    assert quality.estimate({}, 3)[0] == 0.8


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.1"])
def test_held_out_labels(spark, folder):
    got = quality.score(spark.read.parquet(f"{folder}/documents.parquet"), keep=["doc_id"])
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter("quality is not null")
    found = {(r.quality, r.kept): r["count"] for r in
             got.filter("not base_failed").join(labels, "doc_id").groupBy("quality", "kept").count()
             .collect()}
    assert found[1, True] >= 0.99 * (found[1, True] + found.get((1, False), 0))
    assert found.get((0, False), 0) >= 0.8 * (found.get((0, False), 0) + found.get((0, True), 0))


def test_empty_table(spark):
    assert quality.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []
