import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tunelake.llm import passages as p

SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(texts):
    """For each text: words, covered words, digest of what is kept."""
    split = [words_of(t) for t in texts]
    seen = Counter(
        tuple(w[i : i + p.WINDOW]) for w in split for i in range(len(w) - p.WINDOW + 1)
    )
    found = []
    for w in split:
        gone = set()
        for i in range(len(w) - p.WINDOW + 1):
            if seen[tuple(w[i : i + p.WINDOW])] > 1:
                gone.update(range(i, i + p.WINDOW))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        found.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return found


def result(df):
    found = p.remove(df).collect()
    return sorted(
        ((r.doc_id, r.n_words, sum(s.words for s in r.spans), hashlib.sha256(r.kept.encode()).hexdigest())
         for r in found), key=repr,
    )


def made(pick, count, vocabulary):
    return [pick.choice(vocabulary) for _ in range(count)]


def test_odd_rows_against_brute_force(make):
    pick = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)] + ["é", "日本", "a b", "x" * 300]
    common = [made(pick, n, vocabulary) for n in (34, 35, 36, 60, 200)]
    texts = [None, "", " \n ", "one two", "same " * 500, "same " * 36, "a b " * 40, "a b c d e f g " * 6]
    for n in range(120):
        parts = []
        for _ in range(pick.randrange(1, 5)):
            parts += made(pick, pick.randrange(0, 90), vocabulary)
            whole = pick.choice(common)
            low, high = sorted((pick.randrange(len(whole) + 1), pick.randrange(len(whole) + 1)))
            parts += whole if pick.random() < 0.4 else whole[low:high]
        texts.append("".join(w + pick.choice([" ", "  ", "\n", "\t", "\r\n", "\x0b"]) for w in parts))
    base = made(pick, 900, vocabulary)
    for _ in range(25):  # near copies
        changed = [w if pick.random() > 0.01 else "other" + str(pick.random()) for w in base]
        texts.append(" ".join(changed))
    texts += [" ".join(made(pick, 40_000, vocabulary)), texts[12], texts[12], texts[13], texts[13] + " "]
    given = [(n if n % 17 else None, t, "a", 1, 2.0) for n, t in enumerate(texts)] + [(3, texts[3], "a", 1, 2.0)]
    df = make(given, "doc_id long, text string, t1 string, key int, packed double")
    expected = brute([r[1] for r in given])
    assert result(df) == sorted(((r[0], *e) for r, e in zip(given, expected)), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_few_words_many_repetitions(make, seed):
    """Texts of three words: seeds are everywhere, windows repeat inside a text and its bundles."""
    pick = random.Random(seed)
    texts = []
    for _ in range(30):
        cycle = made(pick, pick.randrange(1, 45), "abc")
        texts.append(" ".join((cycle * 40)[: pick.randrange(20, 150)] + made(pick, pick.randrange(30), "abc")))
    df = make(list(enumerate(texts)), "doc_id long, text string")
    assert result(df) == sorted(((n, *e) for n, e in enumerate(brute(texts))), key=repr)


def test_word_hashes_are_those_of_the_words():
    pick = random.Random(1)
    texts = ["".join(pick.choice(["a", "b", "é", "zz", *SPACES]) for _ in range(pick.randrange(0, 60))) for _ in range(300)]
    texts += ["", "a", " ", "a" * (p.CHUNK_BYTES + 5) + " b"]
    hashes, counts = p._hashed([t.encode() for t in texts])
    words = [w for t in texts for w in words_of(t)]
    assert counts.tolist() == [len(words_of(t)) for t in texts]
    by_word = {}
    for word, value in zip(words, hashes.tolist()):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_run_hashes_tell_runs_apart():
    words = np.random.default_rng(1).integers(0, 3, 400).astype(np.uint64)
    seeds, windows = p.run_hashes(words)
    for hashes, size in ((seeds, p.SEED), (windows, p.WINDOW)):
        assert len(hashes) == 400 - size + 1
        runs = [tuple(words[i : i + size].tolist()) for i in range(len(hashes))]
        assert len(set(zip(runs, hashes.tolist()))) == len(set(runs)) == len(set(hashes.tolist()))


def test_paths(spark):
    links = [(1, 2), (2, 3), (3, 4), (3, 4), (4, 5), (4, 6), (7, 5), (6, 8), (8, 9), (20, 21), (21, 22), (22, 20), (30, 30)]
    links += [(n, n + 1) for n in range(100, 163)]
    nodes = {n for link in links for n in link} | {50}
    got = p.paths(
        spark.createDataFrame(links, "node long, following long"),
        spark.createDataFrame([(n,) for n in nodes], "node long"),
    ).collect()
    found = {r.node: (r.path, r.steps) for r in got}
    expected = {1: (1, 0), 2: (1, 1), 3: (1, 2), 4: (1, 3), 5: (5, 0), 6: (6, 0), 7: (7, 0), 8: (6, 1), 9: (6, 2),
                50: (50, 0), 30: (30, 0)}
    expected |= {n: (100, n - 100) for n in range(100, 164)} | {n: (20, 0) for n in (20, 21, 22)}
    assert found == expected and len(got) == len(nodes)


def test_a_copied_passage_is_one_path(spark):
    pick = random.Random(5)
    passage = [f"p{i}" for i in range(400)]
    texts = [" ".join([f"x{n}{i}" for i in range(50)] + passage + [f"y{n}{i}" for i in range(50)]) for n in range(4)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    on_paths, doubtful = p.repeated(df)
    by_text = {}
    for r in on_paths.collect():
        by_text.setdefault((r.t1, r.t2), []).append((r.place, r.windows, r.path, r.steps))
    assert len(by_text) == 4
    for pieces in by_text.values():
        pieces.sort()
        assert len({path for *_, path, _ in pieces}) == 1
        assert [steps for *_, steps in pieces] == list(range(len(pieces)))
        assert all(a[0] + a[1] == b[0] for a, b in zip(pieces, pieces[1:]))
    assert doubtful.count() <= 2 * 2 * 4 + 4  # two pieces at each end of each copy, and their partners


def test_empty_table(spark):
    assert p.remove(spark.createDataFrame([], "doc_id long, text string")).collect() == []
