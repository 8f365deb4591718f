import random

import numpy as np
import pytest

from tunelake.llm import near_duplicates as nd


def kmers(text):
    words = (text or "").split()
    if not words:
        return []
    width = min(5, len(words))
    seen, found = {}, []
    for i in range(len(words) - width + 1):
        kmer = tuple(words[i : i + width])
        seen[kmer] = seen.get(kmer, 0) + 1
        found.append((kmer, seen[kmer]))
    return found


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def similarity(a, b):
    a, b = kmers(a), kmers(b)
    if not a and not b:
        return 1.0
    if len(set(a) & set(b)) < 0.8 * len(set(a) | set(b)) - 1e-9:
        return 0.0  # an alignment pairs no more than both hold
    paired = lcs(a, b)
    return paired / (len(a) + len(b) - paired)


def edited(pick, words, changes):
    words = list(words)
    for _ in range(changes):
        at = pick.randrange(len(words))
        kind = pick.random()
        if kind < 0.6:
            words[at] = f"new{pick.randrange(10**6)}"
        elif kind < 0.8:
            del words[at]
        else:
            words.insert(at, f"more{pick.randrange(10**6)}")
    return words


def test_similarity_by_brute_force():
    pick = random.Random(2)
    for _ in range(400):
        words = [f"w{pick.randrange(pick.choice([3, 40, 400]))}" for _ in range(pick.randint(0, 60))]
        other = edited(pick, words, pick.randint(0, 4)) if words else []
        if pick.random() < 0.2:
            cut = pick.randint(0, len(other))
            other = other[cut:] + other[:cut]
        a, b = " ".join(words), " ".join(other)
        true = similarity(a, b)
        got = nd.aligned(*(nd.labelled_kmers(nd.word_ids(t)) for t in (a, b)))
        assert abs(got - (true if true >= 0.8 - 1e-9 else 0.0)) < 1e-9


def test_sketches_are_sensitive_to_order():
    words = [f"w{i}" for i in range(300)]
    own = nd.sketch(nd.labelled_kmers(nd.word_ids(" ".join(words))))
    turned = nd.sketch(nd.labelled_kmers(nd.word_ids(" ".join(words[150:] + words[:150]))))
    assert 0 < (own == turned).mean() < 0.6
    same = nd.sketch(nd.labelled_kmers(nd.word_ids("\n".join(words))))
    assert (own == same).all()


def test_parts_do_not_change_a_sketch(monkeypatch):
    given = nd.labelled_kmers(nd.word_ids(" ".join(f"w{i % 700}" for i in range(2000))))
    whole = nd.sketch(given)
    monkeypatch.setattr(nd, "AT_ONCE", 3)
    assert (nd.sketch(given) == whole).all()


def groups(pairs, ids):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in ids}


def collection():
    pick = random.Random(7)
    passage = [f"passage{i}" for i in range(25)]
    texts = []
    for _ in range(40):
        words = [f"word{pick.randrange(3000)}" for _ in range(pick.randint(30, 120))]
        texts.append(words)
        for _ in range(pick.randint(0, 3)):
            texts.append(edited(pick, words, pick.randint(0, 4)))
    for _ in range(40):  # different texts with one long passage in common
        texts.append(passage + [f"own{pick.randrange(10**6)}" for _ in range(pick.randint(20, 50))])
    base = [f"base{i}" for i in range(200)]
    texts += [edited(pick, base, pick.randint(0, 3)) for _ in range(60)]
    chain = [f"chain{i}" for i in range(150)]
    for _ in range(6):  # each near the one before
        texts.append(chain)
        chain = edited(pick, chain, 2)
    texts = [" ".join(t) for t in texts] + ["few words", "few  words", "few other words", "x", "x"]
    pick.shuffle(texts)
    return list(enumerate(texts))


def test_classes_by_brute_force(make, rows):
    given = collection()
    pairs = [(i, j) for i, a in given for j, b in given if i < j
             and similarity(a, b) >= 0.8 - 1e-9]
    expected = groups(pairs, [i for i, _ in given])
    got = dict(rows(nd.classes(make([(*g, 1) for g in given], "doc_id long, text string, node int"))))
    assert got == expected
    kept = rows(nd.keep_one(make(given, "doc_id long, text string")))
    assert sorted(kept) == sorted((i, t) for i, t in given if expected[i] == i)


def test_odd_rows(make, rows):
    given = [(1, None, "a"), (2, "", "b"), (3, " \n", "c"), (None, "alone here", "d"), (5, "twin", "e"),
             (5, "twin", "f"), (None, "twin", "g"), (6, "word " * 40_000, "h"), (7, "word " * 40_001, "i")]
    df = make(given, "doc_id long, text string, digest string")
    got = rows(nd.classes(df))
    assert got == sorted([(1, 1), (2, 1), (3, 1), (None, None), (5, 5), (5, 5), (None, 5), (6, 6), (7, 6)],
                         key=repr)
    kept = rows(nd.keep_one(df), "doc_id", "text")
    assert [k for k, _ in kept] == [1, 5, 6, None] and len(kept) == 4


@pytest.mark.parametrize("count", [1, 30])
def test_a_line_of_links(spark, count):
    links = spark.createDataFrame([(i + 1, i) for i in range(count)], "a long, b long")
    got = nd.components(links).collect()
    assert sorted((r.node, r.label) for r in got) == [(i, 0) for i in range(count + 1)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert nd.classes(empty).collect() == [] and nd.keep_one(empty).collect() == []


def test_whole_table_recall(spark):
    """Classes of a given table hold every pair that a scan of all shared k-mers finds."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.class_id for r in nd.classes(df).collect()}
    texts = {r.doc_id: r.text for r in df.collect()}
    found = {i: nd.labelled_kmers(nd.word_ids(t)) for i, t in texts.items()}
    index = {}
    for i, own in found.items():
        for kmer in own.tolist():
            index.setdefault(kmer, []).append(i)
    pairs = {(a, b) for ids in index.values() if len(ids) < 60 for a in ids for b in ids if a < b}
    links = [(a, b) for a, b in pairs if nd.aligned(found[a], found[b]) >= 0.8]
    expected = groups(links, texts)
    assert got == expected and np.unique(list(got.values())).size < len(got)


def family(count, planted):
    """Texts just under 0.8 to each other by the words they share, and pairs just above by two more."""
    pick = random.Random(9)
    core = [f"core{i}" for i in range(359)]
    own = [[f"own{i}x{j}" for j in range(45)] for i in range(count)]
    for i in range(planted):
        own[2 * i][:2] = own[2 * i + 1][:2]
    texts = [" ".join(core + words) for words in own]
    pick.shuffle(texts)
    return list(enumerate(texts))


def test_pairs_inside_a_family_that_is_not_similar(make, rows):
    given = family(200, 6)
    found = [nd.labelled_kmers(nd.word_ids(t)) for _, t in given]
    pairs = [(i, j) for i, _ in given for j, _ in given if i < j and nd.aligned(found[i], found[j]) >= 0.8]
    assert len(pairs) == 6
    got = dict(rows(nd.classes(make(given, "doc_id long, text string"))))
    assert got == groups(pairs, [i for i, _ in given])
