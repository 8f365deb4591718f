import math
import random

import numpy as np
import pytest

from tunelake.llm import language

WORDS = {
    "en": "the of and water house with from where thinking nothing between through".split(),
    "de": "der die und wasser haus mit von zwischen nichts durch schön für".split(),
    "fr": "le la et eau maison avec depuis où rien entre après très".split(),
}


def texts(pick, count=60):
    given = []
    for i in range(count):
        tag = pick.choice(list(WORDS))
        given.append((i, " ".join(pick.choice(WORDS[tag]) for _ in range(pick.randint(5, 40))), tag))
    return given


@pytest.fixture(scope="module")
def model(spark):
    given = texts(random.Random(1), 200)
    df = spark.createDataFrame(given, "doc_id long, text string, lang string")
    return language.fit(df, "text", "lang")


def test_fit_counts(spark, model):
    given = texts(random.Random(1), 200)
    languages, table = model
    assert languages == ["de", "en", "fr"] and table.shape == (4, language.CLASSES)
    for row, tag in enumerate(languages):
        counts = np.full(language.CLASSES, 0.5)
        for _, text, label in given:
            if label == tag:
                np.add.at(counts, language.trigrams(text), 1)
        assert np.allclose(table[row], np.log(counts / counts.sum()), atol=1e-4)
    assert np.allclose(table[3], -math.log(language.CLASSES), atol=1e-4)


def brute(rows, model, declared, host):
    """The posterior of every row, straight from the formula."""
    languages, table = model
    size = len(languages) + 1
    like, share = [], []
    for row in rows:
        grams = language.trigrams(row["text"] or "")
        x = table[:, grams].astype(float).sum(axis=1) / 3
        like.append(x)
        share.append(np.exp(x - x.max()) / np.exp(x - x.max()).sum() if len(grams) else np.zeros(size))

    def tag_of(row):
        tag = row[declared].lower().split("-")[0] if row[declared] else None
        return tag if tag is None or tag in languages else "?"

    def smooth(counts, parent):
        return (counts + language.SMOOTHING * parent) / (counts.sum() + language.SMOOTHING)

    def level(which):
        sums = {}
        for row, s in zip(rows, share):
            key = which(row[host] or "")
            sums[key] = sums.get(key, np.zeros(size)) + s
        return sums

    def domain(h):
        return ".".join(h.split(".")[-2:])

    hosts, domains = level(lambda h: h), level(domain)
    suffixes = level(lambda h: h.split(".")[-1])
    everything = smooth(sum(share), np.full(size, 1 / size))
    said = {}
    for row, s in zip(rows, share):
        if tag_of(row):
            said[tag_of(row)] = said.get(tag_of(row), np.zeros(size)) + s
    total = sum(said.values())
    found = []
    for row, x, s in zip(rows, like, share):
        h = row[host] or ""
        above = smooth(suffixes[h.split(".")[-1]], everything)
        prior = smooth(np.maximum(hosts[h] - s, 0), smooth(domains[domain(h)], above))
        odds = x + np.log(prior)
        if tag_of(row):
            odds = odds + np.log((said[tag_of(row)] + 0.5) / (total + 0.5 * len(said)))
        p = np.exp(odds - odds.max())
        p /= p.sum()
        has = len(language.trigrams(row["text"] or "")) > 0
        best = ([*languages, "und"])[int(p.argmax())] if has else "und"
        found.append((row["id"], best, p.max() if has else 0.0, has and best != "und"))
    return found


def test_posterior_by_brute_force(make, model):
    pick = random.Random(5)
    hosts = ["a.one.de", "b.one.de", "two.de", "x.co.fr", None, "", "host"]
    rows = [
        {"id": i, "text": text, "tag": pick.choice([tag, tag, tag, None, "xx", tag.upper() + "-ZZ"]),
         "site": pick.choice(hosts), "language": 3}
        for i, text, tag in texts(pick, 90)
    ]
    rows += [
        {"id": 100 + i, "text": text, "tag": tag, "site": "two.de", "language": 4}
        for i, (text, tag) in enumerate(
            [(None, "en"), ("", "en"), ("123 %%%", "de"), ("zqxj " * 50, "fr"), ("the", None),
             (WORDS["en"][0] * 9000, None), ("ẞ漢字" * 300, "de"), ("the", None), ("the", None)]
        )
    ]
    schema = "id long, text string, tag string, site string, language int"
    df = make([tuple(r.values()) for r in rows], schema)
    got = language.identify(df, model, declared="tag", host="site")
    assert got.columns == ["id", "text", "tag", "site", "language", "probability", "kept"]
    got = sorted((r.id, r.language, r.probability, r.kept) for r in got.collect())
    for mine, theirs in zip(got, sorted(brute(rows, model, "tag", "site")), strict=True):
        assert mine[:2] == theirs[:2] and mine[3] == theirs[3]
        assert abs(mine[2] - theirs[2]) < 1e-4
    by_id = {r[0]: r for r in got}
    assert not by_id[103][3] and not by_id[100][3]


def test_without_evidence_but_text(make, model, rows):
    df = make([(1, "der die und das wasser"), (2, None)], "id long, text string")
    got = rows(language.identify(df, model, declared=None, host=None), "id", "language", "kept")
    assert got == [(1, "de", True), (2, "und", False)]


def test_markup():
    page = """<!doctype html><HTML class=x LANG='fr-CA'><script>var the = "</p>"</script><style>p{}</style>
    <!-- the the --><p>Après &amp; l&#39;eau<br>rien<script>open"""
    text, tag = language.strip_markup(page)
    assert tag == "fr" and " ".join(text.split()) == "Après & l'eau rien"
    assert language.strip_markup("") == ("", None)


def test_page_evidence(make, rows):
    df = make([(1, "http://u:p@A.Example.com:80/x", "<html lang=en>the"), (2, None, None), (3, "x/y", "")],
              "page_id long, url string, html string")
    got = rows(language.with_page_evidence(df), "page_id", "text", "declared", "host")
    assert got == [(1, " the", "en", "a.example.com"), (2, "", None, None), (3, "", None, None)]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    df = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source")
    model = language.fit(df.filter("doc_id % 2 = 0"), "text", "lang")
    got = language.identify(df.filter("doc_id % 2 = 1"), model, declared=None, host="source").collect()
    assert sum(r.language == r.lang for r in got) >= 0.97 * len(got)


def test_empty_tables(spark, model):
    empty = spark.createDataFrame([], "id long, text string, declared string, host string")
    assert language.identify(empty, model).collect() == []
    none = language.fit(empty, "text", "declared")
    df = spark.createDataFrame([(1, "text", "en", "h")], empty.schema)
    assert [(r.language, r.kept) for r in language.identify(df, none).collect()] == [("und", False)]


def test_a_rare_language_is_learnt_from_all_its_rows(spark):
    pick = random.Random(5)
    given = [(i, " ".join(pick.choice(WORDS["en"]) for _ in range(8)), "en") for i in range(4000)]
    given += [(5000 + i, " ".join(pick.choice(WORDS["de"]) for _ in range(8)), "de") for i in range(3)]
    df = spark.createDataFrame(given, "doc_id long, text string, lang string").repartition(3)
    languages, table = language.fit(df, "text", "lang", rows=40)
    assert languages == ["de", "en"]
    counts = np.full(language.CLASSES, 0.5)
    for _, text, _ in given[4000:]:
        np.add.at(counts, language.trigrams(text), 1)
    assert np.allclose(table[0], np.log(counts / counts.sum()), atol=1e-4)


def test_shares_by_language():
    counts = {"en": 10**9, "de": 10**6, "fr": 7000, "is": 12}
    shares = language.sampled_shares(counts, 20_000)
    assert shares["is"] == 1 and shares["en"] * 10**9 == pytest.approx(shares["de"] * 10**6)
    assert sum(shares[k] * counts[k] for k in counts) == pytest.approx(20_000, abs=4)
    assert set(language.sampled_shares({"en": 19_000, "is": 1000}, 20_000).values()) == {1.0}
    assert language.sampled_shares({}, 20_000) == {}
