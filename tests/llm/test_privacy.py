import hashlib
import math
import random
import re

import pytest
import xxhash

from tunelake.llm import privacy

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = 0
            for i, d in enumerate(reversed(digits)):
                d = int(d) * (1 + i % 2)
                luhn += d - 9 * (d > 9)
            if {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]:
                found.append((m.start(), order, m.end(), kind))
    return [(start, end, kind) for start, _, end, kind in sorted(found)]


def test_spans_as_the_plain_patterns():
    pick = random.Random(4)
    pieces = ["a", "é", "@", ".", "@x.y", "b.c", "1", "23", "255", "256", "0007", " ", "-", "+", "(", ")",
              "4111111111111111", "4111 1111-1111 1111", "+1 (555) 555-1234", "10.0.0.1", "\n", "_", "x@"]
    for _ in range(30000):
        text = "".join(pick.choice(pieces) for _ in range(pick.randint(0, 14)))
        assert privacy.find_entities(text) == plain_spans(text), text


@pytest.mark.parametrize("text", ["a" * 200_000 + "@", "1" * 200_000, "a@" * 50_000, "+1" + " (" * 50_000,
                                  "1." * 50_000, "@a.b" * 20_000 + "x" * 100_000])
def test_very_long_texts(text):
    privacy.find_entities(text)


def documents():
    pick = random.Random(1)
    words = [f"word{i}" for i in range(60)]
    given = []
    for i in range(120):
        body = [pick.choice(words) for _ in range(12)]
        if i < 10:  # the nickname never stands without the address
            body[4:4] = ["zorro", "uses", "diego@vega.example.org"]
        elif i < 40:
            body[3:3] = ["uses"]
        given.append((i, " ".join(body)))
    copied = "a single context: quuxly writes from one@place.example.org to all"
    given += [(200 + i, copied) for i in range(9)]
    return given


WORD = r"[^\W_]+"


def terms_of(words, text):
    """Words of two characters or more and pairs with one space between."""
    found = {w[0].lower() for w in words if len(w[0].lower()) >= 2}
    return found | {f"{a[0].lower()} {b[0].lower()}" for a, b in zip(words, words[1:]) if text[a.end() : b.start()] == " "}


def shares(given):
    """Disclosed shares by brute force."""
    total, met, entities, contexts, holds = len(given), {}, {}, {}, {}
    for n, (_, text) in enumerate(given):
        text = text or ""
        for term in terms_of(list(re.finditer(WORD, text)), text):
            holds.setdefault(term, set()).add(n)
        spans = plain_spans(text)
        apart = [m for m in re.finditer(WORD, text) if not any(a < m.end() and m.start() < b for a, b, _ in spans)]
        for start, end, kind in spans:
            entity = f"{kind}:{text[start:end].lower()}"
            entities.setdefault(entity, set()).add(n)
            block = sum(m.start() < start for m in apart) // privacy.HALF_WINDOW
            around = apart[max(0, block - 1) * privacy.HALF_WINDOW : (block + 2) * privacy.HALF_WINDOW]
            lower = {m[0].lower() for m in around}
            for term in terms_of(around, text):
                if n not in met.setdefault((term, entity), set()):
                    met[term, entity].add(n)
                    least = tuple(
                        tuple(sorted(xxhash.xxh32_intdigest(w, seed) for w in lower - set(term.split(" ")))[:2])
                        for seed in (1, 2)
                    )
                    contexts.setdefault((term, entity), []).append(least)
    found = {}
    for (term, entity), both in met.items():
        known = math.log(total / len(entities[entity]))
        different = max(len(set(c)) for c in zip(*contexts[term, entity]))
        chance = len(holds[term]) * len(entities[entity]) / total
        if different > 1 and different > chance and known > 0:
            tail = different - chance + different * math.log(chance / different)
            if tail <= math.log(privacy.SIGNIFICANCE / len(met)):
                found[term] = max(found.get(term, 0), math.log(len(both) / chance) / known)
    found = {term: s for term, s in found.items() if s >= privacy.GENERALISE}
    return {t: s for t, s in found.items() if " " not in t or not any(w in found for w in t.split(" "))}


def spans_of(text, terms):
    """Where the disclosing terms stand."""
    words = list(re.finditer(WORD, text))
    found = [(m.start(), m.end()) for m in words if m[0].lower() in terms]
    found += [(a.start(), b.end()) for a, b in zip(words, words[1:])
              if text[a.end() : b.start()] == " " and f"{a[0]} {b[0]}".lower() in terms]
    return found


def test_disclosing_terms(make, monkeypatch):
    monkeypatch.setattr(privacy, "BLOCK_TERMS", 2)
    given = documents()
    df = make(given, "doc_id long, text string")
    got = {r.term: r.share for r in privacy.disclosing_terms(df).collect()}
    expected = shares(given)
    assert "zorro" in got and "uses" not in got and "quuxly" not in got
    assert got.keys() == expected.keys()
    assert all(abs(got[word] - expected[word]) < 1e-9 for word in got)


def test_common_words_are_no_candidates(make, monkeypatch):
    """Words that stand near many entities are told by that, and not looked for in the documents."""
    pick = random.Random(7)
    common = [f"word{i}" for i in range(12)]
    given = []
    for i in range(600):
        body = [pick.choice(common) for _ in range(6)] + [f"other{pick.randrange(400)}" for _ in range(20)]
        if i < 300:
            body.insert(9, f"p{i // 12}@x.example.org")
        if i < 24:
            body.insert(15, f"nick{i // 12}")
        given.append((i, " ".join(body)))
    asked = []
    counts = privacy.document_counts
    monkeypatch.setattr(
        privacy, "document_counts",
        lambda df, terms, text: asked.append({r.term for r in terms.select("term").distinct().collect()}) or counts(df, terms, text),
    )
    got = {r.term: r.share for r in privacy.disclosing_terms(make(given, "doc_id long, text string")).collect()}
    expected = shares(given)
    assert got.keys() == expected.keys() >= {"nick0", "nick1"}
    assert all(abs(got[term] - expected[term]) < 1e-9 for term in got)
    assert not asked[0] & set(common)


def test_counts_of_a_task_are_sums(spark):
    """A task sends each term on once, however many batches it has."""
    texts = spark.range(5000, numPartitions=1).selectExpr("concat('wu lives here ', id) as text")
    terms = spark.createDataFrame([("wu",), ("lives here",)], "term string")
    counted = privacy.document_counts(texts, terms)
    assert sorted(map(tuple, counted.collect())) == [("lives here", 5000), ("wu", 5000)]
    sent = []
    mapped = privacy._map
    try:
        privacy._map = lambda *given: sent.append(mapped(*given)) or sent[-1]
        privacy.document_counts(texts, terms)
    finally:
        privacy._map = mapped
    assert sent[0].count() == 2


ODD = ["Σ", "ΟΔΟΣ", "ΟΔΟΣ'Α", "ʰΣ", "İ", "ß", "Ann", "ann", "b", "_", "a_b", " ", "  ", "\t", "\n", "\xa0", "\u2028", "-", "'", "7", "٣", "名前", "e\u0301"]


def plain_terms(text):
    """Places of words and of pairs of words with a space between, word by word."""
    words = list(re.finditer(r"[^\W_]+", text))
    found = [(m.start(), m.end(), m[0].lower()) for m in words]
    found += [(a.start(), b.end(), f"{a[0].lower()} {b[0].lower()}") for a, b in zip(words, words[1:])
              if text[a.end() : b.start()] == " "]
    return sorted(found)


def test_terms_as_word_by_word():
    pick = random.Random(5)
    texts = ["".join(pick.choice(ODD) + pick.choice(["", " ", " "]) for _ in range(pick.randint(0, 15))) for _ in range(4000)]
    every = sorted({term for text in texts for *_, term in plain_terms(text)})
    for text in texts:
        terms = dict.fromkeys(pick.sample(every, 200))
        pairs = privacy._of_two(terms)
        found = [t for t in plain_terms(text) if t[2] in terms]
        assert sorted(privacy._term_spans(text, [], terms, pairs)) == found, text
        alone = frozenset(t for t in terms if " " not in t)
        assert privacy._held(text, alone, pairs) == {t[2] for t in found}, text


def test_only_stretches_with_a_term_are_read_pair_by_pair(monkeypatch):
    """Of words without a term none is looked at on its own, and no pair of them is made."""
    made, pair = [], privacy._pair
    monkeypatch.setattr(privacy, "_pair", lambda *given: made.append(given) or pair(*given))
    terms = {"wu": "", "april rose": ""}
    text = "one two three, " * 500 + "here is Wu; " + "april and rose " * 500
    assert [t for *_, t in privacy._term_spans(text, [], terms, privacy._of_two(terms))] == ["wu"]
    assert len(made) == 2


def test_texts_go_to_python_once_to_be_searched(make, rows, monkeypatch):
    """Terms of the last block are found by the worker that writes the result; blocks do not change it."""
    extra = [(400 + i, "April Rose met Wu, ann@x.example.org" if i < 12 else "other words here") for i in range(200)]
    extra = [(k, f"{text} {k} {k % 7}") for k, text in extra]
    df = make([*documents(), *extra, (None, None)], "doc_id long, text string")
    found = privacy.find(df)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert privacy.disclosing_terms(df).count() > 1
    monkeypatch.setattr(privacy, "BLOCK_TERMS", 1)
    assert rows(privacy.find(df)) == rows(found)


def test_counts_of_null_empty_and_repeated_texts(make):
    texts = make([(None,), (None,), ("",), ("Wu lives",), ("Wu lives",), ("wu  lives wu",)], "text string")
    terms = make([("wu",), ("wu lives",), ("wu lives",), ("lives wu",), ("gone",)], "term string")
    counted = {r.term: r.documents for r in privacy.document_counts(texts, terms).collect()}
    assert counted == {"wu": 3, "wu lives": 2, "lives wu": 1}


def test_find(make, rows):
    given = [*documents(), (None, None), (301, ""), (301, ""), (302, "Zorro: 10.0.0.1, +49 30 1234567")]
    got = rows(privacy.find(make([(*g, "x") for g in given], "doc_id long, text string, spans string")))
    terms = shares(given)
    expected = []
    for key, text in given:
        base = plain_spans(text or "")
        extra = [(low, high, "term") for low, high in spans_of(text or "", terms)
                 if not any(a < high and low < b for a, b, _ in base)]
        both = sorted(base + extra, key=lambda s: (s[0], privacy.KINDS.index(s[2])))
        expected.append((key, *(sum(s[2] == k for s in base) for k in privacy.KINDS[:4]),
                         hashlib.sha256(privacy.listed(base).encode()).hexdigest(), privacy.listed(both)))
    assert got == sorted(expected, key=repr)
    assert any("term:" in r[-1] for r in got)


def test_names_of_any_kind_and_distance(make, rows):
    """A name twelve words away, one sixty words away, a short one, one of common words, one in other letters."""
    pick = random.Random(12)
    common = [f"word{i}" for i in range(400)]

    def prose(n):
        return " ".join(pick.choice(common) for _ in range(n))

    def person(i):
        return {
            "ann@x.example.org": f"Quimby {prose(12)} ann@x.example.org {prose(30)}",
            "bob@x.example.org": f"{prose(5)} bob@x.example.org {prose(60)} Ruthven {prose(9)}",
            "wu@x.example.org": f"{prose(20)} Wu {prose(7)} wu@x.example.org",
            "gray@x.example.org": f"{prose(9)} April Rose {prose(15)} gray@x.example.org {prose(20)}",
            "ist@x.example.org": f"{prose(9)} İSTANBUL {prose(15)} ist@x.example.org {prose(20)}",
        }

    texts = [text for i in range(12) for text in person(i).values()]
    texts += [f"{prose(40)} {pick.choice(['April', 'Rose'])} {prose(20)}" for _ in range(300)]
    texts += [f"{prose(90)} 10.0.0.{i % 200}" for i in range(600)]
    copied = f"Zyx {prose(50)} copied@x.example.org {prose(40)}"
    texts += [copied] * 30 + [copied.replace("word7 ", "other "), copied + " end"] * 4
    given = list(enumerate(texts))
    got = {r.term: r.share for r in privacy.disclosing_terms(make(given, "doc_id long, text string")).collect()}
    assert got.keys() == shares(given).keys()
    assert got.keys() == {"quimby", "ruthven", "wu", "april rose", "İstanbul".lower()}
    hidden = dict(rows(privacy.sanitise(make(given, "doc_id long, text string"))))
    assert "April Rose" not in hidden[3] and any("April" in t for t in hidden.values())
    assert not any("Wu" in t or "İSTANBUL" in t for t in hidden.values())
    assert [hidden[i] for i in range(60, 360)] == texts[60:360]


def test_sanitise(make, rows):
    given = [*documents(), (None, None), (301, ""), (302, "Zorro: 10.0.0.1, +49 30 1234567")]
    got = dict(rows(privacy.sanitise(make([(*g, "x") for g in given],
                                          "doc_id long, text string, _terms_x string")),
                    "doc_id", "text"))
    assert got[302] == "[EMAIL-RELATED]: [IP], [PHONE]" and got[None] is None and got[301] == ""
    assert "zorro" not in got[0] and "[EMAIL]" in got[0] and "uses" in got[0]
    untouched = [k for k, t in given if k is not None and 10 <= k < 120]
    assert all(got[k] == dict(given)[k] for k in untouched)


def test_overlapping_spans_are_replaced_once():
    text = "call +1 4111 1111 1111 now"
    assert privacy.sanitised_text("x 4111111111111111 y", []) == "x [CARD] y"
    assert "1111" not in privacy.sanitised_text(text, [])


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert privacy.find(empty).collect() == [] and privacy.sanitise(empty).collect() == []
