import random
import re

import corpus_pipeline
from tunelake.llm import near_duplicates as nd
from tunelake.llm import packing, privacy, quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "quality", "near_duplicates", "personal_data", "packing"
    ]


def test_whole_small_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    given = {r.doc_id: r for r in docs.collect()}
    left = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, folder), "stage")
        assert docs.columns == COLUMNS
        left.append({r.doc_id: r for r in docs.collect()})
    by_language, good, single, hidden = left
    # language: what goes has no letters; texts stay as they are
    for key, row in given.items():
        if key not in by_language:
            assert not re.search(r"[^\W\d_]{3}", row.text)
        else:
            assert by_language[key] == row
    # quality: none that fails the base rules, and no labelled good text lost
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    for key, row in by_language.items():
        words = row.text.split()
        if key in good:
            assert len(words) >= 50
        elif len(words) >= 50 and labels.get(key) == 1:
            raise AssertionError(key)
    # near-duplicates: one of each group, by brute force
    own = {k: nd.labelled_kmers(nd.word_ids(r.text)) for k, r in good.items()}
    label = {k: k for k in own}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in own:
        for b in own:
            if a < b and nd.aligned(own[a], own[b]) >= 0.8:
                label[max(root(a), root(b))] = min(root(a), root(b))
    assert sorted(single) == sorted({root(k) for k in own})
    # personal data: nothing left, other texts untouched
    for key, row in single.items():
        assert not privacy.find_entities(hidden[key].text)
        assert hidden[key].n_chars == len(hidden[key].text)
        if not privacy.find_entities(row.text) and "[" not in hidden[key].text:
            assert hidden[key].text == row.text
    # packing: every piece of what is left, in sequences that are full but for few
    pieces = corpus_pipeline.run(spark, folder).collect()
    tokens = packing.WordTokens(packing.public_tokenizers.path("word_bpe_49k.json"))
    lengths = {k: len(raw) // 4 + 1 for k, raw in zip(hidden, tokens.encode([r.text for r in hidden.values()]))}
    found = {}
    for r in pieces:
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == lengths
    used = len({r.sequence_id for r in pieces})
    assert used <= -(-sum(lengths.values()) // packing.CAPACITY) + 1


def test_odd_tables(spark):
    pick = random.Random(1)
    words = "the of and water house with from where thinking nothing between through".split()
    texts = [". ".join(" ".join(pick.choice(words) + str(pick.randrange(400)) for _ in range(9)) for _ in range(9))
             + ". the of and to in is" for _ in range(12)]
    rows = [(i, t, "en", "s", len(t), True, 1.5, "x") for i, t in enumerate(texts)]
    rows += [(None, None, None, None, None, None, None, None), (3, "", None, None, 0, None, None, None),
             rows[0], rows[0], (99, "x" * 100_000, "en", None, 1, False, 0.5, "y")]
    schema = (f"doc_id long, text string, lang string, source string, n_chars long, kept boolean, "
              f"{quality.Counts[0]} double, size string")
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.written(stage(spark, docs, ""), "stage")
            assert docs.columns == spark.createDataFrame([], schema).columns
        left = sorted((r.doc_id, r.kept, r.n_words, r.size) for r in docs.collect())
        assert left == [(i, True, 1.5, "x") for i in range(len(texts) if given else 0)]
        assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()} == {
            i for i, *_ in left
        }
