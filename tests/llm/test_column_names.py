"""Columns that are named like what the operators use on the way come back as they were."""

import random
import re
from pathlib import Path

import pytest

import corpus_pipeline
from tunelake.llm import language, near_duplicates, privacy, quality, sharding

FOLDER = Path(quality.__file__).parent
TAKEN = {"doc_id", "text", "lang", "source", "n_chars"}
OPERATORS = {
    "quality": (quality.score, {*quality.Counts, "base_failed", "good", "kept"}),
    "near_duplicates": (near_duplicates.keep_one, set()),
    "privacy": (privacy.sanitise, set()),
    "language": (
        lambda df: language.identify(df, language.fit(df, "text", "lang"), declared="lang", host="source"),
        {"language", "probability", "kept"},
    ),
    "sharding": (lambda df: sharding.shard(df, shards=2), {"size", "shard", "slot"}),
}


def names_in(module):
    """Every name that stands as a string in a module and could be a column's."""
    text = (FOLDER / f"{module}.py").read_text()
    found = set(re.findall(r'"(_?[a-z][a-z_0-9]{0,20})"', text)) | {"w", "l", "upper", "noise", "own", "none", "document"}
    return sorted(found - TAKEN)


def documents(spark, names):
    pick = random.Random(1)
    words = "the of and water house with from where thinking nothing between through".split()
    texts = [
        ". ".join(" ".join(f"{pick.choice(words)}{pick.randrange(400)}" for _ in range(9)) for _ in range(9))
        + ". the of and to in is" for _ in range(9)
    ]
    texts += [texts[0], None, "", "mail me at someone@example.org now"]
    rows = [(n, t, "en", "s", 3, *(f"{name}-{n}" for name in names)) for n, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("module", sorted(OPERATORS))
def test_columns_come_back(spark, module):
    operator, new = OPERATORS[module]
    names = names_in(module)
    assert len(names) > 8
    got = operator(documents(spark, names))
    kept = [n for n in names if n not in new]
    assert [c for c in got.columns if c not in new] == ["doc_id", "text", "lang", "source", "n_chars", *kept]
    rows = got.collect()
    assert len(rows) >= 10
    for row in rows:
        assert [row[n] for n in kept] == [f"{n}-{row.doc_id}" for n in kept]


def test_columns_pass_the_pipeline(spark):
    names = sorted({n for module in OPERATORS for n in names_in(module)} | set(quality.Counts) | {"language", "probability", "kept", "good"})
    docs = documents(spark, names)
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, ""), "stage")
        assert docs.columns == columns
    rows = docs.collect()
    assert len(rows) == 9 and all(row[n] == f"{n}-{row.doc_id}" for row in rows for n in names)
