"""Quality by weak supervision: rules vote or abstain, their accuracies are estimated, then weighed.

Every rule looks at a few counts of a text and votes good (1), bad (-1) or abstains (0). No labels are
used. A document is good or bad, unseen; a rule's good votes and its bad votes are each right with an
accuracy of their own, independently of other rules. Expectation-maximisation alternates between the
probability that a document is good, given the votes and accuracies, and the accuracies given those
probabilities. Documents with the same votes are alike, so it runs on the number of documents with
each pattern of votes: at most 3 to the power of the number of rules, at any scale, counted over all
documents. The posterior probability of good replaces the rule that all must pass.

Everything on the documents is DataFrame functions. Three-word windows are compared by their 64-bit
hash, sorted within their document; no window leaves its row.

Defined results: a null text has no words; empty texts fail the base rules; repeated rows and ties get
equal results; an empty table gives an empty table; columns of the input with the names of new ones
are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import in_one, out_of_one
from tunelake.session import written

LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: A document is kept from this probability on.
KEEP_FROM = 0.5
ROUNDS = 60

_SPACE = "[ \\t-\\r]+"
_STOP_WORDS = (
    "the of and to in is that for with as on was are "
    "der die das und ist von den mit zu nicht ein eine "
    "le la les des et est que dans pour une du en "
    "el los las que una por con para se del y es"
).split()

Counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window which the text holds twice or more."""

    def from_sorted(windows: Column) -> Column:
        last = F.size(windows) - 1

        def repeated(i: Column) -> Column:
            own = windows[i]["h"]
            before = (i > 0) & (windows[F.greatest(i - 1, F.lit(0))]["h"] == own)
            return before | ((i < last) & (windows[F.least(i + 1, last)]["h"] == own))

        starts = F.transform(F.filter(F.sequence(F.lit(0), last), repeated), lambda i: windows[i]["p"])
        covered = F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))
        return F.size(F.array_distinct(covered)).cast("long")

    def from_hashes(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            _let(F.sort_array(placed), from_sorted)
        )

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]),
    )
    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(_let(hashes, from_hashes))


def measures(text: Column) -> Column:
    """What the rules look at, as a struct: the base counts and some more."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^ \\t-\\r]"))
    stop_words = F.array(*map(F.lit, _STOP_WORDS))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(F.array_intersect(words, stop_words)).alias("stop_words"),
            F.size(F.array_distinct(words)).alias("different_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).alias("lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(lines, lambda line: line.rlike("[.!?…][\"'”»)]*[ \\t-\\r]*$"))).alias("ended"),
        )

    return F.struct(
        _let(F.array_remove(F.split(text, _SPACE), ""), of_words).alias("w"),
        _let(lines, of_lines).alias("l"),
        F.regexp_count(text, F.lit("\\p{Lu}")).alias("upper"),
        F.regexp_count(text, F.lit("[!?]{2,}|[*$%&#]{3,}")).alias("noise"),
    )


def _votes() -> list[Column]:
    """The rules, over the columns of ``measures``: 1 good, -1 bad, 0 abstains."""
    words = F.greatest(F.col("w.n_words"), F.lit(1))
    mean = F.col("w.word_chars") / words
    marks = F.col("w.n_symbols") / words
    copied = F.col("l.n_dup_lines") / F.greatest(F.col("l.lines"), F.lit(1))
    repeated = F.col("w.n_repeat_words") / words
    upper = F.col("upper") / F.greatest(F.col("w.word_chars"), F.lit(1))
    noise = F.col("noise") / words
    different = F.col("w.different_words") / words
    ended = F.col("l.ended") / F.greatest(F.col("l.lines"), F.lit(1))
    long_enough = F.col("w.n_words") >= LEAST_WORDS

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    abstain = F.lit(False)
    return [
        vote(~long_enough, F.col("w.n_words") >= 2 * LEAST_WORDS),
        vote((mean < 2.5) | (mean > 14), (mean >= 3.5) & (mean <= 9)),
        vote(marks > 0.1, abstain),
        vote(copied > 0.3, abstain),
        vote(repeated > 0.3, abstain),
        vote(long_enough & (F.col("w.stop_words") < 2), F.col("w.stop_words") >= 4),
        vote((upper > 0.3) | (noise > 0.1), (upper < 0.1) & (noise < 0.01)),
        vote(long_enough & (different < 0.2), different > 0.3),
        vote((F.col("l.lines") > 2) & (ended < 0.2), ended > 0.6),
    ]


#: By rule: the probability that a document is good, given that the rule votes bad, and votes good.
Worth = list[tuple[float, float]]


def _odds(probability: float) -> float:
    return math.log(probability / (1 - probability))


def _posterior(pattern: tuple[int, ...], prior: float, worth: Worth) -> float:
    """Probability of good, given the votes: each vote moves the odds from the prior's to its own."""
    odds = _odds(prior)
    for vote, given in zip(pattern, worth):
        if vote:
            odds += _odds(given[vote > 0]) - _odds(prior)
    return 1 / (1 + math.exp(-odds))


def estimate(
    counts: dict[tuple[int, ...], int], rules: int, rounds: int = ROUNDS
) -> tuple[float, Worth]:
    """Share of good documents and what votes are worth, by expectation-maximisation.

    ``counts``: documents by pattern of votes. A good vote never lowers the odds and a bad one never
    raises them: rules are better than chance, which settles which class is the good one. A vote
    counts as if it had been seen a few times before with its first value.
    """
    prior, worth = 0.8, [(0.2, 0.9)] * rules
    total = sum(counts.values())
    for _ in range(rounds if total else 0):
        good = {pattern: _posterior(pattern, prior, worth) for pattern in counts}
        share = sum(n * good[p] for p, n in counts.items()) / total
        before, prior = prior, min(max(share, 0.05), 0.95)
        updated = []
        for rule in range(rules):
            sums = {-1: [0.2 * 5, 5.0], 1: [0.9 * 5, 5.0]}
            for pattern, n in counts.items():
                if pattern[rule]:
                    sums[pattern[rule]][0] += n * good[pattern]
                    sums[pattern[rule]][1] += n
            bad_vote, good_vote = (sums[v][0] / sums[v][1] for v in (-1, 1))
            updated.append(
                (min(max(bad_vote, 0.005), prior), max(min(good_vote, 0.995), prior))
            )
        change = abs(before - prior) + max(
            (abs(a - b) for old, new in zip(worth, updated) for a, b in zip(old, new)), default=0
        )
        worth = updated
        if change < 1e-9:
            break
    return prior, worth


def score(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``df`` (all by default), the base counts, the verdicts, the posterior.

    The counts are made once and written; the votes are counted from there.
    """
    new = [*Counts, "base_failed", "good", "kept"]
    kept = [c for c in keep or df.columns if c.lower() not in new]
    measured = df.select(in_one(kept), measures(F.col(text)).alias("_m"))
    votes = F.lit(0)
    voted = measured.select("own", F.col("_m.*"))
    for rule in _votes():
        votes = votes * 3 + rule + 1
    voted = written(
        voted.select(
            "own",
            "w.n_words",
            "w.word_chars",
            "w.n_symbols",
            "l.n_dup_lines",
            "w.n_repeat_words",
            votes.cast("int").alias("_votes"),
        ),
        "quality",
    )
    rules = len(_votes())
    by_code = {r["_votes"]: r["n"] for r in
               voted.groupBy("_votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    patterns = {
        code: tuple(code // 3 ** (rules - 1 - rule) % 3 - 1 for rule in range(rules))
        for code in by_code
    }
    prior, worth = estimate({patterns[code]: n for code, n in by_code.items()}, rules)
    verdicts = df.sparkSession.createDataFrame(
        [(code, _posterior(pattern, prior, worth)) for code, pattern in patterns.items()],
        "_code int, good double",
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    # One row for each pattern that occurs: never more than 3 to the power of the number of rules.
    return voted.join(F.broadcast(verdicts), F.col("_votes") == F.col("_code")).select(
        "own",
        *Counts,
        failed.alias("base_failed"),
        "good",
        (~failed & (F.col("good") >= KEEP_FROM)).alias("kept"),
    ).select(*out_of_one(kept), *new)
