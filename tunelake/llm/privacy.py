"""Finding and sanitising personal data by what terms disclose.

Addresses, numbers and the like are found by patterns: the protected entities. The corpus then says how
strongly other terms reveal them. For a term t near an entity e in documents, with N documents,

    PMI(t; e) = log( n(t, e) * N / (n(t) * n(e)) ),   IC(e) = log( N / n(e) ),

and the disclosed share of e is PMI / IC: 1 if t never stands without e, 0 if the two are independent. Terms
are words of two characters or more, and pairs of words with one space between. A text is covered by
overlapping windows of ``2 * HALF_WINDOW`` words, one beginning every ``HALF_WINDOW`` words; t is near e
where a window holds both, which it does wherever at most ``HALF_WINDOW`` words lie between them. n counts
documents, all of them.

Whether a pair is more than chance is decided by the counts. By chance t and e would meet in n(t) n(e) / N
documents. Against that stand the different contexts in which they meet; copies and near-copies of a
text mostly count as one, as a context is known by its two words with the smallest hashes, t left aside (the
larger count of two hash functions). A pair counts if so many contexts have a probability of ``SIGNIFICANCE`` at most, divided
by the number of all pairs (Chernoff's bound of the Poisson tail). Terms whose share reaches
``GENERALISE`` are generalised to the kind of entity wherever they stand, those that reach ``REMOVE`` are
removed; a pair of words is no term where one of them is.

What stands around an entity is kept as one row for each document, copies together, and only entities
with several surroundings are spread out into pairs, as hashes until the counts have decided. A term stands in
at least as many documents as it stands near entities in, so that common words drop out before the pass over
the documents that counts the other terms exactly.
Candidate terms and disclosing terms reach the tasks in blocks of bounded size.

Defined results: a null text counts as empty and stays null when sanitised; repeated rows count as
documents but add no context; documents without entities and disclosing terms stay as they are; an
empty table gives an empty table; ``find`` leaves other columns out, ``sanitise`` keeps them.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from heapq import nsmallest

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelake.llm.common import give_back, in_one, out_of_one, small_batches
from tunelake.session import ship_package, written

HALF_WINDOW, SHORTEST_TERM = 64, 2
SIGNIFICANCE, GENERALISE, REMOVE = 0.01, 0.9, 0.99
#: Terms that a pass over the documents looks for.
BLOCK_TERMS = 500_000
#: Rows, and characters of surroundings, that a worker gathers before it sends them on.
MENTIONS, CHARACTERS = 50_000, 4_000_000

KINDS = ("email", "ip", "card", "phone", "term")

Span = tuple[int, int, str]  # start, end, kind

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_WORD = re.compile(r"[^\W_]+")
#: Words with just a space between each two: pairs of words lie within these, and they are far fewer than words.
_RUN = re.compile(r"[^\W_]++(?: [^\W_]++)*+")


def _emails(text: str) -> Iterator[Span]:
    """From each @: the longest name before it, not reaching into the match before, and a domain."""
    end, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            low = at
            while low > end:  # piece by piece, so that a long text is not copied for each @
                part = text[max(end, low - 64) : low]
                kept = part.rstrip(_LOCAL)
                low -= len(part) - len(kept)
                if kept:
                    break
            if low < at:
                end = domain.end()
                yield low, end, "email"
        at = text.find("@", at + 1 if not domain else max(at + 1, domain.end()))


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def find_entities(text: str) -> list[Span]:
    """The pattern-based spans in code points, by start, then kind."""
    spans = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                spans.append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                spans.append((*m.span(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    spans.append((*m.span(), "phone"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _entity(text: str, span: Span) -> str:
    """One name for all ways to write an entity."""
    start, end, kind = span
    value = text[start:end]
    if kind in ("card", "phone"):
        value = "".join(_DIGIT.findall(value))
    return f"{kind}:{value.lower()}"


def _apart(text: str, spans: list[Span]) -> list[re.Match]:
    """The words that are not part of a span, in order."""
    found, i, end = [], 0, 0
    for m in _WORD.finditer(text):
        while i < len(spans) and spans[i][0] < m.end():
            end = max(end, spans[i][1])
            i += 1
        if m.start() >= end:
            found.append(m)
    return found


def _pair(text: str, first: re.Match, second: re.Match) -> str | None:
    """Two words with one space between them, as a term."""
    if text[first.end() : second.start()] != " ":
        return None
    return f"{first[0].lower()} {second[0].lower()}"


def _words(text: str) -> list[str]:
    """All words in small letters, with a line end between two that have not just a space between them."""
    return " \n ".join(_RUN.findall(text)).lower().split(" ")


def _held(text: str, alone: frozenset[str], pairs: frozenset[tuple[str, ...]]) -> set[str]:
    """The terms that a text holds, of those that are words ``alone`` and those that are ``pairs`` of words."""
    words = _words(text)
    held = set(alone.intersection(words))
    if pairs:
        held.update(map(" ".join, pairs.intersection(zip(words, words[1:]))))
    return held


def _of_two(terms: Iterable[str]) -> frozenset[tuple[str, ...]]:
    """The terms that are pairs of words, as tuples."""
    return frozenset(tuple(term.split(" ")) for term in terms if " " in term)


def _least_words(words: Iterable[str], seed: int) -> list[tuple[int, str]]:
    """The four words with the smallest hashes, which leave two where a term is put aside."""
    return nsmallest(4, ((xxhash.xxh32_intdigest(w, seed), w) for w in words))


def _context(hashes: list[int]) -> int:
    """The first two of the hashes as one number."""
    one, two = (*hashes[:2], 0, 0)[:2]
    return one << 30 ^ two


def _written_out(text: str, words: list[re.Match]) -> str:
    """Words in small letters; a space between two where the text has just that, else a line end."""
    parts = []
    for before, word in zip([None, *words], words):
        if before is not None:
            parts.append(" " if text[before.end() : word.start()] == " " else "\n")
        parts.append(word[0].lower())
    return "".join(parts)


def _terms(block: str) -> tuple[set[str], set[str]]:
    """All words of a written-out block, and its terms: words long enough and pairs of words."""
    words: set[str] = set()
    pairs: set[str] = set()
    for run in block.split("\n") if block else ():
        parts = run.split(" ")
        words.update(parts)
        pairs.update(f"{a} {b}" for a, b in zip(parts, parts[1:]))
    return words, pairs.union(w for w in words if len(w) >= SHORTEST_TERM)


def surroundings(text: str, spans: list[Span]) -> dict[str, list[str]]:
    """For each entity of a text the words of the windows that hold it, written out."""
    words = _apart(text, spans)
    starts = [m.start() for m in words]
    near: dict[str, dict[int, str]] = {}
    blocks: dict[int, str] = {}
    for span in spans:
        block = bisect_left(starts, span[0]) // HALF_WINDOW
        if block not in blocks:
            around = words[max(0, block - 1) * HALF_WINDOW : (block + 2) * HALF_WINDOW]
            blocks[block] = _written_out(text, around)
        near.setdefault(_entity(text, span), {})[block] = blocks[block]
    return {entity: list(held.values()) for entity, held in near.items()}


def near_terms(near: list[str]) -> Iterator[tuple[str, int, int]]:
    """Each term of an entity's surroundings once, with two hashes of its context."""
    seen: set[str] = set()
    for block in near:
        words, terms = _terms(block)
        least = [_least_words(words, seed) for seed in (1, 2)]
        for term in terms - seen:
            own = term.split(" ")
            yield term, *(_context([h for h, w in few if w not in own]) for few in least)
        seen |= terms


def _map(df: DataFrame, function, schema) -> DataFrame:
    ship_package(df.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(small_batches(batches))
        give_back()

    return df.mapInArrow(each, schema)


def sightings(df: DataFrame, text: str = "text") -> DataFrame:
    """Each entity with the words around it in a document and the number of terms there.

    ``n`` documents have the same: copies are one row. Each of them counts for ``part`` by the number of
    its entities, so that the parts of a document never come to more than 1.
    """
    schema = pa.schema(
        {"entity": pa.string(), "near": pa.list_(pa.string()), "terms": pa.int64(), "part": pa.float64()}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            held = 0
            for value in batch.column(0).to_pylist():
                spans = find_entities(value or "")
                around = surroundings(value, spans) if spans else {}
                for entity, near in around.items():
                    terms = len(set().union(*(_terms(block)[1] for block in near)))
                    found.append((entity, near, terms, 1 / len(around)))
                    held += sum(map(len, near))
                    if held >= CHARACTERS:
                        yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*found))], schema=schema)
                        found, held = [], 0
            if found:
                yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*found))], schema=schema)

    rows = _map(df.select(text), run, "entity string, near array<string>, terms long, part double")
    return rows.groupBy("entity", "near", "terms").agg(F.count(F.lit(1)).alias("n"), F.sum("part").alias("part"))


def mentions(seen: DataFrame) -> DataFrame:
    """A row for each sighting and term in it, once for each of the two hashes of its context.

    The second hash is told from the first by its last bit, and only the first carries ``n`` and ``part``.
    """
    schema = pa.schema(
        {"entity": pa.string(), "mentioned": pa.int64(), "term": pa.string(), "context": pa.int64(),
         "n": pa.int64(), "part": pa.float64()}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for row in batch.to_pylist():
                for term, *contexts in near_terms(row["near"]):
                    for other, context in enumerate(contexts):
                        own = (0, 0.0) if other else (row["n"], row["part"])
                        found.append((row["entity"], row["mentioned"], term, context << 1 | other, *own))
                if len(found) >= MENTIONS:
                    yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*found))], schema=schema)
                    found = []
            if found:
                yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*found))], schema=schema)

    return _map(
        seen.select("entity", "near", "n", "part", "mentioned"),
        run,
        "entity string, mentioned long, term string, context long, n long, part double",
    )


def _tail(chance: Column) -> Column:
    """The logarithm of the bound on the probability of so many contexts where ``chance`` is expected."""
    contexts = F.col("contexts")
    return contexts - chance + contexts * F.log(chance / contexts)


def _pairs(df: DataFrame, total: int, text: str, share: float) -> tuple[DataFrame, int]:
    """Entities and terms that may disclose ``share`` beyond chance, and the number of all pairs.

    An entity seen in one surrounding only, however often copied, has one context with each term, which
    proves nothing: its pairs are counted and not made. The others are counted by hashes, two of eight
    bytes for each pair, and get their names back once the counts have decided: a term stands in at
    least as many documents as the pair, and as its parts over all entities come to, so that the chance is at
    least and the share at most what these give.
    """
    seen = written(sightings(df, text), "sightings")
    entities = written(
        seen.groupBy("entity").agg(
            F.sum("n").alias("mentioned"), F.count(F.lit(1)).alias("around"), F.sum("terms").alias("terms")
        ),
        "entities",
    )
    several = seen.join(entities.filter("around > 1").select("entity", "mentioned"), "entity")
    keys = F.xxhash64("entity").alias("e"), F.xxhash64("term").alias("t")
    counted = written(
        mentions(several)
        .groupBy(*keys, "context")
        .agg(F.sum("n").alias("n"), F.sum("part").alias("part"), F.max("mentioned").alias("mentioned"))
        .groupBy("e", "t")
        .agg(
            F.sum("n").alias("together"),
            F.sum("part").alias("part"),
            F.max("mentioned").alias("mentioned"),
            F.greatest(
                F.count_if(F.col("context") % 2 == 0), F.count_if(F.col("context") % 2 != 0)
            ).alias("contexts"),
        ),
        "counted",
    )
    alone = entities.filter("around = 1").agg(F.coalesce(F.sum("terms"), F.lit(0))).first()[0]
    tests = alone + counted.count()
    rare = counted.filter((F.col("contexts") > 1) & (F.col("mentioned") < total))
    parts = counted.groupBy("t").agg(F.sum("part").alias("parts"))
    # Sums of parts have rounding errors.
    least = F.greatest("together", F.ceil(F.col("parts") - 1e-6)) * F.col("mentioned") / F.lit(float(total))
    most = F.log(F.col("together") / least) / F.log(F.lit(float(total)) / F.col("mentioned"))
    likely = written(
        rare.join(parts, "t")
        .filter(
            (F.col("contexts") > least)
            & (_tail(least) <= math.log(SIGNIFICANCE / max(1, tests)) + 1e-9)
            & (most >= share - 1e-9)
        )
        .drop("part", "parts"),
        "likely",
    )
    named = mentions(several.join(likely.select("e").distinct(), F.xxhash64("entity") == F.col("e"), "left_semi"))
    names = named.filter(F.col("context") % 2 == 0).select("entity", "term", *keys).distinct()
    return written(names.join(likely, ["e", "t"]).drop("e", "t"), "pairs"), tests


def _blocks(terms: DataFrame) -> Iterator[list]:
    """Rows of ``terms`` (first column ``term``) in blocks that are small enough to broadcast."""
    count = -(-terms.count() // BLOCK_TERMS)
    for number in range(count):
        yield terms.filter(F.pmod(F.xxhash64("term"), F.lit(count)) == number).collect()


def document_counts(df: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """For each of the ``terms`` (column ``term``) the documents that hold it.

    A worker sums over its batches, and sends on ``MENTIONS`` counts at the least or what it has at the end.
    """
    total = None
    for block in _blocks(terms.select("term").distinct()):
        names = [row["term"] for row in block]
        words = frozenset(name for name in names if " " not in name)
        wanted = df.sparkSession.sparkContext.broadcast((words, _of_two(names)))

        def sums(counts: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"term": list(counts), "n": list(counts.values())},
                pa.schema({"term": pa.string(), "n": pa.int64()}),
            )

        def run(batches: Iterator[pa.RecordBatch], wanted=wanted, sums=sums) -> Iterator[pa.RecordBatch]:
            counts = Counter()
            for batch in batches:
                for value in batch.column(0).to_pylist():
                    counts.update(_held(value or "", *wanted.value))
                if len(counts) >= MENTIONS:
                    yield sums(counts)
                    counts = Counter()
            yield sums(counts)

        part = (
            _map(df.select(text), run, "term string, n long")
            .groupBy("term")
            .agg(F.sum("n").alias("documents"))
        )
        total = part if total is None else total.unionByName(part)
    return total


def disclosing_terms(df: DataFrame, text: str = "text", share: float = GENERALISE) -> DataFrame:
    """Terms that disclose an entity: ``term``, ``kind`` of the entity, ``share`` that they disclose.

    Of several entities the one that is disclosed most counts.
    """
    total = df.count()
    pairs, tests = _pairs(df, total, text, share)
    if pairs.isEmpty():
        return pairs.select("term", F.lit("").alias("kind"), F.lit(0.0).alias("share"))
    terms = document_counts(df, pairs, text)
    known = F.log(F.lit(float(total)) / F.col("mentioned"))
    chance = F.col("documents") * F.col("mentioned") / F.lit(float(total))
    pmi = F.log(F.col("together") / chance)
    scored = (
        pairs.join(terms, "term")
        .filter(
            (known > 0) & (F.col("contexts") > chance) & (_tail(chance) <= math.log(SIGNIFICANCE / tests))
        )
        .withColumn("share", pmi / known)
        .filter(F.col("share") >= share)
        .withColumn("kind", F.split_part("entity", F.lit(":"), F.lit(1)))
    )
    by_kind = scored.groupBy("term", "kind").agg(F.max("share").alias("share"))
    best = by_kind.groupBy("term").agg(
        F.max("share").alias("share"), F.max_by("kind", F.struct("share", "kind")).alias("kind")
    )
    best = written(best.select("term", "kind", "share"), "disclosing")
    words = best.filter(~F.contains("term", F.lit(" "))).select(F.col("term").alias("word"))
    of_pairs = best.filter(F.contains("term", F.lit(" ")))
    covered = of_pairs.select("term", F.explode(F.split("term", " ")).alias("word")).join(words, "word")
    pairs_left = of_pairs.join(covered.select("term").distinct(), "term", "left_anti")
    return written(best.filter(~F.contains("term", F.lit(" "))).unionByName(pairs_left), "disclosing")


def _term_spans(
    text: str, spans: list[Span], terms: dict[str, str], pairs: frozenset[tuple[str, ...]]
) -> list[tuple[int, int, str]]:
    """Words, and pairs of words, that are disclosing terms, outside the spans: start, end, term.

    ``pairs`` are the terms of two words, as tuples.
    """
    if not terms:
        return []
    found = []
    for run in _RUN.finditer(text):
        words = run[0].lower().split(" ")
        if terms.keys().isdisjoint(words) and (not pairs or pairs.isdisjoint(zip(words, words[1:]))):
            continue
        before = None
        for m in _WORD.finditer(text, *run.span()):
            word = m[0].lower()
            if word in terms:
                found.append((m.start(), m.end(), word))
            if pairs and before is not None and (pair := _pair(text, before, m)) in terms:
                found.append((before.start(), m.end(), pair))
            before = m
    return [(a, b, term) for a, b, term in found if not any(s[0] < b and a < s[1] for s in spans)]


def _with_terms(df: DataFrame, terms: DataFrame, text: str, then, schema) -> DataFrame:
    """What ``then`` makes of ``df`` with ``_terms``: array of (start, end, replacement) of the disclosing terms.

    It runs in the worker that has found the terms of the last block, so that texts go to Python once.
    """
    kept = list(df.columns)
    kind = "array<struct<start:int,end:int,instead:string>>"
    df = df.withColumn("_terms", F.array().cast(kind))
    place = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("instead", pa.string())])
    find_terms = None
    for block in _blocks(terms):
        if find_terms is not None:
            df = written(_map(df, find_terms, df.schema), "terms")
        instead = {
            row["term"]: "" if row["share"] >= REMOVE else f"[{row['kind'].upper()}-RELATED]"
            for row in block
        }
        given = df.sparkSession.sparkContext.broadcast(instead)

        def find_terms(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            pairs = _of_two(given.value)
            for batch in batches:
                found = []
                for value, earlier in zip(
                    batch.column(text).to_pylist(), batch.column("_terms").to_pylist()
                ):
                    spans = find_entities(value or "")
                    found.append(
                        [
                            *earlier,
                            *(
                                {"start": start, "end": end, "instead": given.value[word]}
                                for start, end, word in _term_spans(value or "", spans, given.value, pairs)
                            ),
                        ]
                    )
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), pa.array(found, pa.list_(place))],
                    names=[*kept, "_terms"],
                )

    if find_terms is None:
        return _map(df, then, schema)
    return _map(df, lambda batches: then(find_terms(batches)), schema)


def _all_spans(text: str, terms: list[dict]) -> list[tuple[int, int, str, str]]:
    """All spans by start, then kind, with what stands instead."""
    spans = [(*s, f"[{s[2].upper()}]") for s in find_entities(text)]
    spans += [(t["start"], t["end"], "term", t["instead"]) for t in terms]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def find(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts by kind, a digest of the pattern-based spans, and all spans, for each document."""
    df = df.select(F.col(key), F.col(text))
    counted = ["n_email", "n_ip", "n_card", "n_phone"]
    schema = T.StructType(
        [df.schema[key], *(T.StructField(c, T.LongType()) for c in counted),
         T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in counted]
            digests, all_spans = [], []
            for value, terms in zip(
                batch.column(text).to_pylist(), batch.column("_terms").to_pylist()
            ):
                spans = [s[:3] for s in _all_spans(value or "", terms)]
                base = [s for s in spans if s[2] != "term"]
                for column, kind in zip(counts, KINDS):
                    column.append(sum(s[2] == kind for s in base))
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                all_spans.append(listed(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(digests, pa.string()), pa.array(all_spans, pa.string())],
                names=[key, *counted, "base_sha256", "spans"],
            )

    return _with_terms(df, disclosing_terms(df, text), text, run, schema)


def sanitised_text(text: str, terms: list[dict]) -> str:
    """The text with every span replaced; spans that overlap are replaced as one, by the first's."""
    parts, end = [], 0
    for start, stop, _, instead in _all_spans(text, terms):
        if start >= end:
            parts += [text[end:start], instead]
        end = max(end, stop)
    return "".join([*parts, text[end:]])


def sanitise(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with entities and disclosing terms replaced in ``text``; all rows and columns stay."""
    others = [c for c in df.columns if c != text]
    rows = df.select(in_one(others), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if value is None else sanitised_text(value, terms)
                for value, terms in zip(
                    batch.column("text").to_pylist(), batch.column("_terms").to_pylist()
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("own"), pa.array(texts, pa.string())], names=["own", "text"]
            )

    hidden = _with_terms(rows, disclosing_terms(rows), "text", run, rows.schema)
    return hidden.select(*out_of_one(df.columns, text=text))
