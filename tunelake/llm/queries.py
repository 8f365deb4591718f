"""The corpus operators as queries over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.llm import (
    byte_bpe,
    conversations,
    language,
    licences,
    near_duplicates,
    packing,
    passages,
    privacy,
    quality,
    sharding,
    token_counts,
    topk,
    whitening,
)
from tunelake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return register


@_query("op1_byte_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


@_query("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@_query("op2_histogram_sort")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        "size",
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


_OP10 = """
WITH usable AS (
    SELECT row_number() OVER () AS row, vec_id, embedding
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS (
    SELECT row, vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS place,
           len(embedding) AS size
    FROM usable),
whole AS (
    SELECT row, vec_id, size, place, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM parts),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, c.row AS row,
           CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.place = c.place AND q.size = c.size AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
    GROUP BY q.vec_id, c.vec_id, c.row)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""


@_query("op10_bit_sliced_topk", _OP10)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.filter("vec_id % 100 = 0"), 10)


@_query("op9_information_theoretic_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.find(table(spark, sf_dir, "documents"))


@_query("op5_weak_supervision")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return scored.select("doc_id", *quality.Counts, "base_failed", "kept", "good")


@_query("op3_length_histogram")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every length and the usual context limits, with the quantiles that lie at each length."""
    histogram = token_counts.length_histogram(table(spark, sf_dir, "documents"))
    return token_counts.with_quantiles(
        token_counts.limits(histogram, [512, 1024, 2048, 4096, 8192, 16_384, 32_768, 131_072]),
        [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0],
    )


def _op8_sql() -> str:
    """The canonical form and its digests in the other dialect."""
    form = f"regexp_replace(lower(text), '{licences.COPYRIGHT_LINE}', '', 'g')"
    for spelling, common in licences.SPELLINGS:
        form = f"replace({form}, '{spelling}', '{common}')"
    form = f"regexp_replace({form}, '{licences._VERSION}', 'version \\1', 'g')"
    form = f"regexp_replace({form}, '{licences._OTHER}', ' ', 'g')"
    rows = ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''"))
        for name, texts in licences.KNOWN.items()
        for text in texts
    )
    digest = "sha256(trim(regexp_replace({}, '[ \\n]+', ' ', 'g')))"
    return f"""
    WITH known AS (
        SELECT digest, min(name) AS licence
        FROM (SELECT name, {digest.format(form)} AS digest FROM (VALUES {rows}) AS k(name, text))
        GROUP BY digest),
    forms AS (SELECT doc_id, {form} AS form FROM documents),
    split AS (SELECT doc_id, string_split(form, chr(10)) AS parts, form FROM forms),
    units AS (
        SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS line, unnest(parts) AS unit
        FROM split
        UNION ALL
        SELECT doc_id, NULL, form FROM split WHERE contains(form, chr(10)))
    SELECT doc_id, line, licence
    FROM units JOIN known ON {digest.format("unit")} = digest
    WHERE trim(unit) <> '' OR line IS NULL
    """


@_query("op8_canonical_digests", _op8_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


@_query("op4_evidence_fusion")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages: which languages there are is learnt from the labelled documents."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    model = language.fit(documents, "text", "lang")
    pages = language.with_page_evidence(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    of_documents = language.identify(documents, model, declared="lang", host="source")
    of_pages = language.identify(pages.drop("url"), model)
    result = ["language", F.round("probability", 6).alias("probability"), "kept"]
    return of_documents.select("doc_id", F.lit(None).cast("long").alias("page_id"), *result).unionByName(
        of_pages.select(F.lit(None).cast("long").alias("doc_id"), "page_id", *result)
    )


@_query("op7_order_minhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(table(spark, sf_dir, "documents"))


def _op12_sql() -> str:
    """Damage, faults and the cheapest edits, a row of every conversation at a time."""
    space = " || ".join(f"chr({ord(c)})" for c in conversations.SPACE)

    def then(state: str, cost: str, edit: str) -> str:
        """A state is its cost in ten digits and the edits; null where it cannot be reached."""
        dearer = f"lpad(CAST(CAST(left({state}, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0')"
        return f"CASE WHEN {state} IS NOT NULL THEN {dearer} || substr({state}, 11) || '{edit}' END"

    def stays(state: str, letter: str) -> str:
        keep, other = then(state, "more", "K"), then(state, "more + 3", "R")
        return f"CASE WHEN NOT lost THEN CASE WHEN letter = '{letter}' THEN {keep} ELSE {other} END END"

    inserted = {s: then(s, "3", "I") for s in ("s0", "s1", "s3", "user")}
    closed = f"""
        SELECT *, least(s3, {inserted["user"]}) AS assistant
        FROM (SELECT *, least(s2, {inserted["s0"]}, {inserted["s1"]}, {inserted["s3"]}) AS user FROM {{}})"""
    return f"""
    WITH RECURSIVE bits AS (
        SELECT [list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, 3988292384 * (c & 1)))
                for n in range(256)] AS crc_of),
    sums AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               [ascii(x) for x in string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' ||
                                               coalesce(CAST(turn AS VARCHAR), ' '), '')] AS name
        FROM conversations),
    kinds AS (
        SELECT conv_id, turn, role, text,
               xor(list_reduce(list_concat([4294967295], name),
                   lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
        FROM sums, bits),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM kinds JOIN (VALUES (1), (2)) AS copies(copy) ON copy = 1 OR kind = 3
        WHERE kind <> 0),
    repeated AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again,
               rtrim(text, {space}) AS said
        FROM damaged),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS place
        FROM repeated),
    faulty AS (
        SELECT *, left(role, 1) AS letter,
               CASE WHEN said = '' THEN 'blank' WHEN again THEN 'duplicate'
                    WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault
        FROM placed),
    steps AS (
        SELECT *, fault IN ('blank', 'duplicate') AS lost,
               CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more
        FROM faulty),
    survivors(conv_id, place, s0, s1, s2, s3) AS (
        SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '0000000000', CAST(NULL AS VARCHAR),
               CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
        FROM conversations
        UNION ALL
        SELECT conv_id, place, {then("s0", "4", "D")},
               least({then("s1", "4", "D")},
                     CASE WHEN NOT lost AND letter = 's' THEN {then("s0", "more", "K")} END),
               least({then("user", "4", "D")}, {", ".join(stays(s, "u") for s in ("s0", "s1", "assistant"))}),
               least({then("assistant", "4", "D")}, {stays("user", "a")})
        FROM ({closed.format("""(
            SELECT d.conv_id, d.place, lost, more, letter, s0, s1, s2, s3
            FROM survivors v JOIN steps d ON d.conv_id IS NOT DISTINCT FROM v.conv_id AND d.place = v.place + 1)""")})),
    repaired AS (
        SELECT conv_id, CAST(left(least(s0, assistant), 10) AS BIGINT) AS cost,
               substr(least(s0, assistant), 11) AS audit
        FROM ({closed.format("""(
            SELECT * FROM survivors
            QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY place DESC) = 1)""")})),
    letters AS (
        SELECT conv_id, unnest(string_split(audit, '')) AS edit,
               generate_subscripts(string_split(audit, ''), 1) AS nth
        FROM repaired),
    edits AS (
        SELECT *, count(*) FILTER (edit <> 'I') OVER sofar AS place, count(*) FILTER (edit <> 'D') OVER sofar AS kept
        FROM letters
        WINDOW sofar AS (PARTITION BY conv_id ORDER BY nth)),
    shown AS (
        SELECT e.*, d.role, CASE WHEN edit = 'I' THEN '' ELSE d.text END AS text,
               max(CASE WHEN kept = 1 AND edit = 'K' AND letter = 's' THEN 1 ELSE 0 END)
                   OVER (PARTITION BY e.conv_id) AS system
        FROM edits e
        LEFT JOIN steps d ON d.conv_id IS NOT DISTINCT FROM e.conv_id AND d.place = e.place
        WHERE edit <> 'D'),
    texts AS (
        SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (kept - system) % 2 = 1 THEN 'user'
                                        ELSE 'assistant' END || ':' || text, chr(10) ORDER BY nth) AS whole
        FROM shown
        GROUP BY conv_id),
    pairs AS (
        SELECT *, lag(letter) OVER (PARTITION BY conv_id ORDER BY place) || letter AS pair FROM steps),
    faults AS (
        SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM pairs
        GROUP BY conv_id)
    SELECT r.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
           sha256(coalesce(whole, '')) AS repaired_sha256
    FROM repaired r
    LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM r.conv_id
    LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM r.conv_id
    """


@_query("op12_survivor_viterbi", _op12_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.report(conversations.repair(damaged))


@_query("op13_incremental_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


_OP11 = """
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents),
starts AS (SELECT row, unnest(range(1, len(words) - 33)) AS start FROM texts WHERE len(words) >= 35),
windows AS (
    SELECT s.row, start, sha256(array_to_string(list_slice(words, start, start + 34), ' ')) AS digest
    FROM starts s JOIN texts t ON s.row = t.row),
repeated AS (SELECT digest FROM windows GROUP BY digest HAVING count(*) > 1),
covered AS (
    SELECT DISTINCT row, unnest(range(start, start + 35)) AS place
    FROM windows SEMI JOIN repeated USING (digest)),
words AS (SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts),
kept AS (
    SELECT row, string_agg(word, ' ' ORDER BY place) AS text
    FROM words ANTI JOIN covered USING (row, place)
    GROUP BY row),
removed AS (SELECT row, count(*) AS n FROM covered GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (row) LEFT JOIN removed USING (row)
"""


@_query("op11_de_bruijn_passages", _OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove(
        table(spark, sf_dir, "documents"),
        result=[
            "n_words",
            F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"]).alias("n_removed"),
            F.sha2("kept", 256).alias("kept_sha256"),
        ],
    )
