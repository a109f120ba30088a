"""The queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import (
    bpe, collocations, conversation_repair, exact_dedup, jaccard_join, language, line_dedup, packing,
    pii, secret_scan, suffix_dedup, topk, toxicity,
)
from gaugeflow.llm.common import doc_id, span_summary, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def query(sql: str | None = None):
    """Register a function under its name, with the SQL that gives the same rows."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


@query()
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    lost = F.aggregate(
        "removed", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"]
    )
    return cut.select(
        "doc_id", "n_bytes", lost.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS xs
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_sum(list_transform(range(1, len(q.xs) + 1), lambda i: q.xs[i] * c.xs[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op2_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query("""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""")
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup.new_index(spark).mark(table(spark, sf_dir, "documents"))
    return marked.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query("""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, doc_id % 2 AS batch FROM documents
), g AS (
  SELECT text, batch, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text, batch
), f AS (SELECT text, min(batch) AS batch FROM g GROUP BY text)
SELECT d.doc_id, g.keep_id, g.group_size, d.batch = f.batch AND d.doc_id = g.keep_id AS kept
FROM d JOIN f USING (text) JOIN g ON g.text = f.text AND g.batch = f.batch
""")
def exact_dedup_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with even ids, then those with odd ones, against one index."""
    docs, index = table(spark, sf_dir, "documents"), exact_dedup.new_index(spark)
    first, second = (
        written(index.mark(docs.filter(F.col("doc_id") % 2 == k)), "marks") for k in (0, 1)
    )
    return first.unionByName(second).select("doc_id", "keep_id", "group_size", "kept")


@query("""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS position FROM d
), k AS (
  SELECT *, translate(
    trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), g AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT k.*, g.key IS NOT NULL AND doc_id <> keeper AS dropped
  FROM k LEFT JOIN g ON k.key = g.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT dropped), ''))
         AS kept_sha256
FROM m GROUP BY r, doc_id
""")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.drop_lines(docs, line_dedup.keep_bitmaps(docs)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query()
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), VOCABULARY)


@query()
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return jaccard_join.near_duplicates(docs, words=4, percent=85).select(
        "doc_id", "n_shingles", "component_id"
    )


@query()
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *span_summary(pii.KINDS[:-1]))


@query()
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *span_summary(secret_scan.KINDS[:-1]))


@query()
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), VOCABULARY)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs.select(doc_id(), "text"), language.learn(docs)).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score"
    )


@query(r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, string_split_regex(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
  ), '[.,;:!?\n-\r]') AS pieces FROM documents
), p AS (
  SELECT r, lang, generate_subscripts(pieces, 1) AS piece, unnest(pieces) AS text FROM d
), w AS (
  SELECT r, piece, lang, regexp_extract_all(text, '[^ \t]+') AS words FROM p
), x AS (
  SELECT r, piece, lang, unnest(words) AS w1, generate_subscripts(words, 1) AS place FROM w
), y AS (
  SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4
  FROM x WINDOW o AS (PARTITION BY r, piece ORDER BY place)
), f AS (
  SELECT lang, 1 AS size, [w1] AS words, count(*) AS f FROM y GROUP BY ALL
  UNION ALL SELECT lang, 2, [w1, w2], count(*) FROM y WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, [w1, w2, w3], count(*) FROM y WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, [w1, w2, w3, w4], count(*) FROM y WHERE w4 IS NOT NULL GROUP BY ALL
), c AS (
  SELECT lang, size, words, f AS a FROM f WHERE size > 1 AND f >= 30
), k AS (
  SELECT c.*, l.f AS l, r.f AS r, (2000000::HUGEINT * a // (l.f + r.f))::BIGINT AS score,
         row_number() OVER (PARTITION BY c.lang, c.words
           ORDER BY 2000000::HUGEINT * a // (l.f + r.f), l.size) AS cut
  FROM c JOIN f l ON l.lang = c.lang AND l.size < c.size AND l.words = c.words[:l.size]
  JOIN f r ON r.lang = c.lang AND r.size = c.size - l.size AND r.words = c.words[l.size + 1:]
), inside AS (
  SELECT DISTINCT s.lang, s.words FROM c s JOIN (
    SELECT lang, size, a, unnest([words[1:2], words[2:3], words[3:4], words[1:3], words[2:4]]) AS part
    FROM c WHERE size > 2
  ) g ON g.lang = s.lang AND g.part = s.words AND g.size > s.size AND 100 * g.a >= 80 * s.a
), o AS (
  SELECT k.*, array_to_string(k.words, ' ') AS phrase
  FROM k ANTI JOIN inside i ON i.lang = k.lang AND i.words = k.words WHERE cut = 1
), t AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN t USING (lang) WHERE rank <= 2000
""")
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns as a careless export leaves them, by a hash of where they stand."""
    def part(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    damage = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", part("role").alias("role"), part("text").alias("text"),
        damage.alias("damage"),
    ).filter("damage <> 0")
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("damage") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("damage") == 1, F.lit("")).when(
            F.col("damage") == 2, F.translate("text", ".!?", "")
        ).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("damage") == 3, F.array(F.lit(1), F.lit(2))).otherwise(
            F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


@query()
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    found = conversation_repair.repair(damaged(conversations))
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return ids.alias("i").join(
        found.alias("f"), F.col("i.conv_id").eqNullSafe(F.col("f.conv_id")), "left"
    ).select("i.conv_id", *(
        F.coalesce(F.col(f"f.{name}"), empty.get(name, F.lit(0).cast("long"))).alias(name)
        for name in found.columns if name != "conv_id"
    ))


@query()
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels)
    return toxicity.score(docs.select(doc_id(), "text"), model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("offending").cast("long").alias("n_offending"),
    )
