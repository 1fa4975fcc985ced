"""Registered queries of the corpus operators, with their DuckDB equivalents where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardmill.llm import chat, jaccard, langid, licenses, maxscore, mixing, nndescent, packing, pii, toxicity
from rewardmill.llm.common import doc_bucket

#: Where the public vocabularies are; a parameter of the environment, never copied here.
TOKENIZERS = os.environ.get("REWARDMILL_TOKENIZERS", "/opt/tokenizers")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return f"{TOKENIZERS}/{name}"


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack(
        table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), capacity=4096
    )


@query
def op3_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document from profiles of the rows whose id hash mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(doc_bucket("doc_id", 4) == 2, F.lit(False))
    return langid.identify(docs, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "distance"
    )


@query
def op10_toxic_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of rows whose id hash mod 3 is not 1 are learned."""
    held_out = F.coalesce(doc_bucket("doc_id", 3) == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.classify(docs, table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: five-word shingles, Jaccard 0.75."""
    return jaccard.components(table(spark, sf_dir, "documents"), n=5, percent=75)


@query
def op5_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 best other rows of every 20th embedding by integer inner product, exactly."""
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


ORACLES["op5_maxscore"] = """
WITH flat AS (
  SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS d, unnest(embedding) AS x
  FROM embeddings),
bad AS (SELECT DISTINCT vec_id FROM flat WHERE x IS NULL OR NOT isfinite(x)),
term AS (
  SELECT vec_id, d, CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) AS w
  FROM flat WHERE vec_id NOT IN (SELECT vec_id FROM bad)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
  FROM term q JOIN term c ON q.d = c.d AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
  GROUP BY q.vec_id, c.vec_id),
ranked AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest other rows of every 20th embedding by graph search over an NN-descent graph."""
    return nndescent.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op6_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base kinds, and identifiers in learned contexts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.extract(docs, pii.learn_patterns(docs))


@query
def op7_columnar_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one full of control strings, formatted and read back."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], given.schema
    )
    return chat.digests(chat.format_chats(given.union(extra)))


MIX_DOMAINS = ("web", "books", "forum", "news")
MIX_WEIGHTS = {
    "domain": {"web": 40, "books": 30, "forum": 20, "news": 10},
    "lang": {"en": 40, "fr": 25, "de": 20, "es": 15},
}


@query
def op4_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents chosen, and in which epochs, to meet domain, language and source weights."""
    docs = table(spark, sf_dir, "documents")
    levels = {
        "domain": mixing.number_domain(F.col("source"), MIX_DOMAINS),
        "lang": F.col("lang"),
        "source": F.col("source"),
    }
    chosen = mixing.mix(docs, levels, MIX_WEIGHTS, budget_share=0.6, max_epochs=2, seed=17)
    return chosen.select(
        "doc_id", F.col("mix_epoch").alias("epoch"), F.col("mix_domain").alias("domain"),
        F.col("mix_lang").alias("leaf_lang"), F.col("mix_source").alias("leaf_source"),
        F.col("mix_tokens").alias("tokens"),
    )


def _split_sql(name: str, nodes: str, parent: str, level: str) -> str:
    """One level of the hierarchical split, as SQL: children of ``nodes`` by ``parent``."""
    by = f"PARTITION BY {parent}" if parent else ""
    order = f"OVER ({by} ORDER BY ratio NULLS LAST, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""
{name}_a AS (
  SELECT *, CASE WHEN w > 0 THEN CAST(cap AS DOUBLE) / CAST(w AS DOUBLE) END AS ratio FROM {nodes}),
{name}_b AS (
  SELECT *, coalesce(sum(cap) {order}, 0) AS cap_before,
         sum(w) OVER ({by}) - coalesce(sum(w) {order}, 0) AS w_left FROM {name}_a),
{name}_c AS (
  SELECT *, w > 0 AND cap * w_left <= (above - cap_before) * w AS is_full FROM {name}_b),
{name}_d AS (
  SELECT *, coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({by}), 0) AS full_cap,
         sum(w) OVER ({by}) - coalesce(sum(CASE WHEN is_full THEN w END) OVER ({by}), 0) AS rest_w
  FROM {name}_c),
{name} AS (
  SELECT *, CASE WHEN is_full THEN cap
                 WHEN w > 0 THEN greatest(0, w * (above - full_cap) // rest_w) ELSE 0 END AS budget
  FROM {name}_d)"""


ORACLES["op4_hierarchical_mixing"] = f"""
WITH docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, doc_id,
    CASE coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT), 0) % 4
      WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'forum' ELSE 'news' END AS domain,
    coalesce(lang, '(none)') AS leaf_lang, coalesce(source, '(none)') AS leaf_source,
    CASE WHEN length(coalesce(text, '')) > 0
      THEN length(text) - length(replace(text, ' ', '')) + 1 ELSE 0 END AS tokens
  FROM documents),
n1 AS (
  SELECT domain, CAST(sum(tokens) * 2 AS HUGEINT) AS cap,
    CAST(CASE domain WHEN 'web' THEN 40 WHEN 'books' THEN 30 WHEN 'forum' THEN 20 ELSE 10 END AS HUGEINT) AS w,
    (SELECT CAST(floor(sum(tokens) * CAST(0.6 AS DOUBLE)) AS HUGEINT) FROM docs) AS above
  FROM docs GROUP BY domain),{_split_sql("d1", "n1", "", "domain")},
n2 AS (
  SELECT c.domain, c.leaf_lang, c.cap, c.w, d1.budget AS above FROM (
    SELECT domain, leaf_lang, CAST(sum(tokens) * 2 AS HUGEINT) AS cap,
      CAST(CASE leaf_lang WHEN 'en' THEN 40 WHEN 'fr' THEN 25 WHEN 'de' THEN 20 WHEN 'es' THEN 15 ELSE 1 END AS HUGEINT) AS w
    FROM docs GROUP BY domain, leaf_lang) c JOIN d1 ON c.domain = d1.domain),{_split_sql("d2", "n2", "domain", "leaf_lang")},
n3 AS (
  SELECT c.domain, c.leaf_lang, c.leaf_source, c.tokens, c.cap, c.w, d2.budget AS above FROM (
    SELECT domain, leaf_lang, leaf_source, CAST(sum(tokens) AS HUGEINT) AS tokens,
      CAST(sum(tokens) * 2 AS HUGEINT) AS cap, CAST(1 AS HUGEINT) AS w
    FROM docs GROUP BY domain, leaf_lang, leaf_source) c
  JOIN d2 ON c.domain = d2.domain AND c.leaf_lang = d2.leaf_lang),{_split_sql("d3", "n3", "domain, leaf_lang", "leaf_source")},
plan AS (
  SELECT domain, leaf_lang, leaf_source, budget // tokens AS epochs, budget % tokens AS rest
  FROM d3 WHERE tokens > 0),
keyed AS (
  SELECT docs.*, plan.epochs, plan.rest, md5('17:' || CAST(plan.epochs AS VARCHAR) || ':' || id) AS k
  FROM docs JOIN plan ON docs.domain = plan.domain AND docs.leaf_lang = plan.leaf_lang
    AND docs.leaf_source = plan.leaf_source),
placed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, leaf_lang, leaf_source ORDER BY k) AS upto FROM keyed),
times AS (SELECT *, epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS n FROM placed)
SELECT doc_id, CAST(e.epoch AS INTEGER) AS epoch, domain, leaf_lang, leaf_source, CAST(tokens AS BIGINT) AS tokens
FROM times JOIN (SELECT unnest(range(0, 3)) AS epoch) e ON e.epoch < times.n
"""


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known license notices contained in each document."""
    return licenses.scan(table(spark, sf_dir, "documents")).withColumn(
        "containment", F.round("containment", 6)
    )


def _notice_rows() -> str:
    rows = []
    for name, text in sorted(licenses.NOTICES.items()):
        for s in licenses.template_shingles(licenses.template_words(text), 5):
            rows.append(f"('{name}', '{s}')")
    return ", ".join(rows)


ORACLES["op2_license_scan"] = f"""
WITH template(license, shingle) AS (VALUES {_notice_rows()}),
docs AS (
  SELECT doc_id, ' ' || trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) || ' ' AS plain
  FROM documents WHERE text IS NOT NULL),
hits AS (
  SELECT d.doc_id, t.license, count(*) AS matched
  FROM docs d JOIN template t ON contains(d.plain, ' ' || t.shingle || ' ')
  GROUP BY d.doc_id, t.license),
sizes AS (SELECT license, count(*) AS shingles FROM template GROUP BY license)
SELECT doc_id, h.license, CAST(matched AS INTEGER) AS matched, CAST(shingles AS INTEGER) AS shingles,
       round(matched / CAST(shingles AS DOUBLE), 6) AS containment
FROM hits h JOIN sizes s ON h.license = s.license
WHERE matched >= 0.8 * shingles
"""
