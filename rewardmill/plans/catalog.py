"""Registered queries of the decision/reward engine and their DuckDB equivalents.

The test tables hold no decision log, so one is derived: orders are decisions and their
line items rewards; documents with labels are decisions about a source; events carry a
JSON context, a value and a time. Doubles are rounded in both engines, since they add up
in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardmill.config import TrainConfig
from rewardmill.functions import arithmetic, json, ksuid
from rewardmill.operators import layout, merge, models, records, scan, strings, training
from rewardmill.sources.scratch import new_folder
from rewardmill.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------- decisions and rewards


def decision_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as decision rows and line items as reward rows of the central table.

    A line number that an order holds several times is one message, and its largest price
    comes last, so that the last write is the same in both engines.
    """
    none = lambda **kinds: (F.lit(None).cast(t).alias(c) for c, t in kinds.items())
    decisions = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("decision_id"), F.to_json(F.struct(F.col("o_orderstatus").alias("status"))).alias("item"),
        F.to_json(F.struct(F.col("o_orderpriority").alias("priority"))).alias("context"),
        *none(count="double", sample="string", rewards="string"), F.lit(0.0).alias("_seq"), *none(message_id="string", value="string"),
    )
    rewards = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("decision_id"), *none(item="string", context="string", count="double", sample="string", rewards="string"),
        F.col("l_extendedprice").alias("_seq"), F.col("l_linenumber").cast("string").alias("message_id"),
        F.round(F.col("l_extendedprice") * 100).cast("long").cast("string").alias("value"),
    )
    return decisions.unionByName(rewards)


_MERGED = """
WITH message AS (
  SELECT l_orderkey, l_linenumber, CAST(round(max(l_extendedprice) * 100) AS BIGINT) AS cents
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
rewards AS (
  SELECT l_orderkey, CAST(sum(cents) AS DOUBLE) AS reward, count(*) AS n FROM message GROUP BY l_orderkey)
"""
_MERGE_SQL = _MERGED + """
SELECT CAST(o_orderkey AS VARCHAR) AS decision_id, '{"status":"' || o_orderstatus || '"}' AS item,
       coalesce(reward, 0.0) AS reward
FROM orders LEFT JOIN rewards ON o_orderkey = l_orderkey
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR), NULL, reward FROM rewards
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
"""


@query(_MERGE_SQL)
def merge_rewards(spark, sf_dir):
    """Every decision with its rewards united by message and added up."""
    return merge.merge(decision_log(spark, sf_dir)).select("decision_id", "item", "reward")


@query(_MERGED + """
SELECT CAST(coalesce(o_orderkey, l_orderkey) AS VARCHAR) AS decision_id, o_orderkey IS NULL AS orphan,
       coalesce(reward, 0.0) AS reward
FROM (SELECT * FROM orders WHERE o_orderstatus = 'F') o FULL OUTER JOIN rewards ON o_orderkey = l_orderkey
""")
def merge_full_outer_orphans(spark, sf_dir):
    """Rewards without a decision, and decisions without a reward, both stay."""
    log = decision_log(spark, sf_dir).filter("item IS NULL OR item LIKE '%\"F\"%'")
    return merge.merge(log).select("decision_id", F.col("item").isNull().alias("orphan"), "reward")


@query("""
SELECT CAST(conv_id AS VARCHAR) AS decision_id,
  arg_min(CASE WHEN role = 'assistant' THEN text END, turn) FILTER (WHERE role = 'assistant' AND text IS NOT NULL) AS item,
  arg_min(CASE WHEN role = 'user' THEN text END, turn) FILTER (WHERE role = 'user' AND text IS NOT NULL) AS context
FROM conversations GROUP BY conv_id
""")
def merge_first_non_null(spark, sf_dir):
    """Columns merge each on its own: the first value by order, nulls aside."""
    turns = table(spark, sf_dir, "conversations")
    rows = turns.select(
        F.col("conv_id").cast("string").alias("decision_id"), F.when(F.col("role") == "assistant", F.col("text")).alias("item"),
        F.when(F.col("role") == "user", F.col("text")).alias("context"), F.lit(None).cast("double").alias("count"),
        F.lit(None).cast("string").alias("sample"), F.lit(None).cast("string").alias("rewards"), F.col("turn").alias("_seq"),
    )
    return merge.merge(rows).select("decision_id", "item", "context")


@query(_MERGED + """
SELECT CAST(l_orderkey AS VARCHAR) AS decision_id,
  '{' || string_agg('"' || CAST(l_linenumber AS VARCHAR) || '":' || CAST(cents AS VARCHAR), ',' ORDER BY CAST(l_linenumber AS VARCHAR)) || '}' AS rewards
FROM message GROUP BY l_orderkey
""")
def merge_rewards_json(spark, sf_dir):
    """The united rewards as JSON text with sorted keys, numbers in their own text."""
    log = decision_log(spark, sf_dir).filter("message_id IS NOT NULL")
    return merge.merge(log).select("decision_id", "rewards")


@query(_MERGE_SQL)
def merge_idempotent(spark, sf_dir):
    """Merging what is merged with all its input again changes nothing."""
    log = decision_log(spark, sf_dir)
    once = merge.merge(log)
    return merge.merge_files(once, log, ["decision_id"]).select("decision_id", "item", "reward")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS decision_id, CAST(row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) - 1 AS BIGINT) AS slot,
       CAST(sum(n) OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) - n AS BIGINT) AS "start",
       CAST(sum(n) OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) AS BIGINT) AS "end"
FROM (SELECT l_orderkey AS o_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
""")
def group_slices(spark, sf_dir):
    """Where the rows of each decision start and end in decision order."""
    from rewardmill.operators.running import running_sum

    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("decision_id"))
    numbered = running_sum(merge.group_slices(rows).withColumn("_one", F.lit(1)), ["decision_id"], "_one", "_slot")
    return numbered.select("decision_id", (F.col("_slot") - 1).alias("slot"), "start", "end")


# -------------------------------------------------------------------- track records


@query("""
WITH e AS (SELECT event_id % 10 AS k, event_type FROM events)
SELECT CASE WHEN k IN (1, 2, 3, 4, 5, 6, 8, 9) THEN NULL ELSE event_type END AS model,
       CASE k WHEN 1 THEN 'not an object' WHEN 2 THEN 'invalid message_id' WHEN 3 THEN 'invalid count' WHEN 4 THEN 'invalid model'
              WHEN 5 THEN 'invalid reward' WHEN 6 THEN 'invalid decision_id' WHEN 8 THEN 'sample beside a count of 1'
              WHEN 9 THEN 'invalid message_id' END AS reject_reason,
       count(*) AS n
FROM e GROUP BY 1, 2
""")
def classify_and_validate(spark, sf_dir):
    """Track lines made from events, every kind of fault among them, counted by verdict."""
    k, kind = F.col("event_id") % 10, F.col("event_type")
    ident = F.concat(F.lit("0" * 15), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    line = lambda **f: F.to_json(F.struct(*(v.alias(n) for n, v in f.items())))
    good_decision = line(message_id=ident, model=kind, count=F.lit(3), item=F.col("props"), context=F.col("props"))
    good_reward = line(message_id=ident, model=kind, decision_id=ident, reward=F.col("value"))
    value = (
        F.when(k == 1, F.lit("[1, 2"))
        .when(k == 2, line(message_id=F.lit("short"), model=kind, count=F.lit(1)))
        .when(k == 3, line(message_id=ident, model=kind, count=F.lit(0)))
        .when(k == 4, line(message_id=ident, model=F.concat(F.lit("-"), kind), count=F.lit(2)))
        .when(k == 8, line(message_id=ident, model=kind, count=F.lit(1), sample=kind))
        .when(k == 9, line(message_id=F.concat(F.lit(ksuid.lower_bound(1_800_000_001)[:14]), F.lit("z"), F.substring(ident, 16, 12)), model=kind, count=F.lit(2)))
        .when(k == 5, line(message_id=ident, model=kind, decision_id=ident, reward=F.lit("much")))
        .when(k == 6, line(message_id=ident, model=kind, decision_id=F.lit("?"), reward=F.lit(1)))
        .when(k == 7, good_reward).otherwise(good_decision)
    )
    lines = table(spark, sf_dir, "events").select(value.alias("value"), F.col("event_id").alias("_seq"))
    return records.counts(records.parse(lines, 1.8e9))


@query("""
SELECT * FROM (VALUES
  ('29YkUXjeHeDd6K0HcRJrLZhocG0', CAST(1653297422 AS BIGINT), '20220523T091702Z'),
  ('29ZHOrIOV9DyvVuJziDWj1c3zMU', CAST(1653313658 AS BIGINT), '20220523T134738Z'),
  ('1zznFKB3tggXeA08k9lNQJBM3CU', CAST(1635159678 AS BIGINT), '20211025T110118Z'),
  ('000000000000000000000000000', CAST(1400000000 AS BIGINT), '20140513T165320Z'),
  ('zzzzzzzzzzzzzzzzzzzzzzzzzzz', CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR))) t(ksuid, seconds, iso)
""")
def ksuid_decode(spark, sf_dir):
    """Times that ids carry."""
    ids = ("29YkUXjeHeDd6K0HcRJrLZhocG0", "29ZHOrIOV9DyvVuJziDWj1c3zMU", "1zznFKB3tggXeA08k9lNQJBM3CU", "0" * 27, "z" * 27)
    rows = spark.createDataFrame([(i,) for i in ids], "ksuid string")
    return rows.select("ksuid", ksuid.seconds(F.col("ksuid")).alias("seconds"), ksuid.iso_basic(F.col("ksuid")).alias("iso"))


# ----------------------------------------------------------------- scans and samples


@query(_MERGED + """
SELECT CAST(o_orderkey AS VARCHAR) AS decision_id, coalesce(reward, 0.0) AS reward
FROM orders LEFT JOIN rewards ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'
""")
def train_filter(spark, sf_dir):
    """Only decisions train: orphan rewards have neither item nor context."""
    log = decision_log(spark, sf_dir).filter("item IS NULL OR item LIKE '%\"F\"%'")
    kept = scan.train_filter(merge.merge(log), ["decision_id", "item", "context", "reward"])
    return kept.select("decision_id", "reward")


@query("""
SELECT d.doc_id, coalesce(CAST(quality AS DOUBLE), 0.0) AS reward,
       CASE WHEN coalesce(quality, 0) > 0 THEN 1.0 ELSE 0.0 END AS binary_reward
FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id
""")
def reward_fill_binary(spark, sf_dir):
    """Missing rewards are 0; binary rewards tell positive from the rest."""
    quality = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = table(spark, sf_dir, "documents").select("doc_id").join(quality, "doc_id", "left")
    rows = rows.withColumn("reward", F.coalesce(F.col("quality").cast("double"), F.lit(0.0)))
    return rows.select("doc_id", "reward", arithmetic.binary_reward(F.col("reward")).alias("binary_reward"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 'file' an event type and day: its time range and rows."""
    day = F.date_format("ts", "yyyyMMdd")
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("model"), day.alias("day")).agg(
        F.date_format(F.min("ts"), "yyyyMMdd'T'HHmmss'Z'").alias("min_ts"), F.date_format(F.max("ts"), "yyyyMMdd'T'HHmmss'Z'").alias("max_ts"),
        F.count(F.lit(1)).alias("row_count"),
    ).withColumn("path", F.concat_ws("/", F.col("model"), F.col("day")))


_MANIFEST = """
WITH manifest AS (
  SELECT event_type AS model, strftime(ts, '%Y%m%d') AS day, strftime(min(ts), '%Y%m%dT%H%M%SZ') AS min_ts,
         strftime(max(ts), '%Y%m%dT%H%M%SZ') AS max_ts, count(*) AS row_count,
         event_type || '/' || strftime(ts, '%Y%m%d') AS path
  FROM events GROUP BY event_type, strftime(ts, '%Y%m%d'))
"""


@query(_MANIFEST + "SELECT model, day, path, min_ts, max_ts, row_count FROM manifest")
def partition_manifest(spark, sf_dir):
    """Time range and size of every model's daily file."""
    return manifest(spark, sf_dir).select("model", "day", "path", "min_ts", "max_ts", "row_count")


@query(_MANIFEST + """,
run AS (SELECT path, row_count, sum(row_count) OVER (ORDER BY path DESC ROWS UNBOUNDED PRECEDING) - row_count AS before FROM manifest)
SELECT path, row_count FROM run WHERE before * 0.5 < 2000
""")
def budget_scan(spark, sf_dir):
    """Newest files until half of their rows reach 2,000."""
    return scan.budget_files(manifest(spark, sf_dir), sample=0.5, max_rows=2_000).select("path", "row_count")


@query("""
WITH r AS (
  SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5(CAST(event_id AS VARCHAR))) AS r,
         count(*) OVER (PARTITION BY event_type) AS n
  FROM events)
SELECT event_id, event_type FROM r WHERE r <= round_even(n * 0.83, 0)
""")
def exact_sample(spark, sf_dir):
    """Exactly 83 % of each type's events."""
    order = F.md5(F.col("event_id").cast("string"))
    return scan.exact_sample(table(spark, sf_dir, "events"), ["event_type"], order, 0.83).select("event_id", "event_type")


@query("""
SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) < CAST(floor(0.3 * 4294967296) AS BIGINT) AS is_test
FROM documents
""")
def train_test_split(spark, sf_dir):
    """A reproducible 30 % for tests."""
    return table(spark, sf_dir, "documents").select("doc_id", scan.is_test(F.col("doc_id"), 0.3).alias("is_test"))


# ------------------------------------------------------------------ reward statistics


@query("""
SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS low,
       round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS high
FROM events GROUP BY event_type
""")
def reward_describe(spark, sf_dir):
    """Summary of the rewards of every model."""
    d = training.describe(table(spark, sf_dir, "events"), "value", ["event_type"])
    return d.select("event_type", "n", *(F.round(c, 6).alias(c) for c in ("mean", "std")), "low", *(F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")), "high")


@query("""
WITH s AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS d FROM events GROUP BY event_type)
SELECT event_id, round((value - m) / coalesce(nullif(d, 0), 1), 6) AS z FROM events JOIN s ON events.event_type = s.event_type
""")
def reward_zscore(spark, sf_dir):
    """Rewards normalised within their model (a deviation of 0 counts as 1)."""
    events = table(spark, sf_dir, "events")
    stats = events.groupBy("event_type").agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_d"))
    return events.join(stats, "event_type").select("event_id", F.round(arithmetic.standardised(F.col("value"), F.col("_m"), F.col("_d")), 6).alias("z"))


@query("""
WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
t AS (SELECT sum(n) AS n, avg(n) AS mean_count FROM c)
SELECT source, round(1.0 / greatest(CAST(c.n AS DOUBLE) / t.n, 0.0001) / t.mean_count, 9) AS weight FROM c, t
""")
def inverse_propensity(spark, sf_dir):
    """Weights of sources by the inverse of their share, over the mean number on offer."""
    c = table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    t = c.agg(F.sum("n").alias("total"), F.avg("n").alias("mean_count"))  # one row
    p = F.col("n").cast("double") / F.col("total")
    return c.join(F.broadcast(t)).select("source", F.round(arithmetic.inverse_propensity(p, F.col("mean_count")), 9).alias("weight"))


# -------------------------------------------------------------------------- features


@query("""
SELECT event_id, 'context.k' AS feature, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS num, CAST(NULL AS VARCHAR) AS str FROM events
""")
def flatten_json(spark, sf_dir):
    """JSON contexts as long features."""
    return json.flatten(table(spark, sf_dir, "events"), {"props": "context"}, ["event_id"], max_depth=2)


def document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, w, y, feature, num, str) of documents: language and source of each, with its label."""
    quality = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars").join(quality, "doc_id", "left")
    pairs = F.array(
        F.struct(F.lit("item.lang").alias("feature"), F.lit(None).cast("double").alias("num"), F.col("lang").alias("str")),
        F.struct(F.lit("item.source").alias("feature"), F.lit(None).cast("double").alias("num"), F.col("source").alias("str")),
        F.struct(F.lit("item.n_chars").alias("feature"), F.col("n_chars").cast("double").alias("num"), F.lit(None).cast("string").alias("str")),
    )
    return docs.select("doc_id", F.lit(1.0).alias("w"), F.coalesce(F.col("quality").cast("double"), F.lit(0.0)).alias("y"), F.inline(pairs))


_FEATURES = """
WITH q AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
d AS (SELECT d.doc_id, lang, source, n_chars, 1.0 AS w, coalesce(CAST(quality AS DOUBLE), 0.0) AS y FROM documents d LEFT JOIN q ON d.doc_id = q.doc_id),
long AS (
  SELECT doc_id, w, y, 'item.lang' AS feature, CAST(NULL AS DOUBLE) AS num, lang AS str FROM d
  UNION ALL SELECT doc_id, w, y, 'item.source', NULL, source FROM d
  UNION ALL SELECT doc_id, w, y, 'item.n_chars', CAST(n_chars AS DOUBLE), NULL FROM d)
"""


@query(_FEATURES + """,
f AS (SELECT feature, w FROM long UNION ALL SELECT 'context.' || event_type, 0.5 FROM events),
s AS (SELECT feature, round(sum(w), 6) AS weight FROM f GROUP BY feature)
SELECT feature, weight FROM s ORDER BY weight DESC, feature LIMIT 5
""")
def feature_weights_topk(spark, sf_dir):
    """The five features of the largest total weight."""
    long = document_features(spark, sf_dir).select("feature", "w")
    more = table(spark, sf_dir, "events").select(F.concat(F.lit("context."), F.col("event_type")).alias("feature"), F.lit(0.5).alias("w"))
    return training.select_features(long.union(more), 5).select("feature", F.round("weight", 6).alias("weight"))


@query("""
WITH c AS (SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY l_orderkey),
d AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, n FROM orders LEFT JOIN c ON o_orderkey = l_orderkey)
SELECT CAST(o_orderkey AS VARCHAR) AS decision_id, o_orderstatus AS item, 1.0 AS y, 1.0 AS w FROM d
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), o_orderpriority, 0.0, n - 1 FROM d WHERE n > 1
""")
def expand_training_rows(spark, sf_dir):
    """The chosen item, and the sampled other with the weight of all others."""
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("double").alias("count"))
    rows = table(spark, sf_dir, "orders").join(n, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").cast("string").alias("decision_id"), F.col("o_orderstatus").alias("item"), F.lit("{}").alias("context"),
        "count", F.col("o_orderpriority").alias("sample"), F.unix_timestamp("o_orderdate").alias("time"),
    )
    return training.expand(rows, F.col("time")).select("decision_id", "item", "y", "w")


@query(_FEATURES + """
SELECT doc_id, feature, num FROM (
  SELECT doc_id, 'item.n_chars' AS feature, CAST(CAST(n_chars AS FLOAT) AS DOUBLE) AS num FROM d
  UNION ALL SELECT doc_id, 'item.none', NULL FROM d)
""")
def dense_matrix(spark, sf_dir):
    """Features by position in sorted order, read back one by one; what is missing is NaN."""
    names = ["item.none", "item.n_chars"]
    rows = training.dense(document_features(spark, sf_dir), ["doc_id"], names)
    back = rows.select("doc_id", F.posexplode("features").alias("pos", "x"))
    label = F.element_at(F.array(*(F.lit(n) for n in sorted(names))), F.col("pos") + 1)
    return back.select("doc_id", label.alias("feature"), F.when(~F.isnan("x"), F.col("x").cast("double")).alias("num"))


# ------------------------------------------------------------------- string encoding

_STATS = _FEATURES + """,
stats AS (SELECT feature, str, sum(w) AS total_w, sum(w * y) AS total_wy, count(*) AS n FROM long WHERE str IS NOT NULL GROUP BY feature, str),
smooth AS (SELECT feature, str, n, (total_wy + 0.5 * (300.0 * total_w / n)) / (total_w + 300.0 * total_w / n) AS mean FROM stats WHERE n > 20),
ranked AS (
  SELECT feature, str, n, round(mean, 9) AS mean, row_number() OVER (PARTITION BY feature ORDER BY mean DESC, str) - 1 AS pos,
         count(*) OVER (PARTITION BY feature) AS size FROM smooth)
"""


def _ranked(spark, sf_dir):
    return strings.ranked_strings(strings.string_stats(document_features(spark, sf_dir)), 0.5, 300)


@query(_STATS + "SELECT feature, str, mean, CAST(pos AS INTEGER) AS pos, size FROM ranked")
def string_stats_smoothed(spark, sf_dir):
    """Strings ranked by smoothed mean target, rare ones left out."""
    return _ranked(spark, sf_dir).withColumn("mean", F.round("mean", 9))


@query(_STATS + """
SELECT feature, str, round(CASE WHEN size = 1 THEN 1.0 ELSE CAST(size - 1 - pos AS DOUBLE) / (size - 1) * 2.0 - 1.0 END, 9) AS code FROM ranked
""")
def string_table_codes(spark, sf_dir):
    """Codes from +1 (best) to -1 (worst) by rank."""
    return _ranked(spark, sf_dir).select("feature", "str", F.round(arithmetic.code_value(F.col("pos"), F.col("size")), 9).alias("code"))


@query("""
WITH e AS (
  SELECT event_id, value, CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 AS noise FROM events)
SELECT event_id, round((value + noise * pow(2.0, -142)) * (1.0 + noise * pow(2.0, -17)), 6) AS x FROM e
""")
def population_noise(spark, sf_dir):
    """One noise a row, sprinkled over its features."""
    noise = F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
    return table(spark, sf_dir, "events").select("event_id", F.round(arithmetic.sprinkle(F.col("value"), noise), 6).alias("x"))


# ---------------------------------------------------------------------------- layout

ISO = "yyyyMMdd'T'HHmmss'Z'"


@query("""
WITH p AS (SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS t FROM events)
SELECT CAST(level AS INTEGER) AS level, substr(t, 1, CAST(level AS INTEGER)) AS prefix, count(*) AS n
FROM p, (SELECT unnest([6, 8, 11]) AS level) GROUP BY level, substr(t, 1, CAST(level AS INTEGER))
""")
def split_level_rollup(spark, sf_dir):
    """Rows of every month, day and hour from one rollup."""
    return layout.prefix_counts(table(spark, sf_dir, "events"), F.date_format("ts", ISO), (6, 8, 11))


@query("""
WITH p AS (SELECT event_type, strftime(ts, '%Y%m%dT%H%M%SZ') AS t FROM events),
c AS (SELECT event_type, CAST(level AS INTEGER) AS level, substr(t, 1, CAST(level AS INTEGER)) AS prefix, count(*) AS n
      FROM p, (SELECT unnest(range(6, 16)) AS level) GROUP BY 1, 2, 3),
m AS (SELECT event_type, level, max(n) AS largest, sum(n) AS n FROM c GROUP BY event_type, level)
SELECT event_type, CAST(max(n) AS BIGINT) AS n,
       CASE WHEN max(n) <= 100 THEN 0 ELSE coalesce(min(CASE WHEN largest <= 100 THEN level END), 15) END AS level
FROM m GROUP BY event_type
""")
def split_levels(spark, sf_dir):
    """How finely each model's rows must be cut by time for chunks of at most 100."""
    return layout.split_levels(table(spark, sf_dir, "events"), ["event_type"], F.date_format("ts", ISO), max_rows=100)


@query("""
WITH m AS (SELECT user_id, event_type, strftime(min(ts), '%Y%m%dT%H%M%SZ') AS min_ts, strftime(max(ts), '%Y%m%dT%H%M%SZ') AS max_ts FROM events GROUP BY user_id, event_type),
l AS (SELECT *, lead(min_ts) OVER (PARTITION BY user_id ORDER BY max_ts, min_ts, event_type) AS next_min FROM m)
SELECT user_id, event_type AS path, next_min FROM l WHERE next_min <= max_ts
""")
def overlap_check(spark, sf_dir):
    """Neighbouring files of a user that overlap in time."""
    files = table(spark, sf_dir, "events").groupBy("user_id", F.col("event_type").alias("path")).agg(
        F.date_format(F.min("ts"), ISO).alias("min_ts"), F.date_format(F.max("ts"), ISO).alias("max_ts")
    )
    return layout.overlaps(files, ["user_id"]).select("user_id", "path", "next_min")


# ------------------------------------------------------------------ streaming and models


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def stream_ingest(spark, sf_dir):
    """Events read as a stream of files and summed batch by batch: the same as at once."""
    home = new_folder(spark, "stream")
    path = f"{sf_dir}/events*.parquet"
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(path)
    ingest.stream_aggregate(events, f"{home}/sums", f"{home}/checkpoint", ["event_type"], "value").awaitTermination()
    return spark.read.parquet(f"{home}/sums").groupBy("event_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"))


def _model_rows(spark, sf_dir):
    """Documents as training rows: the selected features coded, label, weight, split."""
    long = document_features(spark, sf_dir)
    names = [r["feature"] for r in training.select_features(long, TrainConfig().max_features).collect()]
    coded = strings.encode(long, strings.tables(_ranked(spark, sf_dir), seed=7), seed=7)
    rows = training.dense(coded, ["doc_id", "y", "w"], names)
    return rows.withColumn("is_test", scan.is_test(F.col("doc_id")))


@query()
def propensity_score(spark, sf_dir):
    """Probability of the positive label by boosted trees, and the weight it implies."""
    rows = _model_rows(spark, sf_dir).persist()
    scored = models.propensity(models.fit_propensity(rows, TrainConfig()), rows)
    return scored.select("doc_id", F.round("propensity", 6).alias("propensity"), F.round(arithmetic.inverse_propensity(F.col("propensity"), 1.0), 6).alias("weight"))


@query()
def decision_model(spark, sf_dir):
    """Expected reward by boosted regression trees under inverse propensity weights."""
    rows = _model_rows(spark, sf_dir).persist()
    model = models.fit_decision(rows, TrainConfig())
    return models.predict(model, rows).select("doc_id", F.round("prediction", 6).alias("prediction"))
