"""Registered queries of features, encoding, weights, models and baselines."""

from __future__ import annotations

import math

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardmill.config import TrainConfig
from rewardmill.functions import arithmetic, hashing, json
from rewardmill.operators import bandit, strings, training
from rewardmill.plans.catalog import _FEATURES, _STATS, _ranked, document_features, query, table


def md5_uniform(*parts) -> Column:
    """A uniform in [0, 1) that both engines know: the md5 of some parts' text."""
    text = F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def _md5_sql(text: str) -> str:
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) / 4294967296.0)"


# ---------------------------------------------------------------------------------- JSON


@query("""
WITH e AS (SELECT event_id FROM events)
SELECT event_id, 'context' || repeat('.a', 14) || '.n' AS feature, CAST(event_id % 5 AS DOUBLE) AS num, CAST(NULL AS VARCHAR) AS str FROM e
UNION ALL SELECT event_id, 'context' || repeat('.a', 14) || '.l.0', 1.0, NULL FROM e
UNION ALL SELECT event_id, 'context' || repeat('.a', 14) || '.l.2', 0.0, NULL FROM e
UNION ALL SELECT event_id, 'context' || repeat('.a', 14) || '.l.3.x', NULL, 'y' FROM e
UNION ALL SELECT event_id, 'item', CAST(event_id AS DOUBLE), NULL FROM e WHERE event_id % 3 = 0
UNION ALL SELECT event_id, 'item', NULL, 'i' || CAST(event_id AS VARCHAR) FROM e WHERE event_id % 3 = 1
""")
def flatten_deep_json(spark, sf_dir):
    """Contexts nested seventeen deep, with lists, booleans, nulls and empty containers;
    scalar and empty items."""
    n = F.col("event_id").cast("string")
    deep = F.concat(
        F.lit('{"a":' * 14 + '{"n":'), (F.col("event_id") % 5).cast("string"), F.lit(',"l":[1,null,false,{"x":"y","e":{}},[]]}' + "}" * 14)
    )
    item = F.when(F.col("event_id") % 3 == 0, n).when(F.col("event_id") % 3 == 1, F.concat(F.lit('"i'), n, F.lit('"'))).otherwise("{}")
    rows = table(spark, sf_dir, "events").select("event_id", deep.alias("context"), item.alias("item"))
    return json.flatten(rows, {"context": "context", "item": "item"}, ["event_id"], 6)


@query("""
WITH e AS (SELECT event_id, CAST(event_id AS VARCHAR) AS n FROM events)
SELECT event_id,
  CASE event_id % 6 WHEN 0 THEN n WHEN 1 THEN '"s' || n || '"' WHEN 2 THEN 'true' WHEN 3 THEN 'null' WHEN 4 THEN '{"a":[1,2],"b":{"c":' || n || ',"d":null}}' ELSE '[' || n || ',"x"]' END AS canonical,
  CASE event_id % 6 WHEN 0 THEN '{"$value":' || n || '}' WHEN 1 THEN '{"$value":"s' || n || '"}' WHEN 2 THEN '{"$value":true}' WHEN 3 THEN '{}'
    WHEN 4 THEN '{"a":[1,2],"b":{"c":' || n || ',"d":null}}' ELSE '[' || n || ',"x"]' END AS wrapped
FROM e
""")
def json_forms(spark, sf_dir):
    """Canonical JSON with sorted keys, and primitives wrapped into objects."""
    n, k = F.col("event_id").cast("string"), F.col("event_id") % 6
    text = (
        F.when(k == 0, n).when(k == 1, F.concat(F.lit('"s'), n, F.lit('"'))).when(k == 2, "true").when(k == 3, "null")
        .when(k == 4, F.concat(F.lit('{"b": {"d": null, "c": '), n, F.lit('}, "a": [1, 2]}'))).otherwise(F.concat(F.lit("[ "), n, F.lit(', "x" ]')))
    )
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("t"))
    return rows.select("event_id", json.canonical(F.col("t")).alias("canonical"), json.wrapped(F.col("t")).alias("wrapped"))


# ------------------------------------------------------------------------------- encoding

#: XXH3 of every string that the documents' features hold, from the library itself.
_STRINGS = ["en", "fr", "de", "es", *(f"src{k}" for k in range(100))]
_SEED = 7
_HASHES = ", ".join(f"('{s}', CAST({xxhash.xxh3_64_intdigest(s, seed=_SEED)} AS HUGEINT))" for s in _STRINGS)
_TABLES = _STATS + f""",
xxh(str, h) AS (VALUES {_HASHES}),
entry AS (SELECT r.feature, r.str, pos, size, h FROM ranked r JOIN xxh ON r.str = xxh.str),
fit AS (
  SELECT feature, min(n) AS bits FROM (
    SELECT feature, n, count(DISTINCT h & ((CAST(1 AS HUGEINT) << CAST(n + 1 AS INTEGER)) - 1)) AS different, max(size) AS size
    FROM entry, (SELECT unnest(range(1, 60)) AS n) WHERE n >= greatest(floor(log2(size)), 1) GROUP BY feature, n)
  WHERE different = size GROUP BY feature),
cut AS (SELECT e.*, h & ((CAST(1 AS HUGEINT) << CAST(bits + 1 AS INTEGER)) - 1) AS hash FROM entry e JOIN fit ON e.feature = fit.feature),
masks AS (SELECT feature, CASE WHEN max(hash) = 0 THEN 0 ELSE (CAST(1 AS HUGEINT) << CAST(floor(log2(CAST(max(hash) AS DOUBLE))) + 1 AS INTEGER)) - 1 END AS mask, max(size) AS size FROM cut GROUP BY feature)
"""
_TABLE_ROWS = _TABLES + "SELECT c.feature, CAST(pos AS INTEGER) AS pos, CAST(hash AS BIGINT) AS hash, CAST(mask AS BIGINT) AS mask FROM cut c JOIN masks m ON c.feature = m.feature"


def _tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strings.tables(_ranked(spark, sf_dir), seed=_SEED)


@query(_TABLE_ROWS)
def xxh3_tables(spark, sf_dir):
    """Truncated hashes of every string table, best to worst, and its lookup mask."""
    return _tables(spark, sf_dir).select("feature", F.posexplode("hashes").alias("pos", "hash"), "mask")


@query(_TABLE_ROWS)
def stored_tables(spark, sf_dir):
    """The same tables after a model's metadata has stored them as JSON and given them back."""
    import json as pyjson
    from datetime import datetime

    from rewardmill.operators import models
    from rewardmill.plans.training import string_tables

    found = models.metadata("m", ["item.lang", "item.source", "item.n_chars"], string_tables(_tables(spark, sf_dir)), 1, datetime(2024, 1, 1), "1")
    back = models.check_metadata(pyjson.loads(pyjson.dumps(found)))
    return strings.tables_of(spark, back).select("feature", F.posexplode("hashes").alias("pos", "hash"), "mask")


@query(_TABLES + """,
asked AS (
  SELECT l.doc_id, l.feature, l.str, x.h, coalesce(m.mask, 0) AS mask, CASE WHEN coalesce(m.size, 1) <= 1 THEN 1.0 ELSE 2.0 / (m.size - 1) END AS width
  FROM long l JOIN xxh x ON l.str = x.str LEFT JOIN masks m ON l.feature = m.feature WHERE l.str IS NOT NULL),
coded AS (
  SELECT a.*, c.hash IS NOT NULL AS hit, CASE WHEN c.size = 1 THEN 1.0 ELSE CAST(c.size - 1 - c.pos AS DOUBLE) / (c.size - 1) * 2.0 - 1.0 END AS code
  FROM asked a LEFT JOIN cut c ON a.feature = c.feature AND (a.h & a.mask) = c.hash)
SELECT doc_id, feature, str, round(CASE WHEN hit THEN code ELSE CAST(h & 4294967295 AS DOUBLE) * pow(2.0, -32) * width - width / 2 END, 9) AS num FROM coded
""")
def string_encode_join(spark, sf_dir):
    """All strings encoded by their tables; those outside get their hash's place."""
    long = document_features(spark, sf_dir).filter("str IS NOT NULL")
    return strings.encode(long, _tables(spark, sf_dir), seed=_SEED).select("doc_id", "feature", "str", F.round("num", 9).alias("num"))


@query("""
WITH d AS (SELECT lang, CAST('0x' || substr(md5(source), 1, 15) AS BIGINT) AS h FROM documents),
a AS (SELECT lang, list(DISTINCT h) AS hs, count(DISTINCT h) AS n FROM d GROUP BY lang),
b AS (SELECT lang, n, hs, bit FROM a, (SELECT unnest(range(1, 60)) AS bit) WHERE bit >= greatest(floor(log2(n)), 1)),
c AS (SELECT lang, min(bit) AS bits FROM b WHERE len(list_distinct(list_transform(hs, lambda x: x & ((CAST(1 AS BIGINT) << CAST(bit + 1 AS INTEGER)) - 1)))) = n GROUP BY lang)
SELECT a.lang, CAST(bits AS INTEGER) AS bits, (CAST(1 AS BIGINT) << CAST(bits + 1 AS INTEGER)) - 1 AS mask,
       (CAST(1 AS BIGINT) << CAST(length(ltrim(bin(list_max(hs)), '0')) AS INTEGER)) - 1 AS widest,
       round(CAST(list_max(hs) & 4294967295 AS DOUBLE) * pow(2.0, -32) * 0.5 - 0.25, 9) AS missing
FROM a JOIN c ON a.lang = c.lang
""")
def hash_bits(spark, sf_dir):
    """Fewest bits that tell hashes apart, their mask, the mask of the largest, a miss's place."""
    h = F.conv(F.substring(F.md5("source"), 1, 15), 16, 10).cast("long")
    lists = table(spark, sf_dir, "documents").groupBy("lang").agg(F.collect_set(h).alias("hs")).withColumn("top", F.array_max("hs"))
    bits = hashing.least_bits(F.col("hs"))
    return lists.select(
        "lang", bits.alias("bits"), hashing.mask_of(bits).alias("mask"), hashing.mask_of_largest(F.col("top")).alias("widest"),
        F.round(arithmetic.miss_value(F.col("top"), F.lit(0.5)), 9).alias("missing"),
    )


_ALL_RANKED = _FEATURES + """,
stats AS (SELECT feature, str, sum(w * y) AS wy, count(*) AS n FROM long WHERE str IS NOT NULL GROUP BY feature, str),
smooth AS (SELECT feature, str, (wy + 0.5 * 300.0) / (n + 300.0) AS mean FROM stats),
ranked AS (SELECT feature, str, row_number() OVER (PARTITION BY feature ORDER BY mean DESC, str) - 1 AS pos, count(*) OVER (PARTITION BY feature) AS size FROM smooth),
code AS (SELECT feature, str, CASE WHEN size = 1 THEN 1.0 ELSE CAST(size - 1 - pos AS DOUBLE) / (size - 1) * 2.0 - 1.0 END AS x FROM ranked)
"""


@query(_ALL_RANKED + """
SELECT doc_id, 'item.lang' AS feature, round(CAST(CAST(x AS FLOAT) AS DOUBLE), 6) AS x FROM long JOIN code ON long.feature = code.feature AND long.str = code.str WHERE long.feature = 'item.lang'
UNION ALL SELECT doc_id, 'item.meta.source', round(CAST(CAST(x AS FLOAT) AS DOUBLE), 6) FROM long JOIN code ON long.feature = code.feature AND long.str = code.str WHERE long.feature = 'item.source'
UNION ALL SELECT doc_id, 'item.meta.n', round(CAST(CAST(num AS FLOAT) AS DOUBLE), 6) FROM long WHERE feature = 'item.n_chars'
UNION ALL SELECT doc_id, 'item.none', NULL FROM d
""")
def encode_vectors(spark, sf_dir):
    """JSON items flattened, their strings encoded by tables of all strings, laid out as
    vectors in sorted order, and read back by position."""
    quality = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").cast("double").alias("y"))
    item = F.to_json(F.struct("lang", F.struct("source", F.col("n_chars").alias("n")).alias("meta")))
    rows = table(spark, sf_dir, "documents").join(quality, "doc_id", "left").select(
        "doc_id", F.lit(1.0).alias("w"), F.coalesce("y", F.lit(0.0)).alias("y"), item.alias("item")
    )
    long = json.flatten(rows, {"item": "item"}, ["doc_id", "w", "y"])
    ranked = strings.ranked_strings(strings.string_stats(long), 0.5, 300.0, min_count=0)
    names = sorted(["item.lang", "item.meta.n", "item.meta.source", "item.none"])
    coded = strings.encode(long, strings.tables(ranked, _SEED), _SEED)
    back = training.dense(coded, ["doc_id"], names, rows).select("doc_id", F.posexplode("features").alias("p", "x"))
    return back.select(
        "doc_id", F.get(F.array(*map(F.lit, names)), F.col("p")).alias("feature"), F.round(F.when(~F.isnan("x"), F.col("x").cast("double")), 6).alias("x")
    )


@query(_ALL_RANKED + """
, top AS (SELECT feature FROM (SELECT feature, sum(CASE WHEN feature = 'item.source' THEN 2 ELSE 1 END) AS weight FROM long GROUP BY feature) ORDER BY weight DESC, feature LIMIT 2)
SELECT feature, str, round(x, 9) AS code FROM code WHERE feature IN (SELECT feature FROM top)
""")
def selected_tables(spark, sf_dir):
    """String codes of selected features only."""
    long = document_features(spark, sf_dir)
    weighted = long.withColumn("w", F.when(F.col("feature") == "item.source", 2.0).otherwise(1.0))
    chosen = training.select_features(weighted, 2).select("feature")
    ranked = strings.ranked_strings(strings.string_stats(long.join(chosen, "feature", "left_semi")), 0.5, 300.0, min_count=0)
    return ranked.select("feature", "str", F.round(arithmetic.code_value(F.col("pos"), F.col("size")), 9).alias("code"))


# ------------------------------------------------------------------------- decision rows


def _poisson_sql(x: str, not_zero: bool) -> str:
    cuts, total = [], 0.0
    for k in range(20):
        if k or not not_zero:
            total += math.exp(-1) / math.factorial(k) / ((1 - math.exp(-1)) if not_zero else 1.0)
            cuts.append(f"WHEN {x} < {total!r} THEN {k}.0")
    return f"CASE {' '.join(cuts)} ELSE 20.0 END"


@query(f"""
WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS d, avg(event_id % 4 + 1) AS c FROM events),
r AS (
  SELECT CAST(event_id AS VARCHAR) AS decision_id, event_type, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, round((value - m) / d, 6) AS y,
         round(1.0 / greatest((event_id % 10 + 1) / 11.0, 0.0001) / c * {_poisson_sql(_md5_sql("'b' || CAST(event_id AS VARCHAR)"), True)}, 6) AS w,
         {_md5_sql("'c' || CAST(event_id AS VARCHAR)")} < 0.95 AS kept
  FROM events, s)
SELECT decision_id, y, w, 'item.type' AS feature, CAST(NULL AS DOUBLE) AS num, event_type AS str FROM r WHERE event_type <> 'view'
UNION ALL SELECT decision_id, y, w, 'context.k', k, NULL FROM r WHERE kept
UNION ALL SELECT decision_id, y, w, '(none)', NULL, NULL FROM r WHERE event_type = 'view' AND NOT kept
""")
def decision_training_rows(spark, sf_dir):
    """Decisions as training rows: normalised rewards, inverse propensity times bootstrap
    weights, contexts dropped by chance after scoring; rows without any feature stay."""
    n = F.col("event_id")
    item = F.when(F.col("event_type") == "view", "{}").otherwise(F.to_json(F.struct(F.col("event_type").alias("type"))))
    events = table(spark, sf_dir, "events")
    stats = events.agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("d"), F.avg(n % 4 + 1).alias("c")).first()
    rows = events.select(
        n.cast("string").alias("decision_id"), item.alias("item"), F.col("props").alias("context"), F.col("value").alias("reward"), ((n % 10 + 1) / 11.0).alias("propensity")
    )
    uniforms = {"boot": md5_uniform("b", F.col("decision_id")), "context": md5_uniform("c", F.col("decision_id"))}
    weighted = training.decision_rows(rows, stats["m"], stats["d"], stats["c"], uniforms, TrainConfig())
    weighted = weighted.withColumns({"y": F.round("y", 6), "w": F.round("w", 6)})
    keys = ["decision_id", "y", "w"]
    long = json.flatten(weighted, {"context": "context", "item": "item"}, keys)
    whole = weighted.select(*keys).join(long, keys, "left")
    return whole.select(*keys, F.coalesce("feature", F.lit("(none)")).alias("feature"), "num", "str")


# ------------------------------------------------------------------- bandits, environments


def _replica_uniform(seed: Column, replica: Column) -> Column:
    """A uniform of an event's seed and a replica: the seed, stepped by the replica."""
    return F.pmod(seed * 1664525 + replica.cast("long") * 1013904223, F.lit(4294967296)) / F.lit(4294967296.0)


_REPLICAS = f"""
WITH h AS (SELECT event_type, value, CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) AS seed FROM events),
u AS (
  SELECT event_type, value, CAST(replica AS INTEGER) AS replica, ((seed * 1664525 + replica * 1013904223) % 4294967296) / 4294967296.0 AS x
  FROM h, (SELECT unnest(range(0, {bandit.REPLICAS})) AS replica)),
w AS (SELECT event_type, value, replica, {_poisson_sql("x", False)} AS w FROM u),
sums AS (SELECT event_type, replica, sum(w * value) AS weighted, sum(w) AS weight FROM w GROUP BY event_type, replica)
"""


def _replica_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    seed = F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 8), 16, 10).cast("long")
    return bandit.bootstrap(table(spark, sf_dir, "events"), "event_type", "value", seed, _replica_uniform)


@query(_REPLICAS + "SELECT event_type, replica, round(weighted, 4) AS weighted, CAST(weight AS BIGINT) AS weight FROM sums")
def bootstrap_replicas(spark, sf_dir):
    """Weighted reward sums of every action under all bootstrap replicas, Poisson weights."""
    return _replica_sums(spark, sf_dir).select("event_type", "replica", F.round("weighted", 4).alias("weighted"), F.col("weight").cast("long").alias("weight"))


@query(_REPLICAS + """
SELECT replica, event_type AS action FROM (
  SELECT replica, event_type, row_number() OVER (PARTITION BY replica ORDER BY weighted / weight DESC, event_type DESC) AS r FROM sums WHERE weight > 0) WHERE r = 1
""")
def thompson_choices(spark, sf_dir):
    """The action that each replica thinks best."""
    return bandit.best_actions(_replica_sums(spark, sf_dir), "event_type")


_KINDS = ("weekday_text", "match", "shuffled_match", "feature_match", "pairs")


@query("""
WITH i AS (SELECT unnest(range(0, 1000)) AS interaction),
u AS (SELECT interaction, (CAST('0x' || substr(md5(CAST(interaction AS VARCHAR) || ':0'), 1, 8) AS BIGINT) / 4294967296.0) AS a,
             (CAST('0x' || substr(md5(CAST(interaction AS VARCHAR) || ':1'), 1, 8) AS BIGINT) / 4294967296.0) AS b FROM i),
k AS (SELECT unnest(range(0, 6)) AS k),
image AS (SELECT k, row_number() OVER (ORDER BY md5(CAST(k AS VARCHAR) || ':2')) - 1 AS place FROM k),
hot AS (SELECT k.k, '[' || string_agg(CASE WHEN o.k = k.k THEN '1' ELSE '0' END, ',' ORDER BY o.k) || ']' AS v FROM k, k o GROUP BY k.k),
pair AS (SELECT interaction, CAST(floor(a * 6) AS BIGINT) AS x, (CAST(floor(a * 6) AS BIGINT) + CAST(floor(b * 5) AS BIGINT) + 1) % 6 AS y FROM u)
SELECT 'weekday_text' AS kind, interaction, CAST(CAST(floor(a * 7) AS BIGINT) AS VARCHAR) AS context, ['Have a great day!', 'Have an OK day.', 'Happy Sunday!'][k + 1] AS action,
       CASE WHEN k = 0 THEN 0.01 WHEN k = 1 THEN 0.001 WHEN floor(a * 7) = 0 THEN 1.0 ELSE 0.0 END AS reward FROM u, k WHERE k < 3
UNION ALL SELECT 'match', interaction, CAST(CAST(floor(a * 6) AS BIGINT) AS VARCHAR), CAST(k AS VARCHAR), CASE WHEN k = floor(a * 6) THEN 1.0 ELSE 0.0 END FROM u, k
UNION ALL SELECT 'shuffled_match', interaction, CAST(CAST(floor(a * 6) AS BIGINT) AS VARCHAR), CAST(place AS VARCHAR), CASE WHEN k = floor(a * 6) THEN 1.0 ELSE 0.0 END FROM u, image
UNION ALL SELECT 'feature_match', interaction, c.v, o.v, CASE WHEN c.k = o.k THEN 1.0 ELSE 0.0 END FROM u JOIN hot c ON c.k = floor(a * 6), hot o
UNION ALL SELECT 'pairs', interaction, NULL, CAST(x AS VARCHAR), x / 6.0 FROM pair
UNION ALL SELECT 'pairs', interaction, NULL, CAST(y AS VARCHAR), y / 6.0 FROM pair
""")
def synthetic_environment(spark, sf_dir):
    """A thousand interactions of five environments with all their rewards."""
    uniform = lambda *parts: md5_uniform(parts[0], ":", parts[1])
    out = None
    for kind in _KINDS:
        rows = bandit.environment(spark, kind, interactions=1_000, size=6, uniform=uniform).select(F.lit(kind).alias("kind"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("""
SELECT * FROM (VALUES (0, 16, false), (1, 32, true), (2, 64, true), (3, 128, true), (4, 160, true)) t(epoch, interactions, learned)
""")
def epoch_learner(spark, sf_dir):
    """A Thompson learner over growing epochs: how many interactions each has, and whether
    another that meets only three of the five contexts earned more than half again of what
    even draws earn."""
    rows = bandit.environment(spark, "match", interactions=400, size=5)
    chosen = bandit.run_epochs(rows.filter("context < '3'"), 400, replicas=16)
    earned = chosen.groupBy("epoch").agg(F.avg("reward").alias("mean"))
    every = bandit.run_epochs(rows, 400, replicas=16).groupBy("epoch").agg(F.count(F.lit(1)).cast("int").alias("interactions"))
    return every.join(earned, "epoch").select("epoch", "interactions", (F.col("mean") > 0.3).alias("learned"))


# --------------------------------------------------------------------------------- models


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as decisions with valid ids: which of two sources to show, and its quality."""
    from rewardmill.plans.catalog_files import ident

    quality = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").cast("double").alias("q"))
    item = lambda k: F.to_json(F.struct(k.alias("source")))
    other = F.concat(F.lit("src"), (F.col("doc_id") % 20).cast("string"))
    return table(spark, sf_dir, "documents").join(quality, "doc_id", "left").select(
        ident(F.col("doc_id")).alias("decision_id"), item(F.col("source")).alias("item"),
        F.to_json(F.struct("lang", F.col("n_chars").alias("n"))).alias("context"), F.lit(2.0).alias("count"),
        item(other).alias("sample"), F.lit("{}").alias("rewards"), F.coalesce("q", F.lit(0.0)).alias("reward"),
    )


@query("""
SELECT * FROM (VALUES ('fresh', true), ('of another version', false), ('too old', false), ('not there', false), ('without metadata', false)) t("case", reused)
""")
def checkpoint_reuse(spark, sf_dir):
    """Which stored models are used again, and which are trained anew."""
    from datetime import datetime

    from rewardmill.operators import models
    from rewardmill.plans.catalog import _model_rows
    from rewardmill.sources.partitions import remove
    from rewardmill.sources.scratch import new_folder

    config, now, path = TrainConfig(tree_depth=2, max_checkpoint_age="1 hour"), datetime(2024, 1, 1), new_folder(spark, "model")
    model = models.fit_propensity(_model_rows(spark, sf_dir), config, trees=2)
    models.save(spark, model, models.metadata("m", ["item.lang"], {"item.lang": [3, 1]}, 7, now, config.version, 2.0), path)
    used = lambda where, config, now: models.load_if_fresh(spark, where, config, now) is not None
    rows = [
        ("fresh", used(path, config, now)), ("of another version", used(path, TrainConfig(version="2", max_checkpoint_age="1 hour"), now)),
        ("too old", used(path, config, datetime(2024, 1, 2))), ("not there", used(f"{path}-none", config, now)),
    ]
    remove(spark, f"{path}/metadata")
    rows.append(("without metadata", used(path, config, now)))
    return spark.createDataFrame(rows, "case string, reused boolean")


@query("SELECT unnest(['context.lang', 'context.n', 'item.source']) AS feature")
def trained_features(spark, sf_dir):
    """Both training phases end to end, saved and described by their metadata: the features
    that the decision model was trained on."""
    from datetime import datetime

    from rewardmill.plans import training as plan
    from rewardmill.sources.scratch import new_folder

    found = plan.train(spark, _decisions(spark, sf_dir), "sources", new_folder(spark, "model"), TrainConfig(), datetime(2024, 1, 1))
    return spark.createDataFrame([(f,) for f in found["feature_names"]], "feature string")
