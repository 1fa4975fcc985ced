"""Registered queries over partition files: ingestion, scans, quarantine, grooming, compaction.

Each writes its files in the shared folder first, from ``events``, through the library's own
writers, and returns what reading them back gives.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rewardmill.config import LayoutConfig, TrainConfig
from rewardmill.functions import ksuid, names
from rewardmill.operators import layout, scan
from rewardmill.plans import compaction
from rewardmill.plans.catalog import query, table
from rewardmill.sources import partitions, tracks
from rewardmill.sources.scratch import new_folder
from rewardmill.streaming import ingest

NOW = 1.8e9
_FIRST = datetime(2024, 1, 1, tzinfo=UTC)
#: The first 15 digits of ids of 30 days, whatever digits follow; and of one far in the future.
PREFIXES = [ksuid.lower_bound(int((_FIRST + timedelta(days=d)).timestamp()))[:14] + "z" for d in range(30)]
FUTURE = ksuid.lower_bound(int(NOW) + 86_400)[:14] + "z"


def ident(number: Column) -> Column:
    """A valid id of a number: ten in a row are of one day."""
    day = F.pmod(F.floor(number / 10), F.lit(30)).cast("int")
    return F.concat(F.get(F.array(*(F.lit(p) for p in PREFIXES)), day), F.lpad(number.cast("string"), 12, "0"))


_IDENT = "([" + ", ".join(f"'{p}'" for p in PREFIXES) + "][CAST((event_id // 10) % 30 AS INTEGER) + 1] || lpad(CAST(event_id AS VARCHAR), 12, '0'))"
_TIME = "strftime(DATE '2024-01-01' + CAST((event_id // 10) % 30 AS INTEGER), '%Y%m%dT000000Z')"


# ---------------------------------------------------------------------------- ingestion


@query(f"""
WITH e AS (SELECT event_id, event_id % 10 AS k, event_id // 10 AS ten, {_IDENT} AS id, event_type FROM events),
decision AS (
  SELECT 'model-' || CAST(ten % 3 AS VARCHAR) AS model, id AS decision_id, '{{"e":' || CAST(event_id AS VARCHAR) || '}}' AS item,
         CASE WHEN k = 1 THEN 'null' ELSE '{{"t":"' || event_type || '"}}' END AS context, CAST(k + 2 AS DOUBLE) AS count FROM e WHERE k < 6),
reward AS (
  SELECT e.ten, first.id AS decision_id,
         '{{' || string_agg('"' || e.id || '":' || CASE WHEN e.k = 8 THEN '0.5' ELSE CAST(e.event_id % 7 AS VARCHAR) END, ',' ORDER BY e.id) || '}}' AS rewards,
         sum(CASE WHEN e.k = 8 THEN 0.5 ELSE e.event_id % 7 END) AS reward
  FROM e JOIN e first ON first.ten = e.ten AND first.k = 0 WHERE e.k IN (6, 7, 8) GROUP BY e.ten, first.id)
SELECT coalesce(d.model, 'model-' || CAST(r.ten % 3 AS VARCHAR)) AS model, coalesce(d.decision_id, r.decision_id) AS decision_id,
       item, context, count, coalesce(rewards, '{{}}') AS rewards, CAST(coalesce(reward, 0) AS DOUBLE) AS reward
FROM decision d FULL OUTER JOIN reward r ON d.decision_id = r.decision_id
""")
def ingest_tracks(spark, sf_dir):
    """Gzipped track lines, rewards apart from their decisions and delivered twice, streamed
    batch by batch into partition files and read back as one table."""
    n, k = F.col("event_id"), F.col("event_id") % 10
    model = F.concat(F.lit("model-"), (F.floor(n / 10) % 3).cast("string"))
    quoted = lambda *parts: F.concat(F.lit('"'), *parts, F.lit('"'))
    head = F.concat(F.lit('{"message_id":'), quoted(ident(n)), F.lit(',"model":'), quoted(model))
    context = F.when(k == 1, "").otherwise(F.concat(F.lit(',"context":{"t":'), quoted(F.col("event_type")), F.lit("}")))
    decision = F.concat(head, F.lit(',"count":'), (k + 2).cast("string"), F.lit(',"item":{"e":'), n.cast("string"), F.lit("}"), context, F.lit("}"))
    value = F.when(k == 8, "0.5").otherwise((n % 7).cast("string"))
    reward = F.concat(head, F.lit(',"decision_id":'), quoted(ident(n - k)), F.lit(',"reward":'), value, F.lit("}"))
    line = F.when(k < 6, decision).when(k < 9, reward).otherwise("not a record")
    events = table(spark, sf_dir, "events").select(k.alias("k"), line.alias("value"))
    home = new_folder(spark, "tracks")
    rewards = events.filter("k >= 6").select("value")
    for some in (rewards, events.filter("k < 9").select("value")):  # rewards come first, and again
        some.repartition(2).write.mode("append").option("compression", "gzip").text(f"{home}/in")
    stream = tracks.stream_lines(spark, f"{home}/in", files_per_trigger=2)
    ingest.ingest(stream, f"{home}/table", f"{home}/checkpoint", NOW).awaitTermination()
    columns = ("model", "decision_id", "item", "context", "count", "rewards", "reward")
    return ingest.read_table(spark, f"{home}/table").select(*columns)


# ------------------------------------------------------------------------ partition files


def _parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Decisions of events, and two sets of rewards for them, as rows of the central table."""
    n = F.col("event_id")
    base = table(spark, sf_dir, "events").withColumn("decision_id", ident(n))
    none = lambda t: F.lit(None).cast(t)
    text = lambda a, x, b: F.concat(F.lit(a), x.cast("string"), F.lit(b))

    def part(rows, item, rewards):
        return rows.select(
            F.col("event_type").alias("model"), "decision_id", item.alias("item"), F.when(item.isNotNull(), "{}").alias("context"),
            F.when(item.isNotNull(), 2.0).alias("count"), none("string").alias("sample"), rewards.alias("rewards"), none("double").alias("reward"),
        )

    return [
        part(base, text('{"e":', n, "}"), none("string")),
        part(base, none("string"), text('{"a":', n % 5, "}")),
        part(base.filter("event_id % 2 = 0"), none("string"), text('{"b":', n % 3, "}")),
    ]


def _written(spark: SparkSession, sf_dir: str, parts=(0, 1, 2)) -> str:
    """A partition table with one file a model and part."""
    home, rows = new_folder(spark, "partitions"), _parts(spark, sf_dir)
    for k in parts:
        partitions.write_partitions(rows[k], home, F.lit(k), tag=f"part-{k}")
    return home


_PARTS = f"""
WITH e AS (SELECT event_id, event_type AS model, {_IDENT} AS decision_id, {_TIME} AS t FROM events),
part AS (SELECT 0 AS k, * FROM e UNION ALL SELECT 1, * FROM e UNION ALL SELECT 2, * FROM e WHERE event_id % 2 = 0),
file AS (
  SELECT model, k, min(t) AS min_ts, max(t) AS max_ts, count(*) AS row_count,
         'rewarded_decisions/' || model || '/parquet/' || substr(max(t), 1, 4) || '/' || substr(max(t), 5, 2) || '/' || substr(max(t), 7, 2) AS folder
  FROM part GROUP BY model, k)
"""


@query(_PARTS + "SELECT model, folder, min_ts, max_ts, row_count FROM file")
def partition_files(spark, sf_dir):
    """Where written files lie and what their names say, from the listing alone."""
    home = _written(spark, sf_dir)
    key = partitions.key_of(F.col("path"))
    folder = F.regexp_replace(key, "/[^/]*$", "")
    return partitions.manifest(spark, home).select("model", folder.alias("folder"), "min_ts", "max_ts", "row_count")


@query(_PARTS + """
SELECT model, row_count, model <> 'click' OR k <> 1 AS readable, CASE WHEN model <> 'click' OR k <> 1 THEN row_count ELSE 0 END AS rows_read FROM file
""")
def safe_scan(spark, sf_dir):
    """A scan over files of which one is broken: the others' rows, and which was skipped."""
    home = _written(spark, sf_dir)
    files = partitions.manifest(spark, home)
    rows = {r["path"]: r["model"] for r in files.collect()}
    numbers = partitions.read_files(spark, list(rows)).groupBy("_file").agg(F.max("rewards").alias("r"))
    second = {r["_file"] for r in numbers.filter("r LIKE '{\"a\"%'").collect()}
    broken = next(p for p, m in rows.items() if m == "click" and p.rpartition("/")[2] in second)
    path, fs = partitions._files(spark, broken)
    out = fs.create(path, True)
    out.write(bytearray(b"no parquet"))
    out.close()
    found = partitions.read_safely(spark, list(rows), ["decision_id"])
    skipped = partitions.skipped_files(files, found).select("path", F.lit(False).alias("readable"))
    read = found.groupBy(F.col("_metadata.file_name").alias("_name")).agg(F.count(F.lit(1)).alias("rows_read"))
    counted = partitions.with_row_counts(spark, files.select("model", "path"))
    return (
        counted.withColumn("_name", partitions.file_name(F.col("path"))).join(read, "_name", "left").join(skipped, "path", "left")
        .select("model", "row_count", F.coalesce("readable", F.lit(True)).alias("readable"), F.coalesce("rows_read", F.lit(0)).alias("rows_read"))
    )


@query(_PARTS + """
SELECT model, count(DISTINCT k) AS files, count(*) AS n_rows, CAST(1 AS INTEGER) AS moved FROM part WHERE k < 2 GROUP BY model
""")
def quarantine_scan(spark, sf_dir):
    """One file holds an id of the future: it is moved aside, the scan stops, and the next
    scan reads all the others."""
    home = _written(spark, sf_dir, (0, 1))
    bad = _parts(spark, sf_dir)[2].filter("model = 'view'").withColumn("decision_id", F.concat(F.lit(FUTURE), F.substring("decision_id", 16, 12)))
    partitions.write_partitions(bad, home, F.lit("bad"))
    paths = lambda: [r["path"] for r in partitions.manifest(spark, home).select("path").collect()]
    moved = 0
    try:
        partitions.read_sound(spark, home, paths(), NOW)
    except partitions.UnsoundFiles as stop:
        moved = len(stop.paths)
    assert partitions.list_files(spark, f"{home}/unrecoverable").count() == moved
    name = partitions.manifest(spark, home).select("model", partitions.file_name(F.col("path")).alias("_file"))
    rows = partitions.with_facts(partitions.read_sound(spark, home, paths(), NOW), name)
    return rows.groupBy("model").agg(
        F.count_distinct("_file").alias("files"), F.count(F.lit(1)).alias("n_rows"), F.lit(moved).alias("moved")
    )


@query(f"""
SELECT event_type AS model, {_IDENT} AS decision_id, '{{"e":' || CAST(event_id AS VARCHAR) || '}}' AS item, '{{}}' AS context, CAST(2 AS DOUBLE) AS count,
       '{{"a":' || CAST(event_id % 5 AS VARCHAR) || CASE WHEN event_id % 2 = 0 THEN ',"b":' || CAST(event_id % 3 AS VARCHAR) ELSE '' END || '}}' AS rewards,
       CAST(event_id % 5 + CASE WHEN event_id % 2 = 0 THEN event_id % 3 ELSE 0 END AS DOUBLE) AS reward, CAST(1 AS BIGINT) AS files
FROM events
""")
def compact_partitions(spark, sf_dir):
    """Decisions and their rewards lie in overlapping files; compaction merges them, so that
    every decision is one row of one file, however many files a model's rows take: ``files``
    counts those that hold the decision."""
    home = _written(spark, sf_dir)
    compaction.compact(spark, home, LayoutConfig(max_rows=1_000_000), NOW)
    files = partitions.manifest(spark, home).withColumn("_file", partitions.file_name(F.col("path")))
    rows = partitions.read_files(spark, [r["path"] for r in files.select("path").collect()])
    holding = F.size(F.collect_set("_file").over(Window.partitionBy("model", "decision_id"))).cast("long")
    return partitions.with_facts(rows, files.select("_file", "model")).select(
        "model", "decision_id", "item", "context", "count", "rewards", "reward", holding.alias("files")
    )


@query(f"""
SELECT {_IDENT} AS decision_id, '{{"e":' || CAST(event_id AS VARCHAR) || '}}' AS item, '{{}}' AS context, CAST(0 AS DOUBLE) AS reward FROM events
""")
def training_scan(spark, sf_dir):
    """What training reads of partition files: decisions only, missing rewards as 0."""
    from rewardmill.plans import training as plan

    files = partitions.manifest(spark, _written(spark, sf_dir))
    rows = plan.load(spark, files, TrainConfig(explore=False), max_rows=None, min_rows=None)
    return rows.select("decision_id", "item", "context", "reward")


# ------------------------------------------------------------------------------ planning

ISO = "yyyyMMdd'T'HHmmss'Z'"


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily files of every model; every fifth reaches into the next day."""
    day = F.date_format("ts", "yyyyMMdd")
    late = F.when(F.dayofmonth(F.max("ts")) % 5 == 0, F.max("ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.max("ts"))
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("model"), day.alias("day")).agg(
        F.date_format(F.min("ts"), ISO).alias("min_ts"), F.date_format(late, ISO).alias("max_ts"), F.count(F.lit(1)).alias("row_count")
    ).withColumn("path", F.concat_ws("/", "model", "day"))


_DAILY = """
WITH RECURSIVE file AS (
  SELECT event_type AS model, event_type || '/' || strftime(ts, '%Y%m%d') AS path, strftime(min(ts), '%Y%m%dT%H%M%SZ') AS min_ts,
         strftime(CASE WHEN day(max(ts)) % 5 = 0 THEN max(ts) + INTERVAL 1 DAY ELSE max(ts) END, '%Y%m%dT%H%M%SZ') AS max_ts, count(*) AS row_count
  FROM events GROUP BY event_type, strftime(ts, '%Y%m%d')),
f AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY max_ts, path) AS i FROM file),
fold AS (
  SELECT model, i, CAST(1 AS BIGINT) AS g, row_count AS n FROM f WHERE i = 1
  UNION ALL
  SELECT f.model, f.i, CASE WHEN fold.n + f.row_count <= 150 THEN g ELSE g + 1 END, CASE WHEN fold.n + f.row_count <= 150 THEN fold.n + f.row_count ELSE f.row_count END
  FROM fold JOIN f ON f.model = fold.model AND f.i = fold.i + 1),
small AS (
  SELECT f.model, g, string_agg(path, ',' ORDER BY f.i) AS paths, count(*) AS files, min(min_ts) AS lo, max(max_ts) AS hi, sum(row_count) AS n
  FROM fold JOIN f ON f.model = fold.model AND f.i = fold.i GROUP BY f.model, g),
pair AS (
  SELECT model, g, CAST(1 AS BIGINT) AS p, true AS open FROM small WHERE g = 1
  UNION ALL
  SELECT s.model, s.g, CASE WHEN open AND o.hi >= s.lo THEN p ELSE p + 1 END, NOT (open AND o.hi >= s.lo)
  FROM pair JOIN small s ON s.model = pair.model AND s.g = pair.g + 1 JOIN small o ON o.model = pair.model AND o.g = pair.g),
merged AS (
  SELECT s.model, p, string_agg(paths, ',' ORDER BY s.g) AS paths, sum(files) AS files, sum(n) AS n
  FROM pair JOIN small s ON s.model = pair.model AND s.g = pair.g GROUP BY s.model, p)
"""


@query(_DAILY + """
SELECT model, CAST(row_number() OVER (PARTITION BY model ORDER BY p) - 1 AS INTEGER) AS group_no, paths, CAST(n AS BIGINT) AS row_count
FROM merged WHERE files > 1
""")
def groom_groups(spark, sf_dir):
    """Which daily files of each model to merge for files of up to 150 rows, and which
    neighbours because they overlap."""
    groups = layout.cap_keys(layout.groom_groups(_daily(spark, sf_dir), LayoutConfig(max_rows=150)))
    return groups.select("model", "group_no", F.array_join("paths", ",").alias("paths"), "row_count")


@query("""
WITH file AS (SELECT event_type || '/' || strftime(ts, '%Y%m%d') AS path, count(*) AS row_count FROM events GROUP BY 1),
run AS (SELECT *, sum(row_count) OVER (ORDER BY path DESC ROWS UNBOUNDED PRECEDING) - row_count AS before FROM file),
kept AS (SELECT path, row_count FROM run WHERE before * 0.632 < 0.5 * (SELECT sum(row_count) FROM file)),
total AS (SELECT sum(row_count) AS n FROM kept)
SELECT path, row_count, round(greatest(0.632, least(0.7 * n / n, 1.0)), 9) AS sample FROM kept, total
WHERE CAST('0x' || substr(md5(path), 1, 8) AS BIGINT) / 4294967296.0 < greatest(0.632, least(0.7 * n / n, 1.0))
""")
def sampled_files(spark, sf_dir):
    """Newest files within half of all rows, the sample raised to the rows wanted, and whole
    files drawn as where there are millions of rows."""
    files = _daily(spark, sf_dir).select("path", "row_count")
    total = files.agg(F.sum("row_count")).first()[0]
    chosen = scan.budget_files(files, 0.632, 0.5 * total)
    n = chosen.agg(F.sum("row_count")).first()[0]
    sample = scan.adjusted_sample(0.632, 0.7 * n, n)
    draw = F.conv(F.substring(F.md5("path"), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
    drawn = scan.sample_files(chosen, sample, scan.BIG_ROWS, scan.BIG_FILES, uniform=draw)
    return drawn.select("path", "row_count", F.round(F.lit(sample), 9).alias("sample"))


@query("""
WITH k AS (
  SELECT event_id, CASE event_id % 6
    WHEN 0 THEN 'rewarded_decisions/' || event_type || '/parquet/2024/01/02/20240102T000000Z-20240101T000000Z-' || CAST(event_id AS VARCHAR) || '-' || repeat('x', 36) || '.parquet'
    WHEN 1 THEN 'rewarded_decisions/' || event_type || '/parquet/24/01/02/20240102T000000Z-20240101T000000Z-5-' || repeat('x', 36) || '.parquet'
    WHEN 2 THEN 'rewarded_decisions/-' || event_type || '/parquet/2024/01/02/20240102T000000Z-20240101T000000Z-5-' || repeat('x', 36) || '.parquet'
    WHEN 3 THEN 'rewarded_decisions/' || event_type || '/parquet/2024/01/02/20240102T000000Z-20240101T000000Z-5-' || repeat('y', 35) || '.parquet'
    WHEN 4 THEN event_type || '.parquet' ELSE repeat(event_type || '_.-', 20) END AS path, event_type
  FROM events)
SELECT event_id, regexp_matches(path, '^[a-zA-Z0-9][\\w\\-.]{0,63}$') AS is_model,
       regexp_matches(path, '^rewarded_decisions/[a-zA-Z0-9][\\w\\-.]{0,63}/parquet/[0-9]{4}/[0-9]{2}/[0-9]{2}/[0-9]{8}T[0-9]{6}Z-[0-9]{8}T[0-9]{6}Z-[0-9]+-.{36}\\.parquet') AS is_key,
       CASE WHEN event_id % 6 < 3 THEN '20240101T000000Z' END AS min_ts, CASE WHEN event_id % 6 < 3 THEN '20240102T000000Z' END AS max_ts,
       CASE WHEN event_id % 6 = 0 THEN event_id WHEN event_id % 6 < 3 THEN 5 END AS row_count
FROM k
""")
def name_rules(spark, sf_dir):
    """Which names are models or partition keys, and what file names say."""
    path = _paths(F.col("event_id"), F.col("event_type"))
    facts = names.file_facts(F.col("path"))
    return table(spark, sf_dir, "events").select("event_id", path.alias("path")).select(
        "event_id", names.is_model_name(F.col("path")).alias("is_model"), names.is_partition_key(F.col("path")).alias("is_key"),
        *(facts[c].alias(c) for c in ("min_ts", "max_ts", "row_count")),
    )


def _paths(n: Column, kind: Column) -> Column:
    join = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    times, x36 = "20240102T000000Z-20240101T000000Z-", "x" * 36
    return (
        F.when(n % 6 == 0, join("rewarded_decisions/", kind, "/parquet/2024/01/02/", times, n.cast("string"), f"-{x36}.parquet"))
        .when(n % 6 == 1, join("rewarded_decisions/", kind, "/parquet/24/01/02/", times, f"5-{x36}.parquet"))
        .when(n % 6 == 2, join("rewarded_decisions/-", kind, "/parquet/2024/01/02/", times, f"5-{x36}.parquet"))
        .when(n % 6 == 3, join("rewarded_decisions/", kind, "/parquet/2024/01/02/", times, "5-", "y" * 35, ".parquet"))
        .when(n % 6 == 4, join(kind, ".parquet")).otherwise(F.repeat(join(kind, "_.-"), 20))
    )


@query("""
WITH k AS (
  SELECT 'rewarded_decisions/' || event_type || '/parquet/2024/01/' || lpad(CAST(day(ts) AS VARCHAR), 2, '0') || '/20240102T000000Z-20240101T000000Z-'
         || CAST(event_id AS VARCHAR) || '-' || repeat('x', CASE WHEN event_id % 7 = 0 THEN 30 ELSE 36 END) || '.parquet' AS path, event_type, event_id % 7 <> 0 AS valid
  FROM events)
SELECT path, CAST(row_number() OVER (ORDER BY path DESC) AS INTEGER) AS newest
FROM k WHERE event_type = 'click' AND valid AND path > 'rewarded_decisions/click/parquet/2024/01/11'
""")
def partition_listing(spark, sf_dir):
    """Valid keys of one model behind a given key, newest first."""
    n = F.col("event_id")
    path = F.concat(
        F.lit("rewarded_decisions/"), F.col("event_type"), F.lit("/parquet/2024/01/"), F.lpad(F.dayofmonth("ts").cast("string"), 2, "0"),
        F.lit("/20240102T000000Z-20240101T000000Z-"), n.cast("string"), F.lit("-"), F.expr("repeat('x', CASE WHEN event_id % 7 = 0 THEN 30 ELSE 36 END)"), F.lit(".parquet"),
    )
    keys = table(spark, sf_dir, "events").select(path.alias("path"))
    after = partitions.list_keys(partitions.partition_keys(keys, "click"), "rewarded_decisions/click/", "rewarded_decisions/click/parquet/2024/01/11")
    from rewardmill.operators.running import running_sum

    ordered = running_sum(partitions.newest_first(after).withColumn("_one", F.lit(1)), [F.desc("path")], "_one", "newest")
    return ordered.select("path", F.col("newest").cast("int").alias("newest"))
