"""Rewarded-decision partitions: files whose names say what they hold.

A file lies under ``rewarded_decisions/{model}/parquet/yyyy/mm/dd/`` (the day of its largest
id) and is named ``{max time}-{min time}-{rows}-{36 characters}.parquet``. So a listing is
the manifest: planning reads no row. Files are written aside, then named and moved into
place; inputs go only after that.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardmill import schemas
from rewardmill.functions import ksuid, names

_KEY = r".*/(rewarded_decisions/[^/]+/parquet/[0-9]{4}/[0-9]{2}/[0-9]{2}/[^/]+)$"


class UnsoundFiles(ValueError):
    """Files that held an invalid decision_id; they have been moved aside."""

    def __init__(self, paths: Sequence[str]):
        super().__init__(f"unsound files moved aside: {sorted(paths)}")
        self.paths = list(paths)


# ------------------------------------------------------------------------- file system


def _files(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a file; what lies at the target, the same write tried before, gives way."""
    src, fs = _files(spark, source)
    dst, _ = _files(spark, target)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst):
        fs.delete(dst, False)
    rename(spark, source, target)


def rename(spark: SparkSession, source: str, target: str) -> None:
    src, fs = _files(spark, source)
    dst, _ = _files(spark, target)
    if not fs.rename(src, dst):
        raise OSError(f"could not rename {source} to {target}")


def copy(spark: SparkSession, source: str, target: str) -> None:
    """Copy a file or folder, through the file systems' own streams."""
    src, fs = _files(spark, source)
    dst, to = _files(spark, target)
    to.mkdirs(dst.getParent())
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if not spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, src, to, dst, False, True, conf):
        raise OSError(f"could not copy {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; raises if it is still there afterwards."""
    p, fs = _files(spark, path)
    if not fs.delete(p, True) and fs.exists(p):
        raise OSError(f"could not delete {path}")


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _files(spark, path)
    return fs.exists(p)


# ---------------------------------------------------------------------- lists, manifests


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes) of all parquet files under ``root``, through Spark's own listing."""
    if not exists(spark, root):
        return spark.createDataFrame([], "path string, bytes long")
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet").load(root)
        .select("path", F.col("length").alias("bytes"))
    )


def key_of(path: Column) -> Column:
    """The part of a path from ``rewarded_decisions`` on; "" where it isn't a partition's."""
    return F.regexp_extract(path, _KEY, 1)


def list_keys(keys: DataFrame, prefix: str = "", start_after: str = "") -> DataFrame:
    """Keys with a prefix that sort after ``start_after``."""
    if not isinstance(prefix, str) or not isinstance(start_after, str):
        raise TypeError("prefix and start_after must be strings")
    return keys.filter(F.col("path").startswith(prefix) & (F.col("path") > start_after)).orderBy("path")


def partition_keys(keys: DataFrame, model: str) -> DataFrame:
    """Valid partition keys of one model, in order."""
    own = F.col("path").startswith(f"rewarded_decisions/{model}/parquet/")
    return keys.filter(own & names.is_partition_key(F.col("path"))).orderBy("path")


def manifest_of_names(keys: DataFrame, model: Column) -> DataFrame:
    """Manifest rows from what partition files' names say."""
    facts = names.file_facts(F.col("path"))
    return keys.select(model.alias("model"), "path", *(facts[c].alias(c) for c in ("min_ts", "max_ts", "row_count")))


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Manifest of the partition table at ``root``, from its listing alone."""
    key = key_of(F.col("path"))
    files = list_files(spark, f"{root.rstrip('/')}/rewarded_decisions").filter(names.is_partition_key(key))
    return manifest_of_names(files, F.split(key, "/")[1])


def newest_first(manifest: DataFrame) -> DataFrame:
    return manifest.filter(F.col("path").endswith(".parquet")).orderBy(F.desc("path"))


def with_row_counts(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Row counts from names; only files whose names tell none are opened (unreadable: 0)."""
    named = files.withColumn("row_count", names.file_facts(F.col("path"))["row_count"])
    unnamed = [r["path"] for r in named.filter("row_count IS NULL").select("path").collect()]  # paths, not rows
    if not unnamed:
        return named
    counted = (
        spark.read.option("ignoreCorruptFiles", "true").schema("decision_id string").parquet(*unnamed)
        .groupBy(F.col("_metadata.file_name").alias("_name")).agg(F.count(F.lit(1)).alias("_counted"))
    )
    return (
        named.withColumn("_name", file_name(F.col("path"))).join(counted, "_name", "left")
        .withColumn("row_count", F.coalesce("row_count", "_counted", F.lit(0))).drop("_name", "_counted")
    )


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


# ------------------------------------------------------------------------------ reading


def _list(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_files(spark: SparkSession, paths) -> DataFrame:
    """Rows of these files only, with ``_file`` (their name) and ``_row`` (place in it)."""
    rows = spark.read.schema(schemas.REWARDED_DECISIONS).parquet(*_list(paths))
    return rows.select(*schemas.COLUMNS, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def with_facts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``rows`` (of :func:`read_files`) with what ``files`` says of their file, by ``_file``.

    The listing, a row a file, goes to the rows: left to itself, Spark takes packed rows for the
    smaller table by their bytes on disk, and gathers and unpacks all of them on the driver.
    """
    return rows.join(F.broadcast(files), "_file")


def unsound_files(spark: SparkSession, paths, now: Column | float) -> list[str]:
    """Those of the files that hold an invalid decision_id; only that column is read."""
    rows = spark.read.schema("decision_id string").parquet(*_list(paths))
    bad = rows.filter(~ksuid.is_valid(F.col("decision_id"), now)).select(F.col("_metadata.file_path").alias("p")).distinct()
    return sorted(r["p"] for r in bad.collect())  # files, not rows


def quarantine(spark: SparkSession, root: str, paths: Sequence[str]) -> list[str]:
    """Move files to ``unrecoverable`` beside the table, by their keys; returns where to."""
    moved = []
    for p in paths:
        at = p.rfind("rewarded_decisions/")
        target = f"{root.rstrip('/')}/unrecoverable/{p[at:] if at >= 0 else p.rpartition('/')[2]}"
        move(spark, p, target)
        moved.append(target)
    return moved


def read_sound(spark: SparkSession, root: str, paths, now: Column | float) -> DataFrame:
    """Rows of files that are all sound. One invalid decision_id makes its whole file
    unsound: such files are moved aside and the read stops with :class:`UnsoundFiles`."""
    bad = unsound_files(spark, paths, now)
    if bad:
        quarantine(spark, root, bad)
        raise UnsoundFiles(bad)
    return read_files(spark, paths)


def read_safely(spark: SparkSession, paths, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of those files that can be read; unreadable and missing ones give none. Anything
    else that fails (a store that can't be reached, say) still fails the job."""
    wanted = [f for f in schemas.REWARDED_DECISIONS if columns is None or f.name in columns]
    reader = (
        spark.read.schema(type(schemas.REWARDED_DECISIONS)(wanted))
        .option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    )
    return reader.parquet(*_list(paths))


def skipped_files(manifest: DataFrame, rows: DataFrame) -> DataFrame:
    """Files of the manifest of which a scan returned no row."""
    read = rows.select(F.col("_metadata.file_name").alias("_name")).distinct()
    return manifest.withColumn("_name", file_name(F.col("path"))).join(read, "_name", "left_anti").drop("_name")


# ------------------------------------------------------------------------------ writing


def list_staged(spark: SparkSession, staging: str) -> bool:
    """Whether a write left any folder of rows behind."""
    p, fs = _files(spark, staging)
    return any(s.isDirectory() and not s.getPath().getName().startswith("_temporary") for s in fs.listStatus(p))


def time_parts(decision_id: Column) -> dict[str, Column]:
    """Path parts of the day an id falls on (UTC)."""
    day = ksuid.iso_basic(decision_id)
    return {"yyyy": F.substring(day, 1, 4), "mm": F.substring(day, 5, 2), "dd": F.substring(day, 7, 2)}


def partition_key(model: Column, low: Column, high: Column, n: Column, suffix: Column) -> Column:
    """Key of a file of ``n`` rows from id ``low`` to id ``high``."""
    part = time_parts(high)
    name = F.concat_ws("-", ksuid.iso_basic(high), ksuid.iso_basic(low), n.cast("string"), suffix)
    return F.concat_ws("/", F.lit("rewarded_decisions"), model, F.lit("parquet"), part["yyyy"], part["mm"], part["dd"], F.concat(name, F.lit(".parquet")))


def write_partitions(rows: DataFrame, root: str, chunk: Column, tag: str = "") -> list[str]:
    """Write one file a model and chunk, sorted by id; returns the files' paths.

    A chunk is one task's work and one file: :func:`rewardmill.operators.layout.split_levels`
    bounds its rows. The driver handles file names only. With a ``tag`` (a batch's number,
    say) names repeat when the same write is tried again, so that nothing doubles.
    """
    spark = rows.sparkSession
    staging = f"{root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    (
        rows.withColumn("_chunk", F.md5(F.coalesce(chunk.cast("string"), F.lit(""))))
        .repartition("model", "_chunk").sortWithinPartitions("model", "_chunk", "decision_id")
        .select("model", "_chunk", *schemas.COLUMNS)
        .write.option("compression", "zstd").partitionBy("model", "_chunk").parquet(staging)
    )
    if not list_staged(spark, staging):
        remove(spark, staging)
        return []
    written = spark.read.schema("decision_id string, model string, _chunk string").parquet(staging)
    facts = written.groupBy("model", F.col("_metadata.file_path").alias("path")).agg(
        F.min("decision_id").alias("low"), F.max("decision_id").alias("high"), F.count(F.lit(1)).alias("n")
    )
    digest = F.md5(F.concat_ws(":", F.lit(tag or uuid.uuid4().hex), "model", "low", "high", F.col("n").cast("string")))
    dashed = F.concat_ws("-", *(F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    keyed = facts.select("path", partition_key(F.col("model"), F.col("low"), F.col("high"), F.col("n"), dashed).alias("key"))
    out = []
    for r in keyed.collect():  # one row a file
        out.append(f"{root.rstrip('/')}/{r['key']}")
        move(spark, r["path"], out[-1])
    remove(spark, staging)
    return out


def replace_files(spark: SparkSession, new_rows: DataFrame, root: str, old_paths: Sequence[str], chunk: Column) -> list[str]:
    """Write first, delete after: on a failure the inputs are still all there, and rewards
    merged twice are the same as merged once."""
    new = write_partitions(new_rows, root, chunk)
    for p in old_paths:
        remove(spark, p)
    return new
