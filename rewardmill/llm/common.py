"""Helpers shared by the corpus operators: shared-folder tables, shipping, components."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardmill.sources.scratch import shared_dir

_PACKAGE = Path(__file__).resolve().parents[1]
_SHIPPED: set[str] = set()


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a compressed table in the shared folder and read it back.

    Cuts the lineage like ``checkpoint()``; a lost executor re-reads files, it does not
    recompute the Python stages before. The table goes when the application ends, or sooner
    by :func:`discard`.
    """
    spark = df.sparkSession
    name = f"{shared_dir(spark).rstrip('/')}/rewardmill-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(name)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(name)


def discard(*tables: DataFrame) -> None:
    """Delete the files of ``materialise``d tables that nothing reads any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            if path.getName().startswith("rewardmill-"):
                path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def tidy(spark: SparkSession) -> None:
    """Let Spark clean up the shuffle files of jobs that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ship(spark: SparkSession) -> None:
    """Make this package importable on executors, once an application: only where they are
    this machine's own threads is the driver's path theirs too."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED or sc.master == "local" or sc.master.startswith("local["):
        return
    base = os.path.join(tempfile.mkdtemp(), "rewardmill_src")  # the driver serves it from here
    sc.addPyFile(shutil.make_archive(base, "zip", str(_PACKAGE.parent), _PACKAGE.name))
    _SHIPPED.add(sc.applicationId)


def slices(pdf, rows: int):
    """Consecutive parts of a batch: bounds what a worker holds beside the batch itself."""
    for at in range(0, len(pdf), rows):
        yield pdf.iloc[at : at + rows]


def give_back() -> None:
    """Return freed memory of this Python worker to the system: workers live on between
    stages, and an executor's limit counts what their allocators keep."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not glibc


def free_name(columns, wanted: str) -> str:
    """``wanted``, or with underscores before it, so that no column has that name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


#: Rows up to which a table of ids, hashes and short names is sent to every executor.
SMALL_ROWS = 500_000


def checked_broadcast(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it is counted to have at most ``SMALL_ROWS`` rows; else
    as it is, for a shuffled join (which adaptive execution splits where it is skewed)."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def doc_bucket(column: str, modulus: int):
    """crc32 of the id as decimal text, modulo ``modulus`` (null ids: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected edge list (u, v); component = smallest node.

    Alternating large-star and small-star contraction. All state stays in Spark tables:
    every round is two aggregations that combine before the shuffle and two equi-joins,
    checkpointed in the shared folder, so neither a hub nor a long chain gathers anywhere.
    It goes on until a round changes nothing.
    """
    shared_dir(edges.sparkSession)
    e = (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u > v")
        .distinct()
        .checkpoint()
    )
    mark = _fingerprint(e)
    while mark[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v"),
        )
        e = small.filter("u > v").distinct().checkpoint()
        now = _fingerprint(e)
        if now == mark:
            break
        mark = now
    member = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    root = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return member.union(root)


def _fingerprint(e: DataFrame) -> tuple:
    row = e.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))).alias("h"),
    ).first()
    return (row["n"], row["h"])
