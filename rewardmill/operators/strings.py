"""Target encoding of string features: statistics, tables of hashes, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rewardmill.functions import arithmetic, hashing


def string_stats(long: DataFrame) -> DataFrame:
    """(feature, str, total_w, total_wy, n) over all training rows that hold a string."""
    w, y = F.coalesce("w", F.lit(1.0)), F.coalesce("y", F.lit(0.0))
    return long.filter(F.col("str").isNotNull()).groupBy("feature", "str").agg(
        F.sum(w).alias("total_w"), F.sum(w * y).alias("total_wy"), F.count(F.lit(1)).alias("n")
    )


def ranked_strings(
    stats: DataFrame, prior_mean: float, prior_count: float, min_count: int = 20, max_strings: int = 10_000
) -> DataFrame:
    """(feature, str, mean, pos, size): strings seen more than ``min_count`` times, at most
    ``max_strings`` a feature by weight, from the best smoothed mean (pos 0) on; ties by name."""
    by_weight = Window.partitionBy("feature").orderBy(F.desc("total_w"), "str")
    kept = stats.filter(F.col("n") > min_count).withColumn("_r", F.row_number().over(by_weight)).filter(F.col("_r") <= max_strings)
    mean = arithmetic.smoothed_mean(F.col("total_w"), F.col("total_wy"), F.col("n"), prior_mean, prior_count)
    best = Window.partitionBy("feature").orderBy(F.desc("mean"), "str")
    return kept.withColumn("mean", mean).select(
        "feature", "str", "mean", (F.row_number().over(best) - 1).alias("pos"),
        F.count(F.lit(1)).over(Window.partitionBy("feature")).alias("size"),
    )


def tables(ranked: DataFrame, seed: int) -> DataFrame:
    """(feature, hashes, mask): truncated hashes from best to worst string, and the lookup mask.

    Hashes keep the fewest low bits that tell a feature's strings apart.
    """
    hashed = ranked.withColumn("_h", hashing.xxh3(F.col("str"), seed))
    lists = hashed.groupBy("feature").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "_h"))), lambda x: x["_h"]).alias("_all")
    )
    cut = lists.withColumn("_bits", hashing.least_bits(F.col("_all"))).withColumn(
        "hashes", F.transform("_all", lambda h: h.bitwiseAND(hashing.mask_of(F.col("_bits"))))
    )
    largest = F.array_max(F.transform("hashes", hashing.unsigned_order))
    return cut.select("feature", "hashes", hashing.mask_of_largest(hashing.unsigned_order(largest)).alias("mask"))


def tables_of(spark: SparkSession, found: dict) -> DataFrame:
    """The tables that a model's metadata store, ready for :func:`encode`; ValueError on a
    table of a feature the model doesn't have."""
    unknown = set(found["string_tables"]) - set(found.get("feature_names") or found["string_tables"])
    if unknown:
        raise ValueError(f"string tables of unknown features: {sorted(unknown)}")
    rows = [(k, [int(h) for h in v]) for k, v in sorted(found["string_tables"].items())]
    tabs = spark.createDataFrame(rows, "feature string, hashes array<long>")
    largest = F.array_max(F.transform("hashes", hashing.unsigned_order))
    return tabs.withColumn("mask", hashing.mask_of_largest(hashing.unsigned_order(largest)))


def lookup(tabs: DataFrame) -> DataFrame:
    """(feature, hash, mask, value, width): one row a table entry, ready to join."""
    size = F.size("hashes")
    return tabs.select("feature", "mask", size.alias("_n"), F.posexplode("hashes").alias("pos", "hash")).select(
        "feature", "hash", "mask", arithmetic.code_value(F.col("pos"), F.col("_n")).alias("value"),
        arithmetic.miss_width(F.col("_n")).alias("width"),
    )


def encode(long: DataFrame, tabs: DataFrame, seed: int, noise: Column | float = 0.0) -> DataFrame:
    """``long`` with strings as numbers: their table's value, else their hash spread over the
    table's miss width (width 1, mask 0 without a table).

    Hashes are computed once a distinct string; tables are bounded by ``max_strings`` a
    selected feature, and joined, not looked up in a UDF.
    """
    noise = F.lit(float(noise)) if isinstance(noise, (int, float)) else noise
    distinct = long.filter(F.col("str").isNotNull()).select("feature", "str").distinct()
    widths = tabs.select("feature", "mask", arithmetic.miss_width(F.size("hashes")).alias("width"))
    hashed = distinct.withColumn("_h", hashing.xxh3(F.col("str"), seed)).join(widths, "feature", "left")
    hashed = hashed.withColumn("hash", F.col("_h").bitwiseAND(F.coalesce("mask", F.lit(0).cast("long"))))
    hits = lookup(tabs).select("feature", "hash", "value")
    coded = hashed.join(hits, ["feature", "hash"], "left").select(
        "feature", "str", F.coalesce("value", arithmetic.miss_value(F.col("_h"), F.coalesce("width", F.lit(1.0)))).alias("_code")
    )
    return long.join(coded, ["feature", "str"], "left").withColumn(
        "num", arithmetic.sprinkle(F.coalesce("num", "_code"), noise)
    ).drop("_code")
