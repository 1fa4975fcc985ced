"""Partition layout: split levels, grooming groups, overlap checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rewardmill.config import LayoutConfig

PREFIXES = tuple(range(6, 16))


def split_levels(rows: DataFrame, keys: list[str], time: Column, max_rows: int = 10_000) -> DataFrame:
    """(keys..., n, level): how many characters of the time name a chunk; 0: no split.

    Time prefixes nest, so one rollup counts every level at once; the level is the
    shortest prefix whose largest chunk fits, or the full second.
    """
    timed = rows.select(*keys, *(F.substring(time, 1, k).alias(f"p{k}") for k in PREFIXES))
    names = [f"p{k}" for k in PREFIXES]
    # counts by second combine before the shuffle; the rollup then expands seconds, not rows
    seconds = timed.groupBy(*keys, *names).agg(F.count(F.lit(1)).alias("n"))
    levels = None
    for k in PREFIXES:
        at = seconds.groupBy(*keys, f"p{k}").agg(F.sum("n").alias("n")).groupBy(*keys).agg(
            F.lit(k).alias("_k"), F.max("n").alias("_largest"), F.sum("n").alias("n")
        )
        levels = at if levels is None else levels.union(at)
    fits = F.min(F.when(F.col("_largest") <= max_rows, F.col("_k")))
    return levels.groupBy(*keys).agg(F.max("n").alias("n"), F.coalesce(fits, F.lit(15)).alias("_level")).select(
        *keys, "n", F.when(F.col("n") <= max_rows, 0).otherwise(F.col("_level")).alias("level")
    )


def prefix_counts(rows: DataFrame, time: Column, levels=PREFIXES) -> DataFrame:
    """(level, prefix, n) of all time prefixes, by one rollup."""
    cols = [F.substring(time, 1, k).alias(f"p{k}") for k in levels]
    names = [f"p{k}" for k in levels]
    counted = rows.select(*cols).rollup(*names).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g"))
    depth = F.lit(len(levels)) - F.bit_count("_g")
    return counted.filter(depth > 0).select(
        F.element_at(F.array(*(F.lit(k) for k in levels)), depth.cast("int")).alias("level"),
        F.element_at(F.array(*names), depth.cast("int")).alias("prefix"), "n",
    )


def chunk_of(time: Column, level: Column) -> Column:
    return F.when(level == 0, F.lit("")).otherwise(time.substr(F.lit(1), level))


def groom_groups(manifest: DataFrame, config: LayoutConfig = LayoutConfig()) -> DataFrame:
    """(model, group_no, paths): files to merge, in the order of their latest time.

    A sequential fold over each model's files (metadata, not rows): files join the open
    group while rows and files stay within bounds; then groups whose time touches the next
    one's are merged in pairs, never in chains; single files are left alone.
    """
    file = F.struct("max_ts", "path", "min_ts", "row_count")
    files = manifest.groupBy("model").agg(F.array_sort(F.collect_list(file)).alias("files"))
    one = "struct<paths:array<string>,lo:string,hi:string,n:bigint>"
    empty = F.struct(
        F.array().cast(f"array<{one}>").alias("done"), F.lit(None).cast(one).alias("open")
    )

    def group(x):
        return F.struct(F.array(x["path"]).alias("paths"), x["min_ts"].alias("lo"), x["max_ts"].alias("hi"), x["row_count"].alias("n"))

    def both(a, b):
        return F.struct(
            F.concat(a["paths"], b["paths"]).alias("paths"), F.least(a["lo"], b["lo"]).alias("lo"),
            F.greatest(a["hi"], b["hi"]).alias("hi"), (a["n"] + b["n"]).alias("n"),
        )

    def state(done, open_):
        return F.struct(done.alias("done"), open_.cast(one).alias("open"))

    def add(acc, x):
        g, o = group(x), acc["open"]
        roomy = (o["n"] + x["row_count"] <= config.max_rows) & (F.size(o["paths"]) < config.max_files_per_group)
        return (
            F.when(o.isNull(), state(acc["done"], g))
            .when(roomy, state(acc["done"], both(o, g)))
            .otherwise(state(F.concat(acc["done"], F.array(o)), g))
        )

    def pair(acc, g):
        o = acc["open"]
        return (
            F.when(o.isNull(), state(acc["done"], g))
            .when(o["hi"] >= g["lo"], state(F.concat(acc["done"], F.array(both(o, g))), F.lit(None)))
            .otherwise(state(F.concat(acc["done"], F.array(o)), g))
        )

    def finish(acc):
        return F.when(acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))

    small = F.aggregate("files", empty, add, finish)
    paired = F.aggregate("_small", empty, pair, finish)
    grouped = files.withColumn("_small", small).select("model", paired.alias("_groups"))
    several = F.filter("_groups", lambda g: F.size(g["paths"]) > 1)
    return grouped.select("model", F.posexplode(several).alias("group_no", "_g")).select(
        "model", "group_no", F.col("_g.paths").alias("paths"), F.col("_g.n").alias("row_count")
    )


def cap_keys(groups: DataFrame, config: LayoutConfig = LayoutConfig()) -> DataFrame:
    """Groups as far as their paths' bytes fit the bound; a cut group needs two paths."""
    each = groups.select("model", "group_no", "row_count", F.posexplode("paths").alias("pos", "path"))
    order = Window.partitionBy("model").orderBy("group_no", "pos").rowsBetween(Window.unboundedPreceding, 0)
    fits = each.withColumn("_bytes", F.sum(F.octet_length("path")).over(order)).filter(F.col("_bytes") <= config.max_key_bytes)
    kept = fits.groupBy("model", "group_no", "row_count").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "path"))), lambda x: x["path"]).alias("paths")
    )
    return kept.filter(F.size("paths") > 1).select("model", "group_no", "paths", "row_count")


def overlaps(manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Neighbours in order of max_ts that touch or overlap in time (none: all is well)."""
    order = Window.partitionBy(*keys).orderBy("max_ts", "min_ts", "path")
    return manifest.withColumn("next_min", F.lead("min_ts").over(order)).filter(F.col("next_min") <= F.col("max_ts"))
