"""Running sums, ranks and quantiles over a whole table without one task that holds it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rewardmill.sources.scratch import checkpointed


def running_sum(rows: DataFrame, order: list, value: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``name``: the inclusive running sum of ``value`` in ``order``, within ``by``.

    Rows are dealt by key range, so a group may spread over many tasks; each partition sums
    its own rows, and the partitions' totals (a row each and group in it) are summed before
    them. Rows are checkpointed: both readers must see the same ranges.
    """
    spark, by = rows.sparkSession, list(by)
    ranged = checkpointed(
        rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *by, *order).withColumn(
            "_part", F.spark_partition_id()
        )
    )
    totals = ranged.groupBy(*by, "_part").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*by, "_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    own = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("_own", F.sum(value).over(own))
    same = [summed[c].eqNullSafe(before[c]) for c in (*by, "_part")]
    joined = summed.join(before, same, "left")
    return joined.select(
        *(summed[c] for c in rows.columns), (F.coalesce(before["_before"], F.lit(0)) + summed["_own"]).alias(name)
    )


def first_of_groups(rows: DataFrame, by: Sequence[str], order: Column, wanted: Column) -> DataFrame:
    """Of every group of ``n`` rows (column ``_n``) the first ``wanted`` in ``order``.

    The last order value that belongs is found by a running count over narrow rows; wide ones
    are only filtered by it. ``order`` must tell a group's rows apart: equal ones come together
    or not at all.
    """
    by, row = list(by), rows.withColumn("_order", order)
    narrow = row.groupBy(*by, "_order").agg(F.count(F.lit(1)).alias("_c"))
    sizes = narrow.groupBy(*by).agg(F.sum("_c").alias("_n"))
    upto = running_sum(narrow, ["_order"], "_c", "_upto", by)
    same = lambda a, b: [a[c].eqNullSafe(b[c]) for c in by]
    within = upto.join(sizes, same(upto, sizes)).filter(F.col("_upto") <= wanted).groupBy(
        *(upto[c].alias(c) for c in by)
    ).agg(F.max("_order").alias("_last"))
    return row.join(within, same(row, within)).filter(row["_order"] <= within["_last"]).select(*(row[c] for c in rows.columns))


def quantiles(rows: DataFrame, column: str, by: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """(by..., n, names...): exact quantiles, interpolated between neighbours; nulls aside.

    From counts by value and their running sums, so no task holds a group's values.
    """
    by = list(by)
    counts = rows.filter(F.col(column).isNotNull()).groupBy(*by, F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    sizes = counts.groupBy(*by).agg(F.sum("_c").alias("n"))
    upto = running_sum(counts, ["_v"], "_c", "_upto", by)
    joined = upto.join(sizes, [upto[c].eqNullSafe(sizes[c]) for c in by]) if by else upto.crossJoin(F.broadcast(sizes))  # one row
    joined = joined.select(*(upto[c] for c in (*by, "_v", "_upto")), "n")

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_upto") > rank, F.col("_v")))

    place = {k: (F.col("n") - 1) * p for k, p in shares.items()}
    ends = joined.groupBy(*by).agg(
        F.max("n").alias("n"),
        *(e for k, r in place.items() for e in (at(F.floor(r)).alias(f"_lo_{k}"), at(F.ceil(r)).alias(f"_hi_{k}"))),
    )
    share = {k: place[k] - F.floor(place[k]) for k in shares}
    return ends.select(*by, "n", *((F.col(f"_lo_{k}") + (F.col(f"_hi_{k}") - F.col(f"_lo_{k}")) * share[k]).alias(k) for k in shares))
