"""Training rows: expansion of decisions, feature selection, dense matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rewardmill.config import TrainConfig
from rewardmill.functions import arithmetic, json, ksuid
from rewardmill.operators import scan
from rewardmill.operators.running import quantiles


def expand(decisions: DataFrame, time: Column | None = None) -> DataFrame:
    """One row for the chosen item (y 1, w 1) and, where more than one was on offer, one for
    the sampled other (y 0, w count - 1), with the decision's time ``t``."""
    time = ksuid.seconds(F.col("decision_id")) if time is None else time
    count = F.coalesce("count", F.lit(1.0))
    chosen = F.struct(F.col("item").alias("item"), F.lit(1.0).alias("y"), F.lit(1.0).alias("w"))
    other = F.struct(F.col("sample").alias("item"), F.lit(0.0).alias("y"), (count - 1).alias("w"))
    both = F.filter(F.array(chosen, F.when(count > 1, other)), lambda x: x.isNotNull())
    return decisions.withColumn("t", time).select(
        "decision_id", "context", "t", F.inline(both).alias("item", "y", "w")
    )


def checked(rows: DataFrame) -> DataFrame:
    """Fails the job on a negative time or weight instead of training on it."""
    ok = F.assert_true((F.col("t") >= 0) & (F.col("w") >= 0), "negative time or weight")
    return rows.filter(ok.isNull())


def features(rows: DataFrame, max_depth: int = 4) -> DataFrame:
    """Long features of training rows: (decision_id, y, w, t, feature, num, str).

    A decision's context is flattened for each of its one or two rows: to flatten it once and
    join it to both would shuffle every feature to save parsing it.
    """
    keys = ["decision_id", "y", "w", "t"]
    return json.flatten(rows, {"context": "context", "item": "item"}, keys, max_depth)


def select_features(long: DataFrame, k: int) -> DataFrame:
    """The ``k`` features of the largest total weight (no weight counts 1), ties by name."""
    weight = F.sum(F.coalesce("w", F.lit(1.0)))
    return (
        long.filter(~F.col("feature").isin("w", "y")).groupBy("feature").agg(weight.alias("weight"))
        .orderBy(F.desc("weight"), "feature").limit(k)
    )


def dense(long: DataFrame, keys: Sequence[str], names: Sequence[str], rows: DataFrame | None = None) -> DataFrame:
    """(keys..., features array<float>): one slot a name in sorted order, NaN where missing.

    Every row of ``rows`` (by default: of ``long``) comes out, also one without any of the
    features. By position in an array: no pivot, so the plan doesn't grow with the features.
    """
    names = sorted(names)
    every = (long if rows is None else rows).select(
        *keys, F.lit(None).cast("string").alias("feature"), F.lit(None).cast("double").alias("num")
    )
    some = long.filter(F.col("feature").isin(list(names))).select(*keys, "feature", F.col("num").cast("double"))
    slots = F.map_from_entries(F.collect_set(F.when(F.col("feature").isNotNull(), F.struct("feature", "num"))))
    return some.unionByName(every.distinct() if rows is None else every).groupBy(*keys).agg(slots.alias("_m")).select(
        *keys,
        F.transform(
            F.array(*(F.lit(n) for n in names)),
            lambda f: F.coalesce(F.try_element_at("_m", f), F.lit(float("nan"))).cast("float"),
        ).alias("features"),
    )


def decision_rows(
    rows: DataFrame, mean: Column | float, std: Column | float | None, mean_count: Column | float, uniforms: dict[str, Column],
    config: TrainConfig,
) -> DataFrame:
    """(decision_id, item, context, y, w) of scored decisions, one row each, whatever they hold.

    ``rows`` have a ``propensity``. y is the (normalised) reward; w the inverse propensity
    over the mean number on offer, times a bootstrap weight; the context is dropped by
    chance, after the propensity was scored with it. ``uniforms``: ``boot`` and ``context``.
    """
    column = lambda x: x if isinstance(x, Column) else F.lit(x)
    target = F.col("reward")
    if config.normalize_rewards:
        target = arithmetic.standardised(target, column(mean), column(std).cast("double"))
    boot = arithmetic.bootstrap_weight(uniforms["boot"]) if config.explore else F.lit(1.0)
    weight = arithmetic.inverse_propensity(F.col("propensity"), mean_count, config.clip_min_propensity) * boot
    context = scan.sample_context(F.col("context"), config.context_keep, uniforms["context"])
    return rows.select("decision_id", "item", context.alias("context"), target.alias("y"), weight.alias("w"))


def described(row) -> str:
    """One line of a :func:`describe` row: ``count: 152, mean: 0.87, ..., max: 9.66``."""
    labels = {"n": "count", "mean": "mean", "std": "std", "low": "min", "p25": "25%", "p50": "50%", "p75": "75%", "high": "max"}
    return ", ".join(f"{label}: {row[name]:.6g}" for name, label in labels.items() if row[name] is not None)


def describe(rows: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, deviation, minimum, quartiles, maximum; no task holds a group's values."""
    c, by = F.col(column), list(by)
    sums = rows.groupBy(*by).agg(
        F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("low"), F.max(c).alias("high")
    )
    names = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    middle = quantiles(rows, column, by, names)
    same = [sums[k].eqNullSafe(middle[k]) for k in by] or F.lit(True)
    return sums.join(middle, same, "left").select(
        *(sums[k] for k in by), sums["n"], "mean", "std", "low", *names, "high"
    )
