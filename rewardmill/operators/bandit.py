"""Baselines and synthetic environments for judging bandit models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rewardmill.functions.arithmetic import by_cuts, poisson_cuts, uniform_of
from rewardmill.sources.scratch import checkpointed

REPLICAS = 128


def bootstrap(
    rows: DataFrame, action: str, reward: str, seed: Column, draw: Callable[[Column, Column], Column], replicas: int = REPLICAS
) -> DataFrame:
    """(action, replica, weighted, weight): per action, sums under each replica's Poisson(1)
    row weights.

    A row's uniforms, ``draw(seed, replica)``, are one array, its seed computed once; the
    replicas are generated from it behind the scan, and sums combine before the shuffle, so
    what moves is actions times replicas.
    """
    each = lambda s: F.transform(F.sequence(F.lit(0), F.lit(replicas - 1)), lambda k: draw(s, k))
    uniforms = F.get(F.transform(F.array(seed), each), F.lit(0))
    spread = rows.select(action, reward, F.posexplode_outer(uniforms).alias("replica", "_u"))
    return spread.withColumn("_w", by_cuts(F.col("_u"), poisson_cuts())).groupBy(action, "replica").agg(
        F.sum(F.col("_w") * F.col(reward)).alias("weighted"), F.sum("_w").alias("weight")
    )


def best_actions(sums: DataFrame, action: str) -> DataFrame:
    """(replica, action): Thompson choices, the action of the largest mean under each replica;
    of equal ones the last by name; actions without weight are left out."""
    mean = F.col("weighted") / F.col("weight")
    known = sums.filter(F.col("weight") > 0)
    return known.groupBy("replica").agg(F.max_by(action, F.struct(mean, action)).alias("action"))


def best_action(sums: DataFrame, action: str, replica: int) -> DataFrame:
    """The choice under one replica."""
    return best_actions(sums.filter(F.col("replica") == replica), action).select("action")


def environment(
    spark: SparkSession, kind: str, interactions: int = 3_000, size: int = 10, seed: int = 1,
    uniform: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """(interaction, context, action, reward): every action of every interaction, drawn by
    ``uniform`` of a number and a salt (by default a seeded hash).

    ``weekday`` (three greetings, one of which pays only on Sundays; ``weekday_text`` names
    them), ``match`` and ``shuffled_match`` (the action equal to the context, or to its
    image under a permutation), ``feature_match`` (the same as one-hot vectors), ``pairs``
    and ``feature_pairs`` (two different variants, the larger pays more).
    """
    base = spark.range(interactions).withColumnRenamed("id", "interaction")
    uniform = uniform or (lambda *parts: uniform_of(*parts, seed=seed))
    draw = lambda n, salt: F.floor(uniform(F.col("interaction"), F.lit(salt)) * n).cast("int")
    if kind in ("weekday", "weekday_text"):
        names = ("Have a great day!", "Have an OK day.", "Happy Sunday!")
        k = F.col("_k")
        rows = base.withColumn("_c", draw(7, 0)).withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(2))))
        reward = F.when(k == 0, 0.01).when(k == 1, 0.001).when(F.col("_c") == 0, 1.0).otherwise(0.0)
        action = F.element_at(F.array(*(F.lit(n) for n in names)), k + 1) if kind == "weekday_text" else _one_hot(k, 3)
        return rows.select("interaction", F.col("_c").cast("string").alias("context"), action.alias("action"), reward.alias("reward"))
    if kind in ("match", "shuffled_match", "feature_match"):
        rows = base.withColumn("_c", draw(size, 0)).withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
        image = F.col("_k")
        if kind == "shuffled_match":
            order = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda x: F.struct(uniform(x, F.lit(2)).alias("h"), x.alias("x"))))
            image = F.element_at(F.transform(order, lambda s: s["x"]), F.col("_k") + 1)
        reward = (F.col("_c") == image).cast("double")
        shown = (lambda c: _one_hot(c, size)) if kind == "feature_match" else (lambda c: c.cast("string"))
        return rows.select("interaction", shown(F.col("_c")).alias("context"), shown(F.col("_k")).alias("action"), reward.alias("reward"))
    if kind in ("pairs", "feature_pairs"):
        first, step = draw(size, 0), draw(size - 1, 1) + 1
        other = F.pmod(first + step, F.lit(size)).cast("int")  # never equal to the first
        rows = base.withColumn("_k", F.explode(F.array(first, other)))
        shown = _one_hot(F.col("_k"), size) if kind == "feature_pairs" else F.col("_k").cast("string")
        return rows.select("interaction", F.lit(None).cast("string").alias("context"), shown.alias("action"), (F.col("_k") / size).alias("reward"))
    raise ValueError(f"no such environment: {kind}")


def _one_hot(k: Column, size: int) -> Column:
    hot = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda x: (x == k).cast("int").cast("string"))
    return F.concat(F.lit("["), F.array_join(hot, ","), F.lit("]"))


def run_epochs(
    environment_rows: DataFrame, interactions: int, replicas: int = REPLICAS, seed: int = 1, first: int = 16, growth: float = 2.0
) -> DataFrame:
    """(interaction, epoch, context, action, reward): a Thompson learner's choices, trained
    again after every growing epoch on all rewards it has seen so far.

    Before the first training actions are drawn evenly. Then an interaction asks one replica,
    drawn by hash, for the best action in its context, among those it has weight for; unseen
    contexts draw evenly again. The loop is over epochs: their number is logarithmic.
    """
    ends = [0, *learning_epochs(interactions, first, growth)]
    if ends[-1] < interactions:
        ends.append(interactions)
    known = environment_rows.withColumn("context", F.coalesce("context", F.lit("")))
    drawn = F.row_number().over(Window.partitionBy("interaction").orderBy(F.xxhash64(F.lit(seed), "interaction", "action"), "action"))
    offers = known.withColumn("_even", drawn == 1).withColumn(
        "_replica", F.pmod(F.xxhash64(F.lit(seed + 1), "interaction"), F.lit(replicas)).cast("int")
    )
    seen = None
    for epoch, (start, end) in enumerate(zip(ends, ends[1:])):
        now = offers.filter((F.col("interaction") >= start) & (F.col("interaction") < end))
        if seen is None:
            chosen = now.filter("_even")
        else:
            pairs = seen.withColumn("_pair", F.struct("context", "action"))
            draw = lambda s, k: uniform_of(s, k, seed=seed)
            sums = bootstrap(pairs, "_pair", "reward", F.col("interaction"), draw, replicas).select(
                F.col("_pair.context").alias("context"), F.col("_pair.action").alias("best"), F.col("replica").alias("_replica"), "weighted", "weight"
            )
            mean = F.col("weighted") / F.col("weight")
            best = sums.filter("weight > 0").groupBy("context", "_replica").agg(F.max_by("best", F.struct(mean, "best")).alias("best"))
            asked = now.join(best, ["context", "_replica"], "left")
            chosen = asked.filter(F.when(F.col("best").isNull(), F.col("_even")).otherwise(F.col("action") == F.col("best")))
        rows = chosen.select("interaction", F.lit(epoch).alias("epoch"), "context", "action", "reward")
        seen = checkpointed(rows if seen is None else seen.unionByName(rows))
    return seen


def learning_epochs(interactions: int, first: int = 16, growth: float = 2.0) -> list[int]:
    """After how many interactions a model is trained again: growing epochs."""
    out, size, at = [], float(first), 0
    while at + int(size) <= interactions:
        at += int(size)
        out.append(at)
        size *= growth
    return out
