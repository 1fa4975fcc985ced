"""Merging decisions with their rewards, however late and however often they arrive."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardmill.functions import json

FIRST_OF = ("item", "context", "count", "sample")


def merge(rows: DataFrame, keys: Sequence[str] = ("decision_id",), order: str = "_seq") -> DataFrame:
    """One row a key: first non-null of every column by ``order``, rewards united by
    message id (the last value of one wins), reward their sum. Idempotent.

    Rewards are the JSON of ``rewards`` or, on rows that have a ``message_id`` and a
    ``value``, that single one: what is fresh needn't become text to be read again.

    A full outer join of decisions and rewards as one union and two aggregations. The first
    is over rewards alone, by key and message: it combines before it shuffles, and spreads a
    decision that draws a large part of all rewards. The second sees every decision row and
    one row a message; bodies never travel twice.
    """
    keys = list(keys)
    pair = "array<struct<message_id:string,value:string>>"
    stored = F.map_entries(json.rewards_map(F.col("rewards"))).cast(pair)
    entries = F.coalesce(stored, F.array().cast(pair))
    if {"message_id", "value"} <= set(rows.columns):
        own = F.array(F.struct("message_id", "value")).cast(pair)
        entries = F.when(F.col("message_id").isNotNull(), own).otherwise(entries)
    ordered = F.col(order).alias("_o")
    said = rows.select(*keys, ordered, F.inline(entries).alias("message_id", "value"))
    last = said.groupBy(*keys, "message_id").agg(F.max_by("value", "_o").alias("value"))
    # every key keeps a row, also if it holds nothing at all
    bodies = rows.select(*keys, ordered, *FIRST_OF)
    given = reduce(lambda a, b: a | b, (F.col(c).isNotNull() for c in FIRST_OF))
    bare = rows.filter(~given & (F.size(entries) == 0)).select(*keys).distinct()
    nulls = {f: F.lit(None).cast(bodies.schema[f].dataType) for f in ("_o", *FIRST_OF)}
    no_entry = F.lit(None).cast("struct<message_id:string,value:string>")
    parts = [
        bodies.filter(given).withColumn("_entry", no_entry),
        bare.withColumns({**nulls, "_entry": no_entry}),
        last.select(*keys, *(v.alias(f) for f, v in nulls.items()), F.struct("message_id", "value").alias("_entry")),
    ]
    merged = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(
        *(F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_o"))).alias(c) for c in FIRST_OF),
        F.array_sort(F.collect_list("_entry")).alias("_rewards"),
    )
    return merged.select(
        *keys, *FIRST_OF, json.rewards_text(F.col("_rewards")).alias("rewards"),
        json.rewards_total(F.col("_rewards")).alias("reward"),
    )


def merge_files(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Late rewards: the same merge over what is stored and what is new, stored rows first.

    Stored rows have the order that ``_seq`` gives them; without one they must hold at most
    one row a key, as what was merged does.
    """
    if "_seq" not in existing.columns:
        existing = existing.withColumn("_seq", F.lit(0))
    old = existing.withColumn("_seq", F.struct(F.lit(0).alias("new"), F.col("_seq").cast("double").alias("at")))
    fresh = new.withColumn("_seq", F.struct(F.lit(1).alias("new"), F.col("_seq").cast("double").alias("at")))
    return merge(old.unionByName(fresh, allowMissingColumns=True), keys)


def group_slices(rows: DataFrame, key: str = "decision_id") -> DataFrame:
    """(key, start, end) of each run of equal keys in key order, positions from 0.

    From counts by key and their running sum over key ranges, so no task sees all rows.
    """
    from rewardmill.operators.running import running_sum

    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return running_sum(counts, [key], "n", "end").select(
        key, (F.col("end") - F.col("n")).alias("start"), "end"
    )
