"""From track lines to validated records to rewarded-decision rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rewardmill.functions import json, ksuid, names


def _kind(v: Column) -> Column:
    return F.when(v.isNotNull() & ~F.is_variant_null(v), F.schema_of_variant(v))


def parse(lines: DataFrame, now: Column | float) -> DataFrame:
    """One row a line: its fields, ``is_decision``, and ``reject_reason`` (null if valid).

    The rules, in order: an object; a valid message_id, not in the future; a valid model;
    a count, if any, that is a whole number from 1 on (true counts as 1); for rewards a
    valid decision_id and a numeric reward; for decisions no sample beside a count of 1.
    """
    body = F.try_parse_json("value")
    field = lambda name: F.try_variant_get(F.col("_v"), f"$.{name}", "variant")
    text = lambda name: F.when(_kind(F.col(f"_{name}")) == "STRING", F.try_variant_get(F.col(f"_{name}"), "$", "string"))
    fields = ("message_id", "model", "count", "item", "context", "sample", "decision_id", "reward")
    rows = lines.withColumn("_v", body).withColumns({f"_{n}": field(n) for n in fields})
    count_kind, reward_kind = _kind(F.col("_count")), _kind(F.col("_reward"))
    whole = F.when(count_kind == "BIGINT", F.try_variant_get("_count", "$", "bigint")).when(
        count_kind == "BOOLEAN", F.try_variant_get("_count", "$", "boolean").cast("bigint")
    )
    rows = rows.withColumns(
        {
            "message_id": text("message_id"), "model": text("model"), "decision_id": text("decision_id"),
            "is_decision": count_kind.isNotNull(), "count": whole, "has_sample": F.col("_sample").isNotNull(),
            "reward": F.when(reward_kind == "BOOLEAN", F.try_variant_get("_reward", "$", "boolean").cast("double"))
            .when(reward_kind.isin("BIGINT", "DOUBLE", "FLOAT") | reward_kind.startswith("DECIMAL"), F.try_variant_get("_reward", "$", "double")),
            "reward_text": F.to_json("_reward"),
        }
    )
    reason = (
        F.when(F.col("_v").isNull() | ~F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)), "not an object")
        .when(~ksuid.is_valid(F.col("message_id"), now), "invalid message_id")
        .when(~names.is_model_name(F.col("model")), "invalid model")
        .when(F.col("is_decision") & (F.col("count").isNull() | (F.col("count") < 1)), "invalid count")
        .when(~F.col("is_decision") & ~ksuid.is_valid(F.col("decision_id"), now), "invalid decision_id")
        .when(~F.col("is_decision") & F.col("reward").isNull(), "invalid reward")
        .when(F.col("is_decision") & F.col("has_sample") & (F.col("count") == 1), "sample beside a count of 1")
    )
    return rows.withColumn("reject_reason", reason)


def to_rewarded_decisions(records: DataFrame) -> DataFrame:
    """Valid records as rows of the central table, with model and _seq.

    A decision's absent item or context is the JSON text ``null``; its sample is there
    only if given. A reward becomes a row of its decision with that one reward, as JSON and
    as ``message_id`` and ``value``, which a merge takes as they are.
    """
    valid = records.filter("reject_reason IS NULL")
    decision = F.col("is_decision")
    stored = lambda name: F.coalesce(F.to_json(f"_{name}"), F.lit("null"))
    one = json.rewards_text(F.array(F.struct(F.col("message_id").alias("message_id"), F.col("reward_text").alias("value"))))
    return valid.select(
        "model", F.when(decision, F.col("message_id")).otherwise(F.col("decision_id")).alias("decision_id"),
        F.when(decision, stored("item")).alias("item"), F.when(decision, stored("context")).alias("context"),
        F.when(decision, F.col("count").cast("double")).alias("count"),
        F.when(decision & F.col("has_sample"), stored("sample")).alias("sample"),
        F.when(~decision, one).alias("rewards"), F.lit(None).cast("double").alias("reward"), "_seq",
        F.when(~decision, F.col("message_id")).alias("message_id"), F.when(~decision, F.col("reward_text")).alias("value"),
    )


def rejects(records: DataFrame) -> DataFrame:
    """Lines that broke a rule, with it: stored, so that they can be looked into."""
    return records.filter("reject_reason IS NOT NULL").select("value", "reject_reason")


def counts(records: DataFrame) -> DataFrame:
    """Valid rows by model and invalid rows by reason, in one aggregation."""
    return records.groupBy(
        F.when(F.col("reject_reason").isNull(), F.col("model")).alias("model"), "reject_reason"
    ).agg(F.count(F.lit(1)).alias("n"))
