"""Schemas of the tables that operators exchange."""

from __future__ import annotations

from pyspark.sql import types as T

#: A decision with its accumulated rewards; item is null on rows of orphan rewards.
REWARDED_DECISIONS = T.StructType(
    [
        T.StructField("decision_id", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("context", T.StringType()),
        T.StructField("count", T.DoubleType()),
        T.StructField("sample", T.StringType()),
        T.StructField("rewards", T.StringType()),
        T.StructField("reward", T.DoubleType()),
    ]
)
COLUMNS = REWARDED_DECISIONS.fieldNames()

#: One row a partition file: its time range and size stand for what its name would say.
MANIFEST = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("min_ts", T.StringType()),
        T.StructField("max_ts", T.StringType()),
        T.StructField("row_count", T.LongType()),
    ]
)
