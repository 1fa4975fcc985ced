"""Streaming ingestion: micro-batches of delivered files, each merged and appended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rewardmill import schemas
from rewardmill.config import LayoutConfig
from rewardmill.functions import ksuid
from rewardmill.operators import layout, merge, records
from rewardmill.sources import partitions
from rewardmill.sources.scratch import checkpointed


def chunked(merged: DataFrame, keys: list[str], max_rows: int) -> tuple[DataFrame, Column]:
    """``merged`` and the chunk of each row: as much of its id's time as keeps chunks small.

    Merged rows are written once with their time, then counted and dealt from there.
    """
    timed = checkpointed(merged.withColumn("_time", ksuid.iso_basic(F.col("decision_id"))))
    levels = layout.split_levels(timed, keys, F.col("_time"), max_rows)
    small = F.broadcast(levels.select(*keys, "level"))  # a row a model or group of files
    return timed.join(small, keys), F.concat_ws("/", *keys, layout.chunk_of(F.col("_time"), F.col("level")))


def ingest(
    lines: DataFrame, root: str, checkpoint: str, now: Column | float, available_now: bool = True,
    config: LayoutConfig = LayoutConfig(),
) -> StreamingQuery:
    """Parse, validate and merge every micro-batch into the partition table at ``root``
    (rejects beside it).

    No watermark: a reward may come any time after its decision, so a batch only merges
    within itself and later reads or compactions unite its rows with others. Names of a
    batch's files repeat when it is replayed, and its rejects have a folder of its number:
    exactly once.
    """

    def batch(df: DataFrame, number: int) -> None:
        numbered = df.withColumn("_seq", F.monotonically_increasing_id())
        parsed = records.parse(numbered, now).persist()
        try:
            merged = merge.merge(records.to_rewarded_decisions(parsed), ["model", "decision_id"])
            rows, chunk = chunked(merged, ["model"], config.max_rows)
            partitions.write_partitions(rows, root, chunk, tag=f"batch-{number}")
            records.rejects(parsed).write.mode("overwrite").parquet(f"{root}/rejects/batch={number}")
        finally:
            parsed.unpersist()

    writer = lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="900 seconds")).start()


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The table as of now: all files' rows merged, in the order of their names, that is of
    time, and of rows within a file."""
    files = partitions.manifest(spark, root).select("model", "path").collect()  # names, not rows
    if not files:
        empty = spark.createDataFrame([], schemas.REWARDED_DECISIONS)
        return empty.withColumn("model", F.lit("")).select("model", *schemas.COLUMNS)
    model = spark.createDataFrame([(r["model"], r["path"].rpartition("/")[2]) for r in files], "model string, _file string")
    rows = partitions.with_facts(partitions.read_files(spark, [r["path"] for r in files]), model)
    return merge.merge(rows.withColumn("_seq", F.struct("_file", "_row")), ["model", "decision_id"])


def stream_aggregate(events: DataFrame, table: str, checkpoint: str, keys: list[str], value: str) -> StreamingQuery:
    """Sums of a stream by key, each batch's in its own folder."""

    def batch(df: DataFrame, number: int) -> None:
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).write.mode(
            "overwrite"
        ).parquet(f"{table}/batch={number}")

    return events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
