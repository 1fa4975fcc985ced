"""Track records: JSON lines in (gzipped) text files, batch or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path) -> DataFrame:
    """(value, _seq) of text files; gzip is read as it is, order within a file is kept.

    ``_seq`` is for one pass over the lines: what must be the same again is written first.
    """
    return spark.read.text(path).withColumn("_seq", F.monotonically_increasing_id())


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int = 64, bytes_per_trigger: int | None = None) -> DataFrame:
    """The lines as a stream: every delivered file is read once (batches number their rows).
    A batch is bounded by files or, if given, by their bytes."""
    bound = ("maxFilesPerTrigger", files_per_trigger) if bytes_per_trigger is None else ("maxBytesPerTrigger", bytes_per_trigger)
    return spark.readStream.option(*bound).text(path)


def valid_message_id(ident):
    """What the tracking endpoint accepts: 27 letters or digits."""
    return F.coalesce(ident.rlike("^[a-zA-Z0-9]{27}$"), F.lit(False))
