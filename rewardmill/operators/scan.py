"""Training scans: budgets over newest files, exact and bootstrap samples, splits."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rewardmill.functions.arithmetic import uniform_of
from rewardmill.operators.running import first_of_groups, running_sum

NON_ZERO_SHARE = 1 - 1 / math.e
BIG_ROWS, BIG_FILES = 1_000_000, 100


def train_filter(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with an item and a context, as far as these columns are loaded (pushed to parquet)."""
    need = [c for c in ("item", "context") if c in columns]
    if not need:
        raise ValueError("at least one of item and context must be loaded")
    for c in need:
        rows = rows.filter(F.col(c).isNotNull())
    return rows.select(*columns)


def budget_files(manifest: DataFrame, sample: float = 1.0, max_rows: int | None = None) -> DataFrame:
    """Newest files first, until the rows so far times ``sample`` reach ``max_rows``; the file
    that crosses the bound still counts."""
    if max_rows is None:
        return manifest
    run = running_sum(manifest, [F.desc("path")], "row_count", "_upto")
    before = F.col("_upto") - F.col("row_count")
    return run.filter(before * sample < max_rows).drop("_upto")


def adjusted_sample(sample: float, min_rows: int | None, rows: int) -> float:
    """``sample`` raised so that ``min_rows`` come out, as far as there are that many."""
    return max(sample, min((min_rows or 0) / rows, 1.0)) if rows else 1.0


def sample_files(
    manifest: DataFrame, fraction: float, rows: int, files: int, seed: int = 0, uniform: Column | None = None
) -> DataFrame:
    """Whole files by chance where there are many rows and files; else all of them."""
    if fraction < 1 and rows >= BIG_ROWS and files >= BIG_FILES:
        return manifest.filter((uniform_of(F.col("path"), seed=seed) if uniform is None else uniform) < fraction)
    return manifest


def exact_sample(rows: DataFrame, group: list[str], order: Column, fraction: float) -> DataFrame:
    """round(fraction * n) rows of every group without replacement, those first in ``order``
    (halves round to even). No group is sorted in one task."""
    return first_of_groups(rows, group, order, F.bround(F.col("_n") * fraction))


def sample_context(context: Column, keep: float, uniform: Column) -> Column:
    """The context, or by chance (where ``uniform`` isn't below ``keep``) null."""
    return F.when(uniform < keep, context)


def is_test(key: Column, share: float = 0.3) -> Column:
    """Reproducible split: the key's md5 falls into the test share."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") < int(share * (1 << 32))
