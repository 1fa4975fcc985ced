"""Compaction loop: merge overlapping and small partitions until none is left to merge."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardmill import schemas
from rewardmill.config import LayoutConfig
from rewardmill.operators import layout, merge
from rewardmill.sources import partitions
from rewardmill.streaming.ingest import chunked


@dataclass
class Turn:
    """What one turn did: groups merged, and why others were not."""

    merged: int = 0
    failed: dict[tuple[str, int], str] = field(default_factory=dict)


def plan_groups(spark: SparkSession, root: str, config: LayoutConfig) -> dict[tuple[str, int], list[str]]:
    """(model, group) to the paths to merge, planned from the listing: no row is read."""
    groups = layout.groom_groups(partitions.manifest(spark, root), config)
    if config.max_key_bytes is not None:
        groups = layout.cap_keys(groups, config)
    return {(r["model"], r["group_no"]): list(r["paths"]) for r in groups.collect()}


def merge_groups(spark: SparkSession, root: str, groups: dict[tuple[str, int], list[str]], config: LayoutConfig) -> None:
    """Merge groups in a single job keyed by group, reading their files only; inputs are
    deleted after the outputs are written."""
    member = [(m, g, p.rpartition("/")[2]) for (m, g), paths in groups.items() for p in paths]
    paths = [p for some in groups.values() for p in some]
    rows = partitions.with_facts(partitions.read_files(spark, paths), spark.createDataFrame(member, "model string, group_no int, _file string"))
    merged = merge.merge(rows.withColumn("_seq", F.struct("_file", "_row")), ["model", "group_no", "decision_id"])
    cut, chunk = chunked(merged, ["model", "group_no"], config.max_rows)
    partitions.replace_files(spark, cut.select("model", *schemas.COLUMNS, chunk.alias("_c")), root, paths, F.col("_c"))


def compact_once(spark: SparkSession, root: str, config: LayoutConfig, now: Column | float) -> Turn:
    """One turn over all groups. A group that fails doesn't stop the others: unsound files
    are moved aside and their groups wait for the next turn; if the common job fails, groups
    are merged one by one and those that fail again stay as they were."""
    groups, turn = plan_groups(spark, root, config), Turn()
    if not groups:
        return turn
    try:
        bad = {p.rpartition("/")[2]: p for p in partitions.unsound_files(spark, [p for g in groups.values() for p in g], now)}
    except Exception as error:  # noqa: BLE001 - an unreadable file is found again, group by group
        print(f"compaction looks at groups one by one: {str(error).splitlines()[0]}")
        bad = {}
    for key in [k for k, paths in groups.items() if any(p.rpartition("/")[2] in bad for p in paths)]:
        groups.pop(key)
        turn.failed[key] = "unsound file"
    partitions.quarantine(spark, root, list(bad.values()))
    if not groups:
        return turn
    try:
        merge_groups(spark, root, groups, config)
        turn.merged = len(groups)
    except Exception:  # noqa: BLE001 - whatever it was, it concerns some group
        for key, paths in groups.items():
            try:
                merge_groups(spark, root, {key: paths}, config)
                turn.merged += 1
            except Exception as error:  # noqa: BLE001
                turn.failed[key] = str(error).splitlines()[0]
    return turn


def compact(spark: SparkSession, root: str, config: LayoutConfig = LayoutConfig(), now: Column | float | None = None) -> list[Turn]:
    """Repeat until a turn neither merges nor moves anything, at most ``max_groom_iterations``
    times; returns the turns. Overlaps that remain then are for the next run."""
    now = F.unix_timestamp() if now is None else now
    turns = []
    for _ in range(config.max_groom_iterations):
        turn = compact_once(spark, root, config, now)
        if not turn.merged and "unsound file" not in turn.failed.values():
            break
        turns.append(turn)
    return turns


def overlapping(spark: SparkSession, root: str) -> DataFrame:
    """Files that still overlap their neighbour in time."""
    return layout.overlaps(partitions.manifest(spark, root), ["model"])
