import json

import pytest
from pyspark.sql import functions as F

from rewardmill.config import LayoutConfig
from rewardmill.functions import ksuid
from rewardmill.operators import layout, records
from rewardmill.plans import compaction
from rewardmill.sources import partitions, tracks
from rewardmill.streaming import ingest

ID = "0" * 27
GOOD = {"message_id": ID, "model": "test-model-name-1.0", "item": {"text": "v"}, "context": {"a": 1}, "count": 3, "sample": {"text": "s"}}
REWARD = {"message_id": "0" * 26 + "1", "model": "test-model-name-1.0", "decision_id": ID, "reward": -10}
VERDICTS = [
    (GOOD, None), (REWARD, None), (GOOD | {"message_id": "x"}, "invalid message_id"), (GOOD | {"message_id": 5}, "invalid message_id"),
    (GOOD | {"model": "!"}, "invalid model"), (GOOD | {"count": 0}, "invalid count"), (GOOD | {"count": 1.0}, "invalid count"),
    (GOOD | {"count": "3"}, "invalid count"), (GOOD | {"count": 1}, "sample beside a count of 1"), (GOOD | {"count": True}, "sample beside a count of 1"),
    (REWARD | {"decision_id": "?"}, "invalid decision_id"), (REWARD | {"reward": "1"}, "invalid reward"), (REWARD | {"reward": True}, None),
    ({k: v for k, v in REWARD.items() if k != "reward"}, "invalid reward"), (GOOD | {"extra": [1]}, None), ([1], "not an object"),
]


def lines(spark, values):
    return spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v), k) for k, v in enumerate(values)], "value string, _seq long")


def test_validation(spark):
    parsed = records.parse(lines(spark, [v for v, _ in VERDICTS] + ["{broken", ""]), F.lit(1.7e9))
    got = [r["reject_reason"] for r in parsed.orderBy("_seq").collect()]
    assert got == [reason for _, reason in VERDICTS] + ["not an object", "not an object"]
    assert records.rejects(parsed).count() == sum(r is not None for r in got)


def test_three_states_of_null(spark):
    bare = {"message_id": ID, "model": "m", "count": 2}
    parsed = records.parse(lines(spark, [bare, bare | {"sample": None, "item": None}, REWARD]), F.lit(1.7e9))
    rows = records.to_rewarded_decisions(parsed).orderBy("_seq").collect()
    assert (rows[0]["item"], rows[0]["context"], rows[0]["sample"]) == ("null", "null", None)
    assert (rows[1]["item"], rows[1]["sample"]) == ("null", "null")
    assert (rows[2]["message_id"], rows[2]["value"]) == (REWARD["message_id"], "-10")
    assert (rows[2]["item"], rows[2]["rewards"], rows[2]["decision_id"]) == (None, '{"%s":-10}' % REWARD["message_id"], ID)


def test_tracked_ids_and_bounded_batches(spark, tmp_path):
    ids = spark.createDataFrame([(ID,), ("x" * 27,), ("x" * 26,), ("-" * 27,), (None,)], "i string")
    assert [r[0] for r in ids.select(tracks.valid_message_id(F.col("i"))).collect()] == [True, True, False, False, False]
    for k in range(3):
        (tmp_path / f"{k}.txt").write_text(json.dumps(GOOD) * 2)
    seen = []
    lines_ = tracks.stream_lines(spark, str(tmp_path / "*.txt"), bytes_per_trigger=300)
    lines_.writeStream.foreachBatch(lambda df, n: seen.append(df.count())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sum(seen) == 3 and len(seen) > 1


def manifest(spark, rows):
    return spark.createDataFrame([("m", f"p{k:03}", lo, hi, n) for k, (lo, hi, n) in enumerate(rows)], "model string, path string, min_ts string, max_ts string, row_count long")


def test_groom_groups(spark):
    rows = [("01", "02", 4), ("03", "04", 4), ("05", "06", 4), ("06", "09", 12), ("10", "11", 1)]
    got = layout.groom_groups(manifest(spark, rows), LayoutConfig(max_rows=10)).orderBy("group_no").collect()
    assert [r["paths"] for r in got] == [["p000", "p001"], ["p002", "p003"]]


def test_groups_merge_in_pairs_not_chains(spark):
    rows = [("01", "03", 10), ("03", "05", 10), ("05", "07", 10)]
    got = layout.groom_groups(manifest(spark, rows), LayoutConfig(max_rows=10)).collect()
    assert [r["paths"] for r in got] == [["p000", "p001"]]


def test_cap_keys(spark):
    rows = [(f"{k:02}", f"{k:02}", 1) for k in range(6)]
    groups = layout.groom_groups(manifest(spark, rows), LayoutConfig(max_rows=3))
    got = layout.cap_keys(groups, LayoutConfig(max_key_bytes=4 * 4)).collect()
    assert [r["paths"] for r in got] == [["p000", "p001", "p002"]]


def test_overlaps(spark):
    assert layout.overlaps(manifest(spark, [("01", "02", 1), ("03", "04", 1)]), ["model"]).isEmpty()
    assert layout.overlaps(manifest(spark, [("01", "03", 1), ("03", "04", 1)]), ["model"]).count() == 1


def test_split_levels(spark):
    def level(*parts):
        rows = [(t,) for t, n in parts for _ in range(n)]
        return layout.split_levels(spark.createDataFrame(rows, "t string").withColumn("k", F.lit(1)), ["k"], F.col("t"), 100).first()["level"]

    assert level(("20220101T000000Z", 100)) == 0
    assert level(("20220101T000000Z", 60), ("20220201T000000Z", 41)) == 6
    assert level(("20220101T000000Z", 60), ("20220102T000000Z", 60)) == 8
    assert level(("20220101T000000Z", 101)) == 15


def test_stream_equals_batch_and_late_rewards_join(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "table")
    source.mkdir()
    now = F.lit(1.7e9)
    for name, values in (("a", [GOOD]), ("b", [REWARD, "bad"]), ("c", [REWARD])):
        (source / f"{name}.json").write_text("\n".join(v if isinstance(v, str) else json.dumps(v) for v in values))
        stream = tracks.stream_lines(spark, str(source))
        ingest.ingest(stream, table, str(tmp_path / "checkpoint"), now).awaitTermination()
    rows = ingest.read_table(spark, table).collect()
    assert len(rows) == 1 and rows[0]["reward"] == -10.0 and rows[0]["item"] == '{"text":"v"}'
    assert spark.read.parquet(f"{table}/rejects").count() == 1


SCHEMA = "model string, decision_id string, item string, context string, count double, sample string, rewards string, reward double"
START, FUTURE = 1_650_000_000, 2_000_000


def write_part(spark, table, name, ids, model="m", item=None, tag=""):
    rows = [(model, ksuid.lower_bound(START + 60 * k) if isinstance(k, int) else k, item, "{}", 2.0, None, f'{{"{name}":1}}', None) for k in ids]
    return partitions.write_partitions(spark.createDataFrame(rows, SCHEMA), table, F.lit(name), tag)


def test_files_say_what_they_hold(spark, tmp_path):
    table = str(tmp_path / "t")
    paths = write_part(spark, table, "a", [0, 5]) + write_part(spark, table, "b", range(3), model="n", tag="x")
    assert write_part(spark, table, "b", range(3), model="n", tag="x") == paths[1:]  # tried again: the same file
    facts = {r["model"]: r for r in partitions.manifest(spark, table).collect()}
    assert len(facts) == 2 and (facts["m"]["row_count"], facts["n"]["row_count"]) == (2, 3)
    assert (facts["m"]["min_ts"], facts["m"]["max_ts"]) == ("20220415T052000Z", "20220415T052500Z")
    assert paths[0].startswith(f"{table}/rewarded_decisions/m/parquet/2022/04/15/20220415T052500Z-20220415T052000Z-2-")
    keys = partitions.list_files(spark, table).select(partitions.key_of(F.col("path")).alias("path"))
    assert partitions.partition_keys(keys, "m").count() == 1 == partitions.list_keys(keys, "rewarded_decisions/n/").count()
    first, second = [r["path"] for r in partitions.list_keys(keys).collect()]
    assert [r["path"] for r in partitions.list_keys(keys, start_after=first).collect()] == [second]
    assert [r["path"] for r in partitions.newest_first(keys).collect()] == [second, first]
    with pytest.raises(TypeError):
        partitions.list_keys(keys, start_after=5)
    assert partitions.manifest(spark, str(tmp_path / "none")).count() == 0


def test_row_counts_and_unreadable_files(spark, tmp_path):
    table = str(tmp_path / "t")
    paths = write_part(spark, table, "a", range(4))
    spark.range(3).selectExpr("string(id) AS decision_id").coalesce(1).write.parquet(f"{table}/other")
    broken = paths[0].replace("-4-", "-9-")
    with open(broken, "w") as f:
        f.write("no parquet")
    files = partitions.list_files(spark, table)
    counts = sorted(r["row_count"] for r in partitions.with_row_counts(spark, files).collect())
    assert counts == [3, 4, 9]
    rows = partitions.read_safely(spark, [paths[0], broken])
    assert rows.count() == 4 and partitions.read_safely(spark, paths, ["decision_id"]).columns == ["decision_id"]
    skipped = partitions.skipped_files(partitions.manifest(spark, table), rows).collect()
    assert [r["path"].rpartition("/")[2] for r in skipped] == [broken.rpartition("/")[2]]


def test_unsound_files_are_moved_aside(spark, tmp_path):
    table = str(tmp_path / "t")
    good, bad = write_part(spark, table, "a", range(4)), write_part(spark, table, "b", [1, FUTURE])
    with pytest.raises(partitions.UnsoundFiles):
        partitions.read_sound(spark, table, good + bad, 1.7e9)
    assert partitions.read_sound(spark, table, good, 1.7e9).count() == 4
    assert partitions.manifest(spark, table).count() == 1 == partitions.list_files(spark, f"{table}/unrecoverable").count()
    assert not partitions.exists(spark, bad[0])


def test_compaction_keeps_rewards(spark, tmp_path):
    table = str(tmp_path / "t")
    for part in range(3):
        write_part(spark, table, f"r{part}", range(20), item='{"a":1}' if part == 0 else None)
    turns = compaction.compact(spark, table, LayoutConfig(max_rows=100), 1.7e9)
    assert [t.merged for t in turns] == [1] and not turns[0].failed
    after = partitions.read_files(spark, [r["path"] for r in partitions.manifest(spark, table).collect()])
    assert after.count() == 20 and after.agg(F.sum("reward")).first()[0] == 60.0
    assert after.filter("item IS NULL").isEmpty() and compaction.overlapping(spark, table).isEmpty()
    assert compaction.compact(spark, table, LayoutConfig(max_rows=100), 1.7e9) == []
    assert ingest.read_table(spark, table).count() == 20


def test_a_failing_group_stops_no_other(spark, tmp_path):
    table = str(tmp_path / "t")
    for model in ("a", "b", "c"):
        for part in range(2):
            write_part(spark, table, f"r{part}", range(5), model=model, item='{"a":1}')
    write_part(spark, table, "r9", [3, FUTURE], model="a")
    broken = next(r["path"] for r in partitions.manifest(spark, table).filter("model = 'b'").collect()).removeprefix("file:")
    with open(broken, "w") as f:
        f.write("no parquet")
    turn = compaction.compact_once(spark, table, LayoutConfig(max_rows=100), 1.7e9)
    assert turn.merged >= 1 and ("b", 0) in turn.failed and partitions.exists(spark, broken)
    rest = compaction.compact(spark, table, LayoutConfig(max_rows=100), 1.7e9)
    left = {r["model"]: r["n"] for r in partitions.manifest(spark, table).groupBy("model").agg(F.count("path").alias("n")).collect()}
    assert left["c"] == 1 and left["b"] == 2 and len(rest) <= 3


def test_models_grooming_follows_time(spark):
    rows = [("05", "06", 4), ("01", "02", 4), ("03", "04", 4)]
    got = layout.groom_groups(manifest(spark, rows), LayoutConfig(max_rows=8)).collect()
    assert [r["paths"] for r in got] == [["p001", "p002"]]


def _joins(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_quarantine_sends_the_listing_to_the_rows(spark):
    from rewardmill.plans.queries import QUERIES

    plan = _joins(QUERIES["quarantine_scan"](spark, "/root/testdata/sf0.001"))
    assert "BuildRight" in plan and "BuildLeft" not in plan and "SortMergeJoin" not in plan


def test_reading_a_table_sends_the_listing_to_the_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    write_part(spark, table, "a", range(4), item='{"a":1}')
    write_part(spark, table, "b", range(4))
    plan = _joins(ingest.read_table(spark, table))
    assert "BuildRight" in plan and "BuildLeft" not in plan and "SortMergeJoin" not in plan


def test_compaction_sends_the_listing_to_the_rows(spark, tmp_path, monkeypatch):
    table, plans, merge = str(tmp_path / "t"), [], compaction.merge.merge
    monkeypatch.setattr(compaction.merge, "merge", lambda rows, *a: plans.append(_joins(rows)) or merge(rows, *a))
    for part in "ab":
        write_part(spark, table, part, range(4), item='{"a":1}')
    compaction.compact(spark, table, LayoutConfig(max_rows=100), 1.7e9)
    assert len(plans) == 1 and "BuildRight" in plans[0] and "BuildLeft" not in plans[0]


def test_compacted_decisions_lie_in_one_file_each_beyond_the_bound(spark, monkeypatch):
    from rewardmill.plans import catalog_files

    few = lambda max_rows: LayoutConfig(max_rows=min(max_rows, 30))
    monkeypatch.setattr(catalog_files, "LayoutConfig", few)  # fewer than a model has: as beyond a million
    got = catalog_files.compact_partitions(spark, "/root/testdata/sf0.001").cache()
    assert got.count() == got.select("model", "decision_id").distinct().count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert [r["files"] for r in got.select("files").distinct().collect()] == [1]
    got.unpersist()
