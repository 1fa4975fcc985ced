import math
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rewardmill.config import TrainConfig
from rewardmill.functions import arithmetic, hashing, json
from rewardmill.operators import bandit, models, scan, strings, training


def test_budget_includes_the_crossing_file(spark):
    files = spark.createDataFrame([(f"p{k}", 100) for k in range(3)], "path string, row_count long")
    got = [r["path"] for r in scan.budget_files(files, sample=0.5, max_rows=100).orderBy("path").collect()]
    assert got == ["p1", "p2"]


def test_sampled_rows(spark):
    rows = spark.range(300).select((F.col("id") % 3).alias("file"), "id")
    for low, sample, expected in ((250, 1.0, 300), (250, 0.67, 249), (250, 0.9, 270)):
        share = scan.adjusted_sample(sample, low, 300)
        assert scan.exact_sample(rows, ["file"], F.md5(F.col("id").cast("string")), share).count() == expected
    assert scan.adjusted_sample(0.5, None, 0) == 1.0


def test_samples_and_quantiles_of_one_large_group(spark):
    rows = spark.range(2_000).select(F.lit(None).cast("string").alias("g"), (F.col("id") * 7919 % 2_003).alias("id"), F.lit("wide").alias("x"))
    got = scan.exact_sample(rows, ["g"], F.col("id"), 0.25)
    assert got.columns == rows.columns and sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in rows.collect())[:500]
    two = rows.withColumn("h", F.col("id") % 2).withColumn("v", F.when(F.col("id") % 5 > 0, F.col("id").cast("double")))
    expected = {(r["h"], r["p"]) for r in two.groupBy("h").agg(F.percentile("v", 0.3).alias("p")).collect()}
    from rewardmill.operators.running import quantiles

    assert {(r["h"], r["p"]) for r in quantiles(two, "v", ["h"], {"p": 0.3}).collect()} == expected
    whole = training.describe(two, "v").first()
    assert (whole["n"], whole["p50"]) == tuple(two.agg(F.count("v"), F.percentile("v", 0.5)).first())


def test_dense_keeps_rows_without_features(spark):
    long = spark.createDataFrame([(1, "a", 2.0), (2, "z", 1.0)], "id int, feature string, num double")
    rows = {r["id"]: r["features"] for r in training.dense(long, ["id"], ["b", "a"]).collect()}
    assert rows[1][0] == 2.0 and math.isnan(rows[1][1]) and all(map(math.isnan, rows[2]))
    base = spark.createDataFrame([(1,), (3,)], "id int")
    assert {r["id"] for r in training.dense(long, ["id"], ["a"], base).collect()} == {1, 3}


def test_decisions_of_nothing_still_train(spark):
    rows = spark.createDataFrame([("d1", "{}", "null", 0.5, 1.0), ("d2", "[]", "{}", 0.5, 0.0)], "decision_id string, item string, context string, propensity double, reward double")
    half = {"boot": F.lit(0.5), "context": F.lit(0.99)}
    got = training.decision_rows(rows, 0.5, 0.5, 2.0, half, TrainConfig()).orderBy("decision_id").collect()
    assert [(r["y"], r["w"], r["context"]) for r in got] == [(1.0, 1.0, None), (-1.0, 1.0, None)]


def test_tables_of_metadata(spark):
    found = models.metadata("m", ["a", "b"], {"a": [5, 1]}, 1, datetime(2022, 1, 1), "1")
    assert strings.tables_of(spark, found).first()["mask"] == 7
    with pytest.raises(ValueError, match="unknown"):
        strings.tables_of(spark, {"feature_names": ["b"], "string_tables": {"a": [1]}})


def test_train_filter_needs_a_column(spark):
    with pytest.raises(ValueError):
        scan.train_filter(spark.range(1), ["reward"])


def test_bootstrap_weights_have_the_right_mean(spark):
    w = arithmetic.bootstrap_weight(arithmetic.uniform_of(F.col("id"), seed=3))
    row = spark.range(100_000).select(w.alias("w")).agg(F.avg("w"), F.min("w")).first()
    assert abs(row[0] - 1 / (1 - 1 / math.e)) < 0.02 and row[1] == 1.0


ID = "29YkUXjeHeDd6K0HcRJrLZhocG0"
EXPANSIONS = {
    "full": ({"item": '{"$value":0.0}', "context": '{"k0":0.0,"k1":"1.0"}', "sample": '{"$value":4.0}', "count": 5.0},
             [{"item.$value": 0.0, "context.k0": 0.0, "context.k1": "1.0", "y": 1.0, "w": 1.0}, {"item.$value": 4.0, "context.k0": 0.0, "context.k1": "1.0", "y": 0.0, "w": 4.0}]),
    "null sample": ({"item": "1", "context": '{"a":true}', "sample": "null", "count": 4.0},
                    [{"item": 1.0, "context.a": 1.0, "y": 1.0, "w": 1.0}, {"context.a": 1.0, "y": 0.0, "w": 3.0}]),
    "one item": ({"item": '{"$value":{"k0":0,"k1":[1,"x",null]}}', "context": "{}", "sample": None, "count": 1.0},
                 [{"item.$value.k0": 0.0, "item.$value.k1.0": 1.0, "item.$value.k1.1": "x", "y": 1.0, "w": 1.0}]),
}


@pytest.mark.parametrize("case", EXPANSIONS)
def test_training_rows(spark, case):
    given_, expected = EXPANSIONS[case]
    df = spark.createDataFrame([(ID, given_["item"], given_["context"], given_["count"], given_["sample"])], "decision_id string, item string, context string, count double, sample string")
    long = training.features(training.checked(training.expand(df))).collect()
    got = {}
    for r in long:
        assert r["t"] == 1653297422
        got.setdefault(r["y"], {"y": r["y"], "w": r["w"]})[r["feature"]] = r["str"] if r["num"] is None else r["num"]
    assert [got[y] for y in sorted(got, reverse=True)] == expected


def test_negative_time_fails(spark):
    df = spark.createDataFrame([(-1, 1.0)], "t long, w double")
    with pytest.raises(Exception, match="negative"):
        training.checked(df).collect()


def test_select_features(spark):
    long = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("c", 9.0), ("w", 99.0)], "feature string, w double")
    assert [r["feature"] for r in training.select_features(long, 2).collect()] == ["c", "a"]


@pytest.mark.parametrize("n, expected", [(1, [1.0]), (3, [1.0, 0.0, -1.0]), (5, [1, 0.5, 0, -0.5, -1])])
def test_codes(spark, n, expected):
    got = spark.range(n).select(arithmetic.code_value(F.col("id"), F.lit(n)).alias("c")).collect()
    assert [r["c"] for r in got] == expected


def test_weights(spark):
    row = spark.range(1).select(
        arithmetic.inverse_propensity(F.lit(0.5), 4.0), arithmetic.inverse_propensity(F.lit(0.00005), 4.0),
        arithmetic.standardised(F.lit(1.0), F.lit(1.0), F.lit(0.0)), arithmetic.standardised(F.lit(2.0), F.lit(1.0), F.lit(None).cast("double")),
        arithmetic.smoothed_mean(F.lit(40.0), F.lit(20.0), F.lit(40), 0.0, 300), arithmetic.sprinkle(F.lit(7.0), F.lit(0.0)),
    ).first()
    assert tuple(row) == (0.5, 2500.0, 0.0, 1.0, 20 / 340, 7.0)


def test_masks(spark):
    bits = {n: spark.range(1).select(hashing.mask_of(F.lit(n))).first()[0] for n in (1, 62, 63)}
    assert bits == {1: 3, 62: (1 << 63) - 1, 63: -1}
    for hashes, expected in (([5], 1), ([1, 5], 2), ([0, 4, 8], 3), ([7, 7], 63)):
        assert spark.createDataFrame([(hashes,)], "h array<long>").select(hashing.least_bits(F.col("h"))).first()[0] == expected
    top = spark.createDataFrame([(0,), (9,), (-5,), (None,)], "v long").select(hashing.mask_of_largest(F.col("v"))).collect()
    assert [r[0] for r in top] == [0, 15, -1, 0]


def test_string_encoding(spark):
    import xxhash

    rows = [("f", "a", 1.0, 1.0)] * 30 + [("f", "b", 0.0, 1.0)] * 25 + [("f", "c", 0.0, 1.0)] * 20
    long = spark.createDataFrame(rows, "feature string, str string, y double, w double").withColumn("num", F.lit(None).cast("double"))
    ranked = strings.ranked_strings(strings.string_stats(long), 0.0, 300)
    assert [(r["str"], r["pos"]) for r in ranked.orderBy("pos").collect()] == [("a", 0), ("b", 1)]  # 20 are too few
    tabs = strings.tables(ranked, 7)
    mask = tabs.first()["mask"]
    got = {r["str"]: r["num"] for r in strings.encode(long, tabs, 7).select("str", "num").distinct().collect()}
    assert (got["a"], got["b"]) == (1.0, -1.0)
    h = xxhash.xxh3_64_intdigest("c", seed=7)
    hits = {xxhash.xxh3_64_intdigest(s, seed=7) & mask: v for s, v in (("a", 1.0), ("b", -1.0))}
    assert got["c"] == hits.get(h & mask, ((h & 0xFFFFFFFF) * 2.0**-32) * 2.0 - 1.0)


@settings(max_examples=6, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text("ab", max_size=3), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text("xyz", min_size=1, max_size=2), x, max_size=3), max_leaves=8))
def test_flatten_agrees_with_a_walk(spark, value):
    import json as j

    def walk(v, path):
        if isinstance(v, dict):
            for k, x in v.items():
                yield from walk(x, f"{path}.{k}")
        elif isinstance(v, list):
            for k, x in enumerate(v):
                yield from walk(x, f"{path}.{k}")
        elif v is not None:
            yield path, v if isinstance(v, str) else float(v)

    df = spark.createDataFrame([(1, j.dumps(value))], "id int, item string")
    got = {r["feature"]: r["str"] if r["num"] is None else r["num"] for r in json.flatten(df, {"item": "item"}, ["id"], 6).collect()}
    assert got == dict(walk(value, "item"))


def test_flatten_has_no_deepest_level(spark):
    deep = lambda n, leaf: '{"a":' * n + leaf + "}" * n
    df = spark.createDataFrame([(1, deep(15, "7")), (2, deep(5, '["x"]')), (3, "[[]]")], "id long, item string")
    want = [(1, "item" + ".a" * 15, 7.0, None), (2, "item" + ".a" * 5 + ".0", None, "x")]
    for depth in (2, 12):
        assert sorted(map(tuple, json.flatten(df, {"item": "item"}, ["id"], depth).collect())) == want


def test_models_learn_and_load(spark, tmp_path):
    rows = spark.range(400).select(
        F.col("id").alias("decision_id"), (F.col("id") % 2).cast("double").alias("y"), F.lit(1.0).alias("w"),
        F.array((F.col("id") % 2).cast("float"), F.when(F.col("id") % 3 == 0, float("nan")).otherwise(1.0).cast("float")).alias("features"),
        (F.col("id") % 10 < 3).alias("is_test"),
    )
    config, now = TrainConfig(tree_depth=2, max_checkpoint_age="1 hour"), datetime(2022, 1, 1)
    model = models.fit_propensity(rows, config, trees=2)
    means = {r["y"]: r["p"] for r in models.propensity(model, rows).groupBy("y").agg(F.avg("propensity").alias("p")).collect()}
    assert means[1.0] > 0.7 > 0.3 > means[0.0]
    found = models.metadata("m", ["a", "b"], {"a": [1]}, 7, now, config.version, 2)
    models.save(spark, model, found, str(tmp_path / "m"))
    assert models.load_if_fresh(spark, str(tmp_path / "m"), config, now)[1] == found
    assert models.load_if_fresh(spark, str(tmp_path / "m"), config, datetime(2022, 1, 2)) is None
    assert models.load_if_fresh(spark, str(tmp_path / "m"), TrainConfig(version="2"), now) is None
    assert models.load_if_fresh(spark, str(tmp_path / "none"), config, now) is None


def test_a_fit_takes_no_more_tasks_than_its_values_need(spark, monkeypatch):
    monkeypatch.setattr(models.GBTRegressor, "fit", lambda self, rows: rows)
    rows = spark.range(100, numPartitions=20).select("id", F.array(F.col("id").cast("float")).alias("features"))
    one = models.fit_decision(rows, TrainConfig())
    assert one.rdd.getNumPartitions() == 1 and one.count() == 100
    monkeypatch.setattr(models, "VALUES_PER_TASK", 40)  # 100 rows of a value and a flag
    assert models.fit_decision(rows, TrainConfig()).rdd.getNumPartitions() == 5
    assert models.fit_decision(rows.filter("id < 0"), TrainConfig()).rdd.getNumPartitions() == 1


def test_published_models_replace_the_latest(spark, tmp_path):
    rows = spark.range(60).select((F.col("id") % 2).cast("double").alias("y"), F.lit(1.0).alias("w"), F.array((F.col("id") % 2).cast("float")).alias("features"), (F.col("id") % 10 < 3).alias("is_test"))
    model = models.fit_propensity(rows, TrainConfig(tree_depth=1), trees=1)
    home = str(tmp_path)
    for version in ("1", "2"):
        models.save(spark, model, models.metadata("m", ["a"], {}, 7, datetime(2022, 1, 1), version), f"{home}/saved")
        archive, latest = models.publish(spark, f"{home}/saved", home, "m", datetime(2022, 1, 2, 3, 4, 5))
        config = TrainConfig(version=version, max_checkpoint_age="1 day")
        assert models.load_if_fresh(spark, latest, config, datetime(2022, 1, 1)) is not None is not models.load_if_fresh(spark, archive, config, datetime(2022, 1, 1))
    assert archive.startswith(f"{home}/models/archive/m/m-2022-01-02-03-04-05-") and latest == f"{home}/models/latest/m"
    line = training.described(training.describe(rows, "y").first())
    assert line == "count: 60, mean: 0.5, std: 0.504219, min: 0, 25%: 0, 50%: 0.5, 75%: 1, max: 1"


def test_epoch_learner_learns(spark):
    env = bandit.environment(spark, "match", 300, 4)
    rows = bandit.run_epochs(env, 300, replicas=8).groupBy("epoch").agg(F.avg("reward").alias("m"), F.count("*").alias("n")).orderBy("epoch").collect()
    assert [r["n"] for r in rows] == [16, 32, 64, 128, 60] and rows[-1]["m"] > 0.6 > rows[0]["m"]


def test_metadata_faults():
    good = models.metadata("m", ["a"], {}, 1, datetime(2022, 1, 1), "1")
    for key in ("model_name", "model_seed", "created_at", "version", "string_tables"):
        with pytest.raises(ValueError):
            models.check_metadata({k: v for k, v in good.items() if k != key})
    for change in ({"feature_names": []}, {"string_tables": {"z": [1]}}, {"created_at": "yesterday"}):
        with pytest.raises(ValueError):
            models.check_metadata(good | change)


def test_environments(spark):
    for kind in ("weekday", "weekday_text", "match", "shuffled_match", "feature_match", "pairs", "feature_pairs"):
        rows = bandit.environment(spark, kind, 50, 5).collect()
        per = {"weekday": 3, "weekday_text": 3, "pairs": 2, "feature_pairs": 2}.get(kind, 5)
        assert len(rows) == 50 * per and all(0 <= r["reward"] <= 1 for r in rows)
        if "match" in kind:
            assert sum(r["reward"] for r in rows) == 50
        if "pairs" in kind:
            assert len({(r["interaction"], r["action"]) for r in rows}) == 100
    assert bandit.learning_epochs(120) == [16, 48, 112]


def test_thompson_prefers_the_better_arm(spark):
    rows = spark.range(2_000).select(F.when(F.col("id") % 2 == 0, "good").otherwise("bad").alias("arm"), F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.2).alias("r"), "id")
    sums = bandit.bootstrap(rows, "arm", "r", F.col("id"), lambda s, k: arithmetic.uniform_of(s, k, seed=1), 4)
    assert all(bandit.best_action(sums, "arm", k).first()["action"] == "good" for k in range(4))


def test_both_training_phases(spark, tmp_path):
    from rewardmill.functions import ksuid
    from rewardmill.plans import training as plan

    rows = [(ksuid.lower_bound(1_650_000_000 + k), '{"v":"%s"}' % "ab"[k % 2], '{"c":%d}' % (k % 3), 2.0, '{"v":"%s"}' % "ba"[k % 2], "{}", float(k % 2)) for k in range(120)]
    decisions = spark.createDataFrame(rows, "decision_id string, item string, context string, count double, sample string, rewards string, reward double")
    config = TrainConfig(tree_depth=2, max_checkpoint_age="1 day", max_json_depth=2)
    found = plan.train(spark, decisions, "m", str(tmp_path), config, datetime(2022, 1, 1), trees=2)
    assert set(found["feature_names"]) == {"item.v", "context.c"} and len(found["string_tables"]["item.v"]) == 2
    again = plan.train(spark, decisions, "m", str(tmp_path), config, datetime(2022, 1, 1, 1), trees=2)
    assert again["feature_names"] == found["feature_names"]
