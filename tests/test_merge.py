import random

import pytest
from pyspark.sql import functions as F

from rewardmill.operators import merge

SCHEMA = "decision_id string, item string, context string, count double, sample string, rewards string, reward double, _seq long"
V, S = '{"$value":0}', '{"$value":4}'


def merged(spark, rows):
    df = spark.createDataFrame([("D", *r, None, k) for k, r in enumerate(rows)], SCHEMA)
    return [tuple(r) for r in merge.merge(df).collect()]


CASES = {
    "complementary": ([(V, None, 50.0, None, None), (V, "{}", None, S, None), (None,) * 4 + ('{"r1":100}',), (None,) * 4 + ('{"r2":100}',)],
                      (V, "{}", 50.0, S, '{"r1":100,"r2":100}', 200.0)),
    "no rewards": ([(V, None, 50.0, None, None), (V, "{}", None, S, None)], (V, "{}", 50.0, S, "{}", 0.0)),
    "only rewards": ([(None,) * 4 + ('{"r1":100}',), (None,) * 4 + ('{"r2":100}',)], (None, None, None, None, '{"r1":100,"r2":100}', 200.0)),
    "all null": ([(None,) * 5, (None,) * 5], (None, None, None, None, "{}", 0.0)),
    "null and empty": ([(V, "{}", 50.0, S, None), (None,) * 4 + ("{}",)], (V, "{}", 50.0, S, "{}", 0.0)),
    "merged before": ([(V, "{}", 50.0, S, '{"r3":1,"r1":100}'), (None,) * 4 + ('{"r2":0.5}',)], (V, "{}", 50.0, S, '{"r1":100,"r2":0.5,"r3":1}', 101.5)),
    "one message five times": ([(None,) * 4 + ('{"r":3}',)] * 5, (None, None, None, None, '{"r":3}', 3.0)),
    "last write wins": ([(None,) * 4 + ('{"r":3}',), (None,) * 4 + ('{"r":-7}',)], (None, None, None, None, '{"r":-7}', -7.0)),
    "true counts": ([(None,) * 4 + ('{"r":true}',)], (None, None, None, None, '{"r":true}', 1.0)),
}


@pytest.mark.parametrize("case", CASES)
def test_merge_cases(spark, case):
    rows, expected = CASES[case]
    assert merged(spark, rows) == [("D", *expected)]


def test_merge_is_idempotent_and_order_free(spark):
    rng = random.Random(4)
    rows = [(f"d{rng.randrange(6)}", None, None, None, None, f'{{"m{k}":{rng.randrange(9)}}}', None, k) for k in range(60)]
    rows += [(f"d{k}", f'"i{k}"', "{}", 2.0, None, None, None, 100 + k) for k in range(6)]
    once = sorted(map(tuple, merge.merge(spark.createDataFrame(rows, SCHEMA)).collect()))
    again = merge.merge_files(merge.merge(spark.createDataFrame(rows, SCHEMA)), spark.createDataFrame(rows, SCHEMA), ["decision_id"])
    assert sorted(map(tuple, again.collect())) == once
    late = rows[:]
    rng.shuffle(late)
    late = [(*r[:-1], k) for k, r in enumerate(late)]
    assert sorted(map(tuple, merge.merge(spark.createDataFrame(late, SCHEMA)).collect())) == once


def test_group_slices(spark):
    rows = spark.createDataFrame([(c,) for c in "ABCDEXXYZ"], "decision_id string")
    got = [tuple(r) for r in merge.group_slices(rows).orderBy("start").collect()]
    assert got == [("A", 0, 1), ("B", 1, 2), ("C", 2, 3), ("D", 3, 4), ("E", 4, 5), ("X", 5, 7), ("Y", 7, 8), ("Z", 8, 9)]


def test_hot_decision_keeps_all_rewards(spark):
    rows = spark.range(5_000).select(
        F.lit("D").alias("decision_id"), *(F.lit(None).cast(t).alias(c) for c, t in (("item", "string"), ("context", "string"), ("count", "double"), ("sample", "string"))),
        F.concat(F.lit('{"'), F.col("id").cast("string"), F.lit('":1}')).alias("rewards"), F.col("id").alias("_seq"),
    )
    assert merge.merge(rows).first()["reward"] == 5_000.0
