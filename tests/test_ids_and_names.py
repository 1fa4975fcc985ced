from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rewardmill import config
from rewardmill.functions import ksuid, names


def test_ksuid_times(spark):
    known = {
        "29YkUXjeHeDd6K0HcRJrLZhocG0": 1653297422, "29ZHOrIOV9DyvVuJziDWj1c3zMU": 1653313658,
        "1zznFKB3tggXeA08k9lNQJBM3CU": 1635159678, "0" * 27: 1400000000, "aWgEPTl1tmebfsQzFP4bxwgy80V": 5694967295,
        "z" * 27: None, "short": None, "": None, None: None,
    }
    rows = spark.createDataFrame([(k,) for k in known], "k string").select("k", ksuid.seconds(F.col("k")).alias("s")).collect()
    assert {r["k"]: r["s"] for r in rows} == known


def test_ksuid_validity_uses_the_given_now(spark):
    row = spark.createDataFrame([("29YkUXjeHeDd6K0HcRJrLZhocG0",)], "k string").select(
        ksuid.is_valid(F.col("k"), F.lit(1653297422)).alias("now"), ksuid.is_valid(F.col("k"), F.lit(1653297421)).alias("before")
    ).first()
    assert row["now"] and not row["before"]


def test_lower_bound_starts_its_second(spark):
    bound = ksuid.lower_bound(1653297422)
    assert bound <= "29YkUXjeHeDd6K0HcRJrLZhocG0"
    assert spark.range(1).select(ksuid.seconds(F.lit(bound))).first()[0] == 1653297422


def test_model_names(spark):
    good, bad = ["messages-2.0", "appconfig", "a" * 64], ["!", "a" * 65, "-", "", " ", None, "a\n"]
    rows = spark.createDataFrame([(n,) for n in good + bad], "n string").select("n", names.is_model_name(F.col("n")).alias("ok")).collect()
    assert [r["n"] for r in rows if r["ok"]] == good


def test_partition_keys_and_file_facts(spark):
    name = "20220102T030405Z-20220101T030405Z-17-" + "x" * 36 + ".parquet"
    key = f"rewarded_decisions/m/parquet/2022/01/02/{name}"
    rows = spark.createDataFrame([(key,), (key.replace("2022/01", "22/1"),), ("other",)], "k string")
    facts = names.file_facts(F.col("k"))
    got = rows.select(names.is_partition_key(F.col("k")).alias("ok"), *(c.alias(n) for n, c in facts.items())).collect()
    assert [r["ok"] for r in got] == [True, False, False]
    assert (got[0]["max_ts"], got[0]["min_ts"], got[0]["row_count"]) == ("20220102T030405Z", "20220101T030405Z", 17)
    assert got[2]["row_count"] is None


def test_durations_and_flags():
    assert names.parse_duration("24 hours") == timedelta(hours=24)
    assert names.parse_duration(" 1.5 \n day ") == timedelta(days=1.5)
    for bad in ("24", "24 weeks", "x hours", "1 hourss"):
        with pytest.raises(ValueError):
            names.parse_duration(bad)
    assert names.parse_flag("Yes") and names.parse_flag("1") and not names.parse_flag("no")


def test_runtimes_and_volumes():
    assert names.parse_runtime("2  hours") == 7200 and names.parse_runtime("90 Seconds") == 90 and names.parse_volume("10 GB") == 10
    for bad in ("", None, "2", "0 hours", "-1 days", "1 weeks", "1.5 hours"):
        with pytest.raises(ValueError):
            names.parse_runtime(bad)
    for bad in ("10 MB", "1.5 GB", "0 GB", "10"):
        with pytest.raises(ValueError):
            names.parse_volume(bad)


def test_every_model_has_its_own_settings():
    common = {"schedule": "rate(4 hours)", "max_runtime": "2 hours", "volume_size": "10 GB", "hyperparameters": {"max_trees": 150, "max_decision_records": 8_000_000}}
    tree = {"organization": "org", "project": "p1", "training": common, "models": {"a": None, "b-1": {"training": {"max_runtime": "1 days", "hyperparameters": {"max_trees": "9", "explore": "no"}}}}}
    a, b = config.jobs(tree)
    assert (a.model, a.schedule, a.runtime_seconds, a.volume_gb, a.train.max_trees, a.limits) == ("a", "rate(4 hours)", 7200, 10, 150, {"max_decision_records": 8_000_000})
    assert (b.runtime_seconds, b.train.max_trees, b.train.explore, b.limits) == (86_400, 9, False, a.limits)
    for change in ({"organization": "Org"}, {"project": None}, {"models": []} | {"models": [1]}, {"models": {"!": None}}, {"models": {"a": [1]}}):
        with pytest.raises(ValueError):
            config.jobs(tree | change)


def test_job_names_fit():
    now = datetime(2020, 1, 2, 3, 4, 5)
    assert names.job_name(["svc", "dev", "m_1"], now) == "svc-dev-m-1-20200102030405"
    for service in ("s", "s" * 70):
        long = names.job_name([service, "stage" * 9, "model" * 12], now)
        assert len(long) <= 63 and long.endswith("20200102030405")
