"""Both training phases end to end: propensities, then decisions weighted by them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardmill.config import TrainConfig
from rewardmill.functions import arithmetic, json
from rewardmill.operators import models, scan, strings, training
from rewardmill.sources.scratch import checkpointed


def string_tables(tabs: DataFrame) -> dict[str, list[int]]:
    """Tables for metadata: at most max_features x max_strings hashes."""
    return {r["feature"]: list(r["hashes"]) for r in tabs.collect()}


def load(spark: SparkSession, manifest: DataFrame, config: TrainConfig, max_rows: int | None, min_rows: int | None) -> DataFrame:
    """Newest files within the budget, sampled exactly, null rewards as 0."""
    share = scan.NON_ZERO_SHARE if config.explore else 1.0
    files = scan.budget_files(manifest, share, max_rows).persist()
    totals = files.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("files")).first()
    sample = scan.adjusted_sample(share, min_rows, totals["rows"])
    chosen = [r["path"] for r in scan.sample_files(files, sample, totals["rows"], totals["files"], config.seed).select("path").collect()]
    files.unpersist()
    if not chosen:
        return spark.createDataFrame([], "decision_id string, item string, context string, count double, sample string, rewards string, reward double")
    from rewardmill.sources.partitions import read_safely

    rows = read_safely(spark, chosen).withColumn("_file", F.col("_metadata.file_path"))
    rows = rows.filter(F.col("item").isNotNull() & F.col("context").isNotNull())
    if sample < 1:
        rows = scan.exact_sample(rows, ["_file"], F.xxhash64(F.lit(config.seed), "decision_id"), sample)
    return rows.drop("_file").withColumn("reward", F.coalesce("reward", F.lit(0.0)))


def _with_time(long: DataFrame, rows: DataFrame) -> DataFrame:
    """The decision's time is a feature of its own, ``t``, also of rows without another."""
    t = rows.select("decision_id", "y", "w", "t").distinct().select(
        "*", F.lit("t").alias("feature"), F.col("t").cast("double").alias("num"), F.lit(None).cast("string").alias("str")
    )
    return long.unionByName(t)


def train_propensity(decisions: DataFrame, config: TrainConfig, trees: int | None = None):
    """(model, feature names, string tables, mean item count) from which item was chosen."""
    mean_count = decisions.agg(F.avg("count")).first()[0] or 1.0
    # tables read several times are written: every flattening level reads the expanded rows
    rows = checkpointed(training.checked(training.expand(decisions)))
    long = checkpointed(_with_time(training.features(rows, config.max_json_depth), rows))
    names = [r["feature"] for r in training.select_features(long, config.max_features).collect()]
    kept = long.filter(F.col("feature").isin(names))
    ranked = strings.ranked_strings(strings.string_stats(kept), 0.0, 0.0, config.prune_min_string_count, config.max_strings_per_feature)
    tabs = checkpointed(strings.tables(ranked, config.seed))
    coded = strings.encode(kept, tabs, config.seed)
    matrix = training.dense(coded, ["decision_id", "y", "w"], names, rows).withColumn("is_test", scan.is_test(F.col("decision_id"), config.test_split))
    model = models.fit_propensity(checkpointed(matrix), config, trees)
    return model, sorted(names), tabs, mean_count


def train_decision(decisions: DataFrame, propensity_model, names: list[str], tabs: DataFrame, mean_count: float, config: TrainConfig, trees: int | None = None):
    """(model, feature names, string tables): expected normalised reward under inverse
    propensity and bootstrap weights, with contexts dropped by chance after scoring."""
    reward = arithmetic.binary_reward(F.col("reward")) if config.binary_rewards else F.col("reward")
    rows = decisions.withColumn("reward", reward)
    stats = rows.agg(F.avg("reward").alias("mean"), F.stddev_samp("reward").alias("std")).first()
    chosen = checkpointed(training.expand(rows).filter("y = 1"))
    coded = strings.encode(_with_time(training.features(chosen, config.max_json_depth), chosen), tabs, config.seed)
    matrix = training.dense(coded, ["decision_id", "y", "w"], names, chosen)
    # the model is part of the plan until here; what follows reads its scores
    scored = checkpointed(models.propensity(propensity_model, matrix).select("decision_id", "propensity"))
    ident, seed = F.col("decision_id"), config.seed
    uniforms = {k: arithmetic.uniform_of(ident, F.lit(k), seed=seed) for k in ("boot", "context")}
    weighted = checkpointed(
        training.decision_rows(rows.join(scored, "decision_id"), stats["mean"], stats["std"], mean_count, uniforms, config)
    )
    keys, own = ["decision_id", "y", "w"], [n for n in names if n != "t"]
    long = json.flatten(weighted, {"context": "context", "item": "item"}, keys, config.max_json_depth)
    long = checkpointed(long.filter(F.col("feature").isin(own)))
    prior = long.agg(F.avg("y")).first()[0] or 0.0
    ranked = strings.ranked_strings(strings.string_stats(long), prior, config.reward_prior_count, config.prune_min_string_count, config.max_strings_per_feature)
    own_tabs = checkpointed(strings.tables(ranked, seed))
    noise = arithmetic.uniform_of(ident, F.lit("noise"), seed=seed)
    coded = strings.encode(long, own_tabs, seed, noise)
    model = models.fit_decision(checkpointed(training.dense(coded, keys, own, weighted)), config, trees)
    return model, sorted(own), own_tabs


def train(spark: SparkSession, decisions: DataFrame, model_name: str, path: str, config: TrainConfig, now: datetime, trees: int | None = None) -> dict:
    """Train both phases and save them; a fresh propensity checkpoint is used again."""
    stored = models.load_if_fresh(spark, f"{path}/propensity", config, now)
    if stored is not None:
        model, found = stored
        tabs = strings.tables_of(spark, found)
        names, mean_count = found["feature_names"], found["mean_item_count"]
    else:
        model, names, tabs, mean_count = train_propensity(decisions, config, trees)
        models.save(spark, model, models.metadata(model_name, names, string_tables(tabs), config.seed, now, config.version, mean_count), f"{path}/propensity")
    decision, own, own_tabs = train_decision(decisions, model, names, tabs, mean_count, config, trees)
    found = models.metadata(model_name, own, string_tables(own_tabs), config.seed, now, config.version)
    models.save(spark, decision, found, f"{path}/decision")
    return found
