"""Propensity and decision models: boosted trees over dense features, metadata, reuse."""

from __future__ import annotations

import json as pyjson
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardmill.config import TrainConfig
from rewardmill.functions import names
from rewardmill.sources import partitions

MISSING = -1e6
#: Values (rows by slots) from which on a fit's rows go to more than one task.
VALUES_PER_TASK = 500_000
REQUIRED = {"model_name": str, "string_tables": dict, "model_seed": int, "created_at": str, "version": str}


def as_vectors(rows: DataFrame, array: str = "features") -> DataFrame:
    """Trees here have no branch for missing values: each is a value far off and a flag."""
    missing = F.transform(array, lambda x: F.isnan(x).cast("double"))
    filled = F.transform(array, lambda x: F.when(F.isnan(x), F.lit(MISSING)).otherwise(x.cast("double")))
    return rows.withColumn("_v", array_to_vector(F.concat(filled, missing)))


def packed(rows: DataFrame, vector: str = "_v") -> DataFrame:
    """All ``rows`` in as many partitions as their values need, at most those they have.

    A fit runs two stages for every level of every tree: tasks of a few thousand values take
    longer to start than to run.
    """
    n, slots = rows.agg(F.count(F.lit(1)), F.max(F.size(vector_to_array(vector)))).first()
    return rows.coalesce(max(1, -(-n * (slots or 1) // VALUES_PER_TASK)))


def fit_propensity(rows: DataFrame, config: TrainConfig, trees: int | None = None) -> GBTClassificationModel:
    """P(item was chosen) from features, y and w; rows flagged ``is_test`` stop it early."""
    gbt = GBTClassifier(
        featuresCol="_v", labelCol="y", weightCol="w", validationIndicatorCol="is_test", seed=config.seed,
        maxIter=trees or config.propensity_trees, maxDepth=config.tree_depth,
    )
    return gbt.fit(packed(as_vectors(rows)))


def propensity(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    """``rows`` with ``propensity``, the model's probability."""
    scored = model.transform(as_vectors(rows))
    return scored.withColumn("propensity", vector_to_array("probability")[1]).drop("_v", "rawPrediction", "probability", "prediction")


def fit_decision(rows: DataFrame, config: TrainConfig, trees: int | None = None) -> GBTRegressionModel:
    """Expected (normalised) reward from features, y and w."""
    gbt = GBTRegressor(
        featuresCol="_v", labelCol="y", weightCol="w", seed=config.seed, maxIter=trees or config.max_trees,
        maxDepth=config.tree_depth,
    )
    return gbt.fit(packed(as_vectors(rows)))


def predict(model, rows: DataFrame) -> DataFrame:
    return model.transform(as_vectors(rows)).drop("_v", "rawPrediction", "probability")


def metadata(
    model_name: str, feature_names: Sequence[str], string_tables: dict, seed: int, created: datetime, version: str,
    mean_item_count: float | None = None,
) -> dict:
    found = {
        "model_name": model_name, "feature_names": list(feature_names), "string_tables": string_tables,
        "model_seed": seed, "created_at": created.isoformat(), "version": version,
    }
    if mean_item_count is not None:
        found["mean_item_count"] = float(mean_item_count)
    return check_metadata(found)


def check_metadata(found: dict) -> dict:
    """Raises ValueError unless all keys are there, of their types, and consistent."""
    if not found:
        raise ValueError("metadata: none")
    for key, kind in REQUIRED.items():
        if not isinstance(found.get(key), kind) or isinstance(found.get(key), bool):
            raise ValueError(f"metadata: bad {key}")
    datetime.fromisoformat(found["created_at"])
    features = found.get("feature_names")
    if features is not None and (not isinstance(features, list) or not features):
        raise ValueError("metadata: no features")
    if features is not None and not set(found["string_tables"]) <= set(features):
        raise ValueError("metadata: a string table of no feature")
    return found


def save(spark: SparkSession, model, found: dict, path: str) -> None:
    """Model directory and its metadata, written through Spark's file systems."""
    model.write().overwrite().save(f"{path}/model")
    row = [(pyjson.dumps(check_metadata(found), sort_keys=True),)]
    spark.createDataFrame(row, "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def publish(spark: SparkSession, path: str, root: str, model_name: str, now: datetime) -> tuple[str, str]:
    """Copy a saved model to the archive, under its name and time, and then over the latest
    one; returns both places. The new copy is complete before the old one goes."""
    stamp = now.strftime("%Y-%m-%d-%H-%M-%S")
    archive = f"{root.rstrip('/')}/models/archive/{model_name}/{model_name}-{stamp}-{uuid.uuid4()}"
    latest = f"{root.rstrip('/')}/models/latest/{model_name}"
    partitions.copy(spark, path, archive)
    partitions.copy(spark, archive, f"{latest}.new")
    if partitions.exists(spark, latest):
        partitions.remove(spark, latest)
    partitions.rename(spark, f"{latest}.new", latest)
    return archive, latest


def load_if_fresh(spark: SparkSession, path: str, config: TrainConfig, now: datetime, kind=GBTClassificationModel):
    """(model, metadata) of a stored model of this version that isn't too old; else None,
    whatever is wrong with it: then it is trained again."""
    try:
        found = check_metadata(pyjson.loads(spark.read.text(f"{path}/metadata").first()["value"]))
        if found["version"] != config.version:
            return None
        if now - datetime.fromisoformat(found["created_at"]) > names.parse_duration(config.max_checkpoint_age):
            return None
        return kind.load(f"{path}/model"), found
    except Exception as error:  # noqa: BLE001 - any unusable checkpoint means training again
        print(f"checkpoint not used: {str(error).splitlines()[0]}")
        return None
