"""The supervised matcher: gradient-boosted trees over the features."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.config import FEATURES, LinkConfig


def fit_model(features: DataFrame, config: LinkConfig = LinkConfig()) -> PipelineModel:
    """Fit to rows with all features and label. Its objective is the logistic one; it has no L1 or L2 term."""
    # fixed values: shares of the rows and of the columns that a tree sees, least rows of a leaf, bins
    trees = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=config.trees, maxDepth=config.depth, stepSize=config.learning_rate, subsamplingRate=0.82,
        featureSubsetStrategy="0.88", minInstancesPerNode=4, maxBins=256, seed=config.seed, checkpointInterval=10,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), trees]).fit(features)


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """query_id, target_source, target_id and probability; label too if it is there."""
    keep = [c for c in ("query_id", "target_source", "target_id", "label") if c in features.columns]
    out = model.transform(features.drop("probability"))
    return out.select(*keep, vector_to_array("probability")[1].alias("probability"))


def importances(model: PipelineModel) -> list[tuple[str, float]]:
    """Features with their importance, the greatest first."""
    values = model.stages[-1].featureImportances.toArray()
    return sorted(zip(FEATURES, map(float, values), strict=True), key=lambda pair: -pair[1])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def baseline_score(candidates: DataFrame) -> DataFrame:
    """A score without a model: half the sum of both Jaro likenesses, as probability."""
    return candidates.select("query_id", "target_source", "target_id", (F.lit(0.5) * (F.col("name_jaro") + F.col("address_jaro"))).alias("probability"))
