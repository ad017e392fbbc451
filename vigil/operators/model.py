"""Scaling, clustering, scoring and thresholding.

Training uses MLlib (VectorAssembler + StandardScaler in a Pipeline, KMeans).
Applying a model does not: the fitted means, stddevs and centers are small
(14 + 14 + k*14 numbers), so scoring is generated column arithmetic that
stays inside whole-stage codegen, and the same arithmetic is what the SQL
oracle runs for a fixed model.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import config as C
from vigil.functions import columns as X

MODEL_VERSION = 2
SCALED_PREFIX = "_z_"
DIST_PREFIX = "_d2_"


@dataclass
class AnomalyModel:
    features: list[str]
    mean: list[float]
    std: list[float]
    centers: list[list[float]]
    threshold: float | None = None
    version: int = MODEL_VERSION

    @property
    def k(self) -> int:
        return len(self.centers)

    def with_threshold(self, threshold: float) -> "AnomalyModel":
        return AnomalyModel(self.features, self.mean, self.std, self.centers, threshold, self.version)


# ---------------------------------------------------------------------------
# apply
# ---------------------------------------------------------------------------
def scale_features(df: DataFrame, model: AnomalyModel, keep: bool = False) -> DataFrame:
    """Add ``_z_<feature>`` z-scores with the model's train mean and sample stddev."""
    out = df.select("*", *[X.scaled_expr(f, m, s).alias(SCALED_PREFIX + f)
                           for f, m, s in zip(model.features, model.mean, model.std)])
    return out


def assign_cluster(scaled: DataFrame, model: AnomalyModel) -> DataFrame:
    """Nearest center (``cluster``) and Euclidean distance to it (``anomaly_score``)."""
    zcols = [F.col(SCALED_PREFIX + f) for f in model.features]
    dnames = [f"{DIST_PREFIX}{j}" for j in range(model.k)]
    with_d = scaled.select("*", *[X.squared_distance(zcols, c).alias(d) for c, d in zip(model.centers, dnames)])
    cluster, dist = X.nearest_center(dnames)
    out = with_d.select("*", cluster.alias("cluster"), dist.alias("anomaly_score"))
    return out.drop(*dnames, *[SCALED_PREFIX + f for f in model.features])


def anomaly_scores(df: DataFrame, model: AnomalyModel) -> DataFrame:
    return assign_cluster(scale_features(df, model), model)


def flag_anomaly(scored: DataFrame, threshold: float) -> DataFrame:
    """Strictly above the threshold is anomalous."""
    return scored.withColumn("is_anomaly", F.col("anomaly_score") > F.lit(float(threshold)))


def label(scored: DataFrame, threshold: float, rules=C.FAULT_RULES) -> DataFrame:
    flagged = flag_anomaly(scored, threshold)
    return flagged.withColumn("fault_hint", X.fault_hint(F.col("is_anomaly"), rules))


def score(df: DataFrame, model: AnomalyModel, rules=C.FAULT_RULES) -> DataFrame:
    """Scale, assign, score, flag and label any featured DataFrame."""
    if model.threshold is None:
        raise ValueError("model has no threshold")
    return label(anomaly_scores(df, model), model.threshold, rules)


# ---------------------------------------------------------------------------
# fit
# ---------------------------------------------------------------------------
def threshold_stats(scored_train: DataFrame) -> DataFrame:
    """One row: mean and sample stddev of train scores."""
    return scored_train.agg(F.avg("anomaly_score").alias("score_mean"),
                            F.stddev_samp("anomaly_score").alias("score_std"))


def fit_threshold(scored_train: DataFrame, sigmas: float = C.THRESHOLD_SIGMAS) -> float:
    row = threshold_stats(scored_train).first()
    mu, sd = row["score_mean"], row["score_std"]
    if mu is None:
        raise ValueError("no train rows to fit a threshold")
    return float(mu + sigmas * (sd if sd is not None else 0.0))


def assembler(features: list[str] = C.EXTENDED_COLS) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="raw_features", handleInvalid="skip")


def fit_scaler(train: DataFrame, features: list[str] = C.EXTENDED_COLS) -> PipelineModel:
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return Pipeline(stages=[assembler(features), scaler]).fit(train)


def fit_kmeans(scaled: DataFrame, k: int = C.KMEANS_K, seed: int = C.KMEANS_SEED) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(scaled)


def model_from_fits(pipeline: PipelineModel, kmeans: KMeansModel, features: list[str]) -> AnomalyModel:
    sm = pipeline.stages[-1]
    return AnomalyModel(features=list(features), mean=[float(v) for v in sm.mean.toArray()],
                        std=[float(v) for v in sm.std.toArray()],
                        centers=[[float(v) for v in c] for c in kmeans.clusterCenters()])


@dataclass
class Fitted:
    """The model, how it was fitted, and MLlib's own fits (None for a loaded model: applying doesn't need them)."""

    model: AnomalyModel
    pipeline: PipelineModel | None = None
    kmeans: KMeansModel | None = None
    settings: dict | None = None


def fit_settings(k: int = C.KMEANS_K, seed: int = C.KMEANS_SEED, sigmas: float = C.THRESHOLD_SIGMAS) -> dict:
    return {"k": int(k), "seed": int(seed), "sigmas": float(sigmas)}


def train_model(train: DataFrame, features: list[str] = C.EXTENDED_COLS, k: int = C.KMEANS_K,
                seed: int = C.KMEANS_SEED, sigmas: float = C.THRESHOLD_SIGMAS) -> Fitted:
    """Scaler + KMeans + threshold, all fitted on the train split only.

    The scaled train vectors are persisted for the KMeans iterations and
    released afterwards.
    """
    train = train.select(*features)
    pipeline = fit_scaler(train, features)
    scaled = pipeline.transform(train).select("features").persist()
    try:
        km = fit_kmeans(scaled, k, seed)
    finally:
        scaled.unpersist()
    model = model_from_fits(pipeline, km, features)
    thr = fit_threshold(anomaly_scores(train, model), sigmas)
    return Fitted(model.with_threshold(thr), pipeline, km, fit_settings(k, seed, sigmas))


# ---------------------------------------------------------------------------
# persistence (Hadoop file system paths, so a shared store works on a cluster)
# ---------------------------------------------------------------------------
_PARAMS_SCHEMA = T.StructType([T.StructField("params", T.StringType(), False)])


def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def model_exists(spark: SparkSession, path: str) -> bool:
    return _fs_exists(spark, f"{path}/params")


def save_model(spark: SparkSession, fitted: Fitted, path: str) -> None:
    """The parameters as one JSON row; MLlib's fits beside them, if there are any."""
    if fitted.pipeline is not None:
        fitted.pipeline.write().overwrite().save(f"{path}/mllib/scaling")
    if fitted.kmeans is not None:
        fitted.kmeans.write().overwrite().save(f"{path}/mllib/clusters")
    saved = {"model": asdict(fitted.model), "settings": fitted.settings or fit_settings()}
    spark.createDataFrame([(json.dumps(saved),)], _PARAMS_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/params")


def load_model(spark: SparkSession, path: str, features: list[str] = C.EXTENDED_COLS, settings: dict | None = None) -> Fitted | None:
    """The saved model, or None if absent or saved for another feature list, version or fit settings."""
    if not model_exists(spark, path):
        return None
    saved = json.loads(spark.read.schema(_PARAMS_SCHEMA).json(f"{path}/params").first()["params"])
    model = AnomalyModel(**saved["model"])
    if model.features != list(features) or model.version != MODEL_VERSION or saved["settings"] != (settings or fit_settings()):
        return None
    return Fitted(model, settings=saved["settings"])
