"""Land-cover classes of zones from their statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: settings of the forest
TREES = 200
DEPTH = 10
MIN_PER_NODE = 10
SEED = 0


def feature_names(bands: Sequence[int]) -> list[str]:
    """mean, stdev, min, max of each band, in band order."""
    return [f"{what}{b}" for b in bands for what in ("mean", "stdev", "min", "max")]


def assemble(zs: DataFrame, bands: Sequence[int] | None = None, names: Sequence[str] | None = None) -> DataFrame:
    """Feature vector of the zone statistics of ``bands`` (or of any named columns)."""
    columns = list(names) if names is not None else feature_names(bands)
    values = F.array(*[F.col(c).cast("double") for c in columns])
    # a zone without some statistic has no vector
    known = zs.withColumn("_v", values).filter(~F.exists("_v", lambda v: v.isNull()))
    return known.withColumn("features", array_to_vector("_v")).drop("_v")


def train_classifier(
    df: DataFrame, label: str, trees: int = TREES, depth: int = DEPTH, min_per_node: int = MIN_PER_NODE
) -> RandomForestClassificationModel:
    forest = RandomForestClassifier(
        labelCol=label,
        featuresCol="features",
        predictionCol="predicted",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_per_node,
        seed=SEED,
    )
    return forest.fit(df)


def predict(model: RandomForestClassificationModel, df: DataFrame) -> DataFrame:
    """Adds the class as ``predicted``."""
    return model.transform(df).drop("rawPrediction", "probability")


def class_counts(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    return df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(predicted).cast("int").alias("predicted")
    ).agg(F.count("*").alias("n"))


def confusion(
    df: DataFrame, classes: Sequence[int], label: str = "label", predicted: str = "predicted"
) -> DataFrame:
    """Row per reference label, column ``p{class}`` per produced label."""
    counts = class_counts(df, label, predicted)
    cells = [
        F.coalesce(F.sum(F.when(F.col("predicted") == c, F.col("n"))), F.lit(0)).cast("bigint").alias(f"p{c}")
        for c in classes
    ]
    return counts.groupBy("label").agg(*cells)


def quality(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Accuracy and kappa overall (``class`` NULL), recall and precision per class."""
    counts = class_counts(df, label, predicted)
    n = F.col("n")
    hit = F.when(F.col("label") == F.col("predicted"), n).otherwise(F.lit(0))
    by_label = counts.groupBy(F.col("label").alias("class")).agg(
        F.sum(n).alias("ref"), F.sum(hit).alias("right")
    )
    by_pred = counts.groupBy(F.col("predicted").alias("class")).agg(F.sum(n).alias("made"))
    per = by_label.join(by_pred, "class", "full").na.fill(0, ["ref", "right", "made"])
    total = per.agg(
        F.sum("ref").alias("n"),
        F.sum("right").alias("right"),
        F.sum(F.col("ref") * F.col("made")).alias("chance"),
    )
    observed = F.col("right") / F.col("n")
    expected = F.col("chance") / (F.col("n") * F.col("n"))
    none = F.lit(None).cast("int")
    overall = total.select(
        F.explode(
            F.array(
                F.struct(F.lit("accuracy").alias("metric"), none.alias("class"), observed.alias("value")),
                F.struct(
                    F.lit("kappa").alias("metric"),
                    none.alias("class"),
                    F.try_divide(observed - expected, 1 - expected).alias("value"),
                ),
            )
        ).alias("r")
    ).select("r.*")
    each = per.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit("recall").alias("metric"),
                    F.col("class"),
                    F.try_divide(F.col("right"), F.col("ref")).alias("value"),
                ),
                F.struct(
                    F.lit("precision").alias("metric"),
                    F.col("class"),
                    F.try_divide(F.col("right"), F.col("made")).alias("value"),
                ),
            )
        ).alias("r")
    ).select("r.*")
    return overall.unionByName(each)
