"""Accuracy, confusion counts and progress counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.operators.linear import Linear
from postsift.operators.logreg import LogReg
from postsift.operators.naive_bayes import NaiveBayes


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Share of rows whose label was predicted, as one row."""
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Counts by true and predicted class; absent pairs count zero.

    One global aggregate of four sums, so nothing is shuffled but one row per
    task.
    """
    cells = [(t, p) for t in (0, 1) for p in (0, 1)]
    counts = df.agg(
        *[
            F.count_if((F.col(label) == t) & (F.col(pred) == p)).alias(f"n{t}{p}")
            for t, p in cells
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("label"),
                F.col(f"n{t}0").alias("pred_0"),
                F.col(f"n{t}1").alias("pred_1"),
            )
            for t in (0, 1)
        ]
    )
    return counts.select(F.inline(rows))


def report(df: DataFrame, preds: tuple[str, ...], label: str = "label") -> DataFrame:
    """Accuracy and the four counts for several predictions in one pass, such
    as those of the self-harm classifier and of its ensemble."""
    cells = [(t, p) for t in (0, 1) for p in (0, 1)]
    rows = [
        F.struct(
            F.lit(pred).alias("pred"),
            F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"),
            *[F.count_if((F.col(label) == t) & (F.col(pred) == p)).alias(f"n_{t}{p}") for t, p in cells],
        )
        for pred in preds
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def row_counts(df: DataFrame, stage: str) -> DataFrame:
    """Number of rows at a stage, by the values of the column ``stage``."""
    return df.groupBy(stage).agg(F.count(F.lit(1)).alias("n"))


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def loss_history(model: LogReg | Linear | NaiveBayes, spark: SparkSession | None = None) -> DataFrame:
    """Loss by iteration of a fitted model, also of one that was loaded.

    Of a regression it is the objective on its training rows, of a chunked one
    that of the chunk at hand; of naive Bayes the held-out loss as chunks were
    added, if it was fitted with ``fit_nb_chunks``.
    """
    losses = [h[2] for h in model.history] if isinstance(model, Linear) else model.losses
    spark = spark or SparkSession.getActiveSession()
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(losses)], "iteration int, loss double")
