"""Logistic regression on hashed token counts, with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.functions.scores import argmax_confidence
from postsift.functions.text import cap_tokens
from postsift.sources.durable import durable

_FEATURES = ["__tokens", "__counts", "__features", "__raw", "__probabilities", "__class"]


@dataclass(frozen=True)
class LogRegConfig:
    """Settings of a task: passes over the data and the token cap."""

    epochs: int = 20
    max_len: int | None = None
    features: int = 1 << 18
    reg: float = 0.01


@dataclass(frozen=True)
class LogReg:
    """A fitted model, with the token cap that it was fitted under and its loss by iteration."""

    pipeline: PipelineModel
    max_len: int | None = None
    losses: tuple[float, ...] = ()


def fit_logreg(df: DataFrame, cfg: LogRegConfig = LogRegConfig(), label: str = "label", tokens: str = "tokens") -> LogReg:
    """Fit on the token column; the iterations read a written token table.

    Whole texts count unless the settings cap the tokens; the model then caps
    what it scores in the same way.
    """
    capped = F.col(tokens) if cfg.max_len is None else cap_tokens(tokens, cfg.max_len)
    known = df.where(F.col(label).isin(0, 1))
    rows = durable(known.select(F.col(label).alias("label"), capped.alias("__tokens")), "training-tokens")
    stages = [
        HashingTF(inputCol="__tokens", outputCol="__counts", numFeatures=cfg.features),
        IDF(inputCol="__counts", outputCol="__features"),
        LogisticRegression(
            featuresCol="__features",
            labelCol="label",
            rawPredictionCol="__raw",
            probabilityCol="__probabilities",
            predictionCol="__class",
            maxIter=cfg.epochs,
            regParam=cfg.reg,
        ),
    ]
    fitted = Pipeline(stages=stages).fit(rows)
    return LogReg(fitted, cfg.max_len, tuple(float(v) for v in fitted.stages[-1].summary.objectiveHistory))


def score_logreg(df: DataFrame, model: LogReg, tokens: str = "tokens") -> DataFrame:
    """Add ``prediction`` and ``probability``; a projection in the JVM."""
    capped = F.col(tokens) if model.max_len is None else cap_tokens(tokens, model.max_len)
    scored = model.pipeline.transform(df.withColumn("__tokens", capped))
    result = argmax_confidence(vector_to_array("__raw"))
    return scored.withColumn("__result", result).withColumns(
        {"prediction": F.col("__result.prediction"), "probability": F.col("__result.probability")}
    ).drop("__result", *_FEATURES)
