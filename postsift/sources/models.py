"""Fitted models on disk, one folder per task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from postsift.operators.linear import Linear
from postsift.operators.logreg import LogReg
from postsift.operators.naive_bayes import NaiveBayes

ABOUT = "kind string, prior double, max_len int, features int"
PLACES = "place int, weight double, idf double"
LOSSES = "step int, chunk int, epoch int, loss double"

Model = NaiveBayes | LogReg | Linear


def save_model(model: Model, folder: str, task: str, spark: SparkSession | None = None) -> str:
    """Save a model as ``folder/task``, with the losses of its training; the three tasks lie side by side."""
    spark = spark or SparkSession.getActiveSession()
    path = f"{folder.rstrip('/')}/{task}"
    history = []
    if isinstance(model, NaiveBayes):
        about = ("nb", model.prior, None, None)
        model.weights.write.mode("overwrite").parquet(f"{path}/nb")
        history = [(i, 0, i, v) for i, v in enumerate(model.losses)]
    elif isinstance(model, LogReg):
        about = ("logreg", None, model.max_len, None)
        model.pipeline.write().overwrite().save(f"{path}/logreg")
        history = [(i, 0, i, v) for i, v in enumerate(model.losses)]
    elif isinstance(model, Linear):
        about = ("linear", float(model.weights[-1]), model.max_len, len(model.idf))
        held = {"place": np.arange(len(model.idf), dtype=np.int32), "weight": model.weights[:-1], "idf": model.idf}
        spark.createDataFrame(pa.table(held), PLACES).write.mode("overwrite").parquet(f"{path}/linear")  # a row for each place
        history = [(i, *h) for i, h in enumerate(model.history)]
    else:
        raise ValueError(f"cannot save a {type(model).__name__}")
    spark.createDataFrame(history, LOSSES).coalesce(1).write.mode("overwrite").parquet(f"{path}/losses")
    spark.createDataFrame([about], ABOUT).coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
    return path


def load_model(folder: str, task: str, spark: SparkSession | None = None) -> Model:
    spark = spark or SparkSession.getActiveSession()
    path = f"{folder.rstrip('/')}/{task}"
    about = spark.read.schema(ABOUT).parquet(f"{path}/about").first()
    history = sorted(spark.read.schema(LOSSES).parquet(f"{path}/losses").collect())  # a row for each step
    losses = tuple(r["loss"] for r in history)
    if about["kind"] == "nb":
        weights = spark.read.schema("token string, weight double, n bigint").parquet(f"{path}/nb")
        return NaiveBayes(weights, about["prior"], losses)
    if about["kind"] == "linear":
        table = spark.read.schema(PLACES).parquet(f"{path}/linear").toArrow()
        weights, idf = np.zeros(about["features"] + 1), np.zeros(about["features"])
        at = table.column("place").to_numpy()
        weights[at], idf[at], weights[-1] = table.column("weight").to_numpy(), table.column("idf").to_numpy(), about["prior"]
        return Linear(weights, idf, about["max_len"], tuple((r["chunk"], r["epoch"], r["loss"]) for r in history))
    return LogReg(PipelineModel.load(f"{path}/logreg"), about["max_len"], losses)
