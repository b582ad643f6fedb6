"""Logistic regression that is trained by chunks and goes on from a saved model.

Tokens are hashed to places by CRC-32, weighed by inverse document frequency,
and a post is scaled to length one. Rows are dealt to chunks; for each chunk
some steps of L-BFGS are taken from where the chunk before ended, and each
step is one pass over the chunk: tasks sum up loss and gradient of their rows,
and only these sums, in blocks, are shuffled. Several models (one for each
moderation task) are trained in the same passes. A model that is given goes
on: its weights, its frequencies and its history are kept.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.functions.scores import log_odds_confidence, log_odds_prediction
from postsift.functions.text import cap_tokens
from postsift.operators.naive_bayes import some_at_a_time
from postsift.sources.durable import durable, fresh_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1024  # entries of a gradient in one row
PARTS = 64  # parts in which sums are first added up
SUMS = "task int, block int, part int, sums binary"


@dataclass(frozen=True)
class LinearConfig:
    """``step_rows``: rows of a chunk, about; ``epochs``: passes over each chunk; ``reg``: weight of half the
    squared length; ``features``: places for tokens; ``max_len``: cap on the tokens of a post, if any."""

    epochs: int = 3
    step_rows: int = 1_000_000
    features: int = 1 << 18
    reg: float = 1e-5
    memory: int = 5
    max_len: int | None = None


@dataclass(frozen=True)
class Linear:
    """Weights by place, the last one being the intercept; (chunk, epoch, loss) of all training so far."""

    weights: np.ndarray
    idf: np.ndarray
    max_len: int | None = None
    history: tuple[tuple[int, int, float], ...] = field(default=())


def places(tokens: Column | str, features: int, max_len: int | None = None) -> Column:
    """The place of each token."""
    capped = F.col(tokens) if isinstance(tokens, str) else tokens
    capped = capped if max_len is None else cap_tokens(capped, max_len)
    return F.transform(capped, lambda t: (F.crc32(t.cast("binary")) % features).cast("int"))


def _values(lists: pa.Array, idf: np.ndarray, task: np.ndarray | int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and value of every token; a row's values have length one."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    place = lists.flatten().to_numpy(zero_copy_only=False)
    value = idf[task[row] if isinstance(task, np.ndarray) else task, place]
    length = np.sqrt(np.bincount(row, value * value, len(lists)))
    return row, place, value / np.where(length > 0, length, 1.0)[row]


def _slices(batch: pa.RecordBatch, lists: str) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose lists hold a bounded number of entries, or are one row."""
    start = 0
    for some in some_at_a_time(batch.column(lists)):
        yield batch.slice(start, len(some))
        start += len(some)


def gradients(weights: np.ndarray, idf: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of a task of rows (task, label, places): for each model the gradient, in blocks, and as block -1 loss and rows."""
    models, width = weights.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gradient, totals, part = np.zeros(models * width), np.zeros((models, 2)), 0
        for batch in batches:
            part = int(batch.column("part")[0].as_py()) if batch.num_rows else part
            for some in _slices(batch, "places"):
                task, label = (some.column(c).to_numpy() for c in ("task", "label"))
                row, place, value = _values(some.column("places"), idf, task)
                margin = np.bincount(row, weights[task[row], place] * value, len(task)) + weights[task, -1]
                error = 1 / (1 + np.exp(-np.clip(margin, -700, 700))) - label
                gradient += np.bincount(task[row] * width + place, error[row] * value, models * width)
                gradient += np.bincount(task * width + width - 1, error, models * width)
                totals[:, 0] += np.bincount(task, np.logaddexp(0, np.where(label == 1, -margin, margin)), models)
                totals[:, 1] += np.bincount(task, minlength=models)
        out = []
        for m in range(models):
            own = gradient[m * width : (m + 1) * width]
            out.append((m, -1, totals[m].tobytes()))
            out += [(m, i, own[i * BLOCK : (i + 1) * BLOCK].tobytes()) for i in range(-(-width // BLOCK)) if own[i * BLOCK : (i + 1) * BLOCK].any()]
        columns = list(zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array([part] * len(out), pa.int32()), pa.array(columns[2], pa.binary())],
            names=["task", "block", "part", "sums"],
        )

    return summed


def _added(table: pa.Table) -> pa.Table:
    sums = np.add.reduce([np.frombuffer(b.as_buffer()) for b in table.column("sums")])
    first = table.slice(0, 1)
    return first.set_column(first.schema.get_field_index("sums"), "sums", pa.array([sums.tobytes()], pa.binary()))


def evaluate(rows: DataFrame, weights: np.ndarray, idf: np.ndarray, reg: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean loss and its gradient for each model, in one pass over rows (task, label, places)."""
    models, width = weights.shape
    parted = rows.select("task", "label", "places", (F.spark_partition_id() % PARTS).alias("part"))
    sums = parted.mapInArrow(gradients(weights, idf), SUMS)
    some = sums.groupBy("task", "block", "part").applyInArrow(_added, SUMS)
    total = some.groupBy("task", "block").applyInArrow(_added, SUMS).toArrow()  # a row for each block of each model
    loss, n, gradient = np.zeros(models), np.zeros(models), np.zeros((models, width))
    for m, block, part in zip(*(total.column(c).to_pylist() for c in ("task", "block", "sums")), strict=True):
        values = np.frombuffer(part)
        if block < 0:
            loss[m], n[m] = values
        else:
            gradient[m, block * BLOCK : block * BLOCK + len(values)] = values
    n = np.maximum(n, 1)
    held = weights.copy()
    held[:, -1] = 0  # the intercept is free
    return loss / n + reg / 2 * (held * held).sum(axis=1), gradient / n[:, None] + reg * held


class Descent:
    """L-BFGS for one model. A step that does not lower the loss is halved in the next pass."""

    def __init__(self, at: np.ndarray, loss: float, gradient: np.ndarray, memory: int):
        self.at, self.loss, self.gradient, self.memory = at, loss, gradient, memory
        self.moves: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 1.0

    def direction(self) -> np.ndarray:
        q = -self.gradient
        if not self.moves:
            return q / max(float(np.linalg.norm(q)), 1e-300)
        shares = []
        for s, y in reversed(self.moves):
            share = s @ q / (s @ y)
            q = q - share * y
            shares.append(share)
        s, y = self.moves[-1]
        q = q * (s @ y / (y @ y))
        for (s, y), share in zip(self.moves, reversed(shares), strict=True):
            q = q + s * (share - y @ q / (s @ y))
        return q

    def proposed(self) -> np.ndarray:
        return self.at + self.size * self.direction()

    def answered(self, at: np.ndarray, loss: float, gradient: np.ndarray) -> None:
        if not loss < self.loss:
            self.size /= 2
            return
        s, y = at - self.at, gradient - self.gradient
        if s @ y > 1e-12 * (y @ y):
            self.moves = [*self.moves, (s, y)][-self.memory :]
        self.at, self.loss, self.gradient, self.size = at, loss, gradient, 1.0


def _dealt(rows: DataFrame, cfg: LinearConfig) -> tuple[DataFrame, int]:
    """Rows in chunks of about ``step_rows`` of a task, written once, a folder for each chunk."""
    most = max((r["count"] for r in rows.groupBy("task").count().collect()), default=0)  # a row for each task
    chunks = max(1, math.ceil(most / cfg.step_rows))
    path = fresh_path(rows.sparkSession, "chunks")
    rows.withColumn("chunk", F.pmod(F.xxhash64("places", "label", F.monotonically_increasing_id()), F.lit(chunks))).write.partitionBy("chunk").parquet(path)
    return rows.sparkSession.read.schema("task int, label int, places array<int>, chunk bigint").parquet(path), chunks


def fit_linear_tasks(
    df: DataFrame, cfg: LinearConfig = LinearConfig(), task: str = "task", label: str = "label", tokens: str = "tokens", start: Mapping[str, Linear] | None = None
) -> dict[str, Linear]:
    """Fit a model for each value of the column ``task``, all in the same passes.

    Models in ``start`` go on from where they are; others begin at zero. Rows
    whose label is neither 0 nor 1 are left out.
    """
    start = start or {}
    for name, model in start.items():
        if len(model.idf) != cfg.features or model.max_len != cfg.max_len:
            raise ValueError(f"{name}: the model was fitted with other places or another cap")
    known = df.where(F.col(label).isin(0, 1) & F.col(task).isNotNull())
    names = sorted(r[0] for r in known.select(task).distinct().collect())  # a row for each task
    if not names:
        raise ValueError("there is no labelled row")
    number = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(task)).cast("int") - 1
    of = known.select(number.alias("task"), F.col(label).cast("int").alias("label"), places(tokens, cfg.features, cfg.max_len).alias("places"))
    rows = durable(of.where("places is not null"), "places")
    idf = np.zeros((len(names), cfg.features))
    fresh = [i for i, n in enumerate(names) if n not in start]
    if fresh:
        sizes = {r["task"]: r["count"] for r in rows.groupBy("task").count().collect()}
        seen = rows.where(F.col("task").isin(fresh)).select("task", F.explode(F.array_distinct("places")).alias("place"))
        table = seen.groupBy("task", "place").agg(F.count("*").alias("n")).toArrow()  # at most a row for each place of each task
        at, place, n = (table.column(c).to_numpy() for c in ("task", "place", "n"))
        times = np.zeros_like(idf)
        times[at, place] = n
        idf = np.log((np.array([sizes.get(i, 0) for i in range(len(names))])[:, None] + 1) / (times + 1))
    weights = np.zeros((len(names), cfg.features + 1))
    for i, n in enumerate(names):
        if n in start:
            weights[i], idf[i] = start[n].weights, start[n].idf
    history = {n: list(start[n].history) if n in start else [] for n in names}
    before = {n: 1 + max((h[0] for h in history[n]), default=-1) for n in names}
    dealt, chunks = _dealt(rows, cfg)
    for chunk in range(chunks):
        own = dealt.where(F.col("chunk") == chunk)
        loss, gradient = evaluate(own, weights, idf, cfg.reg)
        descents = [Descent(weights[i], float(loss[i]), gradient[i], cfg.memory) for i in range(len(names))]
        for epoch in range(cfg.epochs + 1):
            if epoch:
                tried = np.stack([d.proposed() for d in descents])
                loss, gradient = evaluate(own, tried, idf, cfg.reg)
                for i, d in enumerate(descents):
                    d.answered(tried[i], float(loss[i]), gradient[i])
            for n, d in zip(names, descents, strict=True):
                history[n].append((before[n] + chunk, epoch, d.loss))
        weights = np.stack([d.at for d in descents])
    return {n: Linear(weights[i], idf[i], cfg.max_len, tuple(history[n])) for i, n in enumerate(names)}


def fit_linear(df: DataFrame, cfg: LinearConfig = LinearConfig(), label: str = "label", tokens: str = "tokens", start: Linear | None = None) -> Linear:
    """Fit one model on the token column, from zero or going on from ``start``."""
    rows = df.select(F.lit("task").alias("__task"), label, tokens)
    return fit_linear_tasks(rows, cfg, "__task", label, tokens, {"task": start} if start else None)["task"]


def _margins(model: Linear, df: DataFrame):
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.idf))  # bounded by the number of places

    @F.arrow_udf("double")
    def margins(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, idf = shared.value
        for lists in batches:
            done = np.zeros(len(lists))
            start = 0
            for some in some_at_a_time(lists):
                row, place, value = _values(some, idf[None], 0)
                done[start : start + len(some)] = np.bincount(row, weights[place] * value, len(some)) + weights[-1]
                start += len(some)
            yield pa.array(done)

    return margins(places("__tokens", len(model.idf), model.max_len))


def linear_log_odds(df: DataFrame, models: Mapping[str, Linear], tokens: str = "tokens") -> DataFrame:
    """Add ``<task>_log_odds`` of each model; a projection. Null tokens have null log-odds."""
    named = df.withColumn("__tokens", F.col(tokens))
    known = F.col("__tokens").isNotNull()
    return named.withColumns({f"{name}_log_odds": F.when(known, _margins(model, df)) for name, model in models.items()}).drop("__tokens")


def score_linear(df: DataFrame, model: Linear, tokens: str = "tokens") -> DataFrame:
    """Add ``prediction`` and ``probability``."""
    scored = linear_log_odds(df, {"__task": model}, tokens)
    results = {"prediction": log_odds_prediction("__task_log_odds"), "probability": log_odds_confidence("__task_log_odds")}
    return scored.withColumns(results).drop("__task_log_odds")
