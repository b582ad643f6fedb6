"""Training by task and by kind of model."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.operators.linear import Linear, LinearConfig, fit_linear, fit_linear_tasks
from postsift.operators.logreg import LogRegConfig, fit_logreg
from postsift.operators.naive_bayes import fit_nb, fit_nb_tasks
from postsift.operators.rows import with_tokens
from postsift.operators.sampling import sample_per_class
from postsift.sources.durable import durable
from postsift.sources.models import Model, save_model

KINDS = ("nb", "logreg", "linear")


def fit_task(
    df: DataFrame,
    model: str = "nb",
    cfg: LogRegConfig | LinearConfig | None = None,
    label: str = "label",
    num_samples: float | str = "all",
    key: str | None = None,
    normalized: bool = False,
    folder: str | None = None,
    task: str | None = None,
    start: Linear | None = None,
) -> Model:
    """Train on ``data`` and a label column, and save where a folder is given.

    ``num_samples`` takes the first rows of each class by ``key`` only. A
    model of the kind ``linear`` goes on from ``start``, where one is given.
    """
    if model not in KINDS:
        raise ValueError(f"unknown model {model!r}; use nb, logreg or linear")
    if start is not None and model != "linear":
        raise ValueError("only models of the kind linear go on from another")
    if num_samples != "all":
        df = sample_per_class(df, num_samples, key, label)
    rows = df if "tokens" in df.columns else with_tokens(df, normalized=normalized)
    if model == "nb":
        fitted = fit_nb(rows, label)
    elif model == "linear":
        fitted = fit_linear(rows, cfg or LinearConfig(), label, start=start)
    else:
        fitted = fit_logreg(rows, cfg or LogRegConfig(), label)
    if folder is not None:
        save_model(fitted, folder, task, df.sparkSession)
    return fitted


def fit_all_tasks(
    df: DataFrame,
    models: Mapping[str, str],
    configs: Mapping[str, LogRegConfig | LinearConfig] | None = None,
    task: str = "task",
    label: str = "label",
    normalized: bool = False,
    folder: str | None = None,
    start: Mapping[str, Linear] | None = None,
) -> dict[str, Model]:
    """Train all tasks on one frame whose column ``task`` names the task of a row.

    The posts are read and split into tokens once. All naive Bayes models are
    counted in one pass, by token and by the class of each task; all linear
    models with the same settings take their steps in the same passes.
    """
    configs, start = configs or {}, start or {}
    unknown = sorted(set(models.values()) - set(KINDS))
    if unknown:
        raise ValueError(f"unknown model {unknown[0]!r}; use nb, logreg or linear")
    rows = df if "tokens" in df.columns else with_tokens(df, normalized=normalized)
    rows = rows.select(F.col(task).alias("task"), F.col(label).alias("label"), "tokens").where(F.col("task").isin(*models))
    of = {kind: [t for t, k in models.items() if k == kind] for kind in KINDS}
    linear = {}  # tasks by their settings
    for t in of["linear"]:
        linear.setdefault(configs.get(t, LinearConfig()), []).append(t)
    if bool(of["nb"]) + len(of["logreg"]) + len(linear) > 1:  # read more than once
        rows = durable(rows, "task-tokens")
    fitted: dict[str, Model] = {}
    if of["nb"]:
        labels = {t: f"label_{i}" for i, t in enumerate(of["nb"])}
        own = [F.when(F.col("task") == t, F.col("label")).alias(c) for t, c in labels.items()]
        fitted |= fit_nb_tasks(rows.where(F.col("task").isin(*of["nb"])).select(*own, "tokens"), labels)
    for cfg, tasks in linear.items():
        begun = {t: m for t, m in start.items() if t in tasks}
        fitted |= fit_linear_tasks(rows.where(F.col("task").isin(*tasks)), cfg, start=begun)
    for t in of["logreg"]:
        fitted[t] = fit_logreg(rows.where(F.col("task") == t), configs.get(t, LogRegConfig()))
    lost = sorted(set(models) - set(fitted))
    if lost:
        raise ValueError(f"no labelled rows of {', '.join(lost)}")
    if folder is not None:
        for t, model in fitted.items():
            save_model(model, folder, t, df.sparkSession)
    return fitted


def fit_all(frames: Mapping[str, DataFrame], models: Mapping[str, str], **options) -> dict[str, Model]:
    """Train every task on its own frame; ``models`` names the kind of each.

    :func:`fit_all_tasks` trains them together, from one frame.
    """
    return {
        task: fit_task(df, models.get(task, "nb"), task=task, **options)
        for task, df in frames.items()
    }
