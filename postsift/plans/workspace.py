"""Files by name: from task files to sets, models and predictions.

Ties the operators to a layout of folders, for work by logical names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.functions.tables import SENTIMENT
from postsift.operators.evaluate import report
from postsift.operators.linear import LinearConfig
from postsift.operators.logreg import LogRegConfig
from postsift.operators.rows import TASKS
from postsift.operators.sampling import concat, sample_per_class, split_task
from postsift.operators.scorers import Lexicon
from postsift.plans.moderate import moderate, score_task
from postsift.plans.train import fit_all_tasks, fit_task
from postsift.sources.models import Model, load_model
from postsift.sources.posts import (
    STORY_SCHEMA,
    TASK_SCHEMA,
    from_texts,
    read_posts,
    read_stories,
    read_task,
    write_fused,
    write_split,
    write_task,
)

SET_NAMES = {"train_set": "train", "test_set": "test"}
PLACE = "__place"


@dataclass(frozen=True)
class Settings:
    """How a task is trained."""

    model: str
    config: LogRegConfig | LinearConfig | None = None


# Spam goes with the counting model, the other two with the regression.
DEFAULTS = {"spam": Settings("nb"), "hatespeech": Settings("logreg"), "selfharm": Settings("logreg")}


@dataclass(frozen=True)
class Workspace:
    """``tasks`` holds a file or folder ``<task>`` per task, ``sets`` the
    training and test sets, ``models`` a model per task, ``results`` the
    predictions; ``stories`` is the file of posts to score. ``key`` seeds the
    random order of splits; ``order`` is the column by which the first rows of
    a class are taken, if that is not their order in the files. ``multi_line``
    says that fields of CSV files may hold newlines."""

    spark: SparkSession
    tasks: str
    sets: str
    models: str
    results: str
    stories: str
    fmt: str = "csv"
    settings: Mapping[str, Settings] = field(default_factory=lambda: dict(DEFAULTS))
    key: str = "data"
    order: str | None = None
    multi_line: bool = True
    task_schema: object = TASK_SCHEMA
    story_schema: object = STORY_SCHEMA

    def load(self, name: str, task: str | None = None, num_samples: float | str = "all") -> DataFrame:
        """``train_set``, ``test_set``, ``stories``, or whatever path."""
        place = PLACE if num_samples != "all" and self.order is None else None
        if name in SET_NAMES:
            path = f"{self.sets}/{task}_sets/split={SET_NAMES[name]}"
            df = read_task(self.spark, path, self.fmt, self.task_schema, self.multi_line, place)
        elif name == "stories":
            df = read_stories(self.spark, self.stories, self.fmt, self.story_schema, self.multi_line, place)
        else:
            df = read_posts(self.spark, name, self.fmt, self.story_schema, self.multi_line, place)
        if num_samples == "all":
            return df
        return sample_per_class(df, num_samples, self.order or PLACE).drop(PLACE)

    def split(self, p: float, seed: int = 0, tasks: Iterable[str] = TASKS) -> dict[str, DataFrame]:
        """Write the training and test set of each task."""
        sets = {}
        for task in tasks:
            df = read_task(self.spark, f"{self.tasks}/{task}", self.fmt, self.task_schema, self.multi_line)
            sets[task] = split_task(df, p, self.key, seed)
            write_split(sets[task], self.sets, task, self.fmt)
        return sets

    def train(self, task: str, df: DataFrame | None = None, num_samples: float | str = "all", go_on: bool = False) -> Model:
        """Fit on the training set, or on the given frame, and save. ``go_on``
        starts from the saved model of the task instead of anew."""
        rows = self.load("train_set", task, num_samples) if df is None else df
        use = self.settings[task]
        start = load_model(self.models, task, self.spark) if go_on else None
        return fit_task(rows, use.model, use.config, folder=self.models, task=task, start=start)

    def train_all(self, num_samples: float | str = "all") -> dict[str, Model]:
        """Fit all tasks on their training sets, read together, and save."""
        sets = [self.load("train_set", t, num_samples).select("data", "label", F.lit(t).alias("task")) for t in TASKS]
        kinds = {t: self.settings[t].model for t in TASKS}
        configs = {t: self.settings[t].config for t in TASKS if self.settings[t].config is not None}
        return fit_all_tasks(concat(*sets), kinds, configs, folder=self.models)

    def predict(
        self,
        task: str,
        data: str | DataFrame = "test_set",
        num_samples: float | str = "all",
        save: bool = True,
        lexicon: Lexicon = SENTIMENT,
        sentiment: Callable | None = None,
        model: Model | Callable | None = None,
    ) -> DataFrame:
        """Score a set, stories or a frame for one task, with its saved model or a given one."""
        df = self.load(data, task, num_samples) if isinstance(data, str) else data
        model = load_model(self.models, task, self.spark) if model is None else model
        scored = score_task(df, model, task, lexicon=lexicon, sentiment=sentiment)
        if not save:
            return scored
        name = data if isinstance(data, str) and data in (*SET_NAMES, "stories") else None
        path = write_task(scored, self.results, task, name, self.fmt)
        return read_posts(self.spark, path, self.fmt, scored.schema)

    def evaluate(self, task: str, data: str | DataFrame = "test_set") -> DataFrame:
        """Accuracy and counts on labelled data; for self-harm of both the
        classifier and the ensemble."""
        scored = self.predict(task, data, save=False)
        preds = ("prediction", "selfharm_pred") if task == "selfharm" else (f"{task}_pred",)
        return report(scored, preds)

    def moderate(
        self,
        data: str | DataFrame | list[str] = "stories",
        num_samples: float | str = "all",
        save: bool = False,
        normalize: bool = False,
        lexicon: Lexicon = SENTIMENT,
        sentiment: Callable | None = None,
        spam_min_prob: float | None = None,
        floor: float = 0.51,
        models: Mapping[str, Model | Callable] | None = None,
    ) -> DataFrame:
        """Posts to verdicts with the saved models of all three tasks, or given ones.

        Files are taken to be normalised, unless ``normalize`` says that it
        is to be done; texts given as a list always are normalised.
        """
        if isinstance(data, list):
            df, normalize = from_texts(self.spark, data), False
        else:
            df = self.load(data, None, num_samples) if isinstance(data, str) else data
        given = models or {}
        used = {task: given[task] if task in given else load_model(self.models, task, self.spark) for task in TASKS}
        verdicts = moderate(df, used, lexicon, sentiment, normalize, spam_min_prob, floor)
        if not save:
            return verdicts
        path = write_fused(verdicts, self.results, self.fmt)
        return read_posts(self.spark, path, self.fmt, verdicts.schema)
