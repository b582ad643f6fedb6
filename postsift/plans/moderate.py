"""Scoring by task, and from posts to verdicts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from postsift.functions.tables import SENTIMENT
from postsift.operators.fusion import fuse, selfharm_ensemble
from postsift.operators.linear import Linear, score_linear
from postsift.operators.logreg import LogReg, score_logreg
from postsift.operators.naive_bayes import WORD_SUM, NaiveBayes, score_nb, score_nb_tasks
from postsift.operators.rows import normalize_rows, rename_result, with_tokens
from postsift.operators.scorers import Lexicon, few_words, score_arrow, score_sentiment

Model = NaiveBayes | LogReg | Linear | Callable


def score(df: DataFrame, model: Model) -> DataFrame:
    """Add ``prediction`` and ``probability`` with whatever kind of model."""
    if isinstance(model, NaiveBayes):
        return score_nb(df, model).drop("log_odds")
    if isinstance(model, LogReg):
        return score_logreg(df, model)
    if isinstance(model, Linear):
        return score_linear(df, model)
    if callable(model):
        return score_arrow(df, model).drop("score_error")
    raise ValueError(f"cannot score with a {type(model).__name__}")


def _selfharm(df: DataFrame, lexicon: Lexicon, load: Callable | None, summed: str | None = None) -> DataFrame:
    return selfharm_ensemble(score_sentiment(df, lexicon, load=load, summed=summed))


def score_task(
    df: DataFrame,
    model: Model,
    task: str,
    normalized: bool = False,
    lexicon: Lexicon = SENTIMENT,
    sentiment: Callable | None = None,
) -> DataFrame:
    """Score one task: ``<task>_pred`` and ``<task>_prob``.

    Self-harm goes through the ensemble with sentiment and keeps the results
    of its classifier in ``prediction`` and ``probability``.
    """
    rows = df if "tokens" in df.columns else with_tokens(df, normalized=normalized)
    scored = score(rows.drop("prediction", "probability"), model)
    done = _selfharm(scored, lexicon, sentiment) if task == "selfharm" else rename_result(scored, task)
    return done if "tokens" in df.columns else done.drop("tokens")


def moderate(
    df: DataFrame,
    models: Mapping[str, Model],
    lexicon: Lexicon = SENTIMENT,
    sentiment: Callable | None = None,
    normalize: bool = True,
    spam_min_prob: float | None = None,
    floor: float = 0.51,
) -> DataFrame:
    """Posts to verdicts: all three tasks, the ensemble and the fusion.

    The text is normalised and split into tokens once. All naive Bayes models
    are summed in one pass, and a small lexicon with them. With models of bounded size every step is a
    projection, so the posts are read, scored and written without a shuffle.
    """
    missing = {"spam", "hatespeech", "selfharm"} - set(models)
    if missing:
        raise ValueError(f"no model for {', '.join(sorted(missing))}")
    rows = normalize_rows(df) if normalize else df
    rows = with_tokens(rows.drop("prediction", "probability"), normalized=True)
    counted = {task: m for task, m in models.items() if isinstance(m, NaiveBayes)}
    words = lexicon if counted and sentiment is None and few_words(lexicon) else None
    if counted:
        rows = score_nb_tasks(rows, counted, words=words).drop(*[f"{t}_log_odds" for t in counted])
    for task in ("spam", "hatespeech", "selfharm"):
        if task not in counted:
            rows = rename_result(score(rows, models[task]), task)
    base = {"selfharm_pred": "prediction", "selfharm_prob": "probability"}
    rows = _selfharm(rows.withColumnsRenamed(base), lexicon, sentiment, None if words is None else WORD_SUM)
    return fuse(rows, spam_min_prob, floor).drop("tokens")
