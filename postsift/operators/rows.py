"""Row filters and projections on frames of posts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.functions.text import cap_tokens, normalize_text, tokenize

TASKS = ("spam", "hatespeech", "selfharm")


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column so that a later filter on it does not redo it.

    The optimizer moves a filter below a projection and repeats the
    expression there. It does not move it below a generator, and a generator
    over a one-element array keeps the rows as they are.
    """
    kept = [F.col(c) for c in df.columns if c != name]
    return df.select(*kept, F.explode(F.array(value)).alias(name)).select(
        *_with_name(df, name)
    )


def _with_name(df: DataFrame, name: str) -> list[str]:
    return df.columns if name in df.columns else [*df.columns, name]


def normalize_rows(df: DataFrame, col: str = "data", n: int = 2, **options) -> DataFrame:
    """Normalise a text column and drop what is left shorter than ``n``."""
    return drop_short(compute_once(df, col, normalize_text(col, **options)), col, n)


def drop_short(df: DataFrame, col: str = "data", n: int = 2) -> DataFrame:
    """Rows whose text has at least ``n`` characters; null text is dropped."""
    return df.where(F.length(col) >= n)


def filter_label(df: DataFrame, value: int, label: str = "label") -> DataFrame:
    return df.where(F.col(label) == value)


def rename_result(df: DataFrame, task: str) -> DataFrame:
    return df.withColumnsRenamed(
        {"prediction": f"{task}_pred", "probability": f"{task}_prob"}
    )


def default_columns(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add constant columns, or copies where a value is a Column."""
    return df.withColumns(
        {k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()}
    )


def cast_prediction(df: DataFrame, col: str = "prediction") -> DataFrame:
    return df.withColumn(col, F.col(col).cast("int"))


def result_view(df: DataFrame, task: str | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """The two result columns of a task, or of the fused verdict."""
    if task is None:
        return df.select(*keys, "prediction", "probability")
    return df.select(*keys, f"{task}_pred", f"{task}_prob")


def with_tokens(df: DataFrame, col: str = "data", normalized: bool = False) -> DataFrame:
    """Add ``tokens``, once, for the steps that go on to read it often."""
    return compute_once(df, "tokens", tokenize(col, normalized=normalized))


def head_tail(df: DataFrame, max_len: int, col: str = "data", normalized: bool = False) -> DataFrame:
    """Cut long texts to their first and last tokens.

    Texts of at least ``max_len - 2`` tokens become the first
    ``max_len // 2 - 10`` and the last ``max_len // 2`` tokens; others stay
    as they are. The text as it was is kept in ``original``.
    """
    if max_len < 22:
        raise ValueError("max_len must be at least 22, so that the head is not empty")
    head, tail = max_len // 2 - 10, max_len // 2
    tokens = F.col("tokens")
    cut = F.concat_ws(" ", F.slice(tokens, 1, head), F.slice(tokens, -tail, tail))
    return (
        with_tokens(df, col, normalized)
        .withColumn("original", F.col(col))
        .withColumn(col, F.when(F.size(tokens) >= max_len - 2, cut).otherwise(F.col(col)))
        .drop("tokens")
    )


def with_capped_tokens(df: DataFrame, max_len: int, tokens: str = "tokens") -> DataFrame:
    return df.withColumn(tokens, cap_tokens(tokens, max_len))


def show_tokens(df: DataFrame, keys: tuple[str, ...], col: str = "data", normalized: bool = False) -> DataFrame:
    """One row per token, with its place in the text."""
    return df.select(*keys, F.posexplode(tokenize(col, normalized=normalized)).alias("position", "token"))
