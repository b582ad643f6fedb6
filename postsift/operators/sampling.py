"""Sampling, shuffling, balancing and splitting of labelled posts."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.operators.evaluate import class_counts
from postsift.operators.ranking import (
    key_order,
    mark_first,
    row_order,
    seeded_key,
    seeded_order,
    take_first,
)

CLASSES = (0, 1)


def sample_per_class(df: DataFrame, n: float | str, key: str, label: str = "label") -> DataFrame:
    """The first ``floor(n)`` rows of either class by ``key``; 'all' for all."""
    if n == "all":
        return df
    quotas = {v: math.floor(n) for v in CLASSES}
    return take_first(df, quotas, [key_order(df, key), row_order(df)], label)


def shuffle(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """All rows in a reproducible random order.

    A distributed sort. Rows with the same key are ordered by a hash of what
    else they hold, and then by where they were read, so that copies spread
    out, too.
    """
    return df.orderBy(seeded_key(seed, key), F.xxhash64(*df.columns), F.monotonically_increasing_id())


def concat(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, by column name; nothing is deduplicated."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _class_sizes(df: DataFrame, label: str) -> dict[int, int]:
    known = df.where(F.col(label).isin(*CLASSES))
    sizes = {r[label]: r["n"] for r in class_counts(known, label).collect()}  # two rows
    return {v: sizes.get(v, 0) for v in CLASSES}


def _mark_random(df, quotas, key, seed, label, sizes) -> DataFrame:
    """Mark the first rows of a class in seeded order; other rows are dropped."""
    known = df.where(F.col(label).isin(*CLASSES))
    return mark_first(known, quotas, [seeded_order(seed, key), row_order(df)], label, "__taken", sizes)


def balance_quotas(sizes: Mapping[int, int], trigger: int = 2, num: int = 6, den: int = 5) -> dict[int, int]:
    """Rows to keep: a class of more than ``trigger`` times the other is cut
    to ``num / den`` times the other."""
    small, large = sorted(CLASSES, key=lambda v: (sizes[v], v))
    if sizes[large] > trigger * sizes[small]:
        return {small: sizes[small], large: sizes[small] * num // den}
    return dict(sizes)


def balance(
    df: DataFrame, key: str, seed: int = 0, label: str = "label", trigger: int = 2, num: int = 6, den: int = 5
) -> DataFrame:
    """Add ``part``: 'keep' or, for the surplus of the larger class, 'extra'.

    Only rows labelled 0 or 1 remain.
    """
    sizes = _class_sizes(df, label)
    marked = _mark_random(df, balance_quotas(sizes, trigger, num, den), key, seed, label, sizes)
    return marked.withColumn("part", F.when(F.col("__taken"), "keep").otherwise("extra")).drop("__taken")


def train_quotas(sizes: Mapping[int, int], p: float) -> dict[int, int]:
    """Training rows per class: ``int(p * N)`` shared out by class size.

    Each class gets the floor of its share; what is left goes to the largest
    remainders, the lower label first among equals.
    """
    total = sum(sizes.values())
    train = int(p * total)
    if total == 0:
        return dict.fromkeys(sizes, 0)
    quotas = {v: train * n // total for v, n in sizes.items()}
    by_remainder = sorted(sizes, key=lambda v: (-(train * sizes[v] % total), v))
    for v in by_remainder[: train - sum(quotas.values())]:
        quotas[v] += 1
    return quotas


def stratified_split(df: DataFrame, p: float, key: str, seed: int = 0, label: str = "label") -> DataFrame:
    """Add ``split``, 'train' or 'test', with class shares preserved."""
    sizes = _class_sizes(df, label)
    marked = _mark_random(df, train_quotas(sizes, p), key, seed, label, sizes)
    return marked.withColumn("split", F.when(F.col("__taken"), "train").otherwise("test")).drop("__taken")


def split_task(df: DataFrame, p: float, key: str, seed: int = 0, label: str = "label") -> DataFrame:
    """Balance, split what is kept, and add the surplus to the test set.

    Both steps take the first rows of a class in one and the same random
    order, so one mark does for both: a training row is among the first of
    the kept, which are the first of the class.
    """
    sizes = _class_sizes(df, label)
    quotas = train_quotas(balance_quotas(sizes), p)
    marked = _mark_random(df, quotas, key, seed, label, sizes)
    return marked.withColumn("split", F.when(F.col("__taken"), "train").otherwise("test")).drop("__taken")


def split_all(frames: Mapping[str, DataFrame], p: float, key: str, seed: int = 0, label: str = "label") -> dict[str, DataFrame]:
    """:func:`split_task` for every task."""
    return {task: split_task(df, p, key, seed, label) for task, df in frames.items()}
