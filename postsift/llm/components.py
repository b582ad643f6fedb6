"""Connected components of a table of links, by union-find and star joins."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.sources.durable import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

EDGE = "node bigint, parent bigint"


def forests(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over the links of one task: its nodes, each with the smallest node it is joined to here."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for part in parts:
        for a, b in zip(part["a"].tolist(), part["b"].tolist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    found = [(x, root(x)) for x in parent]
    yield pd.DataFrame([f for f in found if f[0] != f[1]], columns=["node", "parent"]).astype("int64")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its smallest one."""
    both = edges.select(F.col("node").alias("x"), F.col("parent").alias("y")).union(
        edges.select(F.col("parent").alias("x"), F.col("node").alias("y"))
    )
    least = durable(both.groupBy("x").agg(F.min("y").alias("m")), "least")
    joined = both.where("y > x").join(least, "x")
    return joined.select(F.col("y").alias("node"), F.least("x", "m").alias("parent")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest one."""
    least = durable(edges.groupBy("node").agg(F.min("parent").alias("m")), "least")
    moved = edges.join(least, "node").where("parent != m").select(F.col("parent").alias("node"), F.col("m").alias("parent"))
    return moved.union(least.select("node", F.col("m").alias("parent"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("node", "parent").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())


def components(links: DataFrame) -> DataFrame:
    """Of links (a, b): every node that is not the smallest of its component,
    as ``node``, and that smallest one, as ``component``.

    Each task first reduces its links to a forest. Large-star and small-star
    joins then alternate until nothing changes; both only ever need the least
    neighbour of a node, which is aggregated before the shuffle, and the joins
    read two plain shuffles, whose skewed parts Spark splits.
    """
    edges = durable(links.select("a", "b").where("a != b").mapInPandas(forests, EDGE).distinct(), "forest")
    mark = _mark(edges)
    while mark[0]:
        edges = durable(_small_star(durable(_large_star(edges), "large_star")), "small_star")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select("node", F.col("parent").alias("component"))
