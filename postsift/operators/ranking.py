"""The first rows of every class in some order, without sorting the classes.

Ranking a class with a window would put the whole class, text and all, into
one task. Here only the row that closes the quota is looked for: counts by
prefix of the order key narrow down where it lies, one small aggregate per
step, and the rows themselves are then marked by comparing their key with it.
Marking is a projection, so the wide rows are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsift.operators.evaluate import class_counts
from postsift.sources.durable import durable

COPIES_PER_ROW = 100_000  # exact copies written out by one row of work


@dataclass(frozen=True)
class Order:
    """How rows are ordered: by the hex text that the search goes through.

    Rows are then compared by ``key``, the column that the text stands for,
    with the literal that ``read`` makes of it. A plain column as key lets the
    comparison go down to the scan. Nulls come first and have an empty text.
    """

    text: Column
    key: Column
    read: Callable[[str], object]

    def before(self, value: str) -> Column:
        return self.key.isNull() | (self.key < self.read(value)) if value else F.lit(False)

    def upto(self, value: str) -> Column:
        return self.key.isNull() | (self.key <= self.read(value)) if value else self.key.isNull()

    def same(self, value: str) -> Column:
        return self.key == self.read(value) if value else self.key.isNull()


def _hashed(column: Column) -> Order:
    return Order(column, column, str)


def seeded_key(seed: int, *keys: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def seeded_order(seed: int, *keys: str) -> Order:
    """A reproducible random order: md5 of ``seed:key``, in hex."""
    return _hashed(seeded_key(seed, *keys))


def key_order(df: DataFrame, key: str) -> Order:
    """The order of a column of whole numbers or strings."""
    kind = df.schema[key].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        shifted = F.col(key).cast("long").bitwiseXOR(F.lit(-(2**63)))
        text, read = F.lpad(F.hex(shifted), 16, "0"), lambda value: int(value[1:], 16) - 2**63
    elif isinstance(kind, T.StringType):
        text, read = F.hex(F.encode(F.col(key), "UTF-8")), lambda value: bytes.fromhex(value[1:]).decode()
    else:
        raise TypeError(f"cannot order by {key} of type {kind.simpleString()}")
    marked = F.concat(F.lit("x"), text)  # so that an empty string is not taken for a null
    return Order(F.coalesce(marked, F.lit("")), F.col(key), read)


def row_key(df: DataFrame) -> Column:
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}))


def row_order(df: DataFrame) -> Order:
    """Order among rows that share a key, by all that is in them."""
    return _hashed(row_key(df))


@dataclass(frozen=True)
class Cut:
    """The order key that closes a quota, and how many of its rows to take."""

    value: str
    take: int
    ties: int


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def find_cuts(keys: DataFrame, need: Mapping[int, int]) -> dict[int, Cut]:
    """Closing keys for ``keys(label, ord)``; each need is within its class.

    Three passes whatever the keys are: equal keys are counted and sorted by
    range over the tasks; sums by part tell in which part each quota closes;
    only these parts, one per class, are then gone through in order. A part
    holds each distinct key once, so shared keys and prefixes do not swell it.
    """
    counted = keys.where(F.col("label").isin(*need)).groupBy("label", "ord").agg(F.count(F.lit(1)).alias("n"))
    dealt = durable(counted.repartitionByRange("label", "ord").withColumn("part", F.spark_partition_id()), "ranges")
    sums = dealt.groupBy("label", "part").agg(F.sum("n").alias("n")).collect()  # one row per part and class
    inside, before = {}, {}
    for value, wanted in need.items():
        upto = 0
        for row in sorted((r for r in sums if r["label"] == value), key=lambda r: r["part"]):
            if upto + row["n"] >= wanted:
                inside[value], before[value] = row["part"], upto
                break
            upto += row["n"]
    if len(inside) < len(need):
        raise RuntimeError("the rows changed while they were counted")
    rows = dealt.where(_any([(F.col("label") == v) & (F.col("part") == p) for v, p in inside.items()]))
    running = Window.partitionBy("label").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("n").over(running))
    rest = {v: q - before[v] for v, q in need.items()}
    closing = _any([(F.col("label") == v) & (F.col("upto") >= q) & (F.col("upto") - F.col("n") < q) for v, q in rest.items()])
    found = rows.where(closing).collect()  # one row per class
    return {r["label"]: Cut(r["ord"], rest[r["label"]] - (r["upto"] - r["n"]), r["n"]) for r in found}


def mark_first(
    df: DataFrame,
    quotas: Mapping[int, int],
    orders: Sequence[Order],
    label: str = "label",
    into: str = "taken",
    sizes: Mapping[int, int] | None = None,
) -> DataFrame:
    """Add a boolean: is the row among the first ``quotas[class]`` of its class.

    The first of ``orders`` decides, the next one among rows with equal keys,
    and rows that agree in all of them are taken as copies of each other, of
    which the right number is marked. Rows of other classes are not marked.
    ``sizes`` are the sizes of the classes, where they are known already.
    """
    return _mark(df, quotas, _sizes(df, quotas, label) if sizes is None else sizes, orders, label, into)


def take_first(df: DataFrame, quotas: Mapping[int, int], orders: Sequence[Order], label: str = "label") -> DataFrame:
    """The rows that :func:`mark_first` marks. Where no key is shared at the
    edge of a quota, this is a filter that the scan can use to skip data."""
    sizes = _sizes(df, quotas, label)
    taken, split = _edge(df, quotas, sizes, orders[0], label)
    if not split:
        return df.where(taken)
    return _mark(df, quotas, sizes, orders, label, "__taken").where("__taken").drop("__taken")


def _sizes(df: DataFrame, quotas: Mapping[int, int], label: str) -> dict[int, int]:
    known = df.where(F.col(label).isin(*quotas))
    return {r[label]: r["n"] for r in class_counts(known, label).collect()}  # a row per class


def _edge(df, quotas, sizes, order: Order, label) -> tuple[Column, dict[int, Cut]]:
    """The condition for rows that are taken, and the cuts through equal keys."""
    cls = F.col(label)
    whole = [v for v, q in quotas.items() if q >= sizes.get(v, 0)]
    partial = {v: q for v, q in quotas.items() if 0 < q < sizes.get(v, 0)}
    cuts = {}
    if partial:
        keys = df.where(cls.isin(*partial)).select(cls.alias("label"), order.text.alias("ord"))
        cuts = find_cuts(keys, partial)
    split = {v: c for v, c in cuts.items() if c.take < c.ties}
    edges = [
        (cls == v) & (order.before(c.value) if v in split else order.upto(c.value))
        for v, c in cuts.items()
    ]
    return _any([cls == v for v in whole] + edges), split


def _mark(df, quotas, sizes, orders, label, into) -> DataFrame:
    cls, order = F.col(label), orders[0]
    taken, split = _edge(df, quotas, sizes, order, label)
    taken = F.coalesce(taken, F.lit(False))
    if not split:
        return df.withColumn(into, taken)
    ties = [(cls == v) & order.same(c.value) for v, c in split.items()]
    tie = F.coalesce(_any(ties), F.lit(False))
    tied = df.where(tie)
    rest = {v: c.take for v, c in split.items()}
    if len(orders) > 1:
        marked = _mark(tied, rest, {v: c.ties for v, c in split.items()}, orders[1:], label, into)
    else:
        marked = _mark_copies(tied, rest, label, into)
    return df.where(~tie).withColumn(into, taken).unionByName(marked)


def _mark_copies(df, quotas, label, into) -> DataFrame:
    """Mark so many copies of a row: count them, then write them out again.

    Copies meet in the map-side aggregate, and are written out in parts, so
    no task holds all of them however many there are.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    take = reduce(lambda acc, vq: F.when(F.col(label) == vq[0], F.lit(vq[1]).cast("long")).otherwise(acc), quotas.items(), F.lit(0).cast("long"))
    halves = F.array(
        F.struct(F.lit(True).alias(into), take.alias("__n")),
        F.struct(F.lit(False).alias(into), (F.col("__n") - take).alias("__n")),
    )
    flagged = counted.select(*df.columns, F.inline(halves)).where(F.col("__n") > 0)
    parts = flagged.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(__n - 1) div %d" % COPIES_PER_ROW))))
    size = F.least(F.lit(COPIES_PER_ROW).cast("long"), F.col("__n") - F.col("__part") * COPIES_PER_ROW)
    return (
        parts.withColumn("__size", size)
        .repartition("__part")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__size"))))
        .select(*df.columns, into)
    )
