"""Best-fit packing of documents into bins, under conflicts.

Bins are kept in the order of their residual capacity and carry bitmaps: of
the duplicate clusters they hold, and of the sources, one bitmap per document
allowed of a source. A piece goes into the tightest bin that is compatible:
the search starts at the least residual that fits and goes on from bin to bin.

Documents are dealt to shards of bounded size by hash, each packed on its own;
so the number of tasks grows with the input and no source or cluster ends up
in one task.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.llm.quality import words_of
from postsift.sources.durable import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 4096  # words in a bin
PER_SOURCE = 4  # pieces of one source in a bin
SHARD_DOCS = 4096

PACKED = (
    "doc_id bigint, copy bigint, source string, piece int, first_word bigint, size bigint, bin_id bigint"
)


class Bins:
    """Open bins in the order of residual, then number."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.open: list[tuple[int, int]] = []  # residual, bin
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []

    def put(self, size: int, source: int, cluster: int) -> int:
        """Put a piece into the tightest bin whose bitmaps allow it; ``source`` and ``cluster`` are bits, no cluster is 0."""
        at = bisect_left(self.open, (size, -1))
        while at < len(self.open):
            residual, number = self.open[at]
            if not (self.clusters[number] & cluster or self.sources[number][-1] & source):
                del self.open[at]
                break
            at += 1
        else:
            residual, number = self.capacity, len(self.clusters)
            self.clusters.append(0)
            self.sources.append([0] * self.per_source)
        self.clusters[number] |= cluster
        for i, bitmap in enumerate(self.sources[number]):
            if not bitmap & source:
                self.sources[number][i] = bitmap | source
                break
        if residual > size:
            insort(self.open, (residual - size, number))
        return number


def pieces(size: int, capacity: int) -> list[tuple[int, int]]:
    """First word and size of each piece of a document."""
    return [(at, min(capacity, size - at)) for at in range(0, size, capacity)]


def pack_shard(docs: list[tuple], capacity: int, per_source: int) -> list[tuple]:
    """Pack (doc_id, copy, source, size, cluster); longest pieces first. Rows out follow PACKED, with bin numbers from 0."""
    ordered = sorted(docs, key=lambda d: (-d[3], d[4], d[2] is not None, d[2] or "", d[0] is not None, d[0] or 0, d[1]))
    parts = [(size, first, i, d) for d in ordered for i, (first, size) in enumerate(pieces(d[3], capacity))]
    parts.sort(key=lambda p: -p[0])  # stable
    shared = Counter(d[4] for *_, d in parts)
    bit: dict[object, int] = {}
    for cluster, n in shared.items():
        if n > 1:
            bit[cluster] = 1 << len(bit)
    source_bit: dict[object, int] = {}
    bins = Bins(capacity, per_source)
    out = []
    for size, first, i, (doc_id, copy, source, _, cluster) in parts:
        number = bins.put(size, source_bit.setdefault(source, 1 << len(source_bit)), bit.get(cluster, 0))
        out.append((doc_id, copy, source, i, first, size, number))
    return out + [(d[0], d[1], d[2], 0, 0, 0, None) for d in ordered if not d[3]]


def packer(capacity: int, per_source: int) -> Callable[[pa.Table], pa.Table]:
    def pack(table: pa.Table) -> pa.Table:
        names = ["doc_id", "copy", "source", "size", "cluster"]
        docs = list(zip(*[table.column(n).to_pylist() for n in names], strict=True))
        base = table.column("shard")[0].as_py() << 32
        rows = [(*r[:6], None if r[6] is None else base + r[6]) for r in pack_shard(docs, capacity, per_source)]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        fields = [c.split()[0] for c in PACKED.split(", ")]
        return pa.table({f: pa.array(c, k) for f, c, k in zip(fields, zip(*rows, strict=True), kinds, strict=True)})

    return pack


def packed(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Pack documents (doc_id, text, source) into bins of ``capacity`` words.

    A document longer than a bin is cut into pieces of that size. A bin never
    holds two pieces of one duplicate cluster (texts with the same words but
    for case and blanks; so neither two pieces of one document) and never more
    than ``per_source`` pieces of one source. Returns per piece: doc_id, copy
    (rows that are repeated as they are get numbers from 0), source, piece,
    first_word, size and bin_id. A null or empty text gives one piece of size 0
    that is in no bin (null). A null source is a source of its own; null
    doc_ids are packed like others. Other columns are not looked at; an empty
    table gives an empty table.
    """
    words = words_of(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    counted = docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), words.alias("w"))
    counted = counted.select("doc_id", "source", F.size("w").cast("bigint").alias("size"), F.xxhash64("w").alias("cluster"))
    counted = durable(counted.groupBy("doc_id", "source", "size", "cluster").agg(F.count("*").alias("n")), "sizes")
    total = counted.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // shard_docs))
    single = counted.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1))).drop("n")
    dealt = single.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "copy"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(packer(capacity, per_source), PACKED)
