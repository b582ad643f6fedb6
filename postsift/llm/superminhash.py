"""Near-duplicate documents by SuperMinHash, banding and union-find.

A document is the set of its distinct word shingles. Of the classes of equal
sets, one document each goes on. SuperMinHash draws, for each shingle, a
random permutation of the signature's slots and the rank ``j + r`` (``r`` in
[0, 1)) for the slot at place ``j``; a slot keeps the least rank. As ranks
grow with ``j``, drawing stops as soon as every slot holds a smaller rank than
the next place could give: for long documents after a few places. All
documents of a slice are drawn place by place together.

Bands of the signature make buckets. In a bucket every member is paired with
the smallest one, and verified on the full sets. Members that are still in
different components after that are compared with each other, block by block,
on short hashes of their whole sets; of what agrees, only pairs that connect
components are verified. So a group of thousands of copies costs one pair
each, pairs below the similarity never become rows, and no link is lost.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.llm.components import components
from postsift.llm.words import Runs, Words, listed, mixed, rows_with_keys, rows_without_keys, slices, small_batches
from postsift.sources.durable import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BANDS = 32
BAND_ROWS = 5  # a pair at similarity 0.8 meets in no band in 3 of a million cases
CHUNK = 1 << 15  # shingles drawn at a time
BLOCK = 512  # members of a bucket that are compared with as many others at a time
SLACK = 8  # shingles by which two sets' intersection on short hashes may be too large, besides those that grow with their sizes
ORDER = np.uint64(0x9FB21C651E98DF25)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
SKETCH = "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>"


def shingle_sets(runs: Runs, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted, distinct hashes of its runs of ``width`` words; of a shorter text, of all its words."""
    h = runs.hashes
    full = np.zeros(max(0, len(h) - width + 1), np.uint64)
    for k in range(width if len(full) else 0):
        full = full * ORDER + h[k : k + len(full)]
    full = mixed(full)
    for i, j in zip(runs.first[:-1].tolist(), runs.first[1:].tolist(), strict=True):
        if j - i >= width:
            yield np.unique(full[i : j - width + 1])
        elif j > i:
            acc = np.zeros(1, np.uint64)
            for k in range(i, j):
                acc = acc * ORDER + h[k]
            yield mixed(acc + np.uint64(j - i))
        else:
            yield np.zeros(0, np.uint64)


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """SuperMinHash signatures, a row per set. Slots of an empty set hold the largest number."""
    out = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    flat = out.reshape(-1)
    sizes = np.array([len(s) for s in sets], np.int64)
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    places = None
    for j in range(slots):
        if not len(elements):
            break
        draw = mixed(elements + np.uint64((j + 1) * int(GOLDEN) % (1 << 64)))
        k = (np.uint64(j) + (((draw >> np.uint64(32)) * np.uint64(slots - j)) >> np.uint64(32))).astype(np.int64)
        if places is None:
            at = k
        else:
            row = np.arange(len(elements))
            at = places[row, k].astype(np.int64)
            places[row, k] = places[row, j]
        np.minimum.at(flat, owner * slots + at, (np.uint64(j) << np.uint64(32)) | (draw & np.uint64(0xFFFFFFFF)))
        open_ = out.max(axis=1) >= np.uint64(j + 1) << np.uint64(32)
        stay = open_[owner]
        if places is None:
            elements, owner, k = elements[stay], owner[stay], k[stay]
            places = np.tile(np.arange(slots, dtype=np.uint16), (len(elements), 1))
            places[np.arange(len(elements)), k] = 0
        elif not stay.all():
            elements, owner, places = elements[stay], owner[stay], places[stay]
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature.reshape(len(signature), bands, rows)
    acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN, parts.shape[:2]).copy()
    for i in range(rows):
        acc = mixed(acc * ORDER + parts[:, :, i])
    return acc


def _chunks(sets: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for s in sets:
        if held and size + len(s) > CHUNK:
            yield held
            held, size = [], 0
        held.append(s)
        size += len(s)
    if held:
        yield held


def _signature(s: list[np.ndarray], slots: int) -> np.ndarray:
    """Signatures of a chunk; a set larger than the chunk is drawn in parts, whose least ranks are its own."""
    if len(s) == 1 and len(s[0]) > CHUNK:
        parts = [signatures([s[0][i : i + CHUNK]], slots) for i in range(0, len(s[0]), CHUNK)]
        return np.minimum.reduce(parts)
    return signatures(s, slots)


def sketcher(width: int, bands: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lower=True)
        for batch in slices(batches, "text"):
            counts, digests, keys = [], [], []
            for sets in _chunks(shingle_sets(words(batch.column("text")), width)):
                found = band_keys(_signature(sets, bands * rows), bands, rows)
                for s, bands_of in zip(sets, found, strict=True):
                    counts.append(len(s))
                    digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                    keys.append(bands_of if len(s) else bands_of[:0])
            first = np.concatenate([[0], np.cumsum([len(k) for k in keys], dtype=np.int64)])
            flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), listed(flat, first)],
                names=["doc_id", "n_shingles", "digest", "bands"],
            )

    return sketch


def set_writer(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(lower=True)
        for batch in slices(batches, "text"):
            sets = list(shingle_sets(words(batch.column("text")), width))
            first = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)])
            short = [np.sort(s.astype(np.uint32)).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), listed(np.concatenate(sets).view(np.int64), first), pa.array(short, pa.binary())],
                names=["node", "shingles", "short"],
            )

    return write


def _alike(n: Column, m: Column, percent: int) -> Column:
    """Whether sets of these sizes can reach the similarity at all."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def comparer(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Pairs between two blocks of a bucket that may be similar and are in different components.

    A pair that shares several buckets is left to the first of them. Pairs
    that are similar beyond SLACK connect their components at once; of the
    others, all that still lie apart are given out.
    """

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        key = table.column("key")[0].as_py()
        node, n, component, block, i, j = (table.column(c).to_numpy() for c in ("node", "n", "component", "block", "i", "j"))
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        sets = [np.frombuffer(s.as_buffer(), np.uint32) for s in table.column("short")]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        tokens = np.concatenate([sets[r] for r in right]) if len(right) else np.zeros(0, np.uint32)
        owner = np.repeat(np.arange(len(right)), [len(sets[r]) for r in right])
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        found: list[tuple[int, int, int]] = []
        for x in left.tolist():
            own = bands[x]
            at = int(np.flatnonzero(own == key)[0])
            ok = (node[right] > node[x] if i[0] == j[0] else node[right] != node[x]) & (component[right] != component[x])
            ok &= 100 * np.minimum(n[right], n[x]) >= percent * np.maximum(n[right], n[x])
            if at and ok.any():
                ok &= ~(bands[right][:, :at] == own[:at]).any(axis=1)
            if not ok.any():
                continue
            lo, hi = np.searchsorted(tokens, sets[x], "left"), np.searchsorted(tokens, sets[x], "right")
            size = hi - lo
            spots = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            shared = np.bincount(owner[spots], minlength=len(right))
            slack = SLACK + (2 * n[right] * n[x] >> 32)  # of 32-bit hashes n * m / 2^32 agree by chance
            sure = 100 * (shared - slack) >= percent * (n[right] + n[x] - shared + slack)
            may = ok & (100 * shared >= percent * (n[right] + n[x] - shared))
            found += [(0 if sure[y] else 1, x, int(right[y])) for y in np.flatnonzero(may).tolist()]
        parent = {c: c for c in set(component.tolist())}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        out = []
        for unsure, x, y in sorted(found):
            a, b = root(int(component[x])), root(int(component[y]))
            if a != b:
                out.append(sorted((int(node[x]), int(node[y]))))
                if not unsure:
                    parent[a] = b
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    return compare


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    both = pairs.join(right, "b").join(left, "a").withColumn("shared", shared)
    return both.where(100 * F.col("shared") >= percent * (F.size("of_a") + F.size("of_b") - F.col("shared"))).select("a", "b")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = BAND_ROWS
) -> DataFrame:
    """Group documents (doc_id, text) whose shingle sets have a Jaccard similarity of ``percent`` / 100 or more.

    Returns per row of ``docs``: doc_id, n_shingles (the size of its set),
    component_id (the smallest doc_id that links lead to, its own included)
    and kept (whether that is its own). Words are runs of characters other
    than blanks, A-Z lower-cased. A text with fewer words than a shingle is one
    shingle. A null, empty or blank text has the empty set and links to
    nothing. Equal texts form one component whatever their number. Rows that
    repeat a doc_id are one document: what one links to, all do, and all have
    the same kept. A null doc_id has a null component_id and is kept, and
    nothing is linked through it. Other columns are not looked at; an empty
    table gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    with small_batches(docs.sparkSession):
        sketched = durable(docs.mapInArrow(sketcher(width, bands, rows), SKETCH), "sketched")
    some = sketched.where("doc_id is not null and n_shingles > 0")
    classes = durable(
        some.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    links = _links(docs, classes, width, percent)
    # A doc_id that stands on rows of different texts links their classes.
    repeated = some.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x != y").select("doc_id")
    if repeated.limit(1).count():
        at = some.join(repeated, "doc_id").select("doc_id", "digest").distinct().join(classes.select("digest", "node"), "digest")
        links = links.union(at.select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    found = components(links)
    named = durable(
        classes.select("digest", "node")
        .join(found, "node", "left")
        .select("digest", F.coalesce("component", "node").alias("component_id")),
        "named",
    )
    out = sketched.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), own))
    return out.select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, of each group of near-duplicates one, with all their columns."""
    found = durable(near_duplicates(docs, width, percent).select("doc_id", "kept"), "groups")
    rows = rows_without_keys(docs, durable(found.where("not kept").select("doc_id").distinct(), "dropped"), "doc_id")
    if found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():  # rows that repeat an id
        one = rows.where("doc_id is not null").dropDuplicates(["doc_id"])
        rows = one.union(rows.where("doc_id is null"))
    return rows


def _links(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between classes that connect all that are similar."""
    buckets = classes.select("node", "n", F.explode("bands").alias("key"))
    shared = durable(
        buckets.groupBy("key").agg(F.min(F.struct("node", "n")).alias("centre"), F.max("node").alias("other")).where("centre.node != other").drop("other"),
        "shared",
    )
    members = durable(buckets.join(shared, "key"), "members")
    involved = durable(members.select(F.col("node").alias("doc_id")).distinct(), "involved")
    sets = rows_with_keys(docs, involved, "doc_id").mapInArrow(set_writer(width), "node bigint, shingles array<bigint>, short binary")
    with small_batches(docs.sparkSession):
        sets = durable(sets, "sets")
    if sets.groupBy("node").count().where("count > 1").limit(1).count():  # rows that repeat an id
        sets = durable(sets.distinct(), "distinct_sets")

    fits = _alike(F.col("centre.n"), F.col("n"), percent) & (F.col("node") != F.col("centre.node"))
    star = members.where(fits).select(F.col("centre.node").alias("a"), F.col("node").alias("b")).distinct()
    links = durable(_verified(star, sets, percent), "links")

    found = components(links)
    placed = members.join(found, "node", "left").select(
        "key", "node", "n", F.col("centre.node").alias("centre"), F.coalesce("component", "node").alias("component")
    )
    placed = durable(placed, "placed")
    spread = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members"))
    spread = durable(spread.where("lo != hi").select("key", F.ceil(F.col("members") / BLOCK).alias("blocks")), "spread")
    apart = placed.join(spread, "key").select("key", "node", "n", "component", "blocks")
    details = classes.select("node", "bands").join(sets.select("node", "short"), "node")
    apart = apart.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    apart = apart.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    apart = apart.select("key", "node", "n", "component", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    pairs = apart.join(details, "node").groupBy("key", "i", "j").applyInArrow(comparer(percent), "a bigint, b bigint")
    more = durable(_verified(durable(pairs.distinct(), "apart_pairs"), sets, percent), "more_links")
    return links.union(more)
