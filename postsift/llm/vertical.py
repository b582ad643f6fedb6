"""Jaccard join on word n-grams by vertical partitioning.

A document is the set of its distinct n-grams, as 64-bit hashes; of documents
with equal sets one goes on. All n-grams stand in one global order, the
frequent ones behind the others, and the order is cut into fragments. Each
fragment is worked on by itself: it counts for how many of its n-grams two
documents agree, and these partial overlaps are summed up per pair.

Where that is done:

* Counting, to know the frequent n-grams. A fragment holds its n-grams of all
  documents, as 32-bit remainders.
* Finding pairs. Similar sets agree in several n-grams of their beginnings in
  the global order; their beginnings only go to the fragments. Sums too small
  for the similarity are dropped, all other pairs go on.
* Confirming pairs, on the whole sets: overlaps by fragment, summed.

A pair need not be confirmed if its documents are connected already. So each
document is first confirmed against the one it agrees with most, and what
then still lies apart is compared in a second round. Documents that agree only
in frequent n-grams (there may be thousands of them, all alike) never become
pairs: they are clustered, and the blocks of a cluster that is not yet one
component are compared fragment by fragment with matrices.
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
from postsift.llm.superminhash import shingle_sets
from postsift.llm.words import Words, listed, rows_with_keys, slices, small_batches
from postsift.sources.durable import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Mapped = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

FRAGMENT = 1 << 20  # n-grams of a fragment, about
FREQUENT = 16  # documents that share an n-gram, from which it is frequent
FREQUENT_GRAMS = 1 << 20  # as many go to every task (16 bytes each); with more, the bound above is doubled
SHARE = 20  # of the size of a set, one part more than needed is looked at
PIECES = 4  # fragments of a whole set when pairs are confirmed
BLOCK = 1024  # members of a cluster that are compared with as many others at a time
BLOCK_GRAMS = 1 << 20  # and their n-grams, about
COLUMNS = 4096  # n-grams in a matrix
DENSE = 10_000  # pairs of documents that share an n-gram, from which a matrix is cheaper
SPREAD = 1 << 22  # such pairs listed at a time


def fragment_of(grams: np.ndarray, parts: int) -> np.ndarray:
    """The fragment of each n-gram: ranges of the hash, all of one size."""
    return (((grams >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """N-grams that a set of ``n`` must share with any set that is similar to it."""
    return (percent * n + 99) // 100


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Ids and sets, a slice of texts at a time."""
    words = Words(lower=True)
    for batch in slices(batches, "text"):
        yield batch.column("doc_id"), list(shingle_sets(words(batch.column("text")), width))


def sketcher(width: int) -> Mapped:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets(batches, width):
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary())], names=["doc_id", "n_shingles", "digest"]
            )

    return sketch


def dealer(width: int, parts: int) -> Mapped:
    """All n-grams, by fragment, without their high bits, which the fragment tells."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, width):
            grams = np.sort(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
            at = fragment_of(grams, parts)
            found, first = np.unique(at, return_index=True)
            low = grams.astype(np.uint32)
            held = [low[i:j].tobytes() for i, j in zip(first, [*first[1:], len(low)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(held, pa.binary())], names=["fragment", "grams"])

    return deal


def counted(least: int) -> Callable[[pa.Table], pa.Table]:
    """N-grams of a fragment that stand in ``least`` documents or more."""

    def count(table: pa.Table) -> pa.Table:
        grams = np.sort(np.concatenate([np.frombuffer(b.as_buffer(), np.uint32) for b in table.column("grams")]))
        found, n = np.unique(grams, return_counts=True)
        many = n >= least
        key = (table.column("fragment")[0].as_py() << 32) | found[many].astype(np.int64)
        return pa.table({"gram": pa.array(key), "n": pa.array(n[many].astype(np.int64))})

    return count


def frequent_grams(texts: DataFrame, width: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The frequent n-grams (fragment and low bits), in order, and their numbers of documents."""
    dealt = texts.mapInArrow(dealer(width, parts), "fragment bigint, grams binary")
    with small_batches(texts.sparkSession):
        many = durable(dealt.groupBy("fragment").applyInArrow(counted(FREQUENT), "gram bigint, n bigint"), "frequent")
    sizes = {r["power"]: r["k"] for r in many.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count("*").alias("k")).collect()}
    least = FREQUENT
    while sum(k for power, k in sizes.items() if 1 << power >= least) > FREQUENT_GRAMS:
        least *= 2
    held = many.where(F.col("n") >= least).toArrow()  # at most FREQUENT_GRAMS rows
    gram, n = held.column("gram").to_numpy(), held.column("n").to_numpy()
    order = np.argsort(gram)
    return gram[order], n[order]


class Beginnings:
    """What of a set goes to the fragments: its first n-grams in the global order.

    Sets of s and t n-grams that are similar share at least ``needed`` of the
    larger. Past their beginnings, each has ``needed`` less ``extra`` n-grams;
    so they agree in at least ``extra`` n-grams (of the set with the smaller
    one) within their beginnings, counting both plain and frequent ones.
    """

    def __init__(self, percent: int, parts: int, gram: np.ndarray, n: np.ndarray):
        self.percent, self.parts, self.gram, self.n = percent, parts, gram, n

    def __call__(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The plain and the frequent n-grams of a set's beginning, each in order."""
        size = len(grams)
        upto = min(size, size - needed(size, self.percent) + extra(size))
        if not len(self.gram):
            return grams[:upto], grams[:0]
        key = (fragment_of(grams, self.parts) << 32) | grams.astype(np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.gram, key), len(self.gram) - 1)
        times = np.where(self.gram[at] == key, self.n[at], 0)
        plain = grams[times == 0]
        if len(plain) >= upto:
            return plain[:upto], grams[:0]
        order = np.lexsort((grams, times))
        return plain, grams[order[len(plain) : upto]]


def extra(n: int) -> int:
    return 1 + n // SHARE


def plain_dealer(width: int, begin: Beginnings) -> Mapped:
    """The plain n-grams of all beginnings by fragment, each with its document."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets(batches, width):
            starts = [begin(s)[0] for s in sets]
            grams = np.concatenate(starts) if starts else np.zeros(0, np.uint64)
            nodes = np.repeat(ids.to_numpy(), [len(s) for s in starts])
            order = np.argsort(grams, kind="stable")
            grams, nodes = grams[order], nodes[order]
            found, first = np.unique(fragment_of(grams, begin.parts), return_index=True)
            cuts = list(zip(first, [*first[1:], len(grams)], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array([grams[i:j].tobytes() for i, j in cuts], pa.binary()), pa.array([nodes[i:j].tobytes() for i, j in cuts], pa.binary())],
                names=["fragment", "grams", "nodes"],
            )

    return deal


def frequent_writer(width: int, begin: Beginnings) -> Mapped:
    """Documents whose beginning has frequent n-grams: how many, and the first of them, of which a similar one
    that agrees in no plain n-gram must have one."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets(batches, width):
            rows = [(i, len(s), begin(s)[1]) for i, s in zip(ids.to_pylist(), sets, strict=True)]
            rows = [(i, n, g, g[: max(0, len(g) - extra(needed(n, begin.percent)) + 1)]) for i, n, g in rows if len(g)]
            first = np.cumsum([0] + [len(r[3]) for r in rows])
            flat = np.concatenate([r[3] for r in rows]) if rows else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[2]) for r in rows], pa.int64()), listed(flat.view(np.int64), first)],
                names=["node", "frequent", "grams"],
            )

    return write


def _pair_sums(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
    return a[first], b[first], np.add.reduceat(n, first) if len(a) else n


def partial_overlaps(table: pa.Table) -> pa.Table:
    """Pairs of documents that share n-grams of a fragment, and how many."""
    grams = np.concatenate([np.frombuffer(b.as_buffer(), np.uint64) for b in table.column("grams")])
    nodes = np.concatenate([np.frombuffer(b.as_buffer(), np.int64) for b in table.column("nodes")])
    order = np.argsort(grams, kind="stable")
    grams, nodes = grams[order], nodes[order]
    shared = np.zeros(len(grams), bool)
    shared[1:] = grams[1:] == grams[:-1]
    shared[:-1] |= shared[1:]
    grams, nodes = grams[shared], nodes[shared]
    a, b, n = (np.zeros(0, np.int64) for _ in range(3))
    step = 1
    while step < len(grams):  # no plain n-gram stands in many documents
        same = grams[step:] == grams[:-step]
        if not same.any():
            break
        x, y = nodes[:-step][same], nodes[step:][same]
        a, b, n = _pair_sums(
            np.concatenate([a, np.minimum(x, y)]), np.concatenate([b, np.maximum(x, y)]), np.concatenate([n, np.ones(len(x), np.int64)])
        )
        step += 1
    return pa.table({"a": a, "b": b, "shared": n})


def segment_writer(width: int) -> Mapped:
    """Whole sets, a row for each fragment."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets(batches, width):
            sizes = np.array([np.bincount(fragment_of(s, PIECES), minlength=PIECES) for s in sets], np.int64).reshape(-1)
            nodes = np.repeat(ids.to_numpy(), PIECES)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(np.tile(np.arange(PIECES), len(sets))), listed(flat.view(np.int64), np.concatenate([[0], np.cumsum(sizes)]))],
                names=["node", "piece", "grams"],
            )

    return write


def _similar(shared: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * shared >= percent * (n + m - shared)


def _alike(n: Column, m: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar at all."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def confirmed(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b, n, m), with the sizes of their sets, those that are similar."""
    left = segments.select(F.col("node").alias("a"), "piece", F.col("grams").alias("of_a"))
    right = segments.select(F.col("node").alias("b"), "piece", F.col("grams").alias("of_b"))
    pieces = pairs.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(PIECES - 1).cast("bigint"))))
    overlaps = pieces.join(right, ["b", "piece"]).join(left, ["a", "piece"]).withColumn("shared", F.size(F.array_intersect("of_a", "of_b")))
    sums = overlaps.groupBy("a", "b", "n", "m").agg(F.sum("shared").alias("shared"))
    return sums.where(_similar(F.col("shared"), F.col("n"), F.col("m"), percent)).select("a", "b")


def overlaps_of(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each of the left sets shares with each of the right: those that many have by
    matrices, a run of columns at a time, the others by listing who has them."""

    def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])

    out = np.zeros((len(left), len(right)), np.int32)
    (gl, rl), (gr, rr) = flat(left), flat(right)
    both = np.intersect1d(gl, gr)
    keep_l, keep_r = np.isin(gl, both), np.isin(gr, both)
    cl, rl = np.searchsorted(both, gl[keep_l]), rl[keep_l]
    cr, rr = np.searchsorted(both, gr[keep_r]), rr[keep_r]
    nl, nr = np.bincount(cl, minlength=len(both)), np.bincount(cr, minlength=len(both))
    dense = nl * nr >= DENSE
    column = np.cumsum(dense) - 1
    dl, dr = dense[cl], dense[cr]
    for i in range(0, int(dense.sum()), COLUMNS):
        tables = []
        for c, r, d, rows in ((cl, rl, dl, len(left)), (cr, rr, dr, len(right))):
            at = d & (column[c] >= i) & (column[c] < i + COLUMNS)
            table = np.zeros((rows, min(COLUMNS, int(dense.sum()) - i)), np.float32)
            table[r[at], column[c[at]] - i] = 1
            tables.append(table)
        out += (tables[0] @ tables[1].T).astype(np.int32)
    cl, rl, cr, rr = cl[~dl], rl[~dl], cr[~dr], rr[~dr]
    order = np.argsort(cr, kind="stable")
    cr, rr = cr[order], rr[order]
    lo = np.searchsorted(cr, cl)
    size = np.searchsorted(cr, cl, "right") - lo
    upto = np.cumsum(size)
    i = 0
    while i < len(cl):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + SPREAD, "right")))
        s = size[i:j]
        spots = np.repeat(lo[i:j] - np.concatenate([[0], np.cumsum(s)[:-1]]), s) + np.arange(s.sum())
        np.add.at(out, (np.repeat(rl[i:j], s), rr[spots]), 1)
        i = j
    return out


def block_links(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links between two blocks of a cluster that connect all similar sets of different components."""

    def link(table: pa.Table) -> pa.Table:
        table = table.sort_by([("piece", "ascending"), ("node", "ascending")]).combine_chunks()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        members = table.filter(pa.compute.equal(table.column("piece"), 0))
        node, n, component, block = (members.column(c).to_numpy() for c in ("node", "n", "component", "block"))
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        if not len(left) or not len(right):
            return none
        sums = np.zeros((len(left), len(right)), np.int32)
        grams = table.column("grams").combine_chunks()
        flat, first = grams.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pa.compute.list_value_length(grams).to_numpy())])
        for piece in range(PIECES):
            at = piece * len(node)
            sums += overlaps_of(*([flat[first[at + r] : first[at + r + 1]] for r in rows] for rows in (left, right)))
        ok = (component[left][:, None] != component[right]) & (100 * sums >= percent * (n[left][:, None] + n[right] - sums))
        if i == j:
            ok = np.triu(ok, 1)
        parent = {c: c for c in component.tolist()}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        out = []
        for x, y in zip(*(v.tolist() for v in np.nonzero(ok)), strict=True):
            a, b = root(int(component[left[x]])), root(int(component[right[y]]))
            if a != b:
                parent[a] = b
                out.append(sorted((int(node[left[x]]), int(node[right[y]]))))
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())}) if out else none

    return link


def _plain_pairs(texts: DataFrame, width: int, begin: Beginnings, sizes: DataFrame) -> DataFrame:
    """Pairs (a, b, n, m, shared) that agree in plain n-grams of their beginnings and may be similar."""
    dealt = texts.mapInArrow(plain_dealer(width, begin), "fragment bigint, grams binary, nodes binary")
    partial = dealt.groupBy("fragment").applyInArrow(partial_overlaps, "a bigint, b bigint, shared bigint")
    pairs = partial.groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    of_a = sizes.select(F.col("node").alias("a"), F.col("n"), F.col("frequent").alias("f"))
    of_b = sizes.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("frequent").alias("g"))
    least = 1 + F.floor(F.least("n", "m") / SHARE)
    may = _alike(F.col("n"), F.col("m"), begin.percent) & (F.col("shared") + F.least("f", "g") >= least)
    return pairs.join(of_a, "a").join(of_b, "b").where(may).select("a", "b", "n", "m", "shared")


def _links(texts: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between classes (node, n) that connect all that are similar."""
    total = classes.agg(F.sum("n")).first()[0] or 0
    parts = 1 + total // FRAGMENT
    begin = Beginnings(percent, parts, *frequent_grams(texts, width, parts))
    with small_batches(texts.sparkSession):
        frequent = durable(texts.mapInArrow(frequent_writer(width, begin), "node bigint, frequent bigint, grams array<bigint>"), "frequent_starts")
        sizes = classes.select("node", "n").join(frequent.select("node", "frequent"), "node", "left").fillna(0, ["frequent"])
        pairs = durable(_plain_pairs(texts, width, begin, durable(sizes, "sizes")), "pairs")

    # Members of a bucket are those that share a frequent n-gram; its centre is the smallest of them.
    held = frequent.join(classes.select("node", "n"), "node").select("node", "n", F.explode("grams").alias("gram"))
    centres = held.groupBy("gram").agg(F.min(F.struct("node", "n")).alias("centre"), F.max("node").alias("other")).where("centre.node != other").drop("other")
    star = durable(held.join(centres, "gram").where("node != centre.node").select("node", "n", "centre").distinct(), "star")
    clusters = durable(components(star.select(F.col("centre.node").alias("a"), F.col("node").alias("b"))), "clusters")

    best = pairs.groupBy("b").agg(F.max(F.struct("shared", "a", "n", "m")).alias("at")).select("at.a", "b", "at.n", "at.m")
    near = star.where(_alike(F.col("n"), F.col("centre.n"), percent)).groupBy("node").agg(F.min("centre").alias("centre"), F.first("n").alias("n"))
    near = near.select(F.col("centre.node").alias("a"), F.col("node").alias("b"), F.col("centre.n").alias("n"), F.col("n").alias("m"))
    first = durable(best.union(near).distinct(), "first_pairs")

    clustered = clusters.select("node", "component").union(clusters.select(F.col("component").alias("node"), "component")).distinct()
    named = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).union(clustered.select("node"))
    involved = durable(named.distinct(), "involved")
    with small_batches(texts.sparkSession):
        wanted = rows_with_keys(texts, involved.withColumnRenamed("node", "doc_id"), "doc_id")
        segments = durable(wanted.mapInArrow(segment_writer(width), "node bigint, piece bigint, grams array<bigint>"), "segments")

    links = durable(confirmed(first, segments, percent), "first_links")
    found = components(links)
    at_a, at_b = found.select(F.col("node").alias("a"), F.col("component").alias("x")), found.select(F.col("node").alias("b"), F.col("component").alias("y"))
    rest = pairs.join(first.select("a", "b"), ["a", "b"], "left_anti").join(at_a, "a", "left").join(at_b, "b", "left")
    rest = rest.where(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b", "n", "m")
    links = durable(links.union(confirmed(durable(rest, "second_pairs"), segments, percent)), "links")

    found = components(links)
    placed = clustered.withColumnRenamed("component", "cluster").join(classes.select("node", "n"), "node").join(found, "node", "left")
    placed = durable(placed.select("cluster", "node", "n", F.coalesce("component", "node").alias("component")), "placed")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_GRAMS))
    apart = placed.groupBy("cluster").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), blocks.alias("blocks")).where("lo != hi")
    rows = placed.join(apart.select("cluster", "blocks"), "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    rows = rows.select("cluster", "node", "n", "component", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    more = rows.join(segments, "node").groupBy("cluster", "i", "j").applyInArrow(block_links(percent), "a bigint, b bigint")
    return links.union(durable(more, "block_links"))


def jaccard_groups(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """Group documents (doc_id, text) whose n-gram sets have a Jaccard similarity of ``percent`` / 100 or more.

    Returns per row of ``docs``: doc_id, n_shingles (the size of its set) and
    component_id (the smallest doc_id that links lead to, its own included).
    Words are runs of characters other than blanks, A-Z lower-cased. A text
    with fewer words than an n-gram is one n-gram. A null, empty or blank text
    has the empty set and links to nothing. Equal texts form one component
    whatever their number. Rows that repeat a doc_id are one document: what
    one links to, all do. A null doc_id has a null component_id, and nothing
    is linked through it. Other columns are not looked at; an empty table
    gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    sketch = "doc_id bigint, n_shingles bigint, digest binary"
    with small_batches(docs.sparkSession):
        sketched = durable(docs.mapInArrow(sketcher(width), sketch), "sketched")
    named = sketched.where("doc_id is not null and n_shingles > 0")
    texts, some, owner = docs, named, None
    if named.groupBy("doc_id").count().where("count > 1").limit(1).count():  # rows that repeat an id: they get numbers
        rows = docs.where("doc_id is not null").distinct().withColumn("row", F.monotonically_increasing_id())
        rows = durable(rows, "numbered")
        texts, owner = rows.select(F.col("row").alias("doc_id"), "text"), rows.select("doc_id", "row")
        some = durable(texts.mapInArrow(sketcher(width), sketch), "sketched_rows").where("n_shingles > 0")
    classes = durable(some.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n")), "classes")
    links = _links(rows_with_keys(texts, classes.select(F.col("node").alias("doc_id")), "doc_id"), classes, width, percent)
    if owner is not None:
        numbers = some.join(owner, some["doc_id"] == owner["row"]).select(owner["doc_id"], "row", "digest").join(classes.select("digest", "node"), "digest")
        centre = numbers.groupBy("doc_id").agg(F.min("node").alias("a"))
        links = links.union(numbers.join(centre, "doc_id").select("a", F.col("node").alias("b")))
    found = components(links)
    groups = classes.join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    if owner is not None:  # from numbers back to ids
        least = numbers.join(groups, "digest").groupBy("component_id").agg(F.min("doc_id").alias("least"))
        groups = groups.join(least, "component_id").select("digest", F.col("least").alias("component_id"))
    out = sketched.join(durable(groups, "groups"), "digest", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))
