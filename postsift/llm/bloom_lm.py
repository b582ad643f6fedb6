"""Language-model scores from a log-frequency Bloom filter.

The filter holds, for each n-gram seen ``c`` times in training, the pairs
(n-gram, 1) ... (n-gram, 1 + floor(log2 c)). How often an n-gram was seen is
found by probing level after level until one is missing; a false positive can
raise a count by one level, and never lowers it. Every part of the filter has
BITS_PER_ENTRY bits for each pair it holds, so it grows with the distinct
n-grams of the corpus, and copies of texts take no room. Up to FILTER_BITS it
is broadcast; beyond, n-grams of runs of texts go to the parts of the filter
that they fall in, and their levels come back.

Counting: tasks hash and count the n-grams of their texts in runs, and send
the counts, packed, to the task that owns the hash range. That task merges
them and sets the bits of its part of the filter.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.llm.words import Runs, Words, mixed, slices, small_batches
from postsift.sources.durable import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILTER_BITS = 1 << 26  # 8 MB: the largest filter that is broadcast; a larger one stays in parts
CHUNK = 8 << 20  # bytes of texts that ask for their n-grams together, if the filter is not broadcast
BITS_PER_ENTRY = 10
LEAST_BITS = 1 << 10  # of a part of the filter
PROBES = 4
HEAD_TOKENS = 1_000_000  # exact counts broadcast (12 bytes each); those of rarer tokens are joined
PART_TOKENS = 1 << 20  # training tokens for each part of the filter
RUN_TOKENS = 1 << 21  # tokens that a task counts before it sends them
CONTEXT_MASS = 200.0  # weight of the unigram estimate within a context, in tokens

START = np.uint64(0x5851F42D4C957F2D)
END = np.uint64(0x14057B7EF767814F)
ORDER = np.uint64(0x9FB21C651E98DF25)
GOLDEN = 0x9E3779B97F4A7C15
PACKED = "part int, kind int, hashes binary, counts binary"
MERGED = "part int, size bigint, bits binary, tokens array<bigint>, counts array<bigint>"
CHUNKED = "chunk bigint, rid bigint, doc_id bigint, held_out boolean, text string"
PROBES_SENT = "chunk bigint, part int, hashes binary"
LEVELS = "chunk bigint, part int, levels binary"
SCORED = (
    "rid bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
    "score double, rare_tokens array<bigint>, rare_counts array<int>"
)


def with_ends(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts with an end after each text, their contexts, and the text that each belongs to."""
    docs = len(first) - 1
    ends = first[1:] + np.arange(docs)
    tokens = np.empty(len(hashes) + docs, np.uint64)
    is_word = np.ones(len(tokens), bool)
    is_word[ends] = False
    tokens[is_word], tokens[ends] = hashes, END
    context = np.concatenate([[START], tokens[:-1]]) if docs else tokens
    context[ends[:-1] + 1] = START
    return tokens, context, np.repeat(np.arange(docs), np.diff(first) + 1)


def pair_hash(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mixed(context * ORDER + token)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def level_positions(hashes: np.ndarray, level: int, bits: int | np.ndarray) -> Iterator[np.ndarray]:
    """The places, within its part of the filter (of ``bits`` bits), that stand for an n-gram at a level, by the first 48 bits of its hash."""
    bits = np.asarray(bits, np.uint64)
    h = mixed((hashes >> np.uint64(16)) + np.uint64(level * GOLDEN % (1 << 64)))
    one, two = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    for i in range(PROBES):
        yield (one + np.uint64(i) * two) % bits


def short(hashes: np.ndarray) -> bytes:
    """The first 48 bits of sorted hashes, which are all that the filter looks at: a byte with the width, the first, and the steps."""
    first = hashes >> np.uint64(16)
    steps = np.diff(first).astype("<u8")
    width = max(1, -(-int(steps.max(initial=0)).bit_length() // 8))
    return bytes([width]) + first[:1].astype("<u8").tobytes() + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def long(packed: pa.BinaryScalar) -> np.ndarray:
    """Hashes out of ``short``; their other bits are 0."""
    data = np.frombuffer(packed.as_buffer(), np.uint8)
    width = int(data[0])
    steps = np.pad(data[9:].reshape(-1, width), ((0, 0), (0, 8 - width))).view("<u8").ravel()
    return np.cumsum(np.concatenate([data[1:9].copy().view("<u8"), steps]), dtype=np.uint64) << np.uint64(16)


def counter(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def packed(kind: int, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Tokens with all of their hash, pairs with 48 bits; counts as bytes if they all fit."""
        hashes = np.concatenate(held)
        hashes, counts = np.unique(hashes if kind == 1 else hashes & ~np.uint64(0xFFFF), return_counts=True)
        counts = counts.astype(np.uint8 if counts.max() < 256 else np.uint32)
        part = part_of(hashes, parts)
        cut = np.flatnonzero(np.diff(part)) + 1
        rows = [
            (int(part[s]), kind, hashes[s:e].tobytes() if kind == 1 else short(hashes[s:e]), counts[s:e].tobytes())
            for s, e in zip([0, *cut], [*cut, len(hashes)], strict=True)
        ]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["part", "kind", "hashes", "counts"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ones, twos, size = Words(lower=True), [], [], 0
        for batch in slices(batches, "text"):
            runs = words(batch.column("text"))
            tokens, context, _ = with_ends(runs.hashes, runs.first)
            ones.append(tokens)
            twos.append(pair_hash(context, tokens))
            size += len(tokens)
            if size >= RUN_TOKENS:
                yield from packed(1, ones)
                yield from packed(2, twos)
                ones, twos, size = [], [], 0
        if size:
            yield from packed(1, ones)
            yield from packed(2, twos)

    return count


def merge(table: pa.Table) -> pa.Table:
    """One part of the filter, and the counts of its tokens, out of what tasks counted."""
    kinds = table.column("kind").to_numpy()
    seen = {}
    for kind in (1, 2):
        sent, counted = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
        for i in np.flatnonzero(kinds == kind):
            packed, n = table.column("hashes")[int(i)], table.column("counts")[int(i)].as_buffer()
            sent.append(np.frombuffer(packed.as_buffer(), np.uint64) if kind == 1 else long(packed))
            counted.append(np.frombuffer(n, np.uint8 if n.size == len(sent[-1]) else np.uint32))
        hashes, counts = np.concatenate(sent), np.concatenate(counted)
        hashes, where = np.unique(hashes, return_inverse=True)
        seen[kind] = hashes, np.bincount(where, counts, len(hashes)).astype(np.int64)
    entries = sum(int(np.frexp(counts)[1].sum()) for _, counts in seen.values())  # an n-gram has a pair for each bit of its count
    bits = max(LEAST_BITS, BITS_PER_ENTRY * entries)
    bits += -bits % 64
    field = np.zeros(bits, bool)
    for hashes, counts in seen.values():
        level = 1
        while len(hashes):
            for places in level_positions(hashes, level, bits):
                field[places] = True
            stay = counts >= 1 << level
            hashes, counts, level = hashes[stay], counts[stay], level + 1
    return pa.table(
        {
            "part": pa.array([table.column("part")[0].as_py()], pa.int32()),
            "size": pa.array([bits], pa.int64()),
            "bits": pa.array([np.packbits(field, bitorder="little").tobytes()], pa.binary()),
            "tokens": pa.array([seen[1][0].view(np.int64)], pa.list_(pa.int64())),
            "counts": pa.array([seen[1][1]], pa.list_(pa.int64())),
        }
    )


@dataclass
class Shared:
    """What each executor gets: the filter, part after part, exact counts of frequent tokens, and totals."""

    field: np.ndarray | None  # None if too large to be broadcast
    parts: int
    starts: np.ndarray  # the first bit of each part, and the end of the last
    head: np.ndarray
    head_counts: np.ndarray
    whole: bool  # whether the head holds every token
    total: int
    distinct: int
    texts: int


def levels_of(field: np.ndarray, start: np.ndarray, bits: np.ndarray, hashes: np.ndarray, most: int) -> np.ndarray:
    """The highest level, at most ``most``, at which each n-gram is found among its part's ``bits`` bits from ``start`` on; 0 if at none."""
    found = np.zeros(len(hashes), np.uint8)
    live, level = np.arange(len(hashes)), 1
    while len(live) and level <= most:
        hit = np.ones(len(live), bool)
        for places in level_positions(hashes[live], level, bits[live]):
            places = places + start[live]
            byte = field[(places >> np.uint64(3)).astype(np.int64)]
            hit &= (byte >> (places & np.uint64(7)).astype(np.uint8)) & 1 == 1
        live = live[hit]
        found[live] = level
        level += 1
    return found


def estimates(levels: np.ndarray, total: int) -> np.ndarray:
    """The middle of each level's counts; no n-gram is seen more often than there are tokens."""
    level = levels.astype(np.float64)
    return np.where(level > 0, np.minimum((2.0 ** (level - 1) + 2.0**level - 1) / 2, total), 0.0)


def probed(shared: Shared, hashes: np.ndarray) -> np.ndarray:
    """About how often each n-gram was seen, by the broadcast filter."""
    part = part_of(hashes, shared.parts).astype(np.int64)
    start = shared.starts[part]
    levels = levels_of(shared.field, start, shared.starts[part + 1] - start, hashes, shared.total.bit_length())
    return estimates(levels, shared.total)


def scored_texts(batch: pa.RecordBatch, runs: Runs, shared: Shared, counted: Callable[[np.ndarray], np.ndarray]) -> pa.RecordBatch:
    """The scores of a batch of texts; ``counted`` tells about how often n-grams were seen."""
    tokens, context, doc = with_ends(runs.hashes, runs.first)
    n = batch.num_rows
    room = shared.total + 0.1 * (shared.distinct + 1)
    seen, which = np.unique(tokens, return_inverse=True)
    spot = np.minimum(np.searchsorted(shared.head, seen), max(0, len(shared.head) - 1))
    found = shared.head[spot] == seen if len(shared.head) else np.zeros(len(seen), bool)
    exact = np.where(found, shared.head_counts[spot], 0) if len(shared.head) else np.zeros(len(seen), np.int64)
    settled = (found | shared.whole)[which]
    base = np.bincount(doc, np.where(settled, np.log10((exact + 0.1) / room)[which], 0.0), n)
    known = np.bincount(doc, (exact > 0)[which], n).astype(np.int64)
    rare, many = np.unique(doc[~settled] * len(seen) + which[~settled], return_counts=True)
    rare_first = np.searchsorted(rare // max(1, len(seen)), np.arange(n + 1)).astype(np.int32)
    rare_hash = seen[rare % max(1, len(seen))].view(np.int64)

    ones = counted(seen)[which]
    begins = context == START
    before = np.concatenate([[0.0], ones[:-1]]) if n else ones
    before[begins] = shared.texts
    alone = (ones + 0.1) / room
    both = np.zeros(len(tokens))
    live = np.flatnonzero((ones > 0) & (before > 0))  # an n-gram is seen no more often than its parts
    pairs, back = np.unique(pair_hash(context[live], tokens[live]), return_inverse=True)
    both[live] = np.minimum(counted(pairs)[back], np.minimum(ones[live], before[live]))
    chance = (both + CONTEXT_MASS * alone) / (before + CONTEXT_MASS)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("rid"),
            batch.column("doc_id"),
            batch.column("held_out"),
            pa.array(np.diff(runs.first) + 1, pa.int64()),
            pa.array(known, pa.int64()),
            pa.array(base, pa.float64()),
            pa.array(np.bincount(doc, np.log10(chance), n), pa.float64()),
            pa.ListArray.from_arrays(pa.array(rare_first), pa.array(rare_hash)),
            pa.ListArray.from_arrays(pa.array(rare_first), pa.array(many.astype(np.int32))),
        ],
        names=[c.split()[0] for c in SCORED.split(", ")],
    )


def scorer(share: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shared = Words(lower=True), Shared(*share.value)
        for batch in slices(batches, "text"):
            yield scored_texts(batch, words(batch.column("text")), shared, lambda hashes: probed(shared, hashes))

    return score


def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Runs of some CHUNK bytes of texts, named by their first rid, piece by piece; where they end does not depend on the batches."""
    chunk, number, upto = 0, -1, 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        numbers = (upto + np.cumsum(sizes) - sizes) // CHUNK
        upto += int(sizes.sum())
        cut = np.flatnonzero(np.diff(numbers)) + 1
        for s, e in zip([0, *cut], [*cut, len(numbers)], strict=True):
            if s == e:
                continue
            if numbers[s] != number:
                chunk, number = batch.column("rid")[int(s)].as_py(), numbers[s]
            yield chunk, batch.slice(int(s), int(e - s))


def chunker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the run that they belong to."""
    for chunk, batch in chunks_of(batches):
        texts = batch.column("text").cast(pa.string())
        columns = [pa.array(np.full(batch.num_rows, chunk)), *(batch.column(c) for c in ("rid", "doc_id", "held_out")), texts]
        yield pa.RecordBatch.from_arrays(columns, names=["chunk", "rid", "doc_id", "held_out", "text"])


def ngrams(runs: Runs) -> np.ndarray:
    """The distinct tokens and pairs of texts, in order."""
    tokens, context, _ = with_ends(runs.hashes, runs.first)
    return np.unique(np.concatenate([tokens, pair_hash(context, tokens)]))


def asker(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The n-grams of each run of texts, packed by the part of the filter that they fall in."""

    def packed(chunk: int, found: list[np.ndarray]) -> pa.RecordBatch:
        hashes = np.unique(np.concatenate(found))
        part = part_of(hashes, parts)
        cut = np.flatnonzero(np.diff(part)) + 1
        first = np.array([0, *cut])
        sent = [short(hashes[s:e]) for s, e in zip(first, [*cut, len(hashes)], strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk] * len(first), pa.int64()), pa.array(part[first].astype(np.int32)), pa.array(sent, pa.binary())],
            names=["chunk", "part", "hashes"],
        )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, found, now = Words(lower=True), [], 0
        for chunk, piece in chunks_of(batches):
            if found and chunk != now:
                yield packed(now, found)
                found = []
            now = chunk
            found.extend(ngrams(words(batch.column("text"))) for batch in slices(iter([piece]), "text"))
        if found:
            yield packed(now, found)

    return ask


def answerer(most: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The levels of the n-grams that fall in one part of the filter."""

    def answer(asked: pa.Table, model: pa.Table) -> pa.Table:
        packed = []
        for sent in asked.column("hashes"):
            hashes = long(sent)
            if model.num_rows:
                field = np.frombuffer(model.column("bits")[0].as_buffer(), np.uint8)
                bits = np.full(len(hashes), 8 * len(field), np.uint64)
                packed.append(levels_of(field, np.zeros(len(hashes), np.uint64), bits, hashes, most).tobytes())
            else:
                packed.append(bytes(len(hashes)))
        return pa.table({"chunk": asked.column("chunk"), "part": asked.column("part"), "levels": pa.array(packed, pa.binary())})

    return answer


def chunk_scorer(share: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The scores of runs of texts, each behind the levels that came back for its n-grams, part after part."""

    def scores(words: Words, shared: Shared, levels: list[np.ndarray], texts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = [(batch, words(batch.column("text"))) for batch in slices(iter(texts), "text")]
        hashes = np.unique(np.concatenate([ngrams(runs) for _, runs in cut]))
        found = np.concatenate([np.zeros(0, np.uint8), *levels])
        if len(found) != len(hashes):
            raise RuntimeError(f"{len(hashes)} n-grams of a run of texts, but levels of {len(found)}")
        for batch, runs in cut:
            yield scored_texts(batch, runs, shared, lambda asked: estimates(found[np.searchsorted(hashes, asked)], shared.total))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shared = Words(lower=True), Shared(*share.value)
        now, levels, texts = None, [], []
        for batch in batches:
            chunks = batch.column("chunk").to_numpy()
            cut = np.flatnonzero(np.diff(chunks)) + 1
            for s, e in zip([0, *cut], [*cut, len(chunks)], strict=True):
                if s == e:
                    continue
                if texts and chunks[s] != now:
                    yield from scores(words, shared, levels, texts)
                    levels, texts = [], []
                now, piece = chunks[s], batch.slice(int(s), int(e - s))
                is_text = pc.is_valid(piece.column("rid"))
                levels.extend(np.frombuffer(x.as_buffer(), np.uint8) for x in piece.column("levels").filter(pc.invert(is_text)))
                rows = piece.filter(is_text)
                if rows.num_rows:
                    texts.append(rows)
        if texts:
            yield from scores(words, shared, levels, texts)

    return score


def scored_by_parts(docs: DataFrame, model: DataFrame, shared: Shared, share: Broadcast) -> DataFrame:
    """The scores by a filter that is too large to be broadcast, as a table. The texts are written once, so that both looks at them cut the same runs."""
    docs = durable(docs, "texts")
    with small_batches(docs.sparkSession):
        asked = docs.select("rid", "text").mapInArrow(asker(shared.parts), PROBES_SENT)
        answers = asked.groupBy("part").cogroup(model.groupBy("part")).applyInArrow(answerer(shared.total.bit_length()), LEVELS)
        both = answers.unionByName(docs.mapInArrow(chunker, CHUNKED), allowMissingColumns=True)
        runs = both.repartition("chunk").sortWithinPartitions("chunk", F.col("rid").asc_nulls_first(), "part")
        return durable(runs.mapInArrow(chunk_scorer(share), SCORED), "scored")


def fit(train: DataFrame, head_tokens: int = HEAD_TOKENS, filter_bits: int = FILTER_BITS) -> tuple[Shared, DataFrame]:
    """The filter and totals of the training texts, and the exact count of each token, as (token, c)."""
    return fitted(train, head_tokens, filter_bits)[:2]


def fitted(train: DataFrame, head_tokens: int, filter_bits: int) -> tuple[Shared, DataFrame, DataFrame]:
    """As ``fit``, and the filter's parts as (part, bits)."""
    size = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // (6 * PART_TOKENS)))
    packed = train.select("text").mapInArrow(counter(parts), PACKED)
    with small_batches(train.sparkSession):
        model = durable(packed.groupBy("part").applyInArrow(merge, MERGED), "ngrams")
    counts = model.select(F.explode(F.arrays_zip("tokens", "counts")).alias("t")).select(
        F.col("t.tokens").alias("token"), F.col("t.counts").alias("c")
    )
    end = F.max(F.when(F.col("token") == int(END.view(np.int64)), F.col("c")))
    total, distinct, texts = counts.agg(F.sum("c"), F.count("*"), end).first()
    # The least count at which the tokens are few enough to be broadcast.
    by_size = counts.groupBy(F.floor(F.log2("c")).alias("size")).count().orderBy(F.desc("size")).collect()
    least, held = 1, 0
    for row in by_size:
        held += row["count"]
        if held > head_tokens:
            least = 1 << (row["size"] + 1)
            break
    head = counts.where(F.col("c") >= least).toArrow()
    tokens, seen = (head.column(i).to_numpy().astype(np.int64) for i in (0, 1))
    order = np.argsort(tokens.view(np.uint64))
    field, starts = None, np.zeros(0, np.uint64)
    if (model.agg(F.sum("size")).first()[0] or 0) <= filter_bits:
        starts = np.zeros(parts + 1, np.uint64)
        for row in model.select("part", "size").toLocalIterator():
            starts[row["part"] + 1] = row["size"]
        starts = np.cumsum(starts, dtype=np.uint64)
        field = np.zeros(max(1, int(starts[-1]) // 8), np.uint8)
        for row in model.select("part", "bits").toLocalIterator():  # the filter is bounded; a file at a time spares the driver a second copy
            at = int(starts[row["part"]]) // 8
            field[at : at + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
    shared = Shared(
        field, parts, starts, tokens.view(np.uint64)[order], seen[order].astype(np.uint32 if not len(seen) or seen.max() < 1 << 32 else np.int64),
        least == 1, total or 0, distinct or 0, texts or 0,
    )
    return shared, counts, model.select("part", "bits")


def lm_scores(docs: DataFrame, head_tokens: int = HEAD_TOKENS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Score the texts of documents (doc_id, text) by a bigram model of the training part.

    In training are the rows whose crc32 of the doc_id as text, mod 10, is not
    0; a null doc_id counts as the empty text, so it is held out. Tokens are
    the runs of characters other than blanks, A-Z lower-cased, and an end
    after each text. A null or empty text is an end alone.

    Returns per row: doc_id, held_out, n_tokens, n_known (tokens seen in
    training), train_tokens, base_score (the exact add-0.1 unigram log10
    probability) and score (the model's log10 probability: bigram counts out
    of the Bloom filter, smoothed by the unigram estimate with a mass of
    CONTEXT_MASS tokens). Repeated rows score alike, each counts in training.
    With nothing to train on, all counts are 0. Other columns are not looked
    at; an empty table gives an empty table.
    """
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    docs = docs.select(F.col("doc_id").cast("bigint"), held.alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shared, counts, model = fitted(docs.where("not held_out"), head_tokens, filter_bits)
    room = shared.total + 0.1 * (shared.distinct + 1)
    plain = tuple(getattr(shared, f.name) for f in fields(shared))  # so that executors need no class of ours to read it
    share = docs.sparkSession.sparkContext.broadcast(plain)
    rows = docs.withColumn("rid", F.monotonically_increasing_id())
    broadcast = shared.field is not None
    scored = rows.mapInArrow(scorer(share), SCORED) if broadcast else scored_by_parts(rows, model, shared, share)
    out = ["doc_id", "held_out", "n_tokens", "n_known", F.lit(shared.total).cast("bigint").alias("train_tokens"), "base_score", "score"]
    if shared.whole:
        return scored.select(out)
    if broadcast:
        scored = durable(scored, "scored")
    rare = scored.select("rid", F.explode(F.arrays_zip("rare_tokens", "rare_counts")).alias("r"))
    rare = rare.select("rid", F.col("r.rare_tokens").alias("token"), F.col("r.rare_counts").alias("n")).join(counts, "token", "left")
    c = F.coalesce("c", F.lit(0))
    sums = rare.groupBy("rid").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more"), F.sum(F.col("n") * F.log10((c + 0.1) / room)).alias("rest")
    )
    both = scored.drop("rare_tokens", "rare_counts").join(sums, "rid", "left")
    return both.withColumns(
        {"n_known": F.col("n_known") + F.coalesce("more", F.lit(0)), "base_score": F.col("base_score") + F.coalesce("rest", F.lit(0.0))}
    ).select(out)
