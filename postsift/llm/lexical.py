"""Ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items make one automaton, which goes to every task. Each term
is guarded: it stands between two separators, and in a document every
separator becomes that same one, so that a match is a whole term and never a
part of a longer one. A scan feeds the documents' bytes through the automaton,
which names the term at each match; term frequencies are counted from that,
and no index of the documents is built. The automaton's outputs map to items
by a list of (item, repeats) for each term.

One scan sums up the counts of the corpus, a second one scores: each task
keeps the best documents of every item among its own, and only those are
shuffled. Both scans hold a part of a text at a time, however long it is.

Items are dealt to automata by their size, so that an automaton is bounded
however many items there are; each has scans of its own.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsift.llm.words import Words, slices, small_batches
from postsift.sources.durable import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 10
ITEM_BYTES = 1 << 20  # of item texts in one automaton, on average; a node takes some 40 bytes
SCAN = 1 << 19  # bytes given to the automaton at a time
CELLS = 1 << 20  # scores (document by item) worked out at a time
SALTS = 256  # parts in which the best of an item are merged before its last ranking
GUARD = 0x20
SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@dataclass(frozen=True)
class Items:
    """Items of one automaton. Terms are numbered; those of term ``t`` are the entries
    ``first[t]`` to ``first[t + 1]`` of ``item`` (its number) and ``repeats``."""

    ids: list[int | None]
    terms: list[bytes]
    first: np.ndarray
    item: np.ndarray
    repeats: np.ndarray


def read_items(rows: list[tuple[int | None, str | None]]) -> Items:
    """Rows that repeat an item_id are one item with the terms of all of them."""
    ids: dict[int | None, int] = {}
    held: dict[bytes, dict[int, int]] = {}
    for item_id, text in rows:
        number = ids.setdefault(item_id, len(ids))
        for term in TERM.findall((text or "").translate(LOWER)):
            of = held.setdefault(term.encode(), {})
            of[number] = of.get(number, 0) + 1
    terms = sorted(held)
    first = np.cumsum([0] + [len(held[t]) for t in terms])
    item = np.array([i for t in terms for i in held[t]], np.int64)
    repeats = np.array([n for t in terms for n in held[t].values()], np.int64)
    return Items(list(ids), terms, first, item, repeats)


def automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    """Finds guarded terms in bytes read as Latin-1, and gives their numbers."""
    out = ahocorasick.Automaton()
    guard = chr(GUARD)
    for number, term in enumerate(terms):
        out.add_word(guard + term.decode("latin-1") + guard, number)
    out.make_automaton()
    return out


def _matches(machine: ahocorasick.Automaton, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """End offsets and terms of all matches, a window at a time; windows meet at a separator, which both hold."""
    guards = np.flatnonzero(data == GUARD)
    start = 0
    while start < len(data) - 1:
        stop = int(guards[min(len(guards) - 1, np.searchsorted(guards, start + SCAN))])
        if stop <= start:
            break
        found = np.fromiter(machine.iter(data[start : stop + 1].tobytes().decode("latin-1")), dtype=[("end", np.int64), ("term", np.int64)])
        yield found["end"] + start, found["term"]
        start = stop


class Scan:
    """Of a batch of texts: how many terms each has, and which terms of the automaton how often."""

    def __init__(self, terms: list[bytes]):
        self.words = Words(SEPARATORS, lower=True)
        self.machine = automaton(terms) if terms else None
        self.size = max(1, len(terms))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each text; then text, term and frequency of what was matched."""
        runs = self.words(texts, hashed=False)
        n = np.diff(runs.first)
        if self.machine is None or not len(runs.starts):
            none = np.zeros(0, np.int64)
            return n, none, none, none
        plain = np.where(self.words.is_word[runs.data], runs.data, GUARD).astype(np.uint8)
        shift = np.arange(1, len(n) + 1)  # a guard goes before every text, and one behind the last
        data = np.insert(plain, runs.offsets, GUARD)
        starts = runs.offsets[:-1] + shift
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for ends, terms in _matches(self.machine, data):
            owner = np.searchsorted(starts, ends - 1, "right") - 1
            found, counts = np.unique(owner * self.size + terms, return_counts=True)
            if len(keys) and len(found) and found[0] <= keys[-1]:  # a text goes on in this window
                keys, back = np.unique(np.concatenate([keys, found]), return_inverse=True)
                sums = np.bincount(back, np.concatenate([sums, counts]), len(keys)).astype(np.int64)
            else:
                keys, sums = np.concatenate([keys, found]), np.concatenate([sums, counts])
        return n, keys // self.size, keys % self.size, sums


def counter(terms: list[bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of a task: a row (term, documents with it); of the corpus -1 (documents with a term) and -2 (all terms)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, documents, total = Scan(terms), 0, 0
        df = np.zeros(len(terms), np.int64)
        for batch in slices(batches, "text"):
            n, _, term, _ = scan(batch.column("text"))
            documents += int((n > 0).sum())
            total += int(n.sum())
            df += np.bincount(term, minlength=len(terms))[: len(terms)]
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-1, -2], seen])), pa.array(np.concatenate([[documents, total], df[seen]]))], names=["term", "n"]
        )

    return count


class Best:
    """The k best documents of every item so far: higher score first, then smaller doc_id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows = np.zeros((3, 0), np.int64)  # item, score, doc_id
        self.least = np.ones(items, np.int64)  # a score below this is not among them

    def add(self, scores: np.ndarray, doc_ids: np.ndarray) -> None:
        """``scores`` by item and document."""
        item, doc = np.nonzero(scores >= self.least[:, None])
        rows = np.concatenate([self.rows, np.stack([item, scores[item, doc], doc_ids[doc]])], axis=1)
        rows = rows[:, np.lexsort((rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], np.arange(len(self.least) + 1))
        rank = np.arange(rows.shape[1]) - first[rows[0]]
        self.rows = rows[:, rank < self.k]
        full = rank == self.k - 1
        self.least[rows[0, full]] = rows[1, full]


def scorer(items: Items, weights: np.ndarray, documents: int, total: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best documents of every item among those of a task."""
    lengths = np.diff(items.first)

    def points(lo: int, n: np.ndarray, text: np.ndarray, term: np.ndarray, tf: np.ndarray, out: np.ndarray) -> None:
        """Add up scores of the given matches, of texts from ``lo`` on, into ``out`` (item by document)."""
        m = 100 - 75 + (75 * n[text] * documents) // total
        value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        size = lengths[term]
        entry = np.repeat(items.first[term] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        np.add.at(out, (items.item[entry], np.repeat(text - lo, size)), np.repeat(value, size) * items.repeats[entry])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, best = Scan(items.terms), Best(len(items.ids), k)
        width = max(1, CELLS // max(1, len(items.ids)))
        for batch in slices(batches, "text"):
            n, text, term, tf = scan(batch.column("text"))
            doc_ids = batch.column("doc_id").to_numpy()
            for lo in range(0, len(n) if len(text) else 0, width):
                i, j = np.searchsorted(text, [lo, lo + width])
                out = np.zeros((len(items.ids), min(width, len(n) - lo)), np.int64)
                while i < j:  # so many matches that their entries stay within bounds, or one
                    upto = max(i + 1, int(np.searchsorted(np.cumsum(lengths[term[i:j]]), CELLS, "right")) + i)
                    points(lo, n, text[i:upto], term[i:upto], tf[i:upto], out)
                    i = upto
                best.add(out, doc_ids[lo : lo + width])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in best.rows], names=["item", "score", "doc_id"])

    return score


def _searched(docs: DataFrame, items: Items, k: int) -> DataFrame:
    counts = docs.select("text").mapInArrow(counter(items.terms), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {r["term"]: r["n"] for r in counts.collect()}  # a row for each term of the automaton
    documents, total = counts.get(-1, 0), counts.get(-2, 0)
    df = [counts.get(t, 0) for t in range(len(items.terms))]
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df], np.int64)
    named = docs.where("doc_id is not null").select("doc_id", "text")
    found = named.mapInArrow(scorer(items, weights, documents, total, k), "item bigint, score bigint, doc_id bigint")
    names = docs.sparkSession.createDataFrame(list(enumerate(items.ids)), "item bigint, item_id bigint")
    return durable(found.join(F.broadcast(names), "item").select("item_id", "doc_id", "score"), "found")


def lexical_search(docs: DataFrame, items: DataFrame, k: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ``k`` highest-scoring documents (doc_id, text) for each item (item_id, text).

    Returns item_id, rank (from 1), doc_id and score: a BM25 weight in whole
    numbers, as in :func:`scorer`. Terms are runs of letters and digits of
    ASCII and of all characters beyond; only A-Z is lower-cased. Equal scores
    are ranked by ascending doc_id. A null or empty text has no term: such a
    document counts for nothing, such an item finds nothing, as does one none
    of whose terms occurs. Rows that repeat a doc_id are documents of their
    own, each with a rank. A document without doc_id counts in the statistics
    and is not returned. Rows that repeat an item_id, null as well, are one
    item with the terms of all of them. Other columns are not looked at; an
    empty table on either side gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    items = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // item_bytes
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(parts)))
    found = []
    with small_batches(docs.sparkSession):
        for part in range(parts):
            held = dealt.where(F.col("part") == part).select("item_id", "text").collect()  # some item_bytes of text
            found.append(_searched(docs, read_items([tuple(r) for r in held]), k))
    best = reduce(DataFrame.union, found)
    order = [F.desc("score"), F.col("doc_id")]
    salted = best.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    some = salted.withColumn("place", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).where(F.col("place") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
