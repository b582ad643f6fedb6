"""Licence notices in texts, found even with a few edits.

A notice of which ``k`` edits are allowed is split into ``k + 1`` pieces; any
such match holds one of them unchanged (pigeonhole). All texts of a slice are
searched for the pieces at once, and only around hits the regex library looks
for the notice with at most ``k`` edits, and reports edits and span.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.llm.words import Runs, Words, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Everything in ASCII but digits and letters separates words.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

# Phrases that are looked for as they are, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Short notices in words of lower case, their labels and the edits (of bytes) allowed.
NOTICES = [
    ("released under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    ("licensed under the apache license version 2 0", "apache-2", 4),
    ("licensed under cc by nc 4 0", "cc-by-nc", 2),
    ("licensed under cc by 4 0", "cc-by", 1),
    ("licensed under cc by sa 4 0", "cc-by-sa", 2),
    ("creative commons attribution 4 0 international license", "cc-by", 5),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa", 6),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc", 6),
    ("licensed under the gnu general public license version 3", "gpl-3", 5),
    ("licensed under the gnu general public license version 2", "gpl-2", 5),
    ("gnu lesser general public license", "lgpl", 3),
    ("gnu affero general public license", "agpl", 3),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 6),
    ("subject to the terms of the mozilla public license", "mpl", 4),
    ("this is free and unencumbered software released into the public domain", "unlicense", 6),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", 6),
    ("all rights reserved", "all-rights-reserved", 1),
]

# Words of which one edit makes another licence.
CLAUSES = frozenset([b"nc", b"nd", b"sa"])

SPAN = "struct<label: string, first_word: bigint, last_word: bigint, edits: int, similarity: double>"
FOUND = f"doc_id bigint, n_words bigint, places array<struct<label: string, word: bigint>>, spans array<{SPAN}>"


@dataclass(frozen=True)
class Notice:
    text: bytes
    label: str
    edits: int
    pattern: regex.Pattern
    pieces: list[tuple[int, bytes]]  # offset and bytes


def prepared(notices: list[tuple[str, str, int]]) -> list[Notice]:
    out = []
    for words, label, edits in notices:
        text = words.encode()
        cuts = [len(text) * i // (edits + 1) for i in range(edits + 2)]
        pieces = [(a, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        fuzzy = regex.compile(b"(?e)(?:" + regex.escape(text, literal_spaces=True) + b"){e<=%d}" % edits)
        out.append(Notice(text, label, edits, fuzzy, pieces))
    return out


def joined_words(runs: Runs) -> tuple[bytes, np.ndarray]:
    """The words of all texts with one space between, a line end after each text's last word; and where each word starts."""
    sizes = runs.ends - runs.starts
    place = np.concatenate([[0], np.cumsum(sizes + 1)])
    out = np.full(int(place[-1]), 0x20, np.uint8)
    if len(sizes):
        word = np.repeat(np.arange(len(sizes)), sizes)
        inside = np.arange(len(word)) - np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        out[place[word] + inside] = runs.data[runs.starts[word] + inside]
        last = runs.first[1:][np.diff(runs.first) > 0]
        out[place[last] - 1] = 0x0A
    return out.tobytes(), place[:-1]


def hits(text: bytes, needle: bytes) -> Iterator[int]:
    at = text.find(needle)
    while at >= 0:
        yield at
        at = text.find(needle, at + 1)


def exact_places(text: bytes, phrases: dict[bytes, str]) -> list[tuple[int, str]]:
    """Where phrases stand as whole words, and their labels."""
    edge = b" \n"
    return [
        (at, label)
        for phrase, label in phrases.items()
        for at in hits(text, phrase)
        if (at == 0 or text[at - 1] in edge) and text[at + len(phrase)] in edge
    ]


def fuzzy_spans(text: bytes, notices: list[Notice]) -> list[tuple[int, int, int, float, str]]:
    """Spans (start, end, edits, similarity, label) of notices, whole words each, whose numbers and clauses agree with the notice.

    Of overlapping ones the most similar stays, then the longest, then the first.
    """
    found = []
    for notice in notices:
        windows: list[list[int]] = []
        reach = len(notice.text) + notice.edits
        for at in sorted(at - offset for offset, piece in notice.pieces for at in hits(text, piece)):
            low, high = max(0, at - notice.edits), at + reach
            if windows and low <= windows[-1][1]:
                windows[-1][1] = max(windows[-1][1], high)
            else:
                windows.append([low, high])
        for low, high in windows:
            for line_at, line in _lines(text[low:high]):
                for m in notice.pattern.finditer(line):
                    start, end, more = whole_words(text, low + line_at + m.start(), low + line_at + m.end())
                    edits = sum(m.fuzzy_counts) + more
                    if edits <= notice.edits and exact_words(text[start:end]) == exact_words(notice.text):
                        found.append((start, end, edits, 1 - edits / len(notice.text), notice.label))
    kept: list[tuple[int, int, int, float, str]] = []
    cluster: list[tuple[int, int, int, float, str]] = []  # spans that overlap, one with the next
    reach = 0
    for span in sorted(set(found)):
        if span[0] >= reach:
            kept += best_apart(cluster)
            cluster = []
        cluster.append(span)
        reach = max(reach, span[1])
    return sorted(kept + best_apart(cluster))


def best_apart(cluster: list[tuple[int, int, int, float, str]]) -> list[tuple[int, int, int, float, str]]:
    kept: list[tuple[int, int, int, float, str]] = []
    for span in sorted(cluster, key=lambda s: (-s[3], s[0] - s[1], s)):
        if all(span[1] <= k[0] or k[1] <= span[0] for k in kept):
            kept.append(span)
    return kept


def whole_words(text: bytes, start: int, end: int) -> tuple[int, int, int]:
    """A match from word edge to word edge, and the bytes added for that; more than one at either end is no typing error, but another word."""
    edge, added = b" \n", [0, 0]
    while start > 0 and text[start - 1] not in edge and added[0] < 2:
        start, added[0] = start - 1, added[0] + 1
    while end < len(text) and text[end] not in edge and added[1] < 2:
        end, added[1] = end + 1, added[1] + 1
    return start, end, sum(added) if max(added) < 2 else len(text)


def exact_words(text: bytes) -> bytes:
    """The words of a notice in which no edit is allowed but a lost blank: numbers, and clauses of licences."""
    return b"".join(w for w in text.split() if w.isdigit() or w in CLAUSES)


def _lines(text: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    for line in text.split(b"\n"):
        yield at, line
        at += len(line) + 1


def finder(phrases: dict[str, str], notices: list[tuple[str, str, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, fuzzy = Words(SEPARATORS, lower=True), prepared(notices)
        exact = {phrase.encode(): label for phrase, label in phrases.items()}
        for batch in slices(batches, "text"):
            runs = words(batch.column("text"), hashed=False)
            text, starts = joined_words(runs)
            places: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]

            def word_of(at: int, starts=starts) -> int:
                return int(np.searchsorted(starts, at, "right")) - 1

            for at, label in sorted(exact_places(text, exact)):
                word = word_of(at)
                doc = int(np.searchsorted(runs.first, word, "right")) - 1
                places[doc].append({"label": label, "word": word - int(runs.first[doc])})
            for start, end, edits, similarity, label in fuzzy_spans(text, fuzzy):
                word = word_of(start)
                doc = int(np.searchsorted(runs.first, word, "right")) - 1
                begin = int(runs.first[doc])
                spans[doc].append(
                    {"label": label, "first_word": word - begin, "last_word": word_of(end - 1) - begin, "edits": edits, "similarity": similarity}
                )
            place = pa.struct([("label", pa.string()), ("word", pa.int64())])
            span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32()), ("similarity", pa.float64())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(runs.first), pa.int64()),
                    pa.array(places, pa.list_(place)),
                    pa.array(spans, pa.list_(span)),
                ],
                names=["doc_id", "n_words", "places", "spans"],
            )

    return find


def license_spans(docs: DataFrame, phrases: dict[str, str] | None = None, notices: list[tuple[str, str, int]] | None = None) -> DataFrame:
    """Licence notices in documents (doc_id, text).

    Words are runs of characters other than the ASCII ones that are no digit
    or letter; A-Z is lower-cased. Returns per row: doc_id, n_words, places
    (every place where a phrase's words stand one after the other: label and
    number of the first word, from 0) and spans (notices with at most their
    allowed edits: label, first and last word, edits and similarity, which is
    1 - edits / length). A null or empty text has no words and empty lists.
    Repeated rows are scanned each. Other columns are not looked at; an empty
    table gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return docs.mapInArrow(finder(PHRASES if phrases is None else phrases, NOTICES if notices is None else notices), FOUND)


def license_digest(found: DataFrame) -> DataFrame:
    """Of ``license_spans``: counts, labels (sorted, distinct, joined by commas) and the best similarity."""
    exact = F.transform("places", lambda p: p["label"])
    both = F.concat(exact, F.transform("spans", lambda s: s["label"]))
    words = F.transform("places", lambda p: p["word"])
    best = F.array_max(F.transform("spans", lambda s: s["similarity"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(exact)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(both)), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )
