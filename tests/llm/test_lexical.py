"""Lexical search against a plain ranking of all documents for all items."""

import math
import re
from collections import Counter

import pyarrow as pa
import pytest

from postsift.llm import lexical
from postsift.llm.lexical import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    counted = [(doc_id, Counter(terms(text)), len(terms(text))) for doc_id, text in docs]
    n_docs, total = sum(n > 0 for _, _, n in counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    wanted = {}
    for item_id, text in items:
        wanted.setdefault(item_id, []).extend(terms(text))
    out = []
    for item_id, held in wanted.items():
        scores = []
        for doc_id, c, n in counted:
            score = 0
            for t in held:
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n * n_docs // total)))
            if score > 0 and doc_id is not None:
                scores.append((-score, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, doc_id) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def items(spark):
    texts = ["w1 w2 w3 W3", "the same line", None, "", "été \U0001f600", "x" * 300_000, "w5-w6_w5", "none_of these", "one", "w1"]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(0, "w7 w8", "clash"), (None, "w9", "clash"), (9, "w1", "clash")]
    return spark.createDataFrame(rows, "item_id bigint, text string, doc_id string")


def test_equals_a_plain_ranking(docs, items):
    expected = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 4)
    assert found(lexical_search(docs, items, 4)) == expected
    assert {r[0] for r in expected} >= {0, 1, 4, 5, 6, 8, 9, None}


def test_many_automata_and_small_windows_give_the_same(docs, items, monkeypatch):
    expected = found(lexical_search(docs, items))
    monkeypatch.setattr(lexical, "SCAN", 64)
    monkeypatch.setattr(lexical, "CELLS", 8)
    assert found(lexical_search(docs, items, item_bytes=50_000)) == expected


def test_terms_are_whole():
    scan = lexical.Scan([b"ab", b"abc", "é".encode()])
    n, text, term, tf = scan(pa.array(["ab abc,AB xab abx", None, "é éé ab", "abc"]))
    assert n.tolist() == [5, 0, 3, 1]
    assert list(zip(text.tolist(), term.tolist(), tf.tolist(), strict=True)) == [(0, 0, 2), (0, 1, 1), (2, 0, 1), (2, 2, 1), (3, 1, 1)]


def test_empty_tables(spark, docs, no_docs, items):
    assert found(lexical_search(no_docs, items)) == []
    assert found(lexical_search(docs, items.limit(0))) == []
    assert lexical_search(no_docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_given_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    expected = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert found(lexical_search(docs, items)) == expected
