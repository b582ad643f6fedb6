import itertools
import random
import re

import numpy as np
import pytest

from postsift.llm import superminhash as s


def shingles(text, width):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return set()
    return {tuple(found[i : i + width]) for i in range(max(1, len(found) - width + 1))}


def brute(docs, width, percent):
    sets = {}
    for i, text in docs:
        sets.setdefault((i, text), shingles(text, width))
    parent = {i: i for i, _ in docs if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, sa), (b, sb) in itertools.combinations([(k[0], v) for k, v in sets.items() if k[0] is not None and v], 2):
        if 100 * len(sa & sb) >= percent * len(sa | sb):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in parent}, sets


def check(spark, rows, width, percent):
    expected, sets = brute(rows, width, percent)
    got = s.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), width, percent).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == (expected[r.doc_id], r.doc_id == expected[r.doc_id])
            assert r.n_shingles in {len(v) for k, v in sets.items() if k[0] == r.doc_id}
    return got


def mutated(rng, base, p):
    return " ".join(f"z{rng.randrange(10_000)}" if rng.random() < p else x for x in base.split())


@pytest.mark.parametrize("width", [2, 5])
def test_against_brute_force(spark, width, monkeypatch):
    monkeypatch.setattr(s, "BLOCK", 8)
    rng = random.Random(width)
    rows = []
    for family in range(6):
        base = " ".join(f"f{family}_{rng.randrange(500)}" for _ in range(120))
        rows += [mutated(rng, base, rng.choice([0, 0.01, 0.03, 0.06, 0.1])) for _ in range(25)]
    rng.shuffle(rows)
    check(spark, list(enumerate(rows)), width, 80)


def test_edges(docs, no_docs, spark):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(spark, rows, 2, 80)
    assert s.near_duplicates(no_docs).count() == 0
    one = s.one_of_each(docs)
    assert one.columns == docs.columns
    ids = [r.doc_id for r in one.collect()]
    assert sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 5, 8, 9, 10, 11, 12, 13, 14] and ids.count(None) == 2


def test_one_id_on_two_texts_links_both(spark):
    a, b = " ".join(f"a{i}" for i in range(80)), " ".join(f"b{i}" for i in range(80))
    rows = spark.createDataFrame([(5, a), (5, b), (3, a), (9, b)], "doc_id bigint, text string")
    assert {(r.doc_id, r.component_id) for r in s.near_duplicates(rows).collect()} == {(5, 3), (3, 3), (9, 3)}


def test_signatures_estimate_similarity_and_do_not_depend_on_company():
    rng = np.random.default_rng(1)
    shared, own = rng.integers(0, 1 << 63, 700, dtype=np.uint64), rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    a, b = np.unique(shared), np.unique(np.concatenate([shared, own]))
    both = s.signatures([a, np.zeros(0, np.uint64), b], 512)
    assert abs((both[0] == both[2]).mean() - 0.7) < 0.08
    assert (both[0] == s.signatures([a], 512)[0]).all()
    parts = np.minimum(s.signatures([a[:300]], 512), s.signatures([a[300:]], 512))
    assert (parts[0] == both[0]).all()
    # Every slot of a single element is a place of one permutation.
    one = s.signatures([a[:1]], 64)[0]
    assert sorted((one >> np.uint64(32)).tolist()) == list(range(64))
