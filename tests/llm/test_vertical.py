"""The Jaccard join against comparing every document with every other."""

import random
import re

import numpy as np
import pytest

from postsift.llm import vertical
from postsift.llm.vertical import jaccard_groups, overlaps_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def plain(rows, width=4, percent=85):
    sets = [(doc_id, shingles(text, width)) for doc_id, text in rows]
    named = [(d, s) for d, s in sets if d is not None and s]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(named):
        for b, t in named[:i]:
            if 100 * len(s & t) >= percent * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((d, len(s), None if d is None else root(d)) for d, s in sets), key=str)


def found(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def near(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def corpus(seed):
    """Families of edited copies about the threshold, a passage that many share, and texts on their own."""
    rng = random.Random(seed)
    texts = []
    passage = [f"p{i}" for i in range(60)]
    for family in range(12):
        base = [f"f{family}w{rng.randrange(400)}" for _ in range(rng.choice([8, 30, 150]))]
        texts += [near(rng, base, rng.choice([0, 0, 1, 1, 2, 3])) for _ in range(rng.choice([2, 5, 25]))]
    for i in range(60):
        own = [f"o{i}w{j}" for j in range(rng.choice([2, 5, 8, 30]))]
        texts.append(passage + own if i % 2 else own[:1] + passage + own[1:])
    texts += [[f"x{i}w{rng.randrange(50)}" for _ in range(rng.randrange(1, 90))] for i in range(60)]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("seed", "settings"), [(1, {}), (2, {"FRAGMENT": 500, "BLOCK": 7, "COLUMNS": 16, "DENSE": 4, "SPREAD": 50}), (3, {"FREQUENT": 3, "FREQUENT_GRAMS": 100})])
def test_equals_all_pairs(spark, monkeypatch, seed, settings):
    for name, value in settings.items():
        monkeypatch.setattr(vertical, name, value)
    rows = corpus(seed)
    expected = plain(rows)
    assert len({r[2] for r in expected}) < len(expected) - 60
    assert found(jaccard_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))) == expected


def test_edge_cases(docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(jaccard_groups(docs)) == plain(rows)
    assert found(jaccard_groups(no_docs)) == []


def test_rows_that_repeat_an_id_link_their_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(5, a), (7, a + " end"), (7, b), (9, b + " end"), (3, "alone"), (7, b)]
    got = found(jaccard_groups(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert {r[0]: r[2] for r in got} == {5: 5, 7: 5, 9: 5, 3: 3}


@pytest.mark.parametrize("dense", [1, 5, 10_000])
def test_overlaps(monkeypatch, dense):
    monkeypatch.setattr(vertical, "DENSE", dense)
    monkeypatch.setattr(vertical, "COLUMNS", 3)
    monkeypatch.setattr(vertical, "SPREAD", 5)
    rng = np.random.default_rng(dense)
    left, right = ([np.unique(rng.integers(0, 40, rng.integers(0, 20))) for _ in range(9)] for _ in range(2))
    assert overlaps_of(left, right).tolist() == [[len(np.intersect1d(x, y)) for y in right] for x in left]


def test_beginnings_hold_enough_shared_grams():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        s = rng.integers(0, 1 << 63, n).astype(np.uint64)
        t = np.unique(np.concatenate([s[rng.random(n) < 0.95], rng.integers(0, 1 << 63, int(rng.integers(0, 8))).astype(np.uint64)]))
        s = np.unique(s)
        key = (vertical.fragment_of(s, 7) << 32) | s.astype(np.uint32).astype(np.int64)
        gram = np.sort(key[rng.random(len(s)) < 0.4])
        begin = vertical.Beginnings(85, 7, gram, rng.integers(16, 20, len(gram)))
        if 100 * len(np.intersect1d(s, t)) >= 85 * len(np.union1d(s, t)):
            (plain_s, many_s), (plain_t, many_t) = begin(s), begin(t)
            both = len(np.intersect1d(plain_s, plain_t)) + len(np.intersect1d(many_s, many_t))
            assert both >= min(vertical.extra(len(s)), vertical.extra(len(t)))
