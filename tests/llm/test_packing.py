import random
import re
from collections import Counter, defaultdict

from postsift.llm import packing as p


def key(text):
    return tuple(re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()))


def check(rows, got, capacity, per_source):
    clusters = {}
    for i, text, source in rows:
        clusters.setdefault((i, source, len(key(text))), key(text))
    whole, bins = Counter(), defaultdict(list)
    for r in got:
        whole[(r.doc_id, r.source, r.copy)] += r.size
        assert (r.bin_id is None) == (r.size == 0)
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    assert Counter((str(i), str(s), n) for (i, s, _), n in whole.items()) == Counter((str(i), str(s), len(key(t))) for i, t, s in rows)
    sizes = {(r.doc_id, r.source, r.copy): whole[(r.doc_id, r.source, r.copy)] for r in got}
    for held in bins.values():
        assert sum(r.size for r in held) <= capacity
        assert max(Counter(r.source for r in held).values()) <= per_source
        texts = Counter(clusters[(r.doc_id, r.source, sizes[(r.doc_id, r.source, r.copy)])] for r in held)
        assert max(texts.values()) == 1
    for held in _by_doc(got).values():
        at = 0
        for r in sorted(held, key=lambda r: r.piece):
            assert r.first_word == at
            at += r.size


def _by_doc(got):
    out = defaultdict(list)
    for r in got:
        out[(r.doc_id, r.source, r.copy)].append(r)
    return out


def test_bins_are_whole_and_free_of_conflicts(spark):
    rng = random.Random(5)
    rows = [(i, f"d{i if i % 3 else 0} " + "w " * rng.randrange(400), f"s{i % 5 if i % 2 else 0}") for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = p.packed(df, capacity=300, per_source=2, shard_docs=150).collect()
    check(rows, got, 300, 2)
    again = p.packed(df.repartition(5), capacity=300, per_source=2, shard_docs=150).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_tightest_compatible_bin(monkeypatch):
    """Each piece goes where a search over all bins would put it."""
    rng = random.Random(9)
    for _ in range(30):
        bins, plain = p.Bins(50, 2), []
        for _ in range(200):
            size, source, cluster = rng.randrange(1, 51), 1 << rng.randrange(4), rng.choice([0, 0, 1, 2, 4])
            fits = [
                (50 - sum(s for s, _, _ in held) - size, n)
                for n, held in enumerate(plain)
                if sum(s for s, _, _ in held) + size <= 50 and not any(c & cluster for _, _, c in held) and sum(x == source for _, x, _ in held) < 2
            ]
            number = bins.put(size, source, cluster)
            assert number == (min(fits)[1] if fits else len(plain))
            if number == len(plain):
                plain.append([])
            plain[number].append((size, source, cluster))


def test_edges(docs, no_docs):
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    check(rows, p.packed(docs, capacity=1000, per_source=1).collect(), 1000, 1)
    assert p.packed(no_docs).count() == 0
