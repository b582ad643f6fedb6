import math
import re
import zlib
from collections import Counter

import numpy as np

from postsift.llm import bloom_lm as m


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or "")) + [None]


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def check(rows, got):
    train = Counter(t for i, text in rows if not held_out(i) for t in tokens(text))
    total, distinct = sum(train.values()), len(train)
    expected = []
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((train[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)
        expected.append((str(i), held_out(i), len(own), sum(train[t] > 0 for t in own), total, round(base, 6)))
    assert sorted(expected) == sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert all(r.score < 0 for r in got)


def test_base_is_exact_and_rare_tokens_are_joined(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    whole, joined = m.lm_scores(docs).collect(), m.lm_scores(docs, head_tokens=50).collect()
    check(rows, whole)
    check(rows, joined)
    assert sorted((str(r.doc_id), r.score) for r in whole) == sorted((str(r.doc_id), r.score) for r in joined)


def test_nothing_to_train_on(spark, no_docs):
    assert m.lm_scores(no_docs).count() == 0
    only = next(i for i in range(100) if held_out(i))
    row = m.lm_scores(spark.createDataFrame([(only, "a b")], "doc_id bigint, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.base_score == 0.0


def test_counts_come_back_within_a_level_and_never_too_small(spark):
    rows = [(i, " ".join(f"t{j}" for j in range(200) for _ in range(1 + (j * j) % 37))) for i in range(30)]
    shared, counts = m.fit(spark.createDataFrame(rows, "doc_id bigint, text string"))
    seen = {r.token: r.c for r in counts.collect()}
    hashes = np.array(list(seen), np.int64).view(np.uint64)
    guess = m.probed(shared, hashes)
    exact = np.array(list(seen.values()))
    level = np.floor(np.log2(exact))
    assert (guess >= (2**level + 2 ** (level + 1) - 1) / 2).all()
    assert (guess <= 2 ** (level + 2)).mean() > 0.98
    assert (m.probed(shared, m.mixed(np.arange(20_000, dtype=np.uint64))) > 0).mean() < 0.1


def test_a_small_filter_is_worse_but_whole(spark, docs):
    got = m.lm_scores(docs, filter_bits=1 << 12).collect()
    check([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], got)


def test_a_filter_beyond_the_broadcast_bound_scores_alike(spark, docs):
    whole, parts = m.lm_scores(docs).collect(), m.lm_scores(docs, filter_bits=1 << 12, head_tokens=50).collect()
    assert sorted((str(r.doc_id), round(r.score, 6), round(r.base_score, 6)) for r in whole) == sorted((str(r.doc_id), round(r.score, 6), round(r.base_score, 6)) for r in parts)


def test_several_parts_score_alike(spark, monkeypatch):
    monkeypatch.setattr(m, "PART_TOKENS", 1000)
    rows = [(i, " ".join(f"t{(i * j * 31 + j) % 3000}" for j in range(300))) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert m.fit(df)[0].parts > 10
    assert {tuple(r) for r in m.lm_scores(df, filter_bits=1).collect()} == {tuple(r) for r in m.lm_scores(df).collect()}


def test_a_full_filter_gives_no_count_above_the_total(spark):
    shared, _ = m.fit(spark.createDataFrame([(1, "a b c"), (2, "a d")], "doc_id bigint, text string"))
    shared.field[:] = 255
    assert (m.probed(shared, m.mixed(np.arange(1000, dtype=np.uint64))) <= shared.total).all()


def test_bigrams_beat_unigrams_on_held_out_text(spark):
    text = "the cat sat on the mat and the dog ran to the cat"
    rows = [(i, text) for i in range(40)]
    for r in m.lm_scores(spark.createDataFrame(rows, "doc_id bigint, text string")).where("held_out").collect():
        assert r.score > r.base_score


def test_many_runs_of_texts_score_alike(spark, docs, monkeypatch):
    whole = m.lm_scores(docs).collect()
    monkeypatch.setattr(m, "CHUNK", 2000)
    monkeypatch.setattr(m, "PART_TOKENS", 1000)
    parts = m.lm_scores(docs, filter_bits=1).collect()
    monkeypatch.setattr(m, "CHUNK", 1 << 30)
    one = m.lm_scores(docs, filter_bits=1).collect()
    assert sorted(map(repr, parts)) == sorted(map(repr, one))
    assert sorted((str(r.doc_id), round(r.base_score, 6), r.n_known) for r in parts) == sorted((str(r.doc_id), round(r.base_score, 6), r.n_known) for r in whole)


def test_runs_do_not_depend_on_batches():
    import pyarrow as pa

    texts = ["x" * (37 * i % 90) for i in range(200)] + [""] * 3 + ["y" * (m.CHUNK + 1), "z"]
    whole = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["rid", "text"])

    def cut(step):
        batches = (whole.slice(i, step) for i in range(0, len(texts), step))
        return [(chunk, rid) for chunk, piece in m.chunks_of(batches) for rid in piece.column("rid").to_pylist()]

    assert cut(1) == cut(7) == cut(1000) and len({c for c, _ in cut(7)}) == 2


def test_sorted_hashes_come_back_with_48_bits():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    for hashes in (rng.integers(0, 1 << 64, n, np.uint64) for n in (1, 2, 50, 300_000, 1_000_000)):
        hashes = np.sort(hashes)
        packed = m.short(hashes)
        assert (m.long(pa.scalar(packed, pa.binary())) == hashes & ~np.uint64(0xFFFF)).all()
    assert len(packed) < 4.001 * len(hashes)
