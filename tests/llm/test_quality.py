import math
import re
from collections import Counter

from postsift.llm import quality as q

LABELS = "doc_id bigint, quality int, toxic int"


def facts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(again), failed


def check(rows, got):
    expected = sorted((str(i), *facts(text)) for i, text in rows)
    assert expected == sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)


def test_facts(docs, no_docs, spark):
    labels = spark.createDataFrame([(5, 1, 0), (8, 1, 0), (9, 0, 0), (None, 1, 0)], LABELS)
    got = q.quality(docs, labels).collect()
    check([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], got)
    assert q.quality(no_docs, labels).count() == 0
    kept = q.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)


def test_repeated_windows(spark):
    texts = ["a a a a", "a a a", "a b c a b c", "a b c x a b c", "a b c b c a b c", "x y", "p q r s p q r t q r s", "a b c " * 3]
    texts += ["a  b\tc\x0ba\nb c", "1 2 3 4 5 6 2 3 4 5 1 2 3"]
    rows = list(enumerate(texts))
    check(rows, q.quality(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame([], LABELS)).collect())


def test_scores_follow_the_target(spark):
    good, bad = " ".join(f"good{i % 60}" for i in range(300)), " ".join(f"bad{i % 60}" for i in range(300))
    rows = [(i, good if i % 2 else bad) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(10)], LABELS)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = q.quality(docs, labels).collect()
    assert all((r.score > 0.05) if r.doc_id % 2 else (r.score < -0.05) for r in got)
    # The mean over all n-grams of the buckets' log ratios, worked out here.
    weights = q.bucket_weights(docs, q.trusted_ids(labels))
    from pyspark.sql import functions as F

    w = q.words_of(F.lower("text"))
    for r in docs.select("doc_id", q.ngram_buckets(w, F.size(w), q.BUCKETS).alias("b")).collect():
        mean = math.fsum(weights[b] for b in r.b) / len(r.b)
        assert len(r.b) == 599 and math.isclose(mean, next(g.score for g in got if g.doc_id == r.doc_id), rel_tol=1e-9)


def test_without_trusted_documents_only_the_base_decides(spark, docs):
    got = q.quality(docs, spark.createDataFrame([], LABELS)).collect()
    assert all(r.kept != r.base_failed for r in got)
    assert {r.score for r in got} == {0.0, None}


def test_trusted_ids_are_bounded(spark):
    labels = spark.createDataFrame([(i % 50, 1, 0) for i in range(100)] + [(99, 1, 1), (98, 0, 0)], LABELS)
    ids = [r.doc_id for r in q.trusted_ids(labels, 20).collect()]
    assert len(set(ids)) == len(ids) == 20 and max(ids) < 50
