from collections import Counter
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from postsift.operators import ranking
from postsift.operators import sampling as R


def labelled(spark, normal, toxic, parts=3):
    rows = [(i, 0) for i in range(normal)] + [(normal + i, 1) for i in range(toxic)]
    return spark.createDataFrame(rows, "id long, label int").repartition(parts)


def counts(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize(
    "normal, toxic, keep, extra",
    [(100, 10, 22, 88), (20, 10, 30, 0), (21, 10, 22, 9), (10, 100, 22, 88), (5, 0, 0, 5)],
)
def test_balance(spark, normal, toxic, keep, extra):
    done = counts(R.balance(labelled(spark, normal, toxic), "id", 3), "part")
    assert (done[("keep",)], done[("extra",)]) == (keep, extra)


def test_balance_is_by_hash_whatever_the_partitions(spark):
    kept = {r.id for r in R.balance(labelled(spark, 100, 10), "id", 3).where("label = 0 and part = 'keep'").collect()}
    by_hash = sorted(range(100), key=lambda i: md5(f"3:{i}".encode()).hexdigest())
    assert kept == set(by_hash[:12])
    again = R.balance(labelled(spark, 100, 10, parts=7), "id", 3).where("label = 0 and part = 'keep'")
    assert kept == {r.id for r in again.collect()}


def test_split(spark):
    df = labelled(spark, 100, 10)
    done = R.split_task(df, 0.8, "id", 3)
    assert counts(done, "split") == {("train",): 17, ("test",): 93}
    assert sorted(r.id for r in done.collect()) == list(range(110))
    assert counts(done.where("split = 'train'"), "label") == {(0,): 9, (1,): 8}


@pytest.mark.parametrize(
    "sizes, p, quotas",
    [({0: 12, 1: 10}, 0.8, {0: 9, 1: 8}), ({0: 3, 1: 3}, 0.5, {0: 2, 1: 1}), ({0: 0, 1: 0}, 0.5, {0: 0, 1: 0}), ({0: 7, 1: 5}, 1.0, {0: 7, 1: 5})],
)
def test_train_quotas(sizes, p, quotas):
    assert R.train_quotas(sizes, p) == quotas


def test_sample_takes_the_first_by_key(spark):
    df = labelled(spark, 50, 20).unionByName(spark.createDataFrame([(999, None), (998, 7)], "id long, label int"))
    done = R.sample_per_class(df, 5.9, "id")
    assert sorted(r.id for r in done.collect()) == [0, 1, 2, 3, 4, 50, 51, 52, 53, 54]
    assert R.sample_per_class(df, "all", "id").count() == 72
    assert R.sample_per_class(df, 30, "id").count() == 50
    assert R.sample_per_class(df, 0, "id").count() == 0


def test_sample_by_negative_numbers_and_by_strings(spark):
    numbers = spark.createDataFrame([(i, 0) for i in range(-50, 50)], "id long, label int")
    assert sorted(r.id for r in R.sample_per_class(numbers, 60, "id").collect()) == list(range(-50, 10))
    words = [f"{'é' * (i % 3)}{i}" for i in range(90)]
    df = spark.createDataFrame([(w, 0) for w in words], "id string, label int")
    expected = sorted(words, key=lambda w: w.encode())[:40]
    assert sorted(r.id for r in R.sample_per_class(df, 40, "id").collect()) == sorted(expected)


def test_long_shared_prefixes_take_no_more_passes(spark, monkeypatch):
    """Two written tables whatever the keys are, and the exact first rows."""
    written = []
    plain = ranking.durable
    monkeypatch.setattr(ranking, "durable", lambda df, name: written.append(name) or plain(df, name))
    for prefix in ("", "the same opening of every post, again and again " * 4):
        rows = [(f"{prefix}{i % 90:03d}", i % 2, i) for i in range(300)]
        df = spark.createDataFrame(rows, "key string, label int, n int")
        written.clear()
        for n in (1, 7, 100):
            taken = R.sample_per_class(df, n, "key").collect()
            for v in (0, 1):
                expected = sorted(r[0] for r in rows if r[1] == v)[:n]
                assert sorted(r.key for r in taken if r.label == v) == expected
        assert len(written) <= 3 * 3


def test_hot_group_of_copies(spark, monkeypatch):
    """A third of the rows are copies of one: the right number is taken."""
    monkeypatch.setattr(ranking, "COPIES_PER_ROW", 7)
    rows = [(5, 0, "same")] * 100 + [(i + 10, 0, "x") for i in range(100)] + [(i, 1, "y") for i in range(100)]
    df = spark.createDataFrame(rows, "id long, label int, data string")
    marked = ranking.mark_first(df, {0: 60, 1: 30}, [ranking.key_order(df, "id"), ranking.row_order(df)])
    assert counts(marked.where("id = 5 and data = 'same'"), "taken") == {(True,): 60, (False,): 40}
    assert marked.count() == 300
    assert counts(marked.where("label = 1"), "taken") == {(True,): 30, (False,): 70}
    split = R.split_task(df, 0.5, "id", 1)
    assert split.count() == 300
    assert counts(split, "split") == {("train",): 150, ("test",): 150}


def test_shuffle_and_concat(spark):
    df = labelled(spark, 40, 10)
    order = [r.id for r in R.shuffle(df, "id", 9).collect()]
    assert order == sorted(range(50), key=lambda i: md5(f"9:{i}".encode()).hexdigest())
    assert R.concat(df, df.select("label", "id")).count() == 100


def test_marking_shuffles_no_rows(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    plan = R.split_task(df, 0.8, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_sample_filter_reaches_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    done = R.sample_per_class(df, 5, "doc_id")
    assert "LessThanOrEqual(doc_id" in done._jdf.queryExecution().executedPlan().toString()
    assert done.count() == 10


def test_null_keys_are_not_lost(spark):
    rows = [(None, 0)] * 3 + [(i, 0) for i in range(30)] + [(i, 1) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, label int")
    assert R.split_task(df, 0.5, "id").count() == 38
    assert R.balance(df, "id").count() == 38


@pytest.mark.parametrize("kind", ["long", "string"])
def test_null_keys_come_first_in_a_sample(spark, kind):
    rows = [(None, 0, str(i)) for i in range(4)] + [(i, 0, "x") for i in range(6)]
    df = spark.createDataFrame(rows, "id long, label int, data string").withColumn("id", F.col("id").cast(kind))
    for n in (0, 2, 4, 7, 10, 11):
        done = R.sample_per_class(df, n, "id").collect()
        assert len(done) == min(n, 10)
        assert sum(r.id is None for r in done) == min(n, 4)
    blank = df.unionByName(spark.createDataFrame([("", 0, "blank")], "id string, label int, data string")) if kind == "string" else df
    assert R.sample_per_class(blank, 5, "id").count() == 5


def test_split_all(spark):
    sets = R.split_all({"spam": labelled(spark, 10, 10), "hatespeech": labelled(spark, 30, 10)}, 0.5, "id")
    assert {t: df.where("split = 'train'").count() for t, df in sets.items()} == {"spam": 10, "hatespeech": 11}
