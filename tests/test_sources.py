import pytest

from postsift.operators.naive_bayes import fit_nb
from postsift.operators.rows import with_tokens
from postsift.plans.moderate import moderate
from postsift.sources import durable
from postsift.sources import posts as IO
from postsift.streaming.posts import stream_posts, write_stream

TEXTS = ['plain', 'with "quotes", and commas', "two\nlines", "back\\slash \\", "émoji 😁", "'edge'", "  spaces  ", "cr\r\nlf", "tab\tbed", "", None]


def test_csv_holds_every_text(spark, tmp_path):
    df = spark.createDataFrame([(t, i % 2, str(i)) for i, t in enumerate(TEXTS)], IO.STORY_SCHEMA)
    path = IO.write_task(df, str(tmp_path), "spam", "test_set")
    assert path.endswith("/only_spam_test_set")
    back = IO.read_posts(spark, path)
    # an empty field is a null, as it is for the tools that write such files
    assert {r.story_id: r.data for r in back.collect()} == {str(i): t or None for i, t in enumerate(TEXTS)}
    assert back.select("label", "story_id").exceptAll(df.select("label", "story_id")).count() == 0
    assert IO.write_task(df, str(tmp_path), "spam").endswith("/only_spam")
    stories = IO.read_stories(spark, path)
    assert stories.columns[-2:] == ["prediction", "probability"]
    assert stories.where("prediction is not null or probability is not null").count() == 0


def test_a_file_as_written_by_other_tools(spark, tmp_path):
    (tmp_path / "in.csv").write_text('data,label\n"say ""hi"", now",1\n"two\nlines",0\n', encoding="utf8")
    rows = IO.read_task(spark, str(tmp_path / "in.csv")).collect()
    assert [tuple(r) for r in rows] == [('say "hi", now', 1), ("two\nlines", 0)]


def test_normalised_texts_need_no_multi_line(spark, tmp_path):
    df = IO.from_texts(spark, TEXTS[:-1]).drop("prediction", "probability")
    df.write.options(**IO.CSV_WRITE_OPTIONS).csv(str(tmp_path / "out"))
    back = IO.read_posts(spark, str(tmp_path / "out"), schema="data string", multi_line=False)
    assert sorted(back.collect()) == sorted(df.collect())


def test_fused_and_split(spark, tmp_path):
    df = spark.createDataFrame([("a", "train"), ("b", "test")], "data string, split string")
    for fmt in ("csv", "parquet"):
        path = IO.write_split(df, str(tmp_path / fmt), "spam", fmt)
        back = IO.read_posts(spark, path, fmt, df.schema)
        assert sorted(map(tuple, back.collect())) == [("a", "train"), ("b", "test")]
    path = IO.write_fused(df, str(tmp_path), "parquet")
    assert path.endswith("/all_toxicity") and spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        IO.read_posts(spark, path, "xml")


def test_texts(spark):
    rows = IO.from_texts(spark, ["Hi there!", "x", ""]).collect()
    assert [tuple(r) for r in rows] == [("hi there ! ", None, None)]


def test_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    assert IO.spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == cores
    wide = spark.range(0, 100, 1, cores + 3)
    assert IO.spread(wide) is wide


def test_durable(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    kept = durable.durable(df, "kept")
    assert kept.schema == df.schema and [tuple(r) for r in kept.collect()] == [(1, "a")]
    assert kept.inputFiles()[0].removeprefix("file://").startswith(durable.shared_folder(spark))


def test_a_stream_gets_the_verdicts_of_a_batch(spark, tmp_path):
    train = spark.createDataFrame([("cheap pills", 1), ("lovely walk", 0)], "data string, label int")
    model = fit_nb(with_tokens(train))
    models = dict.fromkeys(("spam", "hatespeech", "selfharm"), model)
    posts = spark.createDataFrame([("Cheap!", 0, "1"), ("A walk", 0, "2")], IO.STORY_SCHEMA)
    posts.write.parquet(str(tmp_path / "in"))
    stream = moderate(stream_posts(spark, str(tmp_path / "in")), models)
    write_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, moderate(posts, models).collect()))
