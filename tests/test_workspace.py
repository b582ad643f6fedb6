from dataclasses import replace

import pytest

from postsift.plans.workspace import Settings, Workspace
from postsift.sources.posts import CSV_WRITE_OPTIONS

WORDS = {
    "spam": ("buy cheap pills offer", "a lovely walk outside"),
    "hatespeech": ("those awful people stink", "nice people all around"),
    "selfharm": ("want to end it tonight", "what a day to live"),
}


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    home = str(tmp_path_factory.mktemp("work"))
    for task, (toxic, normal) in WORDS.items():
        rows = [(f"{toxic} {i}x", 1) for i in range(10)] + [(f"{normal} {i}x, it's ok", 0) for i in range(40)]
        df = spark.createDataFrame(rows, "data string, label int")
        df.write.options(**CSV_WRITE_OPTIONS).csv(f"{home}/tasks/{task}")
    posts = [("buy cheap pills", 1, "a"), ("such awful people", 1, "b"), ("nice people all around here, it is ok", 0, "c")]
    stories = spark.createDataFrame(posts, "data string, label int, story_id string")
    stories.write.options(**CSV_WRITE_OPTIONS).csv(f"{home}/stories")
    settings = {task: Settings("nb") for task in WORDS} | {"hatespeech": Settings("logreg")}
    space = Workspace(spark, *[f"{home}/{d}" for d in ("tasks", "sets", "models", "results", "stories")], settings=settings)
    space.split(0.8, seed=1)
    space.train_all()
    return space


def test_sets(work):
    for task in WORDS:
        train, test = work.load("train_set", task), work.load("test_set", task)
        assert (train.count(), test.count()) == (17, 33)
        assert not {r.data for r in train.collect()} & {r.data for r in test.collect()}
        assert work.load("train_set", task, 3).count() == 6
        assert work.load("train_set", task, 3).columns == ["data", "label"]


def test_first_rows_in_file_order_by_default(work, spark, tmp_path):
    rows = [(f"post {(i * 37) % 100},\n{i}", i % 2) for i in range(100)]
    spark.createDataFrame(rows, "data string, label int").coalesce(1).write.options(**CSV_WRITE_OPTIONS).csv(str(tmp_path / "p"))
    path = str(tmp_path / "p")
    assert sorted(r.data for r in work.load(path, num_samples=5.5).collect()) == sorted(r[0] for r in rows[:10])
    by_text = replace(work, order="data").load(path, num_samples=5)
    assert sorted(r.data for r in by_text.collect()) == sorted(d for v in (0, 1) for d in sorted(r[0] for r in rows if r[1] == v)[:5])


def test_predict_and_evaluate(work):
    done = work.predict("spam")
    assert done.columns == ["data", "label", "spam_pred", "spam_prob"] and done.count() == 33
    assert done.where("spam_pred <> label").count() == 0
    assert done.inputFiles()[0].split("/")[-2] == "only_spam_test_set"
    rows = {r.pred: r for r in work.evaluate("selfharm").collect()}
    assert set(rows) == {"prediction", "selfharm_pred"}
    assert rows["prediction"].accuracy == 1.0
    assert work.evaluate("hatespeech").first().n_00 > 0


def test_moderate(work):
    done = {r.story_id: r for r in work.moderate(save=True).collect()}
    assert done["a"].prediction == "spam" and done["c"].prediction == "0"
    assert done["a"].label == 1
    one = work.moderate(["BUY cheap pills!!"]).collect()
    assert [(r.data, r.prediction) for r in one] == [("buy cheap pills ! ! ", "spam")]
    path = work.moderate(work.stories)
    assert path.count() == 3


def test_train_on_a_frame(work):
    assert work.train("spam", work.load("train_set", "spam")).prior < 0
