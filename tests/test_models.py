import math
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from postsift.operators import evaluate as A
from postsift.operators import naive_bayes as NB
from postsift.operators.logreg import LogRegConfig, fit_logreg, score_logreg
from postsift.operators.rows import with_tokens
from postsift.operators.scorers import score_arrow, score_sentiment
from postsift.plans.moderate import moderate, score, score_task
from postsift.plans.train import fit_all, fit_task
from postsift.sources.models import load_model, save_model

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TRAIN = [
    ("buy cheap pills now now", 1),
    ("cheap cheap offer buy", 1),
    ("lovely walk in the park", 0),
    ("the park was lovely and quiet", 0),
    ("walk the dog", 0),
]
NEW = ["buy a dog", "cheap cheap park pills", "unknown words", "", None, "the the the", "cheap cheap park pills"]


def brute_force(texts):
    seen = {0: Counter(), 1: Counter()}
    for text, label in TRAIN:
        seen[label].update(text.split())
    vocabulary = set(seen[0]) | set(seen[1])
    total = {c: sum(seen[c].values()) + len(vocabulary) for c in seen}
    prior = math.log(sum(y for _, y in TRAIN) / sum(1 - y for _, y in TRAIN))

    def weight(w):
        return math.log((seen[1][w] + 1) / total[1]) - math.log((seen[0][w] + 1) / total[0])

    return [prior + sum(weight(w) for w in t.split() if w in vocabulary and len(w) > 1) for t in texts]


@pytest.fixture(scope="module")
def train(spark):
    return with_tokens(spark.createDataFrame(TRAIN, "data string, label int"), normalized=True)


@pytest.fixture(scope="module")
def new(spark):
    return with_tokens(spark.createDataFrame(list(enumerate(NEW)), "id int, data string"), normalized=True)


@pytest.mark.parametrize("broadcast_tokens", [NB.BROADCAST_TOKENS, 5, 0])
def test_naive_bayes_against_brute_force(train, new, broadcast_tokens):
    model = NB.fit_nb(train)
    rows = NB.score_nb(new, model, broadcast_tokens=broadcast_tokens).orderBy("id").collect()
    assert len(rows) == len(NEW)
    for text, row in zip(NEW, rows):
        if text is None:
            assert row.log_odds is None
            continue
        expected = brute_force([text])[0]
        assert row.log_odds == pytest.approx(expected)
        assert row.prediction == int(expected > 0)
        assert row.probability == pytest.approx(1 / (1 + math.exp(-abs(expected))))


def test_broadcast_scoring_shuffles_nothing(train, new):
    plan = NB.score_nb(new, NB.fit_nb(train))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_many_copies_of_a_text(spark, train):
    df = with_tokens(spark.createDataFrame([(i, "cheap dog") for i in range(200)], "id int, data string"))
    for bound in (0, 3):
        done = NB.score_nb(df, NB.fit_nb(train), broadcast_tokens=bound)
        assert done.count() == 200
        assert done.select(F.round("log_odds", 9)).distinct().count() == 1


def test_tasks_in_one_pass_are_as_one_by_one(spark, train):
    df = train.withColumns(
        {"other": (1 - F.col("label")).cast("int"), "some": F.when(F.col("data") != "walk the dog", F.col("label"))}
    )
    together = NB.fit_nb_tasks(df, {"a": "label", "b": "other", "c": "some"})
    apart = {t: NB.fit_nb(df.where(F.col(c).isNotNull()), c) for t, c in {"a": "label", "b": "other", "c": "some"}.items()}
    for task in together:
        assert together[task].prior == apart[task].prior
        a, b = ({r.token: round(r.weight, 12) for r in m[task].weights.collect()} for m in (together, apart))
        assert a == b
    scored = NB.score_nb_tasks(df, together)
    for task in together:
        alone = {r.data: r.log_odds for r in NB.score_nb(df, apart[task]).collect()}
        for row in scored.collect():
            assert row[f"{task}_log_odds"] == pytest.approx(alone[row.data])


def test_per_token(train, new):
    model = NB.fit_nb(train)
    whole = {r.id: r for r in NB.score_nb(new, model).collect()}
    for row in NB.score_nb(new, model, per_token=True).collect():
        if row.data:
            assert row.log_odds == pytest.approx(whole[row.id].log_odds / max(1, len(row.tokens)))


def test_fit_and_score_do_not_depend_on_partitions(train, new):
    def results(parts):
        model = NB.fit_nb(train.repartition(parts))
        weights = {r.token: (r.weight, r.n) for r in model.weights.collect()}
        scores = {r.id: r.log_odds for r in NB.score_nb(new.repartition(parts), model).collect()}
        return model.prior, weights, scores

    one, many = results(1), results(7)
    assert one[:2] == many[:2]
    assert one[2] == pytest.approx(many[2])


def test_one_class_only_is_an_error(train):
    with pytest.raises(ValueError, match="both classes"):
        NB.fit_nb(train.where("label = 1"))


def test_logreg(spark, train, new):
    cfg = LogRegConfig(epochs=20, features=1 << 10, reg=0.0)
    model = fit_logreg(train, cfg)
    scored = score_logreg(train, model)
    assert scored.columns == [*train.columns, "prediction", "probability"]
    assert A.accuracy(scored).first().accuracy == 1.0
    assert scored.where("probability < 0.5 or probability > 1").count() == 0
    history = [r.loss for r in A.loss_history(model).orderBy("iteration").collect()]
    assert history[0] > history[-1]


@pytest.mark.parametrize("cap, right", [(None, 40), (256, 20)])
def test_the_cap_belongs_to_the_model(spark, tmp_path, cap, right):
    """The last of 300 words decides; only a model without a cap sees it, saved or not."""
    rows = [(i, " ".join(["word"] * 299 + ["bad" if i % 2 else "fine"]), i % 2) for i in range(40)]
    df = with_tokens(spark.createDataFrame(rows, "id int, data string, label int"))
    model = fit_logreg(df, LogRegConfig(epochs=20, features=1 << 10, max_len=cap))
    save_model(model, str(tmp_path), "spam", spark)
    for m in (model, load_model(str(tmp_path), "spam", spark)):
        assert m.max_len == cap
        assert score(df, m).where("prediction = label").count() == right


def test_large_lexicon(spark):
    lexicon = {f"w{i}": (-1.0 if i % 2 else 1.0) for i in range(20_000)}
    df = with_tokens(spark.createDataFrame([("w1 w3 w2", 0.6), ("w19998 other", 0.6), ("other", 0.6)], "data string, probability double"))
    rows = {r.data: r for r in score_sentiment(df, lexicon).collect()}
    assert [rows[t].sentiment_prediction for t in ("w1 w3 w2", "w19998 other", "other")] == [1, 0, 1]
    assert rows["other"].sentiment_probability == 0.6


@pytest.mark.parametrize("kind", ["nb", "logreg"])
def test_models_come_back_as_saved(spark, train, new, tmp_path, kind):
    model = fit_task(train, kind, LogRegConfig(epochs=5, features=1 << 10), folder=str(tmp_path), task="spam")
    back = load_model(str(tmp_path), "spam", spark)
    for m in (model, back):
        assert score(new, m).columns[-2:] == ["prediction", "probability"]
    a, b = ([tuple(r) for r in score(new.where("data is not null"), m).orderBy("id").select("prediction", F.round("probability", 9)).collect()] for m in (model, back))
    assert a == b


def test_fit_task_options(spark, train):
    with pytest.raises(ValueError, match="unknown model"):
        fit_task(train, "forest")
    with pytest.raises(ValueError):
        save_model(object(), "/tmp", "spam", spark)
    keyed = train.withColumn("id", F.length("data"))
    model = fit_task(keyed, "nb", num_samples=1, key="id")
    assert model.prior == 0.0
    both = fit_all({"spam": train, "hatespeech": train}, {"spam": "nb", "hatespeech": "nb"})
    assert both["spam"].prior == both["hatespeech"].prior


def failing_loader():
    def score(texts):
        if texts.str.contains("bad").any():
            raise RuntimeError("cannot")
        size = texts.str.len().to_numpy(float)
        return np.stack([np.zeros(len(size)), size - 5], axis=1)

    return score


def test_a_failing_row_does_not_take_others_along(spark):
    texts = [f"{'x' * (i % 10)}" for i in range(100)] + ["bad one", None, "bad two"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, data string").coalesce(1)
    rows = score_arrow(df.where("data is not null"), failing_loader).orderBy("id").collect()
    for row in rows:
        if "bad" in row.data:
            assert (row.prediction, row.probability) == (0, 0.0)
            assert row.score_error == "RuntimeError: cannot"
        else:
            assert row.score_error is None
            assert row.prediction == int(len(row.data) > 5)
            assert 0.5 <= row.probability <= 1


def test_wrong_shape_is_a_failure(spark):
    df = spark.createDataFrame([("a",), ("b",)], "data string")
    rows = score_arrow(df, lambda: lambda texts: np.zeros(1)).collect()
    assert all("one row of class scores" in r.score_error for r in rows)


def test_sentiment(spark):
    texts = ["good good bad", "bad bad good", "neither", "good bad", None]
    df = with_tokens(spark.createDataFrame([(i, t, 0.75) for i, t in enumerate(texts)], "id int, data string, probability double"))
    lexicon = {"good": 1.0, "bad": -1.0}
    rows = score_sentiment(df, lexicon).orderBy("id").collect()
    sure = 1 / (1 + math.exp(-1))
    assert [r.sentiment_prediction for r in rows] == [0, 1, 1, 0, 1]
    assert [r.sentiment_probability for r in rows] == pytest.approx([sure, sure, 0.75, 0.5, 0.75])


def test_sentiment_by_a_model(spark):
    df = with_tokens(spark.createDataFrame([("long text", 0.75), ("bad", 0.75)], "data string, probability double"))
    rows = {r.data: r for r in score_sentiment(df, load=failing_loader).collect()}
    assert (rows["long text"].sentiment_prediction, rows["bad"].sentiment_prediction) == (1, 1)
    assert rows["bad"].sentiment_probability == 0.75
    assert rows["long text"].probability == 0.75 and "score_error" not in rows["bad"].asDict()


def test_moderate_with_every_kind_of_model(spark, train):
    nb, logreg = NB.fit_nb(train), fit_logreg(train, LogRegConfig(epochs=5, features=1 << 10))
    df = spark.createDataFrame([("1", "Cheap, cheap pills!"), ("2", "A lovely WALK."), ("3", "x")], "story_id string, data string")
    for models in (
        {"spam": nb, "hatespeech": nb, "selfharm": nb},
        {"spam": nb, "hatespeech": logreg, "selfharm": failing_loader},
        {"spam": failing_loader, "hatespeech": nb, "selfharm": logreg},
    ):
        rows = {r.story_id: r for r in moderate(df, models).collect()}
        assert set(rows) == {"1", "2"}
        assert rows["1"].data == "cheap , cheap pills ! "
        assert all(r.prediction in ("0", "spam", "hatespeech", "selfharm") for r in rows.values())
    assert rows["1"].prediction == "spam"
    raw = moderate(df, {"spam": nb, "hatespeech": nb, "selfharm": nb}, normalize=False)
    assert {r.data for r in raw.collect()} == {"Cheap, cheap pills!", "A lovely WALK.", "x"}
    with pytest.raises(ValueError, match="no model for selfharm"):
        moderate(df, {"spam": nb, "hatespeech": nb})
    with pytest.raises(ValueError):
        score(df, 5)


def test_score_task(spark, train):
    nb = NB.fit_nb(train)
    df = spark.createDataFrame([("cheap pills", None, None)], "data string, prediction string, probability double")
    assert score_task(df, nb, "spam").columns == ["data", "spam_pred", "spam_prob"]
    done = score_task(df, nb, "selfharm")
    assert {"prediction", "probability", "sentiment_prediction", "selfharm_pred", "selfharm_prob"} <= set(done.columns)


def test_evaluation(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1)], "label int, prediction int")
    assert A.accuracy(df).first().accuracy == 0.75
    assert [tuple(r) for r in A.confusion(df).orderBy("label").collect()] == [(0, 1, 1), (1, 0, 2)]
    assert [tuple(r) for r in A.confusion(df.where("label = 1")).orderBy("label").collect()] == [(0, 0, 0), (1, 0, 2)]
    assert {r.label: r.n for r in A.class_counts(df).collect()} == {0: 2, 1: 2}


def test_joins_of_cold_tokens_do_not_carry_the_texts(train, new):
    done = NB.score_nb(new, NB.fit_nb(train), per_token=True, broadcast_tokens=2).select("id", "log_odds")
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "tokens#" not in plan.split("Relation")[0] and "data#" not in plan.split("Relation")[0]


def test_a_model_of_millions_of_tokens_is_broadcast(spark):
    wide = spark.range(2_000_000).select(F.concat(F.lit("a-longish-token"), "id").alias("token"), F.lit(1.0).alias("t"), F.lit(1).alias("n"))
    assert NB._split_by_frequency(wide, 3, NB.BROADCAST_TOKENS)[1] is None


def test_long_batches_are_summed_in_slices(monkeypatch):
    keys = np.array([[5, 9, 7], None, [], [9, 9, 1, 2, 3, 5], [8]], object)
    lists = pa.array(list(keys), pa.list_(pa.int64()))
    known, weights = np.array([5, 9]), np.array([[1.0, 10.0, 0.0]])
    for most in (1, 4, 1000):
        monkeypatch.setattr(NB, "AT_ONCE", most)
        sums, rest = NB.sum_by_list(lists, lambda flat: NB.find_keys(flat.to_numpy(), known), weights, lambda flat: flat.to_numpy() != 2)
        assert sums.to_pylist() == [[11.0], [0.0], [0.0], [21.0], [0.0]]
        assert rest.to_pylist() == [[7], [], [], [1, 3], [8]]
        assert all(sum(len(s or ()) for s in some.to_pylist()) <= max(most, 6) for some in NB.some_at_a_time(lists))
