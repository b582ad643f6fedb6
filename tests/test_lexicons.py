"""Lexicons of any size, the map of known tokens, and tasks trained together."""

import math

import pytest
from pyspark.sql import functions as F

from postsift.operators.linear import Linear, LinearConfig
from postsift.operators.naive_bayes import NaiveBayes, fit_nb, fit_nb_chunks, known_tokens, log_odds
from postsift.operators.scorers import fit_lexicon, lexicon_sentiment
from postsift.plans.moderate import moderate
from postsift.plans.train import fit_all_tasks


def test_map_of_known_tokens(spark):
    cold = spark.range(20_000).select(F.concat(F.lit("w"), "id").alias("token"))
    known = known_tokens(cold)
    asked = spark.range(40_000).select("id", F.concat(F.lit("w"), "id").alias("token")).where(known(F.col("token")))
    counts = asked.agg(F.count_if(F.col("id") < 20_000).alias("own"), F.count_if(F.col("id") >= 20_000).alias("other")).first()
    assert counts["own"] == 20_000 and counts["other"] < 2_000
    assert known_tokens(cold.limit(0)) is not None


def test_a_lexicon_beyond_the_bound_scores_like_the_broadcast_one(spark):
    lexicon = {f"w{i}": (i % 7 - 3) / 4 for i in range(500)}
    rows = [(i, [f"w{(i * 31 + j * j) % 900}" for j in range(i % 30)]) for i in range(120)] + [(999, None), (998, ["w0", "w0", "none"])]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    frame = spark.createDataFrame(list(lexicon.items()), "token string, weight double")

    def scores(scored):
        assert scored.columns == ["id", "tokens", "sentiment_score"]
        return {r.id: r.sentiment_score for r in scored.collect()}

    expected = scores(lexicon_sentiment(df, lexicon))
    assert expected[999] is None and expected[998] == 2 * lexicon["w0"]
    assert scores(lexicon_sentiment(df, frame)) == expected
    assert scores(lexicon_sentiment(df, frame, broadcast_tokens=3)) == expected


def test_fitted_lexicon(spark):
    rows = [(["good", "sunny"],)] * 8 + [(["bad", "rainy"],)] * 6 + [(["good", "plain"],)] * 5 + [(["bad", "plain"],)] * 5 + [(["sunny"],), (["good", "bad"],)]
    weights = {r.token: r for r in fit_lexicon(spark.createDataFrame(rows, "tokens array<string>"), {"good": 1.0, "bad": -1.0}).collect()}
    base = math.log(14 / 12)
    assert weights["sunny"].weight == pytest.approx(math.log(9) - base) and weights["sunny"].n == 8
    assert weights["rainy"].weight == pytest.approx(-math.log(7) - base)
    assert weights["plain"].weight == pytest.approx(-base)
    with pytest.raises(ValueError, match="known sentiment"):
        fit_lexicon(spark.createDataFrame([(["x"],)], "tokens array<string>"), {"good": 1.0})


def labelled(spark):
    words = (["buy", "now"], ["nice", "walk"])
    rows = [(t, i % 2, [*words[1 - i % 2], f"{t}{i % 9}"]) for t in ("a", "b", "c") for i in range(60)]
    return spark.createDataFrame(rows, "task string, label int, tokens array<string>")


def test_tasks_of_several_kinds_together(spark, tmp_path):
    df = labelled(spark)
    models = fit_all_tasks(df, {"a": "nb", "b": "nb", "c": "linear"}, {"c": LinearConfig(features=256)}, folder=str(tmp_path))
    assert isinstance(models["c"], Linear)
    for t in "ab":
        alone = fit_nb(df.where(F.col("task") == t))
        assert models[t].prior == alone.prior
        assert sorted(map(tuple, models[t].weights.collect())) == sorted(map(tuple, alone.weights.collect()))
    with pytest.raises(ValueError, match="no labelled rows of d"):
        fit_all_tasks(df, {"c": "linear", "d": "linear"}, {t: LinearConfig(features=256, epochs=1) for t in "cd"})


def test_naive_bayes_with_held_out_losses(spark):
    df = labelled(spark)
    model = fit_nb_chunks(df, chunks=3)
    assert isinstance(model, NaiveBayes) and len(model.losses) == 3 and all(0 < v < math.log(2) for v in model.losses)
    assert sorted(map(tuple, model.weights.collect())) == sorted(map(tuple, fit_nb(df).weights.collect()))


def test_a_small_lexicon_is_summed_with_the_models(spark):
    rows = [("good day sun", 1), ("bad rain", 0), ("good good bad word", 1), ("nothing here", 0), (None, 0), ("rare thing bad", 1)]
    df = spark.createDataFrame(rows, "data string, label int").withColumn("tokens", F.split("data", " "))
    model, words = fit_nb(df), {"good": 1, "bad": -0.5, "rare": 0.25, "unseen": 3.0}

    def results(scored, column):
        return {r["data"]: (r["a_log_odds"] and round(r["a_log_odds"], 9), r[column]) for r in scored.collect()}

    expected = results(lexicon_sentiment(log_odds(df, {"a": model}), words), "sentiment_score")
    assert expected["rare thing bad"][1] == -0.25 and expected["nothing here"][1] is expected[None][1] is None
    for most in (1000, 2, 0):  # all tokens broadcast, a few, none
        assert results(log_odds(df, {"a": model}, broadcast_tokens=most, words=words), "__word_sum") == expected
    none = log_odds(df, {"a": model}, words={}).collect()
    assert [r["__word_sum"] for r in none] == [None] * len(rows)


def test_moderation_with_counted_models_takes_one_pass_through_python(spark):
    rows = [("good day sun", 1), ("bad rain", 0), ("good good bad word", 1), ("nothing here", 0)] * 3
    df = spark.createDataFrame(rows, "data string, label int")
    model = fit_nb(df.withColumn("tokens", F.split("data", " ")))
    done = moderate(df.select("data"), dict.fromkeys(("spam", "hatespeech", "selfharm"), model), {"good": 1.0, "bad": -1.0})
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and done.count() == len(rows)
    assert not {"__word_sum", "sentiment_score"} & set(done.columns)
