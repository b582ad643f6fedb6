import pytest

from postsift.functions.scores import argmax_confidence, softmax, verdict_message
from postsift.operators import fusion as E
from postsift.operators.rows import cast_prediction, default_columns, rename_result, result_view

SCHEMA = (
    "spam_pred int, spam_prob double, hatespeech_pred int, hatespeech_prob double, "
    "selfharm_pred int, selfharm_prob double, probability double"
)
ROWS = [
    ((1, 0.52, 1, 0.99, 1, 0.99, 0.99), ("spam", 0.52)),
    ((0, 0.9, 1, 0.80, 1, 0.90, 0.85), ("selfharm", 0.90)),
    ((0, 0.9, 1, 0.80, 1, 0.80, 0.75), ("hatespeech", 0.80)),
    ((0, 0.9, 1, 0.70, 0, 0.9, 0.90), ("hatespeech", 0.70)),
    ((0, 0.9, 0, 0.9, 1, 0.60, 0.65), ("selfharm", 0.60)),
    ((0, 0.9, 0, 0.9, 0, 0.95, 0.97), ("0", 0.97)),
    ((0, 0.9, 1, 0.505, 0, 0.9, 0.90), ("0", 0.505)),
    ((0, 0.9, 0, 0.9, 0, None, None), ("0", 1.0)),
    ((None, None, None, None, 1, 0.7, 0.8), ("selfharm", 0.7)),
    ((0, 0.9, 1, None, 1, 0.7, 0.8), ("hatespeech", 1.0)),
    ((0, 0.0, 0, 0.0, 0, 0.0, 0.0), ("0", 0.0)),
]


@pytest.mark.parametrize("row, verdict", ROWS)
def test_verdict(spark, row, verdict):
    fused = E.fuse(spark.createDataFrame([row], SCHEMA)).first()
    assert (fused.prediction, fused.probability) == verdict


def test_spam_min_prob(spark):
    fused = E.fuse(spark.createDataFrame([ROWS[0][0]], SCHEMA), spam_min_prob=0.55).first()
    assert (fused.prediction, fused.probability) == ("hatespeech", 0.99)


@pytest.mark.parametrize(
    "row, pred, prob",
    [((1, 0.9, 1, 0.7), 1, 0.8), ((1, 0.9, 0, 0.99), 0, 0.9), ((1, 0.9, None, None), 1, 0.9), ((0, 0.9, 1, 0.7), 0, 0.9)],
)
def test_selfharm_ensemble(spark, row, pred, prob):
    schema = "prediction int, probability double, sentiment_prediction int, sentiment_probability double"
    done = E.selfharm_ensemble(spark.createDataFrame([row], schema)).first()
    assert done.selfharm_pred == pred
    assert done.selfharm_prob == pytest.approx(prob)


def test_message(spark):
    df = spark.createDataFrame([("0", 0.9), ("spam", 0.98765), ("selfharm", 1.0)], "p string, q double")
    out = [r.m for r in df.select(verdict_message("p", "q").alias("m")).collect()]
    assert out == [
        "The post does not have any toxic content",
        "spam detected with 98.76 % probability",
        "selfharm detected with 100.00 % probability",
    ]


def test_argmax_and_softmax(spark):
    df = spark.createDataFrame([([1.0, 3.0],), ([2.0, 2.0],), ([1000.0, -1000.0],)], "s array<double>")
    rows = [r.r for r in df.select(argmax_confidence("s").alias("r")).collect()]
    assert [r.prediction for r in rows] == [1, 0, 0]
    assert [r.probability for r in rows] == pytest.approx([0.8807970779778823, 0.5, 1.0])
    assert df.select(softmax("s").alias("x")).first().x == pytest.approx([0.11920292202211755, 0.8807970779778823])


def test_projections(spark):
    df = spark.createDataFrame([(1.0, 0.7)], "prediction double, probability double")
    named = rename_result(cast_prediction(df), "spam")
    assert named.columns == ["spam_pred", "spam_prob"]
    assert dict(named.dtypes)["spam_pred"] == "int"
    assert result_view(default_columns(named, {"x": 1}), "spam").columns == ["spam_pred", "spam_prob"]
