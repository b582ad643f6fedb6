"""Class scores to a prediction and the confidence in it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The wording of a verdict.
CLEAN_MESSAGE = "The post does not have any toxic content"
TOXIC_MESSAGE = (" detected with ", " % probability")


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def softmax(scores: Column | str) -> Column:
    """Array of raw class scores to array of probabilities."""

    def shares(raw: Column) -> Column:
        def over(top: Column) -> Column:
            powers = F.transform(raw, lambda s: F.exp(s - top))
            return _once(F.struct(powers.alias("p"), F.aggregate(powers, F.lit(0.0), lambda a, x: a + x).alias("t")), _divided)

        return _once(F.array_max(raw), over)

    return _once(_as_column(scores), shares)


def _divided(parts: Column) -> Column:
    return F.transform(parts["p"], lambda x: x / parts["t"])


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once however often it is used."""
    return F.transform(F.array(value), use)[0]


def argmax(scores: Column | str) -> Column:
    """Index of the largest score; the first one wins a tie."""
    scores = _as_column(scores)
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def argmax_confidence(scores: Column | str) -> Column:
    """``struct(prediction, probability)`` of raw class scores.

    The probability is the confidence in the predicted class, so it is at
    least one half with two classes.
    """
    return _once(
        _as_column(scores),
        lambda raw: F.struct(argmax(raw).alias("prediction"), F.array_max(softmax(raw)).alias("probability")),
    )


def log_odds_prediction(log_odds: Column | str) -> Column:
    """1 where the log-odds of class 1 are above zero; a tie is class 0."""
    return (_as_column(log_odds) > 0).cast("int")


def log_odds_confidence(log_odds: Column | str) -> Column:
    """Confidence in the predicted class, ``1 / (1 + exp(-|log-odds|))``."""
    return 1 / (1 + F.exp(-F.abs(_as_column(log_odds))))


def verdict_message(prediction: Column | str, probability: Column | str) -> Column:
    """The sentence shown to a user for a fused verdict."""
    prediction, probability = _as_column(prediction), _as_column(probability)
    percent = F.format_string("%.2f", F.bround(probability * 100, 2))
    before, after = (F.lit(part) for part in TOXIC_MESSAGE)
    found = F.concat(prediction, before, percent, after)
    return F.when(prediction == "0", F.lit(CLEAN_MESSAGE)).otherwise(found)
