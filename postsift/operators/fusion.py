"""From the results of single tasks to one verdict per post."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def selfharm_ensemble(df: DataFrame) -> DataFrame:
    """Self-harm only where the classifier and the sentiment agree on it.

    The confidence is the classifier's, or where both say 1 the mean of both.
    A missing sentiment counts as 1 with the classifier's confidence.
    """
    base = F.col("probability")
    sentiment = F.coalesce("sentiment_prediction", F.lit(1))
    sentiment_prob = F.coalesce("sentiment_probability", base)
    pred = F.col("prediction").cast("int").bitwiseAND(sentiment)
    return df.withColumns(
        {
            "sentiment_prediction": sentiment,
            "sentiment_probability": sentiment_prob,
            "selfharm_pred": pred,
            "selfharm_prob": F.when(pred == 1, (base + sentiment_prob) / 2).otherwise(base),
        }
    )


def arbitrate(df: DataFrame, spam_min_prob: float | None = None) -> DataFrame:
    """Pick one label: spam first, then the surer of self-harm and hate speech.

    A tie of the two goes to hate speech. Where no task fires, the label is
    ``'0'`` and ``probability`` keeps the value it had, that of the self-harm
    classifier. ``spam_min_prob`` asks for a minimal confidence in spam.
    """
    spam = F.col("spam_pred") == 1
    if spam_min_prob is not None:
        spam = spam & (F.col("spam_prob") > spam_min_prob)
    hate, harm = F.col("hatespeech_pred") == 1, F.col("selfharm_pred") == 1
    harm_wins = harm & (~F.coalesce(hate, F.lit(False)) | (F.col("selfharm_prob") > F.col("hatespeech_prob")))
    label = (
        F.when(spam, "spam").when(harm_wins, "selfharm").when(hate, "hatespeech").otherwise("0")
    )
    probability = (
        F.when(label == "spam", F.col("spam_prob"))
        .when(label == "selfharm", F.col("selfharm_prob"))
        .when(label == "hatespeech", F.col("hatespeech_prob"))
        .otherwise(F.col("probability"))
    )
    return df.withColumns({"prediction": label, "probability": probability})


def default_probability(df: DataFrame) -> DataFrame:
    return df.withColumn("probability", F.coalesce("probability", F.lit(1.0)))


def confidence_floor(df: DataFrame, floor: float = 0.51) -> DataFrame:
    """A label held with less confidence than ``floor`` becomes ``'0'``."""
    unsure = (F.col("prediction") != "0") & (F.col("probability") < floor)
    return df.withColumn("prediction", F.when(unsure, "0").otherwise(F.col("prediction")))


def fuse(df: DataFrame, spam_min_prob: float | None = None, floor: float = 0.51) -> DataFrame:
    """All steps from per-task results to the verdict."""
    return confidence_floor(default_probability(arbitrate(df, spam_min_prob)), floor)
