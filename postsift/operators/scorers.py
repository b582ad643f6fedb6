"""Scoring with a model that the caller brings, and sentiment."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.functions.scores import argmax_confidence, log_odds_confidence
from postsift.functions.tables import SENTIMENT
from postsift.operators.naive_bayes import BROADCAST_TOKENS, NaiveBayes, log_odds, sum_by_list
from postsift.sources.durable import durable

Scorer = Callable[[pd.Series], np.ndarray]
Lexicon = Mapping[str, float] | DataFrame

# A mapping of more words is scored as a frame of them is.
LEXICON_WORDS, LEXICON_BYTES = 100_000, 16 * 1024 * 1024

# Executors get the functions of this module with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _scored(score: Scorer, texts: pd.Series) -> pd.DataFrame:
    """Scores of a batch; where it fails, of its halves, down to the rows."""
    if texts.empty:
        return pd.DataFrame({"scores": [], "error": []})
    try:
        scores = np.asarray(score(texts), dtype=float)
        if scores.ndim != 2 or len(scores) != len(texts):
            raise ValueError("the scorer must return one row of class scores per text")
        return pd.DataFrame({"scores": list(scores), "error": None})
    except Exception as failure:
        if len(texts) == 1:
            return pd.DataFrame({"scores": [None], "error": [f"{type(failure).__name__}: {failure}"]})
        half = len(texts) // 2
        return pd.concat([_scored(score, texts[:half]), _scored(score, texts[half:])], ignore_index=True)


def score_arrow(df: DataFrame, load: Callable[[], Scorer], col: str = "data") -> DataFrame:
    """Score texts with any model: ``load()`` gives a function from a batch of
    texts to class scores, one row each.

    The model is loaded once per task and only the text goes to Python. A row
    that cannot be scored gets prediction 0, probability 0 and the reason in
    ``score_error``, and the job goes on.
    """

    @F.pandas_udf("scores array<double>, error string")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = load()
        for texts in batches:
            yield _scored(score, texts.reset_index(drop=True))

    raw = df.withColumn("__scored", scores(F.col(col)))
    result = raw.withColumn("__result", argmax_confidence("__scored.scores"))
    failed = F.col("__scored.scores").isNull()
    return result.withColumns(
        {
            "prediction": F.when(failed, 0).otherwise(F.col("__result.prediction")),
            "probability": F.when(failed, 0.0).otherwise(F.col("__result.probability")),
            "score_error": F.col("__scored.error"),
        }
    ).drop("__scored", "__result")


def fit_lexicon(df: DataFrame, seeds: Mapping[str, float], tokens: str = "tokens", least: int = 5, smooth: float = 1.0) -> DataFrame:
    """Word weights learned from a few words of known sentiment: a row (token, weight, n) for each word that
    stands in at least ``least`` posts with a seed.

    A word's weight is the log-odds of standing together with seeds above zero
    rather than below, against the odds of all posts that have seeds. A post
    counts for the side that its seeds sum up to. Posts are counted once for
    each of their words, in one pass.
    """
    scored = lexicon_sentiment(df.select(F.col(tokens).alias("tokens")), seeds).where("sentiment_score != 0")
    none = F.array(F.lit(None).cast("string"))  # carries the number of posts
    words = scored.select((F.col("sentiment_score") > 0).alias("up"), F.explode(F.concat(none, F.array_distinct("tokens"))).alias("token"))
    counts = durable(words.groupBy("token").agg(F.count_if("up").alias("up"), F.count_if(~F.col("up")).alias("down")), "sentiment-counts")
    total = counts.where("token is null").first()
    if total is None:
        raise ValueError("no post holds a word of known sentiment")
    base = math.log((total["up"] + smooth) / (total["down"] + smooth))
    weight = F.log((F.col("up") + smooth) / (F.col("down") + smooth)) - F.lit(base)
    n = F.col("up") + F.col("down")
    return counts.where("token is not null").where(n >= least).select("token", weight.alias("weight"), n.alias("n"))


def few_words(lexicon: Lexicon) -> bool:
    return not isinstance(lexicon, DataFrame) and len(lexicon) <= LEXICON_WORDS and sum(len(w.encode()) + 16 for w in lexicon) <= LEXICON_BYTES


def lexicon_sentiment(
    df: DataFrame, lexicon: Lexicon = SENTIMENT, tokens: str = "tokens", broadcast_tokens: int = BROADCAST_TOKENS
) -> DataFrame:
    """Add ``sentiment_score``: the sum of the weights of known words, null
    for a text without any.

    The lexicon is a mapping, or a frame (token, weight) of any size; weights
    of a word that is repeated add up. A small mapping is broadcast as it is;
    others are scored as naive Bayes models are.
    """
    if not isinstance(lexicon, DataFrame) and not few_words(lexicon):
        lexicon = df.sparkSession.createDataFrame(list(lexicon.items()), "token string, weight double")
    if isinstance(lexicon, DataFrame):
        n = F.max("n") if "n" in lexicon.columns else F.count(F.lit(1))
        table = durable(lexicon.where("token is not null").groupBy("token").agg(F.sum("weight").alias("weight"), n.alias("n")), "lexicon")
        models = {"__sum": NaiveBayes(table, 0.0), "__known": NaiveBayes(table.withColumn("weight", F.lit(1.0)), 0.0)}
        scored = log_odds(df, models, tokens, broadcast_tokens)
        score = F.when(F.col("__known_log_odds") > 0, F.col("__sum_log_odds"))
        return scored.withColumn("sentiment_score", score).drop("__sum_log_odds", "__known_log_odds")
    words = pa.array(list(lexicon), pa.string())
    weights = np.zeros((2, len(lexicon) + 1))  # the last one is that of words that are not there
    weights[:, :-1] = list(lexicon.values()), np.ones(len(lexicon))
    shared = df.sparkSession.sparkContext.broadcast((words, weights))

    @F.arrow_udf("array<double>")
    def summed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, values = shared.value
        for lists in batches:
            yield sum_by_list(lists, lambda flat: pc.fill_null(pc.index_in(flat, value_set=known), len(known)).to_numpy(zero_copy_only=False), values)[0]

    return (
        df.withColumn("__sums", summed(F.col(tokens)))
        .withColumn("sentiment_score", F.when(F.col("__sums")[1] > 0, F.col("__sums")[0]))
        .drop("__sums")
    )


def score_sentiment(
    df: DataFrame,
    lexicon: Lexicon = SENTIMENT,
    tokens: str = "tokens",
    base: str = "probability",
    load: Callable[[], Scorer] | None = None,
    col: str = "data",
    summed: str | None = None,
) -> DataFrame:
    """Add ``sentiment_prediction``, 1 for negative and 0 for positive, and
    ``sentiment_probability``.

    The lexicon decides by default; ``load`` brings another model, with the
    scores of (positive, negative). A text that cannot be scored counts as 1
    with the probability of the base model. ``summed`` names a column that
    holds the lexicon's sums already; it is dropped.
    """
    if load is None:
        scored = lexicon_sentiment(df, lexicon, tokens) if summed is None else df.withColumn("sentiment_score", F.col(summed)).drop(summed)
        score = F.col("sentiment_score")
        sign, confidence = (score < 0).cast("int"), log_odds_confidence(score)
        columns, extra = (sign, confidence), ["sentiment_score"]
    else:
        inner = score_arrow(df.select(F.struct("*").alias("__row"), F.col(col).alias("__text")), load, "__text")
        done = F.col("score_error").isNull()
        columns = F.when(done, F.col("prediction")), F.when(done, F.col("probability"))
        scored = inner.select("__row.*", columns[0].alias("__sign"), columns[1].alias("__confidence"))
        columns, extra = (F.col("__sign"), F.col("__confidence")), ["__sign", "__confidence"]
    return scored.withColumns(
        {
            "sentiment_prediction": F.coalesce(columns[0], F.lit(1)),
            "sentiment_probability": F.coalesce(columns[1], F.col(base)),
        }
    ).drop(*extra)
