"""The given tables as posts, task sets and stand-in results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.operators.rows import with_tokens
from postsift.sources.posts import spread

# Schemas are declared, so that no file is opened to find them out.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# Word weights that occur in the invented prose of the tables.
LEXICON = {"the": 0.5, "and": -0.5, "le": 0.25, "les": -0.25, "der": 0.5, "und": -0.5, "el": 0.25, "los": -0.25}

# Masked forms that occur once every `e` is replaced by `*`.
MASKS = [("th*", "the"), ("*r*", "ere"), ("h*ll", "hell"), ("d*mn", "damn"), ("cr*p", "crap")]

# Primes for stand-in scores, one per task.
PRIMES = {"spam": 7, "hatespeech": 11, "selfharm": 13, "sentiment": 17}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return docs.withColumnRenamed("text", "data")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with a label per task; there is none for self-harm, so one made
    of the two others stands in."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id",
        F.col("toxic").alias("hatespeech"),
        F.when(F.col("doc_id") % 3 == 0, 1 - F.col("quality")).otherwise(F.col("toxic")).alias("selfharm"),
        (1 - F.col("quality")).alias("spam"),
    )
    return posts(spark, sf_dir).join(labels, "doc_id")


def labelled_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_tokens(labelled(spark, sf_dir))


def toxic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))


def spam_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("label"))


def stand_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every task's results, worked out from the id of a document."""
    return with_stand_in(table(spark, sf_dir, "documents").select("doc_id"))


def with_stand_in(docs: DataFrame) -> DataFrame:
    """The stand-in results of rows that have a doc_id."""
    out = {}
    for task, prime in PRIMES.items():
        p = F.col("doc_id") * prime % 1000 / 1000.0
        pred, prob = {
            "selfharm": ("prediction", "probability"),
            "sentiment": ("sentiment_prediction", "sentiment_probability"),
        }.get(task, (f"{task}_pred", f"{task}_prob"))
        out[pred] = (p >= 0.5).cast("int")
        out[prob] = F.greatest(p, 1 - p)
    return docs.withColumns(out)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in cols})
