"""Quality rules by the log-likelihood ratio of hashed n-grams, in Spark's own functions only.

Words and pairs of words are hashed to buckets. Two multinomials over the
buckets, of a trusted target and of the raw corpus, give every bucket the log
of their ratio; a document scores the mean over its n-grams and is kept if
that reaches THRESHOLD. Nothing of this needs a shuffle of texts: the counts
are summed by bucket on the map side, and the weights, one per bucket, go
into the scoring expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
TRUSTED_DOCS = 20_000  # of the documents labelled good, so many at most (those with the least hash) are the target
THRESHOLD = -0.2  # nats per n-gram
PRIOR = 1.0  # pseudo-counts of a bucket, spread as in the raw corpus
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    """The runs of characters other than blanks."""
    return F.array_remove(F.split(text, BLANKS), "")


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once. Not an alias, which the optimizer may copy into each place of use."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column, size: Column) -> Column:
    """Words in 3-word windows that stand twice or more in the text.

    A window's number is its hash with the last bits replaced by its place, so
    that sorting brings equal windows together. Windows whose hash bits occur
    once are settled. The few others are sorted as strings, which is exact.
    Each repeated window covers its three words, less what the next one covers.
    """

    def window(i: Column) -> Column:
        # Through get() a place is looked up without a bounds error.
        return F.struct(*[F.get(words, i + k).alias(f"w{k}") for k in range(3)])

    def candidates(bits: Column) -> Column:
        span = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)
        numbered = F.transform(
            F.sequence(F.lit(0), size - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(-span).bitwiseOR(i.cast("bigint")),
        )

        def paired(sorted_: Column) -> Column:
            def same(a: Column, b: Column) -> Column:
                return F.coalesce(F.call_function("shiftright", a, bits) == F.call_function("shiftright", b, bits), F.lit(False))

            return F.filter(sorted_, lambda v, i: same(v, F.get(sorted_, i - 1)) | same(v, F.get(sorted_, i + 1)))

        return F.transform(_bound(F.sort_array(numbered), paired), lambda v: v.bitwiseAND(span - 1).cast("int"))

    def settled(places: Column) -> Column:
        named = F.sort_array(F.transform(places, lambda i: F.struct(window(i).alias("w"), i.alias("i"))))

        def paired(sorted_: Column) -> Column:
            def same(a: Column, b: Column) -> Column:
                return F.coalesce(a["w"] == b["w"], F.lit(False))

            twice = F.filter(sorted_, lambda v, i: same(v, F.get(sorted_, i - 1)) | same(v, F.get(sorted_, i + 1)))
            return F.sort_array(F.transform(twice, lambda v: v["i"]))

        return _bound(named, paired)

    def covered(starts: Column) -> Column:
        parts = F.transform(starts, lambda v, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - v, F.lit(3))))
        return F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def counted(found: Column) -> Column:
        return F.when(F.size(found) == 0, F.lit(0).cast("bigint")).otherwise(_bound(settled(found), covered))

    bits = F.ceil(F.log2((size + 1).cast("double"))).cast("int") + 1
    return F.when(size < 4, F.lit(0).cast("bigint")).otherwise(_bound(_bound(bits, candidates), counted))


def ngram_buckets(words: Column, size: Column, buckets: int) -> Column:
    """The buckets of all words and pairs of neighbouring words."""
    ones = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    twos = F.transform(
        F.sequence(F.lit(0), size - 2),
        lambda i: F.pmod(F.xxhash64(F.get(words, i), F.get(words, i + 1)), F.lit(buckets)).cast("int"),
    )
    return F.when(size > 1, F.concat(ones, twos)).otherwise(ones)


def bucket_weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """The log-likelihood ratio of each bucket, from all documents and the trusted ids (doc_id; TRUSTED_DOCS at most)."""
    marked = docs.join(F.broadcast(trusted.select("doc_id").distinct().withColumn("good", F.lit(1))), "doc_id", "left")
    words = marked.select("good", words_of(F.lower("text")).alias("w"))
    features = words.select("good", F.explode(ngram_buckets(F.col("w"), F.size("w"), buckets)).alias("bucket"))
    counted = features.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("good").alias("target")).collect()
    raw, target = [0] * buckets, [0] * buckets
    for row in counted:
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    n_raw, n_target = sum(raw), sum(target)
    if not n_target:
        return [0.0] * buckets
    share = [(r + 1.0) / (n_raw + buckets) for r in raw]
    return [math.log((t + PRIOR * buckets * p) / (n_target + PRIOR * buckets) / p) for t, p in zip(target, share, strict=True)]


def trusted_ids(labels: DataFrame, most: int = TRUSTED_DOCS) -> DataFrame:
    """The documents labelled good; of more than ``most``, those with the least hash of their id."""
    good = labels.where("quality = 1 and toxic = 0 and doc_id is not null").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """Judge documents (doc_id, text) by base rules and by their likeness to trusted ones.

    ``labels`` (doc_id, quality, toxic) names trusted documents. Returns per
    row: doc_id, n_words, word_chars (code points in words), n_symbols,
    n_dup_lines (lines with a word that equal an earlier line), n_repeat_words
    (words in 3-word windows that the text holds twice or more), base_failed
    (fewer than 50 words, or more than half of them repeated), score (mean log
    ratio of its words and word pairs, in lower case; null without words) and
    kept (not base_failed and score >= threshold). A null or empty text has no
    words and fails. Without any trusted document all scores are 0. Repeated
    rows are judged alike. Other columns are not looked at; an empty table
    gives an empty table.
    """
    return judged(docs, labels, threshold, buckets).select(F.col("row.doc_id").cast("bigint").alias("doc_id"), "judged.*")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns."""
    return judged(docs, labels, threshold, buckets).where("judged.kept").select("row.*")


def judged(docs: DataFrame, labels: DataFrame, threshold: float, buckets: int) -> DataFrame:
    """Rows of ``docs`` as a struct, ``row``, and their judgement as another, ``judged``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    weights = bucket_weights(counted, trusted_ids(labels), buckets)
    # One constant array: a lookup is an access by position.
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")

    def measured(words: Column) -> Column:
        size = F.size(words)
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        scores = _bound(
            words_of(F.lower(text)), lambda w: F.aggregate(ngram_buckets(w, F.size(w), buckets), F.lit(0.0), lambda a, b: a + F.get(table, b))
        )
        return F.struct(
            size.cast("bigint").alias("n_words"),
            (F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("bigint").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
            _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            repeated_words(words, size).alias("n_repeat_words"),
            F.when(size > 0, scores / (2 * size - 1)).alias("score"),
        )

    def decided(m: Column) -> Column:
        failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
        kept = ~failed & F.coalesce(m["score"] >= threshold, F.lit(False))
        counts = [m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        return F.struct(*counts, failed.alias("base_failed"), m["score"].alias("score"), kept.alias("kept"))

    found = docs.select(F.struct("*").alias("row"), F.explode(F.transform(F.array(words_of(text)), measured)).alias("judged"))
    return found.withColumn("judged", _bound(F.col("judged"), decided))
