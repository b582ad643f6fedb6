"""Mixing sources to target weights by Pareto order sampling, in Spark's own functions only.

A source of which the mix wants ``f`` times its size gives floor(f) whole
copies of every document. Of the rest, documents are ranked by random odds
over inclusion odds, and taken in that order up to a fixed size. The order is
never cut in one task: documents are sorted over all tasks by source and rank,
and running sizes are made up of sums per task and source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsift.llm.quality import BLANKS
from postsift.sources.durable import durable

WEIGHTS = (1, 2, 3)  # of the sources in the order of their names, over and over
MOST_COPIES = 3
SEED = "mix-1"
BROADCAST_SOURCES = 100_000
BROADCAST_ROWS = 1_000_000  # documents whose numbers of copies go to every executor; more are joined by a shuffle


def size_in_words(text: Column) -> Column:
    """The number of runs of characters other than blanks."""
    inner = F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]" + BLANKS + r"(?=[^\x20\x09-\x0D])")), F.lit(0))
    return F.when(text.rlike(r"[^\x20\x09-\x0D]"), inner + 1).otherwise(0).cast("bigint")


def row_key() -> Column:
    """128 bits of hash of what a row of documents holds."""
    return F.concat_ws("-", F.hex(F.xxhash64("doc_id", "source", "text")), F.hex(F.xxhash64("text", F.lit(1), "source", "doc_id"))).alias("row_key")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Of rows (source, size): source, source_size, n and target.

    All sizes together are shared by weight; a source gets ``most`` times its
    size at most, and what is over is shared by weight among the others, until
    none is above. That is one level for all sources below their bound: with
    sources sorted by bound over weight, those before the level get their bound.
    There is a row per source, so the windows over all of them are small.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    ranked = by_source.withColumn("weight", F.get(F.array(*map(F.lit, weights)), place)).withColumn("bound", most * F.col("source_size"))
    order = [(F.col("bound") / F.col("weight")).asc(), F.asc_nulls_last("source")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    since = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("bound").over(before), F.lit(0))) / F.sum("weight").over(since)
    leveled = ranked.withColumn("level", level).withColumn("below", F.col("bound") / F.col("weight") <= F.col("level"))
    # The first source that is not filled sets the level of all that follow.
    final = F.max(F.when(~F.col("below"), F.col("level"))).over(whole)
    target = F.when(F.col("below") | final.isNull(), F.col("bound").cast("double")).otherwise(final * F.col("weight"))
    return leveled.withColumn("target", F.least(target, F.col("bound").cast("double"))).select("source", "source_size", "n", "target")


def pareto_rank(size: Column, mean: Column, part: Column) -> Column:
    """Random odds over inclusion odds. Chances are ``part`` on average; shorter documents have more, as they scatter less in words."""
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10)
    u = (draw.cast("double") + 0.5) / float(1 << 52)
    chance = F.greatest(F.lit(1e-12), F.least(F.lit(0.999999), part * 2 * mean / F.greatest(mean + size, F.lit(1.0))))
    return (u / (1 - u)) / (chance / (1 - chance))


def mixed_sizes(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """How often each of the documents (doc_id, text, source) is taken.

    Returns per row: doc_id, source, size (words), source_size, target (of its
    source, in words), copies, taken (copies * size) and row_key. The words taken of a
    source come nearest to the target that whole documents in rank order
    allow, and no document is taken more than ``most`` times. The ranks derive
    from doc_id, so reruns agree; rows that repeat a doc_id get the same rank
    and are ordered by size, equal rows at random. A null or empty text has
    size 0 and is taken as often as the whole copies say; a null source is a
    source of its own, the last; a null doc_id counts as the empty text. An
    empty table gives an empty table; other columns are not looked at.
    """
    sized = durable(docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), size_in_words(F.col("text")).alias("size"), row_key()), "sized")
    targets = durable(source_targets(sized, weights, most), "targets")
    few = targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    named = targets.withColumnRenamed("source", "of")
    both = sized.join(F.broadcast(named) if few else named.hint("merge"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    both = both.withColumn("wanted", wanted).withColumn("whole", F.floor("wanted"))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    mean = F.col("source_size") / F.col("n")
    ranked = both.withColumn("rest", rest).withColumn("rank", pareto_rank(F.col("size"), mean, F.greatest(F.col("wanted") - F.col("whole"), F.lit(1e-9))))
    order = ["source", "rank", "doc_id", "size"]
    dealt = durable(ranked.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranked")
    sums = dealt.groupBy("part", "source").agg(F.sum("size").alias("s"))
    upto = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("part").alias("at"), F.col("source").alias("of"), F.coalesce(F.sum("s").over(upto), F.lit(0)).alias("before"))
    sums = durable(sums, "sums")
    running = Window.partitionBy("part", "source").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = dealt.withColumn("running", F.sum("size").over(running))
    out = out.join(sums, (F.col("part") == F.col("at")) & F.col("source").eqNullSafe(F.col("of")))
    # Taken is what ends nearer to the rest than it starts.
    more = (F.col("before") + F.col("running") - F.col("size") / 2 <= F.col("rest")) & (F.col("size") > 0)
    copies = F.least(F.col("whole") + more.cast("int"), F.lit(most)).cast("bigint")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "row_key")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The rows of ``docs``, each as often as ``mixed_sizes`` takes it."""
    taken = mixed_sizes(docs, weights, most).groupBy("row_key").agg(F.sum("copies").alias("times"), F.count("*").alias("rows"))
    taken = durable(taken, "taken")
    keyed = docs.select(F.struct("*").alias("row"), row_key())
    if taken.where("rows > 1").limit(1).count():  # equal rows count together
        keyed = keyed.dropDuplicates(["row_key"])
    taken = taken.where("times > 0").select("row_key", "times")
    few = taken.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    both = keyed.join(F.broadcast(taken) if few else taken.hint("merge"), "row_key")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times")))
    return both.select("row", copies).select("row.*")
