"""Multinomial naive Bayes as aggregation over tokens.

The model is a table, one row per token with its log-odds weight, and the
log-odds of the classes. It is fitted by counting and scored by summing.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.functions.scores import log_odds_confidence, log_odds_prediction
from postsift.sources.durable import durable

# Bounds of what goes to every executor. Of a larger model that is the part
# with the most frequent tokens, and the other tokens are joined. A token goes
# as its hash of 64 bits, with a weight for each task.
BROADCAST_TOKENS = 8_000_000
BROADCAST_BYTES = 192 * 1024 * 1024

AT_ONCE = 1 << 18  # tokens of a batch that are looked up together
FEW_KEYS = 1 << 12  # are searched as well in any order

WORD_SUM = "__word_sum"

# A map of the tokens that are joined tells which tokens of a text need not be
# shuffled: so many bits a token, up to its bound. With fewer bits than tokens
# it tells too little and is left out.
MAP_BITS, MOST_MAP_BITS, MAP_PART = 16, 1 << 29, 1 << 15

# Executors get the functions of this module with the task and need no copy
# of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class NaiveBayes:
    weights: DataFrame  # token, weight, n: how often it was seen
    prior: float
    losses: tuple[float, ...] = ()  # held-out loss as chunks were added, where it was asked for


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fit_nb_tasks(df: DataFrame, labels: Mapping[str, str], tokens: Column | str = "tokens") -> dict[str, NaiveBayes]:
    """Fit one model per task, all in one pass over the tokens.

    ``labels`` names the 0/1 column of each task; rows that have no label for
    a task do not count for it. A null token per post carries the number of
    posts through the same aggregate, whose map side sums up frequent tokens
    before anything is shuffled.
    """
    none = F.array(F.lit(None).cast("string"))
    words = df.select(*set(labels.values()), F.explode(F.concat(none, _as_column(tokens))).alias("token"))
    counted = words.groupBy("token").agg(
        *[
            F.count_if(F.col(label) == cls).alias(f"{task}_{cls}")
            for task, label in labels.items()
            for cls in (0, 1)
        ]
    )
    counts = durable(counted, "token-counts")
    return {task: _model(counts, task) for task in labels}


def _model(counts: DataFrame, task: str) -> NaiveBayes:
    n0, n1 = F.col(f"{task}_0"), F.col(f"{task}_1")
    post, used = F.col("token").isNull(), F.col("token").isNotNull() & (n0 + n1 > 0)
    sums = counts.agg(
        F.sum(F.when(post, n0)).alias("d0"),
        F.sum(F.when(post, n1)).alias("d1"),
        F.sum(F.when(used, n0)).alias("t0"),
        F.sum(F.when(used, n1)).alias("t1"),
        F.count_if(used).alias("v"),
    ).first()
    if not sums["d0"] or not sums["d1"]:
        raise ValueError(f"{task}: both classes must be present in the training set")
    weight = F.log((n1 + 1) / F.lit((sums["t1"] or 0) + sums["v"])) - F.log(
        (n0 + 1) / F.lit((sums["t0"] or 0) + sums["v"])
    )
    weights = counts.where(used).select("token", weight.alias("weight"), (n0 + n1).alias("n"))
    return NaiveBayes(weights, math.log(sums["d1"] / sums["d0"]))


def fit_nb(df: DataFrame, label: str = "label", tokens: Column | str = "tokens") -> NaiveBayes:
    return fit_nb_tasks(df, {"task": label}, tokens)["task"]


def _wide(models: Mapping[str, NaiveBayes]) -> DataFrame:
    """All weights by token, zero where a task does not know the token."""
    tables = [
        m.weights.select("token", F.col("weight").alias(task), F.col("n").alias(f"{task}_n"))
        for task, m in models.items()
    ]
    joined = reduce(lambda a, b: a.join(b, "token", "full"), tables).na.fill(0.0, list(models))
    seen = [F.coalesce(f"{task}_n", F.lit(0)) for task in models]
    return joined.select("token", *models, reduce(Column.__add__, seen).alias("n"))


def _split_by_frequency(wide: DataFrame, tasks: int, most: int) -> tuple[DataFrame, DataFrame | None]:
    """The most frequent tokens, within the bounds, and the others if any.

    Tokens are counted by the power of two that their frequency has; powers
    are taken from the top for as long as they fit.
    """
    level = F.floor(F.log2(F.greatest("n", F.lit(1)))).cast("int")
    levels = wide.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"))
    tokens = 0
    lowest = 64
    for row in sorted(levels.collect(), key=lambda r: -r["level"]):  # at most 64 rows
        tokens += row["n"]
        if tokens > most or tokens * 8 * (1 + tasks) > BROADCAST_BYTES:
            return wide.where(level >= lowest), wide.where(level < lowest)
        lowest = row["level"]
    return wide, None


def log_odds(
    df: DataFrame,
    models: Mapping[str, NaiveBayes],
    tokens: str = "tokens",
    broadcast_tokens: int = BROADCAST_TOKENS,
    words: Mapping[str, float] | None = None,
) -> DataFrame:
    """Add ``<task>_log_odds`` for every model, in one pass over the tokens.

    Models of proven size are broadcast and the sums are a projection: no row
    is shuffled and rows need no key. Of larger ones the frequent tokens,
    which make up nearly all of a text, are summed like that, and only the
    tokens that are left over go through a join. Tokens are told apart by 64
    bits of hash. The weights of a few ``words`` are summed on the way, by the
    same Python workers: WORD_SUM, null for a text without any of them.
    """
    tasks = list(models)
    hot, cold = _split_by_frequency(_wide(models), len(tasks), broadcast_tokens)
    keys = F.transform(F.col(tokens), _key)
    if cold is None:
        summed = df.withColumn("__hot", _summed_weights(hot, tasks, words=words)(keys)).withColumn("__known", F.col(tokens).isNotNull())
        sums = {t: F.col("__hot.sums")[i] for i, t in enumerate(tasks)}
    elif df.isStreaming:
        raise ValueError("the model is too large to score a stream as it is; use streaming.posts.write_batches")
    else:
        first = df.withColumn("__hot", _summed_weights(hot, tasks, cold, words)(keys)).withColumn("__known", F.col(tokens).isNotNull())
        summed = _joined_weights(first, cold, tasks)
        sums = {
            t: F.col("__hot.sums")[i] + F.coalesce(F.col("__sums")[t], F.lit(0.0)) for i, t in enumerate(tasks)
        }
    odds = {f"{t}_log_odds": F.when(F.col("__known"), sums[t] + models[t].prior) for t in tasks}
    if words is not None:
        odds[WORD_SUM] = F.when(F.col("__hot.words")[1] > 0, F.col("__hot.words")[0])
    return summed.withColumns(odds).drop("__sums", "__hot", "__known")


def _key(token: Column) -> Column:
    return F.xxhash64(token)


def _word_weights(spark: SparkSession, words: Mapping[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of words in order; their weights, and a one for each."""
    held = spark.createDataFrame(list(enumerate(words)), "i int, token string").select("i", _key(F.col("token")).alias("key")).toArrow()
    keys = held["key"].to_numpy()
    order = np.argsort(keys)
    weights = np.zeros((2, len(keys) + 1))  # the last one is that of words that are not there
    weights[:, :-1] = np.array(list(words.values()), float)[held["i"].to_numpy()[order]], np.ones(len(keys))
    return keys[order], weights


def _summed_weights(table: DataFrame, tasks: list[str], cold: DataFrame | None = None, words: Mapping[str, float] | None = None):
    """An Arrow function from keys of tokens to sums; with ``cold`` also to the keys not summed that may be there, and
    with ``words`` to the sum of their weights and their number."""
    held = table.select(_key(F.col("token")).alias("key"), *tasks).toArrow()  # within the bounds checked before
    keys = held["key"].to_numpy()
    order = np.argsort(keys)
    weights = np.zeros((len(tasks), len(keys) + 1))  # the last one is that of tokens that are not found
    for i, t in enumerate(tasks):
        weights[i, :-1] = held[t].to_numpy()[order]
    context = table.sparkSession.sparkContext
    joins = cold is not None
    shared, marks = context.broadcast((keys[order], weights)), _map_of(cold) if joins else None
    few = None if words is None else context.broadcast(_word_weights(table.sparkSession, words))
    kinds = {"sums": "array<double>"} | ({"rest": "array<bigint>"} if joins else {}) | ({} if few is None else {"words": "array<double>"})

    @F.arrow_udf(", ".join(f"{name} {kind}" for name, kind in kinds.items()))
    def summed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, values = shared.value

        def find(flat: pa.Array) -> np.ndarray:
            return find_keys(flat.to_numpy(zero_copy_only=False), known)

        def may_be_cold(flat: pa.Array) -> np.ndarray:
            return np.ones(len(flat), bool) if marks is None else is_marked(flat.to_numpy(zero_copy_only=False), marks.value)

        def find_word(flat: pa.Array) -> np.ndarray:
            return find_keys(flat.to_numpy(zero_copy_only=False), few.value[0])

        for lists in batches:
            done = [*sum_by_list(lists, find, values, may_be_cold)] if joins else [sum_by_list(lists, find, values)[0]]
            if few is not None:
                done.append(sum_by_list(lists, find_word, few.value[1])[0])
            yield pa.StructArray.from_arrays(done, list(kinds))

    return summed


def find_keys(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The place of each key in the sorted ones, or else their number."""
    places = np.full(len(keys), len(known))
    if 0 < len(known) <= FEW_KEYS:
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, at, len(known))
    if len(known) and len(keys):
        order = np.argsort(keys)  # so that the search runs through the sorted ones once
        keys = keys[order]
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        places[order] = np.where(known[at] == keys, at, len(known))
    return places


def some_at_a_time(lists: pa.Array) -> Iterator[pa.Array]:
    """Slices of lists that hold AT_ONCE entries or so, but never less than one list."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(lists):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + AT_ONCE, "right")))
        yield lists.slice(start, stop - start)
        start = stop


def sum_by_list(
    lists: pa.Array, find: Callable[[pa.Array], np.ndarray], weights: np.ndarray, keep: Callable[[pa.Array], np.ndarray] | None = None
) -> tuple[pa.Array, pa.Array | None]:
    """For each list of tokens the sum of each row of weights, and with
    ``keep`` those tokens without weights that it says to keep. ``find`` gives
    the places of tokens, the last one being that of all tokens not found."""
    sums, left, rest = np.zeros((len(lists), len(weights))), np.zeros(len(lists), np.int64), []
    start = 0
    for some in some_at_a_time(lists):
        own, own_left = sums[start : start + len(some)], left[start : start + len(some)]
        start += len(some)
        lengths = pc.fill_null(pc.list_value_length(some), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        filled = lengths > 0
        starts = (np.cumsum(lengths) - lengths)[filled]
        if not len(starts):
            continue
        flat = some.flatten()
        places = find(flat)
        for i, row in enumerate(weights):
            own[filled, i] = np.add.reduceat(row[places], starts)
        if keep is not None:
            kept = places == weights.shape[1] - 1
            kept[kept] = keep(flat.filter(pa.array(kept)))
            own_left[filled] = np.add.reduceat(kept.astype(np.int64), starts)
            rest.append(flat.filter(pa.array(kept)))
    ends = np.arange(len(lists) + 1, dtype=np.int32) * len(weights)
    summed = pa.ListArray.from_arrays(pa.array(ends), pa.array(sums.ravel()))
    if keep is None:
        return summed, None
    left_ends = np.concatenate([[0], np.cumsum(left)]).astype(np.int32)
    return summed, pa.ListArray.from_arrays(pa.array(left_ends), pa.concat_arrays(rest) if rest else lists.flatten())


def _joined_weights(df: DataFrame, cold: DataFrame, tasks: list[str]) -> DataFrame:
    """Add ``__sums`` over the tokens left over, by way of a join.

    The rows are written once, with what the frequent tokens sum up to, so
    that they are normalised once and have a number of their own. Only numbers
    and keys of left-over tokens go through the join; a token that was rare in
    training and is common here is split by adaptive execution, as both sides
    of the join are plain shuffles. Tokens that the model does not know, by the
    map of those it does, have been left out; rows with nothing left over meet
    no join, and of the others only the columns that are wanted.
    """
    rows = durable(df.withColumn("__row", F.monotonically_increasing_id()), "summed")
    words = rows.select("__row", F.explode("__hot.rest").alias("key"))
    weights = cold.select(_key(F.col("token")).alias("key"), *tasks)
    sums = words.join(weights, "key").groupBy("__row").agg(*[F.sum(t).alias(t) for t in tasks])
    nested = sums.select("__row", F.struct(*tasks).alias("__sums"))
    left = F.coalesce(F.size("__hot.rest"), F.lit(0)) > 0
    none = F.lit(None).cast(nested.schema["__sums"].dataType)
    joined = rows.where(left).join(nested, "__row", "left")
    return joined.unionByName(rows.where(~left).withColumn("__sums", none)).drop("__row")


def _map_of(cold: DataFrame) -> Broadcast | None:
    """A bit for each hash of a token, or None if there are too many tokens.

    Spark sets the bits, in parts; the whole map, within its bound, goes to
    every executor.
    """
    tokens = cold.count()
    bits = min(MOST_MAP_BITS, MAP_PART * (1 + tokens * MAP_BITS // MAP_PART))
    if tokens > bits // 2:
        return None
    at = cold.select(F.pmod(_key(F.col("token")), F.lit(bits)).alias("at"))
    parts = at.groupBy(F.floor(F.col("at") / MAP_PART).alias("part")).agg(F.bitmap_construct_agg(F.col("at") % MAP_PART).alias("bits"))
    held = np.zeros((bits // MAP_PART, MAP_PART // 8), np.uint8)
    for part, marks in zip(*(c.to_pylist() for c in parts.toArrow().columns), strict=True):  # within the bound
        held[part] = np.frombuffer(marks, np.uint8)
    return cold.sparkSession.sparkContext.broadcast(held.reshape(-1))


def is_marked(keys: np.ndarray, marks: np.ndarray) -> np.ndarray:
    places = keys % (8 * len(marks))
    return (marks[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def known_tokens(cold: DataFrame) -> Callable[[Column], Column] | None:
    """A test of tokens: false only for those that are not in ``cold``; true for some 6 % of these, too."""
    shared = _map_of(cold)
    if shared is None:
        return None

    @F.arrow_udf("boolean")
    def marked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for keys in batches:
            yield pa.array(is_marked(keys.to_numpy(), shared.value))

    return lambda token: marked(_key(token))


def fit_nb_chunks(df: DataFrame, label: str = "label", tokens: str = "tokens", chunks: int = 5, held_out: int = 10) -> NaiveBayes:
    """Naive Bayes whose ``losses`` tell how training rows add up: the log-loss on held-out rows of the model of
    the first chunk, of the first two, and so on.

    Every ``held_out``-th row, by a hash of its tokens, is held out; the others
    are dealt to chunks by another hash. Tokens are counted once, by chunk. The
    model itself is that of all rows.
    """
    known = df.where(F.col(label).isin(0, 1) & F.col(tokens).isNotNull()).select(F.col(label).alias("label"), F.col(tokens).alias("tokens"))
    seed = F.md5(F.concat_ws(" ", "tokens"))
    rest, own = F.conv(F.substring(seed, 1, 8), 16, 10).cast("long"), F.conv(F.substring(seed, 9, 8), 16, 10).cast("long")
    rows = durable(known.withColumn("chunk", F.when(rest % held_out == 0, -1).otherwise(own % chunks)), "chunked-tokens")
    none = F.array(F.lit(None).cast("string"))
    words = rows.select("label", "chunk", F.explode(F.concat(none, "tokens")).alias("token"))
    sides = [F.count_if(F.col("label") == c).alias(f"task_{c}") for c in (0, 1)]
    counts = durable(words.groupBy("chunk", "token").agg(*sides), "chunk-counts")
    losses = []
    for upto in range(chunks):
        summed = counts.where(F.col("chunk").between(0, upto)).groupBy("token").agg(F.sum("task_0").alias("task_0"), F.sum("task_1").alias("task_1"))
        model = _model(durable(summed, "counts-so-far"), "task")
        odds = log_odds(rows.where("chunk = -1"), {"at": model}).select(F.when(F.col("label") == 1, -F.col("at_log_odds")).otherwise(F.col("at_log_odds")).alias("z"))
        losses.append(odds.agg(F.avg(F.greatest("z", F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))))).first()[0])
    whole = durable(counts.groupBy("token").agg(F.sum("task_0").alias("task_0"), F.sum("task_1").alias("task_1")), "counts")
    model = _model(whole, "task")
    return NaiveBayes(model.weights, model.prior, tuple(float("nan") if v is None else v for v in losses))


def score_nb_tasks(
    df: DataFrame,
    models: Mapping[str, NaiveBayes],
    tokens: str = "tokens",
    per_token: bool = False,
    broadcast_tokens: int = BROADCAST_TOKENS,
    words: Mapping[str, float] | None = None,
) -> DataFrame:
    """Add ``<task>_log_odds``, ``<task>_pred`` and ``<task>_prob``.

    Long texts drive the confidence to one; ``per_token`` divides the
    log-odds by the number of tokens. ``words`` are summed as :func:`log_odds` says.
    """
    if per_token:  # counted beforehand, so that no join has to carry the tokens
        df = df.withColumn("__size", F.greatest(F.size(tokens), F.lit(1)))
    scored = log_odds(df, models, tokens, broadcast_tokens, words)
    if per_token:
        scored = scored.withColumns({f"{t}_log_odds": F.col(f"{t}_log_odds") / F.col("__size") for t in models}).drop("__size")
    results = {}
    for task in models:
        results[f"{task}_pred"] = log_odds_prediction(f"{task}_log_odds")
        results[f"{task}_prob"] = log_odds_confidence(f"{task}_log_odds")
    return scored.withColumns(results)


def score_nb(
    df: DataFrame,
    model: NaiveBayes,
    tokens: str = "tokens",
    per_token: bool = False,
    broadcast_tokens: int = BROADCAST_TOKENS,
) -> DataFrame:
    """Add ``log_odds``, ``prediction`` and ``probability``."""
    scored = score_nb_tasks(df, {"__task": model}, tokens, per_token, broadcast_tokens)
    return scored.withColumnsRenamed(
        {"__task_log_odds": "log_odds", "__task_pred": "prediction", "__task_prob": "probability"}
    )
