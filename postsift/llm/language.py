"""Language of documents and pages, by fusing evidence in Bayes' rule.

The languages are those declared by enough rows with text; one more hypothesis,
"und", says that a text is in none of them. The text speaks through a
multinomial over hashed byte trigrams, weighted down to EVIDENCE independent
ones, as neighbouring trigrams are not independent. A language's multinomial is
smoothed by that of all texts, half of it uniform. "und" is nearly uniform: what
no language has seen speaks for it, while a text that mixes two of them is
nearer to either than to it. To that come how
often the declared language goes with each true one, and the languages of the
host: its shares are smoothed by those of its address suffix, and these by those
of the whole corpus. All of that is counted by grouped aggregation of what the
texts alone say. A row's own part is taken out of the counts that judge it: of
the trigrams of its declared language, of its host and suffix, and of its
declaration. Only the background and the corpus shares keep it.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.llm.words import SPACES, rows_without_keys, slices, small_batches, text_bytes
from postsift.sources.durable import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UND = "und"
NOT_LANGUAGES = ("und", "mul", "mis", "zxx")  # fixed values: codes that name no language
FLOOR = 5  # rows with text that must declare a language
MOST = 256  # languages, of most rows, that are told apart; bounds the table of counts (32 MB)
SMOOTHING = 2000.0  # trigrams that the background is worth in a language's multinomial
UND_POOL = 0.05  # share of all texts in the multinomial of "und"; the rest is uniform
DISCOUNT = 0.75  # taken off each seen count for the background, so that a single sight of a trigram says little
BUCKETS = 1 << 15
SLICE = 1 << 20  # bytes of text worked on at a time
EVIDENCE = 40  # trigrams that count as independent
STRENGTH = 20.0  # rows that the smoothing of a host or a suffix is worth
LEAST = 0.5  # probability below which a row is rejected
UNIT = 1000  # shares are summed as whole thousandths, so that sums do not depend on their order

# Bytes as they count: letters in lower case, white space as blanks, and all digits alike, as numbers tell no language.
LOWER = bytes(c + 32 if 65 <= c <= 90 else 0x20 if c in SPACES else 0x30 if 0x30 <= c <= 0x39 else c for c in range(256))


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of the trigram that starts at each byte of all texts, BUCKETS where it would
    leave its text; and where the texts start and the last ends. All bytes count alike."""
    raw, offsets = text_bytes(texts)
    bucket = np.full(len(raw), BUCKETS, np.int32)
    if len(raw) > 2:
        data = np.frombuffer(LOWER, np.uint8)[raw].astype(np.uint32)
        code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
        bucket[:-2] = ((code * np.uint32(2654435761)) >> np.uint32(8)) % np.uint32(BUCKETS)
    for back in (1, 2):
        at = offsets[1:] - back
        bucket[at[at >= 0]] = BUCKETS
    return bucket, offsets


def sums_by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offsets) - 1)
    filled = np.diff(offsets) > 0
    if filled.any():
        out[filled] = np.add.reduceat(values, offsets[:-1][filled], dtype=np.float64)
    return out


@dataclass
class Trigrams:
    """Counts of languages by buckets, the shares of the background, and those of "und"."""

    languages: tuple[str, ...]
    counts: np.ndarray
    background: np.ndarray
    und: np.ndarray


def declared_languages(rows: DataFrame, floor: int = FLOOR, most: int = MOST) -> tuple[str, ...]:
    """Codes of two or three letters that at least ``floor`` rows (text, declared) with text declare."""
    code = F.length("declared").isin(2, 3) & ~F.col("declared").isin(*NOT_LANGUAGES) & (F.octet_length("text") >= 3)
    stated = rows.where(code).groupBy("declared").agg(F.count("*").alias("n")).where(F.col("n") >= floor)
    return tuple(sorted(r["declared"] for r in stated.orderBy(F.desc("n"), "declared").limit(most).collect()))


def places(declared: pa.Array, languages: tuple[str, ...]) -> np.ndarray:
    place = {x: i for i, x in enumerate(languages)}
    return np.array([place.get(x, len(languages)) for x in declared.to_pylist()], np.int64)


def counter(languages: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = BUCKETS + 1
        counts = np.zeros((len(languages) + 1) * width, np.int64)
        for batch in slices(batches, "text", SLICE):
            buckets, offsets = trigrams(batch.column("text"))
            of = places(batch.column("declared"), languages)
            at, n = np.unique(np.repeat(of * width, np.diff(offsets)) + buckets, return_counts=True)
            counts[at] += n
        known = counts.reshape(-1, width)[:, :BUCKETS].ravel()
        seen = np.flatnonzero(known)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(known[seen], pa.int64())], names=["place", "n"])

    return count


def fit_trigrams(rows: DataFrame, languages: tuple[str, ...]) -> Trigrams:
    """Trigrams of rows (text, declared) by declared language; a table of bounded size. All rows make up the background."""
    counted = rows.select("text", "declared").mapInArrow(counter(languages), "place bigint, n bigint")
    summed = counted.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((len(languages) + 1) * BUCKETS)
    table[summed.column("place").to_numpy()] = summed.column("n").to_numpy()
    table = table.reshape(len(languages) + 1, BUCKETS)
    pool = table.sum(axis=0)
    pool /= max(pool.sum(), 1)
    return Trigrams(languages, table[:-1].astype(np.float32), (pool + 1 / BUCKETS) / 2, UND_POOL * pool + (1 - UND_POOL) / BUCKETS)


def scorer(model: Broadcast, carried: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds n_trigrams, evidence (log-likelihoods, the largest 0) and units (shares by text alone in whole parts of UNIT); "und" is last."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Trigrams = model.value
        width = len(fitted.languages)
        counts, sizes = fitted.counts, fitted.counts.sum(axis=1, dtype=np.float64)
        lent = SMOOTHING + DISCOUNT * np.count_nonzero(counts, axis=1)  # what the background is worth
        logs = np.log((np.maximum(counts - DISCOUNT, 0.0) + lent[:, None] * fitted.background) / (sizes + SMOOTHING)[:, None])
        table = np.pad(np.vstack([logs, np.log(fitted.und)]), ((0, 0), (0, 1))).astype(np.float32)
        for batch in slices(batches, "text", SLICE):
            buckets, offsets = trigrams(batch.column("text"))
            n = sums_by_text(buckets < BUCKETS, offsets).astype(np.int64)
            sums = np.stack([sums_by_text(row[buckets], offsets) for row in table], axis=1)
            # In its declared language a row is judged by the others' trigrams.
            of = places(batch.column("declared"), fitted.languages)
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            asked = (of[row] < width) & (buckets < BUCKETS)
            own, times = np.unique(row[asked] * BUCKETS + buckets[asked], return_counts=True)
            row, bucket = own // BUCKETS, own % BUCKETS
            left = np.maximum(counts[of[row], bucket] - times - DISCOUNT, 0.0) + lent[of[row]] * fitted.background[bucket]
            without = np.bincount(row, times * np.log(left / (np.maximum(sizes[of[row]] - n[row], 0.0) + SMOOTHING)), minlength=batch.num_rows)
            judged = np.flatnonzero((of < width) & (n > 0))
            sums[judged, of[judged]] = without[judged]
            sums *= (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None]
            sums -= sums.max(axis=1, keepdims=True) if batch.num_rows else 0
            shares = np.exp(sums)
            shares /= shares.sum(axis=1, keepdims=True)
            units = np.where((n > 0)[:, None], np.floor(shares * UNIT + 0.5), 0).astype(np.int64)
            first = np.arange(batch.num_rows + 1, dtype=np.int32) * (width + 1)
            lists = [pa.ListArray.from_arrays(pa.array(first), pa.array(x.ravel())) for x in (sums, units)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(n, pa.int64()), *lists], names=[*carried, "n_trigrams", "evidence", "units"]
            )

    return score


@dataclass
class Priors:
    """What the whole corpus says: shares of the hypotheses, and units by declared language and hypothesis."""

    base: np.ndarray
    stated: np.ndarray


def fused(evidence: np.ndarray, own: np.ndarray, hosts: np.ndarray, suffixes: np.ndarray, declared: np.ndarray, priors: Priors) -> np.ndarray:
    """Log-probabilities up to a constant, rows by hypotheses, of the last of which ("und") nothing is declared."""
    width = len(priors.base) - 1

    def smoothed(counts: np.ndarray, prior: np.ndarray) -> np.ndarray:
        left = np.maximum(counts - own, 0) / UNIT
        return (left + STRENGTH * prior) / (left.sum(axis=1, keepdims=True) + STRENGTH)

    logs = evidence + np.log(smoothed(hosts, smoothed(suffixes, priors.base)))
    said = np.flatnonzero(declared < width)
    if len(said):
        times = np.maximum(priors.stated[declared[said]] - own[said], 0) / UNIT + 1
        times[np.arange(len(said)), declared[said]] += 3  # a declaration is right more often than not
        whole = np.maximum(priors.stated.sum(axis=0) - own[said], 0) / UNIT + width + 3 * (np.arange(width + 1) < width)
        logs[said] += np.log(times / whole)
    return logs


FUSED = "language string, probability double, text_language string, kept boolean"


def fuser(languages: tuple[str, ...], priors: Priors, carried: list[str], least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = np.array([*languages, UND], object)

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:

            def matrix(name: str, batch: pa.RecordBatch = batch) -> np.ndarray:
                return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, len(names))

            own = matrix("units")
            logs = fused(matrix("evidence"), own, matrix("hosts"), matrix("suffixes"), places(batch.column("declared"), languages), priors)
            heard = batch.column("n_trigrams").to_numpy() > 0
            top = logs.argmax(axis=1)
            chance = np.where(heard, 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1), 0.0)
            language = np.where(heard, names[top], UND)
            alone = np.where(heard, names[matrix("evidence").argmax(axis=1)], UND)
            kept = (language != UND) & (chance >= least)
            out = [pa.array(language, pa.string()), pa.array(chance), pa.array(alone, pa.string()), pa.array(kept.astype(bool))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *out], names=[*carried, "language", "probability", "text_language", "kept"])

    return fuse


def host_suffix(host: Column) -> Column:
    """What follows the last dot of a host, or nothing."""
    return F.when(host.contains("."), F.lower(F.substring_index(host, ".", -1))).otherwise(F.lit(""))


def _listed(counts: DataFrame, keys: list[str], width: int, name: str) -> DataFrame:
    """Rows (keys, place, n) as a list of ``width`` counts for each key."""
    found = counts.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("place", "n"))).alias("found"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.element_at("found", i), F.lit(0).cast("bigint")))
    return found.select(*keys, dense.alias(name))


def identified(rows: DataFrame, keep: list[str], languages: tuple[str, ...] | None = None, least: float = LEAST) -> DataFrame:
    """Languages of rows (text, declared, host, and the columns of ``keep``).

    Returns the columns of ``keep``, declared, host, language, probability,
    text_language (what the text alone says) and kept (a language is told, with
    probability >= least). ``languages`` are by default those that rows declare
    (declared_languages). A text in none of them gets "und", with the
    probability of that, and is not kept. Texts of fewer than 3 bytes, null and
    empty ones say nothing: they are "und", with probability 0. A declared
    language that is null or none of the languages says nothing. A null host
    counts as the host "", one without a dot has the suffix "". Repeated rows
    get the same result. An empty table gives an empty table.
    """
    declared = F.lower(F.regexp_extract(F.coalesce("declared", F.lit("")), r"^\s*([A-Za-z]+)", 1))
    rows = rows.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), declared.alias("declared"), F.coalesce("host", F.lit("")).alias("host"))
    languages = declared_languages(rows) if languages is None else languages
    width = len(languages) + 1
    with small_batches(rows.sparkSession):
        model = rows.sparkSession.sparkContext.broadcast(fit_trigrams(rows, languages))
    carried = [*keep, "declared", "host"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(carried).schema)
    said = rows.mapInArrow(scorer(model, carried), f"{kinds}, n_trigrams bigint, evidence array<double>, units array<bigint>")
    with small_batches(rows.sparkSession):
        said = durable(said.withColumn("suffix", host_suffix(F.col("host"))), "evidence")

    counted = said.select("host", "suffix", "declared", F.posexplode("units").alias("place", "n")).where("n > 0")
    counted = durable(counted.groupBy("host", "suffix", "declared", "place").agg(F.sum("n").alias("n")), "shares")
    hosts = _listed(counted.groupBy("host", "place").agg(F.sum("n").alias("n")), ["host"], width, "hosts")
    suffixes = _listed(counted.groupBy("suffix", "place").agg(F.sum("n").alias("n")), ["suffix"], width, "suffixes")
    # At most a row per pair of languages.
    known = F.when(F.col("declared").isin(*languages), F.col("declared")) if languages else F.lit(None).cast("string")
    pairs = counted.groupBy(known.alias("declared"), "place").agg(F.sum("n").alias("n")).collect()
    whole, stated = np.zeros(width), np.zeros((width - 1, width))
    for r in pairs:
        whole[r["place"]] += r["n"]
        if r["declared"] is not None:
            stated[languages.index(r["declared"]), r["place"]] = r["n"]
    priors = Priors((whole + UNIT) / (whole.sum() + width * UNIT), stated)

    nothing = F.array_repeat(F.lit(0).cast("bigint"), width)
    both = said.join(hosts, "host", "left").join(suffixes, "suffix", "left")
    both = both.select(*carried, "n_trigrams", "evidence", "units", F.coalesce("hosts", nothing).alias("hosts"), F.coalesce("suffixes", nothing).alias("suffixes"))
    return both.mapInArrow(fuser(languages, priors, carried, least), f"{kinds}, {FUSED}")


def row_key() -> Column:
    """128 bits of hash of all that tells a row's language."""
    one, two = F.xxhash64("doc_id", "text", "lang", "source"), F.xxhash64("text", F.lit(1), "source", "lang", "doc_id")
    return F.concat_ws("-", F.hex(one), F.hex(two)).alias("row_key")


def document_languages(docs: DataFrame) -> DataFrame:
    """Languages of documents (doc_id, text, lang, source): the source is the host, ``lang`` is declared.

    Adds row_key, a hash of the four columns, by which rows without a doc_id can be found again.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), row_key(), "text", F.col("lang").cast("string").alias("declared"), F.col("source").cast("string").alias("host"))
    return identified(rows, ["doc_id", "row_key"])


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is kept, with all their columns."""
    gone = durable(document_languages(docs).where("not kept").select("row_key").distinct(), "rejected")
    return rows_without_keys(docs.select(F.struct("*").alias("row"), row_key()), gone, "row_key").select("row.*")


def page_languages(pages: DataFrame) -> DataFrame:
    """Languages of pages (page_id, url, html): declared in <html lang>, with host and suffix of the address.

    The text is the html without scripts, styles, comments and tags.
    """
    markup = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>"
    rows = pages.select(
        F.col("page_id").cast("bigint"),
        F.regexp_replace("html", markup, " ").alias("text"),
        F.regexp_extract("html", r"(?is)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)", 1).alias("declared"),
        F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)).alias("host"),
    )
    return identified(rows, ["page_id"])
