"""WARC archives: written from pages, and read back by boundary-chain verification.

Archives are plain text output of Spark whose line end is the end of a
record. They are read in splits, cut at the magic that opens a record. Every
piece is a candidate: its header tells where its successor starts. Magic also
occurs inside payloads, so candidates are only believed if the chain of
successors from the file's start reaches them. Each task follows the chains
within its split to where they leave it; pointer jumping over these exits,
which doubles its reach with each join, finds where the chain enters each
split. All candidates it does not reach are payload.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections.abc import Iterator
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postsift.sources.durable import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
BROADCAST_GROUPS = 500_000  # groups of equal payloads that go to every executor; more are joined by a shuffle
LEAST_BYTES = 0  # smaller payloads are written again each time

# The digits of base 32 as conv() writes them, and as RFC 4648 does.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: five hex digits make four of base 32."""
    digest = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), CONV_DIGITS, BASE32_DIGITS)


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write pages (page_id, url, html) as WARC files, one per task, to a folder.

    Of pages with equal payloads of at least ``least_bytes`` bytes, the one
    with the largest page_id is a response record; the others are revisit
    records without payload, that name digest, length and that page.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("bytes", F.octet_length("payload"))
    large = rows.where(F.col("bytes") >= least_bytes)
    groups = large.groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("n")).where("n > 1 and original is not null")
    groups = durable(groups.select("digest", "original"), "payload_groups")
    few = groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    both = rows.join(F.broadcast(groups) if few else groups.hint("merge"), "digest", "left")
    revisits = F.col("original").isNotNull() & (F.col("bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("original"))

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\r\n]+", " "), F.lit("\r\n")), F.lit(""))

    header = F.concat(
        F.lit(MAGIC),
        field("WARC-Type", F.when(revisits, "revisit").otherwise("response")),
        field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Date", F.lit(DATE)),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        field("WARC-Refers-To", F.when(revisits, F.concat(F.lit("<urn:page:"), F.col("original").cast("string"), F.lit(">")))),
        field("WARC-Profile", F.when(revisits, F.lit(PROFILE))),
        field("X-Payload-Length", F.when(revisits, F.col("bytes").cast("string"))),
        field("Content-Type", F.lit("text/html")),
        F.lit("Content-Length: "),
        F.when(revisits, 0).otherwise(F.col("bytes")).cast("string"),
        F.lit(END),
    )
    body = F.when(revisits, F.lit("")).otherwise(F.col("payload"))
    both.select(F.concat(header, body).alias("value")).write.option("lineSep", END).text(path)


PIECES = (
    "file string, block bigint, seq bigint, rel bigint, size bigint, body_at bigint, length bigint, succ bigint, exit bigint, "
    "alone boolean, type string, record_id string, refers_to string, digest string, full_length bigint, sha1 string"
)


def header_of(piece: bytes) -> tuple[dict[str, str], int, int] | None:
    """Fields, where the payload starts and how long it is; None if this is no header."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    return (fields, end + 4, int(length)) if length.isascii() and length.isdigit() and len(length) < 19 else None


def base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut pieces into candidates. ``rel`` counts from the first piece of the split; chains are followed within it."""
    magic = len(MAGIC)

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        out: dict[int, int] = {}
        ends = []
        for row in reversed(rows):
            rel, succ = row[3], row[7]
            if succ is not None:
                out[rel] = out.get(succ, succ)
            ends.append(out.get(rel))
        done = [(*r[:8], e, *r[8:]) for r, e in zip(rows, reversed(ends), strict=True)]
        names = [c.split()[0] for c in PIECES.split(", ")]
        kinds = [{"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}[c.split()[1]] for c in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

    rows, at, here = [], 0, None
    for batch in batches:
        for file, block, piece in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("value"), strict=True):
            if here != (file, block):
                if rows:
                    yield flush(rows)
                rows, at, here = [], 0, (file, block)
            value = piece.as_buffer()
            body = bytes(value)
            rel = at - magic
            found = None if block == 0 and not rows else header_of(body)  # nothing stands before a file's first magic
            if found is None:
                rows.append((file, block, len(rows), rel, len(body) + magic, None, None, None, False, None, None, None, None, None, None))
            else:
                fields, start, length = found
                succ = rel + magic + start + length + len(END)
                alone = start + length + len(END) == len(body)
                rows.append(
                    (
                        file, block, len(rows), rel, len(body) + magic, start, length, succ, alone,
                        fields.get("warc-type"), fields.get("warc-record-id"), fields.get("warc-refers-to"),
                        fields.get("warc-payload-digest"), int(x) if (x := fields.get("x-payload-length", "")).isdigit() else None,
                        base32(body[start : start + length]) if alone else None,
                    )
                )
            at += len(body) + magic
    if rows:
        yield flush(rows)


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces again, with their numbers in the split."""
    here, seq = None, 0
    for batch in batches:
        numbers = []
        for at in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True):
            seq = seq + 1 if at == here else 0
            here = at
            numbers.append(seq)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], names=[*batch.schema.names, "seq"])


def walk(part: pd.DataFrame) -> pd.DataFrame:
    """Of the candidates of a split: which the chain reaches, given where it enters, and which one each piece belongs to."""
    part = part.sort_values("seq")
    succ = dict(zip(part["rel"], part["succ"], strict=True))
    at = next(iter(part.loc[part["entered"], "rel"]), None)
    reached = set()
    while at in succ:
        reached.add(at)
        at = succ[at] if pd.notna(succ[at]) else None
        at = int(at) if at is not None else None
    owner, owners = None, []
    for rel in part["rel"]:
        owner = rel if rel in reached else owner
        owners.append(owner)
    return pd.DataFrame(
        {"file": part["file"], "block": part["block"], "seq": part["seq"], "reached": part["rel"].isin(reached), "owner": pd.array(owners, "Int64")}
    )


def reachable(jumps: DataFrame) -> DataFrame:
    """Of pointers (file, off, exit): the offsets that lead on from the start of their file, by pointer jumping."""
    reached = durable(jumps.where("off = 0").select("file", "off"), "reached")
    count = reached.count()
    while True:
        step = reached.join(jumps, ["file", "off"]).select("file", F.col("exit").alias("off"))
        reached = durable(reached.union(step).distinct(), "reached")
        before, count = count, reached.count()
        if count == before:
            return reached
        twice = jumps.select("file", "off", F.col("exit").alias("via")).join(
            jumps.select("file", F.col("off").alias("via"), F.col("exit").alias("next")), ["file", "via"], "left"
        )
        jumps = durable(twice.select("file", "off", F.coalesce("next", "via").alias("exit")), "jumps")


def pieces_of(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.option("lineSep", MAGIC).text(path)
    return read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value")
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives in a folder.

    Returns file, off (where the record starts), type, record_id, refers_to,
    payload_bytes, payload_digest (base 32 SHA-1, of the payload read; of a
    revisit as its header states) and n_pieces (more than one if the payload
    holds magic). What the chain of a file does not reach is no record.
    """
    found = durable(pieces_of(spark, path).mapInArrow(candidates, PIECES), "candidates")
    blocks = found.groupBy("file", "block").agg(F.sum("size").alias("size"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = durable(blocks.select("file", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")), "blocks")
    placed = durable(found.join(blocks, ["file", "block"]).withColumn("off", F.col("base") + F.col("rel")), "placed")
    jumps = placed.where("exit is not null").select("file", "off", (F.col("base") + F.col("exit")).alias("exit"))
    reached = reachable(jumps).withColumn("entered", F.lit(True))
    marked = placed.select("file", "block", "seq", "rel", "succ", "off").join(reached, ["file", "off"], "left")
    marked = marked.select("file", "block", "seq", "rel", "succ", F.coalesce("entered", F.lit(False)).alias("entered"))
    walked = marked.groupBy("file", "block").applyInPandas(walk, "file string, block bigint, seq bigint, reached boolean, owner bigint")
    # Pieces before the first record of a split belong to the last one of the splits before.
    carried = durable(placed.drop("off").join(durable(walked, "walked"), ["file", "block", "seq"]).withColumn("at", F.col("base") + F.col("owner")), "walked_pieces")
    lasts = carried.groupBy("file", "block").agg(F.max("at").alias("last"))
    lasts = lasts.select("file", "block", F.last("last", ignorenulls=True).over(before).alias("earlier"))
    owned = carried.join(lasts, ["file", "block"]).withColumn("off", F.coalesce("at", "earlier"))
    fields = ["file", "off", "type", "record_id", "refers_to", "digest", "full_length", "length", "sha1"]
    whole = owned.where("reached and alone").select(*fields, F.lit(1).cast("bigint").alias("n_pieces"))
    rest = durable(owned.where("off is not null and not (reached and alone)"), "rest")
    if rest.limit(1).count():
        whole = whole.join(rest.select("file", "off").distinct(), ["file", "off"], "left_anti").union(_joined(spark, path, owned, rest, fields))
    revisit = F.col("type") == "revisit"
    return whole.select(
        "file",
        "off",
        "type",
        "record_id",
        "refers_to",
        F.when(revisit & F.col("full_length").isNotNull(), F.col("full_length")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit & F.col("digest").isNotNull(), F.regexp_replace("digest", "^sha1:", "")).otherwise(F.col("sha1")).alias("payload_digest"),
        "n_pieces",
    )


def _payload(start: int, length: int, parts: list) -> str:
    """The digest of a record's payload out of its pieces, between which the magic stood."""
    whole = MAGIC.encode().join(bytes(p["value"]) for p in sorted(parts, key=lambda p: (p["block"], p["seq"])))
    return base32(whole[start : start + length])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_payload(*r) for r in zip(*(batch.column(c).to_pylist() for c in ("body_at", "length", "parts")), strict=True)]
        keep = [c for c in batch.schema.names if c not in ("body_at", "parts", "sha1")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(rows, pa.string())], names=[*keep, "sha1"])


def _joined(spark: SparkSession, path: str, owned: DataFrame, rest: DataFrame, fields: list[str]) -> DataFrame:
    """Records whose payload spans several pieces: these alone are read again."""
    split = durable(rest.select("file", "off").distinct(), "split_records")
    wanted = durable(owned.join(split, ["file", "off"]).select("file", "block", "seq", "off"), "wanted")
    few = wanted.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    again = pieces_of(spark, path).mapInArrow(numbered, "file string, block bigint, value binary, seq bigint")
    again = again.join(F.broadcast(wanted) if few else wanted.hint("merge"), ["file", "block", "seq"])
    parts = again.groupBy("file", "off").agg(F.collect_list(F.struct("block", "seq", "value")).alias("parts"))
    heads = owned.where("reached").join(split, ["file", "off"]).select(*fields, "body_at")
    both = heads.join(parts, ["file", "off"]).withColumn("n_pieces", F.size("parts").cast("bigint"))
    order = [*fields[:-1], "n_pieces", "sha1"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in both.select(order).schema)
    out = both.select(*fields[:-1], "n_pieces", "body_at", "parts").mapInArrow(_digests, schema)
    return out.select(*fields, "n_pieces")


def archived_pages(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write pages to archives, read them back, and return what the records say.

    Per page: page_id, payload_bytes, payload_digest, record_type (response or
    revisit) and refers_to (a page_id, of revisits). A null html is an empty
    payload; a null page_id stays null, and is a response if its payload has no
    page_id at all; of rows that repeat the largest page_id of a payload all
    are responses. A null url is left out. Payloads may hold anything, records
    included. Other columns are not looked at; an empty table gives an empty
    table.
    """
    write_archives(pages, path, least_bytes)
    records = read_archives(pages.sparkSession, path)
    number = partial(F.regexp_extract, pattern=r"^<urn:page:(-?\d+)>$", idx=1)
    return records.select(
        F.nullif(number("record_id"), F.lit("")).cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.nullif(number("refers_to"), F.lit("")).cast("bigint").alias("refers_to"),
        "n_pieces",
    )
