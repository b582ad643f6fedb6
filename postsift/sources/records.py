"""Records of quoted CSV files, read in splits and numbered in file order.

A quoted field may hold newlines, so where a record starts depends on all that
stands before it: Spark's own reader takes one task per file. Here the lines
of a file are read in splits. First, each split tells how it ends, and how many
records start in it, for both states in which it can begin (between records, or
inside of a quoted field). For that Spark counts the lines, and only those that
can change the state, and empty ones, are looked at one by one, each with its
place among all. These few rows, one for each split, are scanned in order: that
gives the state in which each split begins, and the number of its first record.
Then every split knows both, and puts its records together. If any runs over a
split's end, the pieces are joined by their number, in a shuffle of records.
Records become columns in Spark's parser.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsift.sources.durable import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Mapped = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

SPLIT = "id bigint, opens boolean, n bigint, opens_inside boolean, n_inside bigint, first_at bigint, last_at bigint"
PIECE = "number bigint, block bigint, rank bigint, head boolean, whole boolean, record string"

# A field that is quoted from its start goes on to the quote that is not doubled;
# quotes within other fields are plain characters.
_FIELD = r'(?:[^",][^,]*+|"(?:[^"]|"")*+"[^,]*+|)'
_FROM_START = re.compile(rf'(?:{_FIELD},)*+"(?:[^"]|"")*+\Z')
_FROM_INSIDE = re.compile(rf'(?:[^"]|"")*+(?:"[^,]*+(?:,(?:{_FIELD},)*+"(?:[^"]|"")*+\Z)|\Z)')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the line ends within a quoted field, if it begins inside of one or at a record's start."""
    if '"' not in line:
        return inside
    return (_FROM_INSIDE if inside else _FROM_START).match(line) is not None


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Ranges of rows of one split, one after the other."""
    ids = batch.column("id").to_numpy()
    cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), batch.num_rows]
    return ((i, j) for i, j in zip(cuts, cuts[1:], strict=False) if i < j)


def _turns(lines: pa.Array) -> np.ndarray:
    """Lines that can change the state: those with an odd number of quotes in a row somewhere. Any other line ends
    in the state in which it began: inside of a field it holds doubled quotes, and else its fields are closed."""
    return np.flatnonzero(pc.match_substring(pc.replace_substring(lines, '""', ""), '"').to_numpy(zero_copy_only=False))


def _filled(lines: pa.Array) -> np.ndarray:
    """Whether there is anything in a line."""
    return pc.invert(pc.or_(pc.equal(pc.binary_length(lines), 0), pc.equal(lines, "\r"))).to_numpy(zero_copy_only=False)


def _states(lines: pa.Array, turns: np.ndarray, inside: bool) -> tuple[np.ndarray, bool]:
    """The state in which each line begins, and that after the last one."""
    before = np.full(len(lines), inside)
    for i in turns.tolist():
        state = ends_inside(lines[i].as_py(), inside)
        if state != inside:
            before[i + 1 :] = inside = state
    return before, inside


def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split: does it end inside of a field, and how many records start in it, from either state. Of the lines,
    in order, those that hold something and cannot change the state may be left out: ``at`` numbers all of them. The
    records are those from the first to the last line given, which are told as well."""
    out: list[list] = []
    for batch in batches:
        for i, j in _runs(batch):
            own, at = batch.column("id")[i].as_py(), batch.column("at").to_numpy()[i:j]
            if not out or out[-1][0] != own:
                out.append([own, False, 0, True, 0, int(at[0]), int(at[0]) - 1])
            lines = batch.column("value").slice(i, j - i)
            filled, turns = _filled(lines), _turns(lines)
            since = np.diff(at, prepend=out[-1][6])  # this line, and those left out before it, which begin as it does
            for k in (1, 3):
                before, out[-1][k] = _states(lines, turns, out[-1][k])
                out[-1][k + 1] += int((since - ~filled)[~before].sum())
            out[-1][6] = int(at[-1])
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
    columns = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
    names = ["id", "opens", "n", "opens_inside", "n_inside", "first_at", "last_at"]
    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names)


def scan_splits(splits: DataFrame) -> DataFrame:
    """The state before each split, the number of its first record, and the rank of its file, from 1. One row per
    split, of all files in the order of their paths."""
    order = Window.partitionBy("file").orderBy("block")
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("opens") & ~F.col("opens_inside")).cast("int")  # ends in the other state
    settled = F.when(F.col("opens") == F.col("opens_inside"), F.col("opens").cast("int"))  # whatever it begins in
    known = splits.withColumn("turned", F.sum(turns).over(upto)).withColumn("settled", settled)
    last = F.last(F.when(F.col("settled").isNotNull(), F.struct("settled", "turned")), ignorenulls=True).over(before)
    known = known.withColumn("last", last).withColumn("so_far", F.coalesce(F.lag("turned").over(order), F.lit(0)))
    state = F.coalesce(F.col("last.settled"), F.lit(0)) + F.col("so_far") - F.coalesce(F.col("last.turned"), F.lit(0))
    known = known.withColumn("inside", state % 2 == 1)
    own = F.when(F.col("inside"), F.col("n_inside")).otherwise(F.col("n"))
    every = Window.orderBy("file", "block")
    number = F.coalesce(F.sum(own).over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rank = F.dense_rank().over(Window.orderBy("file")).cast("long")
    open_ = F.when(F.col("inside"), F.col("opens_inside")).otherwise(F.col("opens"))
    return known.select("id", "file", "block", "inside", number.alias("first"), rank.alias("rank"), open_.alias("open"))


def _given(number: list | np.ndarray, block: int, rank: int, head: list | np.ndarray, whole: bool, records: pa.Array) -> pa.RecordBatch:
    n = len(records)
    columns = [pa.array(number, pa.int64()), pa.array([block] * n, pa.int64()), pa.array([rank] * n, pa.int64()), pa.array(head, pa.bool_())]
    return pa.RecordBatch.from_arrays([*columns, pa.array([whole] * n, pa.bool_()), records], names=["number", "block", "rank", "head", "whole", "record"])


def assembler(header: bool, splits: Broadcast) -> Mapped:
    """Records of the splits of a task, and of those that do not lie in one split the pieces. ``splits`` tells the
    rank, place, state and first number of each."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = splits.value
        split, at, held = None, None, []  # the split at hand, and the parts of a record that is not complete yet
        inside, carried = False, False
        number, first = 0, 0

        def closed(whole: bool) -> Iterator[pa.RecordBatch]:
            """What is held: a record, or its part in this split."""
            whole = whole and not carried
            if held:
                text = "\n".join(held)
                head = header and at[1] == 0 and not carried and number == first
                yield _given([number], at[1], at[0], [head], whole, pa.array([text.removesuffix("\r") if whole else text]))
            held.clear()

        for batch in batches:
            for i, j in _runs(batch):
                if (own := batch.column("id")[i].as_py()) != split:
                    yield from closed(False)
                    if own not in known:
                        raise RuntimeError("the files were split in other places when they were looked at first; read them anew")
                    split, (*at, inside, first) = own, known[own]
                    carried, number = inside, first - 1  # a record that goes on is the last of those before
                lines = batch.column("value").slice(i, j - i)
                before, inside = _states(lines, _turns(lines), inside)
                keep = before | _filled(lines)
                lines, before = lines.filter(pa.array(keep)), before[keep]
                starts = np.flatnonzero(~before)
                upto = int(starts[0]) if len(starts) else len(lines)
                if upto:  # of the record that is held
                    held.append("\n".join(lines.slice(0, upto).to_pylist()))
                if len(starts):
                    yield from closed(True)
                    offsets = pa.array(np.append(starts, len(lines)).astype(np.int32))
                    records = pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")
                    carried = False
                    done = len(records) - inside
                    if done:
                        numbers = number + 1 + np.arange(done)
                        head = (numbers == first) & (header and at[1] == 0)
                        yield _given(numbers, at[1], at[0], head, True, pc.replace_substring_regex(records.slice(0, done), r"\r\z", ""))
                    number += len(records)
                    if inside:
                        held.append(records[done].as_py())
                if not inside:
                    yield from closed(True)
        yield from closed(False)

    return assemble


def _numbered(lines: DataFrame, splits: DataFrame, header: bool) -> DataFrame:
    rows = splits.collect()  # one row per split
    known = lines.sparkSession.sparkContext.broadcast({r["id"]: (r["rank"], r["block"], r["inside"], r["first"]) for r in rows})
    position = (F.col("number") - (F.col("rank") if header else 0)).alias("position")
    records = lines.select("value", "id").mapInArrow(assembler(header, known), PIECE)
    if any(r["open"] for r in rows):  # some run over a split's end
        own = [F.max(c).alias(c) for c in ("rank", "head", "whole")]
        records = records.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("block", "record"))).alias("parts"), *own)
        joined = F.regexp_replace(F.array_join("parts.record", "\n"), r"\r\z", "")
        records = records.withColumn("record", F.when(F.col("whole"), F.col("parts")[0]["record"]).otherwise(joined))
    return records.where("not head").select(position, "rank", "record")


def _split_id(path: str, block: str) -> Column:
    return F.xxhash64(path, block)


def _lines(text: DataFrame) -> DataFrame:
    """Lines with the split that they are from, as a hash: to carry the path with every line would cost more than all
    else. Its parts are only for the count of lines."""
    path, block = "_metadata.file_path", "_metadata.file_block_start"
    return text.select("value", _split_id(path, block).alias("id"), F.xxhash64(path).alias("path"), F.col(block).alias("block"))


def _survey(lines: DataFrame, path: str | list[str]) -> DataFrame:
    """What :func:`scan_splits` tells, written once."""
    numbered = lines.withColumn("at", F.monotonically_increasing_id())
    counts = numbered.groupBy("path", "block").agg(F.min("at").alias("from"), F.max("at").alias("to"))
    files = lines.sparkSession.read.format("binaryFile").load(path)  # their contents are not read
    files = files.select(F.col("_metadata.file_path").alias("file")).distinct().withColumn("path", F.xxhash64("file"))
    every = counts.join(F.broadcast(files), "path").withColumn("id", _split_id("file", "block"))  # a row per split
    empty, turns = F.col("value").isin("", "\r"), F.contains(F.replace("value", F.lit('""'), F.lit("")), F.lit('"'))
    looked = numbered.select("value", "id", "at").where(empty | turns).mapInArrow(survey, SPLIT)
    told = every.join(looked, "id", "left")
    other = F.raise_error(F.lit("the files were split anew while they were looked at; read them again")).cast("bigint")
    start = F.when((F.col("first_at") < F.col("from")) | (F.col("last_at") > F.col("to")), other).otherwise(F.col("first_at") - F.col("from"))
    rest = F.col("to") - F.col("last_at")
    none = F.col("first_at").isNull()
    splits = told.select(
        "id",
        "file",
        "block",
        F.coalesce("opens", F.lit(False)).alias("opens"),
        F.when(none, F.col("to") - F.col("from") + 1).otherwise(start + F.col("n") + F.when(F.col("opens"), 0).otherwise(rest)).alias("n"),
        F.coalesce("opens_inside", F.lit(True)).alias("opens_inside"),
        F.when(none, 0).otherwise(F.col("n_inside") + F.when(F.col("opens_inside"), 0).otherwise(rest)).alias("n_inside"),
    )
    return durable(scan_splits(splits), "splits")


def numbered_records(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """The records of CSV files (``record``), each with its ``position`` among all, from 0, in the order of the
    files' paths and within a file. Headers are left out.

    The first pass runs at once. The splits must be the same when the result
    is used: if the setting for their size changes in between, that raises.
    """
    lines = _lines(spark.read.text(path, lineSep="\n"))
    return _numbered(lines, _survey(lines, path), header).drop("rank")


def read_quoted_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, options: dict | None = None, position: str | None = None
) -> DataFrame:
    """Quoted CSV files with a header, whose fields may hold newlines, read in splits as :func:`numbered_records` does.

    As in Spark's reader, ``schema`` goes by position, and columns that the
    folders name (``split=train``) stand last. ``position`` names a column
    for the place of a row in the files, if it is wanted.
    """
    schema = spark.createDataFrame([], schema).schema
    text = spark.read.text(path, lineSep="\n")
    folders = [f for f in text.schema.fields if f.name != "value"]
    told = {f.name for f in folders}
    lines = _lines(text)
    splits = _survey(lines, path)
    given = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in (options or {}).items() if k != "header"}
    fields = T.StructType([f for f in schema.fields if f.name not in told])
    records = _numbered(lines, splits, header=True)
    rows = records.select("position", "rank", F.from_csv("record", F.lit(fields.toDDL()), given).alias("row"))
    if folders:
        kinds = {f.name: f.dataType for f in schema.fields}
        values = {f.name: F.url_decode(F.regexp_extract("file", f"/{re.escape(f.name)}=([^/]*)/", 1)) for f in folders}
        named = {k: F.when(v != "__HIVE_DEFAULT_PARTITION__", v).cast(kinds.get(k, text.schema[k].dataType)) for k, v in values.items()}
        files = splits.select("rank", "file").distinct().select("rank", *[v.alias(k) for k, v in named.items()])
        rows = rows.join(F.broadcast(files), "rank")  # one row per file
    own = [F.col("position").alias(position)] if position else []
    return rows.select(*own, *[F.col("row")[f.name].alias(f.name) for f in fields], *[F.col(f.name) for f in folders])


def with_file_positions(df: DataFrame, position: str) -> DataFrame:
    """Rows just read from Parquet files, with their place: path of the file, then row in it, as text in order."""
    place = F.lpad(F.col("_metadata.row_index").cast("string"), 19, "0")
    return df.select("*", F.concat(F.col("_metadata.file_path"), F.lit("\t"), place).alias(position))
