"""Quoted CSV in splits against Spark's reader of whole files, and rows in file order."""

import csv
import io
import random

import pyarrow as pa
import pytest

from postsift.operators import sampling as R
from postsift.sources import posts as IO
from postsift.sources import records
from postsift.sources.records import ends_inside, numbered_records, read_quoted_csv

SCHEMA = "data string, label int"
KNOBS = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def small_splits(spark):
    for k, v in KNOBS.items():
        spark.conf.set(k, v)
    yield
    for k in KNOBS:
        spark.conf.unset(k)


def texts(seed, n):
    rng = random.Random(seed)
    parts = ["word", "two words", "\n", "\n\n", '"', '""', ",", " ", "é\U0001f600", '",', '\n"x",1\n', "\r\n", "long " * 30]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(n)]


def write(path, rows, newline="\n", quoting=csv.QUOTE_MINIMAL):
    held = io.StringIO()
    out = csv.writer(held, lineterminator=newline, quoting=quoting)
    out.writerow(["data", "label"])
    out.writerows(rows)
    path.write_bytes(held.getvalue().encode())


def whole(spark, path):
    return [tuple(r) for r in spark.read.schema(SCHEMA).options(**IO.CSV_OPTIONS).csv(str(path)).collect()]


@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_equals_the_reader_of_whole_files(spark, tmp_path, small_splits, quoting):
    rows = [(t, i % 2) for i, t in enumerate(texts(1, 400))]
    rows[200] = ("one record over many splits\n" * 500 + '"', 1)
    path = tmp_path / "a.csv"
    write(path, rows, quoting=quoting)
    got = read_quoted_csv(spark, str(path), SCHEMA, IO.CSV_OPTIONS, "position")
    splits = spark.read.text(str(path), lineSep="\n").rdd.getNumPartitions()
    assert splits > 8
    found = sorted(tuple(r) for r in got.collect())
    assert [r[0] for r in found] == list(range(len(rows)))
    assert [r[1:] for r in found] == whole(spark, path) == rows


def test_line_ends_of_two_characters_and_blank_lines(spark, tmp_path, small_splits):
    rows = [(t.replace("\r", ""), 0) for t in texts(2, 200)]
    path = tmp_path / "b.csv"
    write(path, rows, "\r\n")
    raw = path.read_bytes()
    path.write_bytes(raw.replace(b"data,label\r\n", b"data,label\r\n\r\n") + b"\r\n\r\n")
    got = sorted(read_quoted_csv(spark, str(path), SCHEMA, IO.CSV_OPTIONS, "position").collect())
    assert [(r.data, r.label) for r in got] == whole(spark, path)
    assert len(got) == 200


def test_quotes_that_open_nothing(spark, tmp_path, small_splits):
    path = tmp_path / "c.csv"
    lines = ["data,label"] + [f'5" disk {i},1' if i % 3 else f'"a ""b"" {i}\nnext, line",0' for i in range(500)]
    path.write_text("\n".join(lines) + "\n")
    got = sorted(read_quoted_csv(spark, str(path), SCHEMA, IO.CSV_OPTIONS, "position").collect())
    assert [(r.data, r.label) for r in got] == whole(spark, path)
    assert len(got) == 500


def test_many_files_in_the_order_of_their_names(spark, tmp_path, small_splits):
    rows = [(t, i) for i, t in enumerate(texts(3, 300))]
    for k in range(3):
        write(tmp_path / f"part-{k}.csv", rows[k * 100 : k * 100 + 100])
    (tmp_path / "part-3.csv").write_text("data,label\n")
    (tmp_path / "part-4.csv").write_text("")
    got = sorted(read_quoted_csv(spark, str(tmp_path), SCHEMA, IO.CSV_OPTIONS, "position").collect())
    assert [(r.position, r.data, r.label) for r in got] == [(i, t, v) for i, (t, v) in enumerate(rows)]


def test_a_field_that_is_never_closed_and_empty_input(spark, tmp_path, small_splits):
    path = tmp_path / "d.csv"
    path.write_text("data,label\nfine,1\n" + '"open\n' + "more\n" * 2000)
    got = sorted(numbered_records(spark, str(path)).collect())
    assert [r.position for r in got] == [0, 1]
    assert got[1].record == '"open\n' + "more\n" * 1999 + "more"
    (tmp_path / "e.csv").write_text("")
    assert read_quoted_csv(spark, str(tmp_path / "e.csv"), SCHEMA, IO.CSV_OPTIONS).collect() == []


def test_other_splits_than_first_seen_raise(spark, tmp_path, small_splits):
    path = tmp_path / "f.csv"
    write(path, [(t, 0) for t in texts(4, 200)])
    got = read_quoted_csv(spark, str(path), SCHEMA, IO.CSV_OPTIONS)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    with pytest.raises(Exception, match="split in other places"):
        got.collect()


@pytest.mark.parametrize(
    ("line", "from_start", "from_inside"),
    [
        ("", False, True),
        ("a,b", False, True),
        ('"a', True, False),
        ('a"b', False, False),
        ('"a""', True, False),
        ('x","y', True, True),
        ('"a","b', True, True),
        ('a,"b', True, False),
        ('","', False, True),
        ('""', False, True),
        ('"",1', False, True),
    ],
)
def test_states_of_a_line(line, from_start, from_inside):
    assert (ends_inside(line, False), ends_inside(line, True)) == (from_start, from_inside)


def test_states_agree_with_the_csv_module():
    rng = random.Random(5)
    for _ in range(3000):
        line = "".join(rng.choice('a,"') for _ in range(rng.randint(0, 9)))
        for before in ("", '"x\n'):
            rows = list(csv.reader(io.StringIO(before + line + "\nZ")))  # an open field takes in the next line
            assert ends_inside(line, bool(before)) == any("\nZ" in f for f in rows[-1]), (before, line)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_first_rows_of_a_class_in_file_order(spark, tmp_path, small_splits, fmt):
    rows = [(t, i % 3) for i, t in enumerate(texts(6, 300))]
    if fmt == "csv":
        write(tmp_path / "g.csv", rows)
        path = str(tmp_path / "g.csv")
    else:
        path = str(tmp_path / "g")
        spark.createDataFrame(rows, SCHEMA).repartitionByRange(1, "label").coalesce(1).write.parquet(path)
        rows = [tuple(r) for r in spark.read.parquet(path).collect()]
    df = IO.read_task(spark, path, fmt, position="position")
    got = R.sample_per_class(df, 20.9, "position").drop("position")
    expected = [r for v in (0, 1) for r in [r for r in rows if r[1] == v][:20]]
    assert sorted(map(tuple, got.select("data", "label").collect())) == sorted(expected)


def test_batches_do_not_matter(spark, tmp_path, small_splits):
    rows = [(t, 1) for t in texts(7, 100)]
    path = tmp_path / "h.csv"
    write(path, rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = sorted(read_quoted_csv(spark, str(path), SCHEMA, IO.CSV_OPTIONS, "position").collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(r.data, r.label) for r in got] == rows


def test_lines_that_cannot_change_the_state_do_not():
    rng = random.Random(8)
    for _ in range(3000):
        line = "".join(rng.choice(["a", ",", '""', '"']) for _ in range(rng.randint(0, 7)))
        if not len(records._turns(pa.array([line]))):
            assert (ends_inside(line, False), ends_inside(line, True)) == (False, True), line


def test_lines_that_cannot_change_the_state_need_not_be_looked_at():
    lines = [x for t in texts(9, 300) for x in f'"{t.replace(chr(34), chr(34) * 2)}",1'.split("\n")]
    batch = pa.RecordBatch.from_pydict({"value": lines, "id": [7] * len(lines), "at": list(range(100, 100 + len(lines)))})
    every = next(records.survey(iter([batch]))).to_pylist()[0]
    needed = sorted({*records._turns(batch["value"]).tolist(), *(i for i, x in enumerate(lines) if x in ("", "\r"))})
    assert 0 < needed[0] or len(needed) < len(lines)
    few = batch.take(pa.array(needed))
    some = next(records.survey(iter([few.slice(0, 50), few.slice(50)]))).to_pylist()[0]
    start, rest = some["first_at"] - 100, 99 + len(lines) - some["last_at"]
    assert (some["opens"], some["opens_inside"]) == (every["opens"], every["opens_inside"])
    assert start + some["n"] + (not some["opens"]) * rest == every["n"]
    assert some["n_inside"] + (not some["opens_inside"]) * rest == every["n_inside"]


def test_splits_of_blank_or_plain_lines_only(spark, tmp_path, small_splits):
    path = tmp_path / "i.csv"
    blank, plain = "\n" * 10000, "a plain line\n" * 1000
    rows = [(f"x{blank}y", 0), ("z", 1), (f"{plain}\r", 2), *[(f"v{i}", i) for i in range(1000)], (f'"{plain}{blank}', 3)]
    write(path, rows)
    raw = path.read_text(newline="")
    path.write_bytes(raw.replace("\nz,1\n", f"\n{blank}z,1\n{blank}").encode())
    got = sorted(read_quoted_csv(spark, str(path), SCHEMA, IO.CSV_OPTIONS, "position").collect())
    assert [(r.data, r.label) for r in got] == rows
    assert [r.position for r in got] == list(range(len(rows)))
