import base64
import hashlib
from collections import defaultdict

import pytest

from postsift.llm import warc as w

PAGES = "page_id bigint, url string, html string, digest string"


def record(payload, extra=""):
    size = len(payload.encode())
    return f"WARC/1.0\r\nWARC-Type: response\r\n{extra}Content-Length: {size}\r\n\r\n{payload}\r\n\r\n"


def expected(rows, least=0):
    groups = defaultdict(list)
    for i, _, html, _ in rows:
        if i is not None:
            groups[html or ""].append(i)
    out = []
    for i, _, html, _ in rows:
        payload = (html or "").encode()
        top = max(groups[html or ""], default=None)
        revisit = top is not None and i != top and len(payload) >= least
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((i, len(payload), digest, "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def found(df):
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()], key=str)


def nasty_pages():
    inner = record("inside") * 3
    htmls = [None, "", "a", "a", "é" * 100, inner, f"x{inner}", inner + "\r\n\r\n", "WARC/1.0\r\n", "\r\n\r\n", "\r\n\r\nWARC/1.0\r\n\r\n", "tail\r\n"]
    htmls += ["WARC/1.0\r\nContent-Length: 5\r\n\r\nabc", "z" * 5000 + record("q" * 300) + "z" * 5000, "WARC/1.0\r\nContent-Length: 99999999999999999999\r\n\r\n", "\n", "\r"]
    rows = [(i, f"http://h/{i}\r\nX: y" if i % 3 else None, h, "clash") for i, h in enumerate(htmls)]
    return [*rows, rows[4], (None, None, "nobody", None), (None, None, "a", None), *[(100 + i, "u", "same", None) for i in range(30)]]


@pytest.mark.parametrize("split", ["128m", "700"])
@pytest.mark.parametrize("least", [0, 2])
def test_round_trip(spark, tmp_path, split, least):
    rows = nasty_pages()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = w.archived_pages(spark.createDataFrame(rows, PAGES).coalesce(2), str(tmp_path / "a"), least)
        assert found(df) == expected(rows, least)
        assert df.where("n_pieces > 1").count() >= 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_empty_table(spark, tmp_path):
    assert w.archived_pages(spark.createDataFrame([], PAGES), str(tmp_path / "a")).count() == 0


def test_what_the_chain_does_not_reach_is_no_record(spark, tmp_path):
    good = record("one", "WARC-Record-ID: <urn:page:1>\r\n") + record("two", "WARC-Record-ID: <urn:page:2>\r\n")
    (tmp_path / "x.warc").write_bytes((good + "garbage" + record("lost")).encode())
    got = w.read_archives(spark, str(tmp_path)).collect()
    assert sorted(r.record_id for r in got) == ["<urn:page:1>", "<urn:page:2>"]


def test_digest_matches_python(spark):
    texts = ["", "a", "é" * 50, "x" * 1000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", w.base32_sha1(df.t).alias("d")).collect():
        assert r.d == base64.b32encode(hashlib.sha1(r.t.encode()).digest()).decode()
