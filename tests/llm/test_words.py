import re

import numpy as np
import pyarrow as pa

from postsift.llm import words as w


def test_words_match_a_regular_expression(monkeypatch):
    monkeypatch.setattr(w, "WINDOW", 64)
    texts = [None, "", "a", " a  b\t", "AÉé b", "x" * 200 + " y", "\x00 \x00\x00", "a b", "end\n", "   z", "w" * 64 + " v" * 40]
    runs = w.Words(lower=True)(pa.array(texts))
    seen = {}
    for i, text in enumerate(texts):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        expected = re.findall(r"[^\x20\x09-\x0D]+", lower)
        lo, hi = runs.first[i], runs.first[i + 1]
        got = [runs.data[s:e].tobytes().decode() for s, e in zip(runs.starts[lo:hi], runs.ends[lo:hi], strict=True)]
        assert got == expected
        for word, h in zip(got, runs.hashes[lo:hi].tolist(), strict=True):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_hashes_do_not_depend_on_place():
    one = w.Words()(pa.array(["alpha beta gamma"])).hashes
    two = w.Words()(pa.array(["x" * 1000 + " gamma", "beta", "alpha"])).hashes
    assert list(one) == list(two[1:][::-1])


def test_slices_keep_all_rows():
    batch = pa.record_batch({"text": ["a" * n for n in (5, 50, 0, 7, 3)] + [None]})
    parts = list(w.slices(iter([batch]), "text", 10))
    assert [x for p in parts for x in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert max(p.num_rows for p in parts) < 6


def test_mixed_is_one_to_one():
    x = np.arange(10_000, dtype=np.uint64)
    assert len(np.unique(w.mixed(x))) == len(x)
