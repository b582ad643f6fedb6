"""The prefix trie against one built from plain lists of turns."""

import hashlib
import math
import random
import zlib

import pytest

from postsift.llm import trie
from postsift.llm.trie import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, depth string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ident(role, text):
    return hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()


def plain(rows):
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append(((turn is not None, turn or 0), ident(role, text), (role or "", text or "")))
    own = {c: [t[2] for t in sorted(v)] for c, v in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))  # the remainder has the sign of c, as in SQL
        seq = tuple(own.get(base, [])[:h] + turns[h:])
        ends.setdefault(seq, []).append(c)
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children, leaves, saved = {}, {}, {}
    for seq, held in members.items():
        if seq:
            children.setdefault(seq[:-1], []).append(seq)
    for seq, held in members.items():
        for d in range(len(seq) + 1):
            leaves[seq[:d]] = leaves.get(seq[:d], 0) + (seq not in children)
            saved[seq[:d]] = saved.get(seq[:d], 0) + (len(held) - 1) * (len(seq[-1][1].encode()) if seq else 0)
    out = []
    for seq, held in members.items():
        told = hashlib.sha256(",".join(map(str, sorted(ends.get(seq, [])))).encode()).hexdigest()
        parent = min(members[seq[:-1]]) if seq else None
        out.append((min(held), len(seq), parent, len(held), len(children.get(seq, [])), leaves[seq], saved[seq], told))
    return sorted(out, key=str)


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(seed, convs, texts):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for turn in range(rng.randint(1, 9)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(texts)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(7)


@pytest.mark.parametrize(("run_turns", "part_bytes"), [(100_000, 1 << 23), (3, 3000), (1, 6000)])
def test_equals_a_plain_trie(spark, run_turns, part_bytes):
    rows = made(1, 60, ["a", "b", "é", "", None])
    rows += [(100 + i, t, "user", "a" if t < 3 else f"t{i}") for i in range(40) for t in range(6)]  # a common start
    rows += [(200 + i, t, "user", "same") for i in range(30) for t in range(8)]  # copies
    rows += [(None, 1, "user", "a"), (300, None, "user", "z"), (300, 1, None, None), (300, 1, None, None), (300, 1, "user", "q")]
    rows += [(-7, 0, "user", "below zero"), (-5, 0, "user", "x"), (400, 0, "user", "long" * 50_000), (405, 0, "user", "long" * 50_000)]
    rows += [(500, t, "user", str(t)) for t in range(700)] + [(505, t, "user", str(t)) for t in range(690)]
    rows = [*rows, *rows[:5]]
    assert found(prefix_trie(frame(spark, rows), run_turns, part_bytes)) == plain(rows)


def test_empty_table(spark):
    assert found(prefix_trie(frame(spark, []))) == []
    assert found(prefix_trie(frame(spark, [(None, 0, "user", "a")]))) == []


def test_given_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert found(prefix_trie(df)) == plain([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])


def test_layouts_grow_and_keep_their_children():
    root = trie.Tree(b"")
    kinds = []
    for i in range(256):
        root.insert(bytes([(i * 37) % 256, 1]), trie.Key([1], 1, i))
        kinds.append(type(root.layout).__name__ + str(getattr(root.layout, "room", "")))
    assert [kinds.index(k) for k in ("Small4", "Small16", "Indexed", "Direct")] == [0, 4, 16, 48]
    assert [b for b, _ in root.layout.items()] == list(range(256))
    assert all(root.layout.get((i * 37) % 256).key.conv_id == i for i in range(256))


def test_paths_are_compressed_and_only_whole_turns_are_nodes():
    keys = [b"aaaa" + b"bbbb", b"aaaa" + b"bbcc", b"aaaa", b"abaa"]  # ids of four bytes
    root = trie.Tree(b"")
    for i, key in enumerate(keys):
        root.insert(key, trie.Key([10, 1][: len(key) // 4], 1, i))
    assert root.layout.get(ord("a")).path == b"a"  # forks within an id
    rows = [r[2:] for r in trie.nodes(root, 0, False, width=4)]
    assert rows == [(2, 0, 1, 0, 1, 0), (2, 1, 1, 0, 1, 0), (1, 0, 3, 2, 2, 20), (1, 3, 1, 0, 1, 0), (0, 0, 4, 2, 3, 20)]
