"""Prefix trie of conversations, from adaptive radix trees over turn ids.

A turn is a fixed-width big-endian id (the 16 bytes of an md5 over role and
text), and a conversation the ids of its turns, one after the other. Equal
conversations are counted first, so that each is one key however many copies
it has. Keys are dealt out by range and sorted; tasks build adaptive radix
trees over runs of them. A tree's nodes grow from 4 to 16, 48 and 256 children
as they fill, and paths without branches are kept as bytes in one node. Only
depths at whole turns give out nodes of the trie, also in the midst of such a
path; a branch within an id gives out none.

A run starts where the one before ended, and knows how many turns its first
key shares with the last key before it, and whether its last key goes on in
the next. So each node of the trie is counted once as a child, as a leaf and
as a text, in the first run that meets it, and what runs give out for the same
node is summed up.
"""

from __future__ import annotations

import hashlib
import os
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsift.sources.durable import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 16  # bytes of a turn id
RUN_TURNS = 100_000  # turns of the keys of one tree, or those of one key
PART_BYTES = 8 << 20  # bytes of keys in a range of them, about
LEAD = 8  # turns that a conversation can take from another one, at most
NODE = "node binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
NO_END = hashlib.sha256(b"").hexdigest()


@dataclass
class Key:
    """A distinct conversation: UTF-8 bytes of each turn's text, number and smallest id of its copies."""

    sizes: list[int]
    n: int
    conv_id: int


class Small:
    """Up to ``room`` children beside their bytes, in order (4 or 16)."""

    __slots__ = ("room", "at", "nodes")

    def __init__(self, room: int):
        self.room = room
        self.at = bytearray()
        self.nodes: list[Tree] = []

    def get(self, byte: int) -> Tree | None:
        i = self.at.find(byte)
        return self.nodes[i] if i >= 0 else None

    def full(self) -> bool:
        return len(self.at) == self.room

    def put(self, byte: int, node: Tree) -> None:
        i = self.at.find(byte)
        if i >= 0:
            self.nodes[i] = node
            return
        i = sum(b < byte for b in self.at)
        self.at.insert(i, byte)
        self.nodes.insert(i, node)

    def items(self) -> list[tuple[int, Tree]]:
        return list(zip(self.at, self.nodes, strict=True))


class Indexed:
    """Up to 48 children; 256 bytes tell the place of each (255: none)."""

    __slots__ = ("place", "nodes")

    def __init__(self) -> None:
        self.place = bytearray(b"\xff" * 256)
        self.nodes: list[Tree] = []

    def get(self, byte: int) -> Tree | None:
        i = self.place[byte]
        return self.nodes[i] if i != 255 else None

    def full(self) -> bool:
        return len(self.nodes) == 48

    def put(self, byte: int, node: Tree) -> None:
        i = self.place[byte]
        if i != 255:
            self.nodes[i] = node
            return
        self.place[byte] = len(self.nodes)
        self.nodes.append(node)

    def items(self) -> list[tuple[int, Tree]]:
        return [(b, self.nodes[i]) for b, i in enumerate(self.place) if i != 255]


class Direct:
    """A place for each byte."""

    __slots__ = ("nodes",)

    def __init__(self) -> None:
        self.nodes: list[Tree | None] = [None] * 256

    def get(self, byte: int) -> Tree | None:
        return self.nodes[byte]

    def full(self) -> bool:
        return False

    def put(self, byte: int, node: Tree) -> None:
        self.nodes[byte] = node

    def items(self) -> list[tuple[int, Tree]]:
        return [(b, n) for b, n in enumerate(self.nodes) if n is not None]


def grown(layout: Small | Indexed | Direct) -> Small | Indexed | Direct:
    """The next larger layout with the same children."""
    if isinstance(layout, Small):
        out = Small(16) if layout.room == 4 else Indexed()
    else:
        out = Direct()
    for byte, node in layout.items():
        out.put(byte, node)
    return out


class Tree:
    """A node of the radix tree: the path that leads to it from its parent's
    branch, the key that ends here, and its children by their first byte."""

    __slots__ = ("path", "key", "layout")

    def __init__(self, path: bytes, key: Key | None = None):
        self.path = path
        self.key = key
        self.layout: Small | Indexed | Direct = Small(4)

    def put(self, node: Tree) -> None:
        """Hang a node below by the first byte of its path."""
        byte = node.path[0]
        if self.layout.get(byte) is None and self.layout.full():
            self.layout = grown(self.layout)
        self.layout.put(byte, node)

    def insert(self, key: bytes, value: Key) -> None:
        at, done = self, 0
        while done < len(key):
            below = at.layout.get(key[done])
            if below is None:
                at.put(Tree(key[done:], value))
                return
            same = len(os.path.commonprefix([below.path, key[done : done + len(below.path)]]))
            if same < len(below.path):  # the path forks within
                fork = Tree(below.path[:same])
                below.path = below.path[same:]
                fork.put(below)
                at.put(fork)
                below = fork
            at, done = below, done + same
        at.key = value


def nodes(root: Tree, seen: int, opens: bool, width: int = WIDTH) -> Iterator[tuple]:
    """Nodes of the trie that a run of keys meets, children first: digest, parent's digest, depth, smallest
    conversation, conversations, children, leaves and saved bytes, as far as this run is the one to count them.

    ``seen``: turns that the first key shares with the last key before the
    run. ``opens``: whether the next key after the run begins with its last one.
    """
    hashes = [hashlib.md5(usedforsecurity=False)]  # of the path so far, one for each whole turn
    sums: list[list] = [[None, 0, 0, 0, 0, None]]  # smallest id, conversations, nodes a turn below, leaves, saved, sizes
    stack: list[tuple] = [(root, 0, b"", True, True, False)]
    while stack:
        node, before, rest, first, last, done = stack.pop()
        depth, below = before + len(node.path), node.layout.items()
        if not done:
            stack.append((node, before, rest, first, last, True))
            sums.append([None, 0, 0, 0, 0, None])
            path = rest + node.path
            whole = len(path) - len(path) % width
            for i in range(0, whole, width):
                hashes.append(hashes[-1].copy())
                hashes[-1].update(path[i : i + width])
            for i in range(len(below) - 1, -1, -1):
                stack.append((below[i][1], depth, path[whole:], first and i == 0, last and i == len(below) - 1, False))
            continue
        least, n, heads, leaves, saved, sizes = sums.pop()
        if node.key is not None:
            least = node.key.conv_id if least is None else min(least, node.key.conv_id)
            n, sizes = n + node.key.n, node.key.sizes
            leaves += not below and not (last and opens)
        for d in range(depth // width, before // width if node is not root else -1, -1):
            new = not (first and d <= seen)
            saved += (n - new) * (sizes[d - 1] if d else 0)
            yield hashes[d].digest(), hashes[d - 1].digest() if d else None, d, least, n, heads, leaves, saved
            heads = int(new)
        del hashes[before // width + 1 :]
        upper = sums[-1]
        upper[0] = least if upper[0] is None else min(upper[0], least)
        upper[1:5] = upper[1] + n, upper[2] + heads, upper[3] + leaves, upper[4] + saved
        upper[5] = sizes


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, Key]]:
    for batch in batches:
        yield from (
            (part, key, Key(sizes, n, conv_id))
            for part, key, sizes, n, conv_id in zip(*(batch.column(c).to_pylist() for c in ("part", "key", "sizes", "n", "conv_id")), strict=True)
        )


def shared_turns(a: bytes, b: bytes) -> int:
    return len(os.path.commonprefix([a, b])) // WIDTH


def builder(edges: dict[int, tuple[int, bool]], run_turns: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Nodes of the keys of a task, which come in order within each part. ``edges``: for each part, the turns
    that its first key shares with the key before the part, and whether the key behind it begins with its last."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.binary() if c in ("node", "parent") else pa.int64()) for c in (f.split()[0] for f in NODE.split(", "))])

        def given(tree: Tree, seen: int, opens: bool) -> Iterator[pa.RecordBatch]:
            held = []
            for row in nodes(tree, seen, opens):
                held.append(row)
                if len(held) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

        tree, turns, seen, before = None, 0, 0, (None, b"")
        for part, key, value in _rows(batches):
            if tree is not None and (part != before[0] or turns >= run_turns):
                opens = edges[before[0]][1] if part != before[0] else key.startswith(before[1])
                yield from given(tree, seen, opens)
                tree = None
            if tree is None:
                seen = edges[part][0] if part != before[0] else shared_turns(before[1], key)
                tree, turns = Tree(b""), 0
            tree.insert(key, value)
            turns += 1 + len(value.sizes)
            before = (part, key)
        if tree is not None:
            yield from given(tree, seen, edges[before[0]][1])

    return build


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of (node, conv_id): for each node in a batch its ids, joined."""
    for batch in batches:
        if not batch.num_rows:
            continue
        node, ids = batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()
        starts = [0] + [i for i in range(1, len(node)) if node[i] != node[i - 1]]
        texts = [",".join(map(str, ids[i:j])) for i, j in zip(starts, [*starts[1:], len(ids)], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([node[i] for i in starts], pa.binary()), pa.array([ids[i] for i in starts], pa.int64()), pa.array(texts)],
            names=["node", "first_id", "ids"],
        )


def sealed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids, from pieces in order of (node, first_id); one piece is held at a time."""
    node, digest = None, None
    for batch in batches:
        out = []
        for at, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if at != node:
                if node is not None:
                    out.append((node, digest.hexdigest()))
                node, digest = at, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.string())], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, and its turns (id, bytes): the first h of conversation c - c % 5, then its own after its first
    h, with h = crc32(c) % 9. A missing role or text is empty; turns without a number come first."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    told = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.select(
        F.col("conv_id").cast("bigint"),
        F.struct(F.col("turn").cast("bigint").alias("turn"), told.alias("id"), F.octet_length(text).alias("bytes")).alias("at"),
    ).where("conv_id is not null")
    own = durable(turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("at")).alias("turns")), "own_turns")
    base = F.col("conv_id") - F.col("conv_id") % 5
    lead = own.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, LEAD).alias("lead"))
    both = own.withColumn("base", base).join(lead, "base", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    taken = F.coalesce(F.slice("lead", F.lit(1), h), F.slice("turns", 1, 0))
    return both.select("conv_id", F.concat(taken, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def _edges(dealt: DataFrame) -> dict[int, tuple[int, bool]]:
    """What :func:`builder` needs of a part's neighbours; a row for each part."""
    ends = dealt.groupBy("part").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    order = Window.orderBy("part")  # as many rows as parts
    beside = ends.select("part", "lo", "hi", F.lag("hi").over(order).alias("before"), F.lead("lo").over(order).alias("behind"))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, lo, hi, before, behind = (c.to_pylist() for c in batch.columns)
            seen = [0 if b is None else shared_turns(b, a) for a, b in zip(lo, before, strict=True)]
            opens = [b is not None and b.startswith(a) for a, b in zip(hi, behind, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(seen, pa.int64()), pa.array(opens)], names=["part", "seen", "opens"])

    return {r["part"]: (r["seen"], r["opens"]) for r in beside.mapInArrow(told, "part int, seen bigint, opens boolean").collect()}


def _over(turns: Column) -> tuple[Column, Column]:
    """The key of a conversation, and the bytes of its turns."""
    return F.unhex(F.array_join(F.transform(turns, lambda t: t["id"]), "")), F.transform(turns, lambda t: t["bytes"])


def prefix_trie(conversations: DataFrame, run_turns: int = RUN_TURNS, part_bytes: int = PART_BYTES) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations (conv_id, turn, role, text).

    Returns per distinct sequence of first turns, the empty one included:
    conv_id (its smallest member), depth, parent_conv_id (null at the root),
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256, as the
    registered query states them. Turns of a conversation with equal numbers
    (and those without, which come first) are ordered by the md5 of role and
    text. Repeated rows are turns of their own. Rows without conv_id belong to
    no conversation. Other columns are not looked at; an empty table gives an
    empty table. A conversation is one row: its ids, not its texts, are held
    together.
    """
    key, sizes = _over(F.col("turns"))
    convs = durable(rebuilt(conversations).select("conv_id", key.alias("key"), sizes.alias("sizes")), "rebuilt")
    keys = durable(convs.groupBy("key", "sizes").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")), "keys")
    total = keys.agg(F.sum(F.octet_length("key"))).first()[0] or 0
    parts = 1 + total // part_bytes
    ranged = keys.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id())
    dealt = durable(ranged, "dealt")
    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part", "key").select("part", "key", "sizes", "n", "conv_id")
    met = ordered.mapInArrow(builder(_edges(dealt), run_turns), NODE)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    trie = durable(met.groupBy("node", "parent", "depth").agg(F.min("conv_id").alias("conv_id"), *sums), "trie")

    ends = convs.select(F.unhex(F.md5("key")).alias("node"), "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    parts_of = ends.mapInArrow(pieces, "node binary, first_id bigint, ids string")
    ended = parts_of.repartition("node").sortWithinPartitions("node", "first_id").select("node", "ids").mapInArrow(sealed, "node binary, ends_sha256 string")

    above = trie.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = trie.join(above, "parent", "left").join(ended, "node", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_END)).alias("ends_sha256")
    )
