"""Main text of web pages, by differencing pages of neighbouring addresses.

A page is cut into lines, one per block of its markup. The pages of a host are
sorted by their path; each is paired with the neighbour whose path is nearest,
the lines of the two are aligned by their longest common subsequence, and the
lines that both hold are deleted, but for those of an <article> or <main>,
as passages recur between articles. Neighbours that are copies of each other
tell nothing, so the search goes on past them. Markup then decides on what
differencing leaves: parts that are never main text (menus, forms, adverts
...) go, and where there is an article all that stands outside of it.
"""

from __future__ import annotations

import html
import math
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsift.llm.words import slices
from postsift.sources.durable import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COPY = 80  # percent of the text that copies share
STRETCH = 1 << 18  # lines of a stretch of pages that are paired in one task
BROADCAST_PAGES, BROADCAST_LINES = 200_000, 2_000_000  # pages with deleted lines, and these lines, that go to every executor; more are joined by a shuffle

# Fixed values of HTML: elements that start a new line of text, that hold no text to be read, and that have no end tag.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "nav aside footer header form script style noscript template iframe svg canvas math button select option textarea dialog head object audio video menu".split()
)
# Words in class, id or role that name parts which are no main text.
NEVER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion promoted cookie cookies consent gdpr notice notices "
    "popup modal overlay sidebar sidebars aside menu menus nav navbar navigation breadcrumb breadcrumbs toolbar header masthead footer foot share sharing social "
    "newsletter subscribe subscription signup login related recommended comment comments reply replies respond disqus discussion widget widgets search form".split()
)
ARTICLE_NAMES = frozenset("article entry post story content".split())
COMMENT_NAMES = frozenset("comment comments reply replies respond disqus discussion".split())
# Words that may stand beside those in one name without changing what it says, as in "ad-box" or "related-posts".
BESIDE = ARTICLE_NAMES | frozenset(
    "area articles bar block body bottom box button buttons col column container desktop entries global group head heading inner item items label left link links list main "
    "mobile module outer page panel posts primary right row secondary section sections site slot stories text title top unit wrap wrapper zone".split()
)
# Of these, an id inside an article may as well be the anchor of one of its sections.
ANCHORS = frozenset("discussion notice notices search related recommended form reply replies respond header menu menus share sharing social promotion promoted subscription banner banners widget widgets".split())

TAG = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
)
NAMED = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
WORD = re.compile(r"[a-z0-9]+")
FLAT = re.compile(r"\s+")
ADDRESS = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)[^/?#]*([^?#]*)")


@dataclass
class Line:
    text: str
    never: bool  # inside markup that is never main text
    main: bool  # inside an article
    around: tuple[int, ...]  # the parts that are never main text around that article


def never_names(attributes: str, name: str, main: bool) -> set[str]:
    """What an element's class, role and id say of parts that are no main text.

    A name counts if all of its words tell so or say nothing beside ("ad-box", not "notice-of-meeting").
    An article's own header holds its headline; inside an article an id may name one of its sections.
    """
    found: set[str] = set()
    for m in NAMED.finditer(attributes):
        kind, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if kind == "id" and main and name[:1] == "h" and name[1:].isdigit():
            continue
        for token in value.split():
            words = {w for w in WORD.findall(token) if w.isalpha()}
            told = words & NEVER_NAMES
            if not told or words - NEVER_NAMES - BESIDE:
                continue
            if words & ARTICLE_NAMES:
                told.discard("header")
            found |= told - ANCHORS if kind == "id" and main else told
    return found


def page_lines(page: str) -> list[Line]:
    """The lines of a page in order.

    Unclosed elements end with the one around them. An article starts anew
    inside a part that is never main text if that part's end tag is missing,
    but not inside of a closed one (a teaser in an aside, an advert), unless the
    page has no other text; and never among comments.
    """
    lines: list[Line] = []
    parts: list[str] = []
    # Open elements that matter: name, never, main, inside comments, around, and the parts that are never main text open here.
    stack: list[tuple[str, bool, bool, bool, tuple[int, ...], tuple[int, ...]]] = [("", False, False, False, (), ())]
    closed: set[int] = set()
    at = opened = 0

    def flush() -> None:
        if parts:
            text = FLAT.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                _, never, main, _, around, _ = stack[-1]
                lines.append(Line(text, never, main, around))
            parts.clear()

    while True:
        m = TAG.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in RAW and not closing:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            if name != "textarea":
                continue
        if name in RAW:
            continue
        told = never_names(attributes, name, stack[-1][2]) if not closing and attributes else set()
        tracked = name in NEVER or name in ("article", "main", "body", "html") or name in BLOCKS or bool(told)
        if name in BLOCKS:
            flush()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    if stack[-1][1:] != stack[i - 1][1:]:
                        flush()
                    closed.update(stack[i][5][-1:])  # its own number, or that of a part around it that it does not end
                    closed.difference_update(stack[i - 1][5])
                    del stack[i:]
                    break
        elif name not in VOID and not attributes.endswith("/"):
            _, never, main, comments, around, open_parts = stack[-1]
            comments = comments or not COMMENT_NAMES.isdisjoint(told)
            if name in ("article", "main"):
                state = (comments, True, comments, open_parts, open_parts)
            elif name == "body":
                state = (False, False, False, (), ())
            else:
                here = name in NEVER or bool(told)
                if here:
                    opened += 1
                state = (never or here, main, comments, around, (*open_parts, opened) if here else open_parts)
            if name == "p" and stack[-1][0] == "p":  # a paragraph ends the one before
                stack.pop()
            if state[:2] != (never, main) or state[3] != around:
                flush()
            if tracked or state[0]:
                stack.append((name, *state))
    flush()
    inside = [line.never or not closed.isdisjoint(line.around) for line in lines]
    if not all(inside):
        for line, gone in zip(lines, inside, strict=True):
            line.never = gone
    if any(line.main and not line.never for line in lines):
        for line in lines:
            line.never = line.never or not line.main
    return lines


def address(url: str | None) -> tuple[str, str]:
    """Host and path of a URL; of none, and of anything else, no host and the whole as path."""
    m = ADDRESS.match(url or "")
    return (m[1].lower(), m[2]) if m else ("", url or "")


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` that a longest common subsequence with ``b`` takes.

    Bit-parallel, a row of bits per line of ``b``. Only lines that both hold take part; every so many rows one is
    kept, from which those behind it are worked out again on the way back, so that memory goes with lines to the power 1.5.
    """
    in_a, in_b = set(a), set(b)
    of_a = [i for i, x in enumerate(a) if x in in_b]
    a, b = [a[i] for i in of_a], [y for y in b if y in in_a]
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1

    def after(row: int, y: int) -> int:
        u = row & places[y]
        return ((row + u) | (row - u)) & full

    step = max(1, math.isqrt(len(b)))
    row, kept = full, []
    for j, y in enumerate(b):
        if j % step == 0:
            kept.append(row)
        row = after(row, y)
    out, i = [], len(a)
    for start in range(len(kept) - 1, -1, -1):
        rows = [kept[start]]  # rows[j]: before line start * step + j
        for y in b[start * step : (start + 1) * step]:
            rows.append(after(rows[-1], y))
        j = len(rows) - 1
        while i and j:
            if rows[j] >> (i - 1) & 1:
                i -= 1
            elif not rows[j - 1] >> (i - 1) & 1:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append(of_a[i])
    return out[::-1]


@dataclass
class Page:
    key: str
    host: str
    path: str
    hashes: list[int]
    sizes: list[int]
    free: list[bool]
    edge: bool = False


def copies(a: Page, b: Page) -> bool:
    """Whether two pages share at least COPY percent of the larger one's text that may be main text."""
    if list(a.hashes) == list(b.hashes):
        return True
    whole, other = sum(a.sizes), sum(b.sizes)
    if not whole or 100 * min(whole, other) < COPY * max(whole, other):
        return False
    return 100 * sum(a.sizes[i] for i in common_lines(list(a.hashes), list(b.hashes))) >= COPY * max(whole, other)


def shared_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def deleted_lines(page: Page, before: Page | None, after: Page | None) -> list[int]:
    """Lines of a page that go: shared with the nearer of the pages around its run of copies, or if that is a copy of it with the other."""
    near = sorted((p for p in (before, after) if p is not None), key=lambda p: -shared_prefix(p.path, page.path))
    for other in near:
        if not copies(page, other):
            return [i for i in common_lines(list(page.hashes), list(other.hashes)) if page.free[i]]
    return []


LINED = "key string, host string, path string, hashes array<bigint>, sizes array<int>, free array<boolean>"
PAGE = f"struct<{LINED.replace(' string', ':string').replace(' array', ':array')}>"
PAIRED = f"kind string, run string, host string, stretch bigint, key string, gone array<int>, page {PAGE}, before {PAGE}, after {PAGE}, joined boolean"


def liner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        out: list[tuple] = []
        for key, url, page in zip(batch.column("key").to_pylist(), batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            lines = page_lines(page)
            hashes = [xxhash.xxh3_64_intdigest(line.text) - (1 << 63) for line in lines]
            # Only lines that would be main text count in comparing two pages.
            sizes = [0 if line.never else len(line.text) for line in lines]
            out.append((key, *address(url), hashes, sizes, [line.never or not line.main for line in lines]))
        kinds = [pa.string(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_())]
        names = ["key", "host", "path", "hashes", "sizes", "free"]
        columns = list(zip(*out, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def as_page(row: dict) -> Page:
    return Page(*(row[c] for c in ("key", "host", "path", "hashes", "sizes", "free")), edge=row.get("edge", False))


def as_row(page: Page | None) -> dict | None:
    return None if page is None else {c: getattr(page, c) for c in ("key", "host", "path", "hashes", "sizes", "free")}


def differ(part: pa.Table) -> pa.Table:
    """Difference the pages of one stretch of addresses. The pages next to the stretch (``edge``) are only partners.

    A run of copies that goes on beyond the stretch is reported as a segment, with the page before it or after it
    if that is seen here; its members ("wait") are differenced when all segments are known.
    """
    rows = part.sort_by([("start", "ascending")]).to_pylist()
    stretch = next(r["stretch"] for r in rows)
    pages = [as_page(r) for r in rows]
    out: list[dict] = []
    first = 0
    while first < len(pages):
        last = first
        while last + 1 < len(pages) and pages[last + 1].host == pages[first].host and copies(pages[last], pages[last + 1]):
            last += 1
        run = pages[first : last + 1]
        before = pages[first - 1] if first and pages[first - 1].host == run[0].host else None
        after = pages[last + 1] if last + 1 < len(pages) and pages[last + 1].host == run[0].host else None
        own = [p for p in run if not p.edge]
        if own and (run[0].edge or run[-1].edge):
            name = f"{stretch}:{first}"
            here = {"run": name, "host": run[0].host, "stretch": stretch}
            out.append(here | {"kind": "segment", "before": as_row(before), "after": as_row(after), "joined": run[0].edge})
            out += [here | {"kind": "wait", "key": p.key, "page": as_row(p)} for p in own]
        else:
            for p in own:
                gone = deleted_lines(p, before, after)
                if gone:
                    out.append({"kind": "done", "key": p.key, "gone": gone})
        first = last + 1
    page = pa.struct([("key", pa.string()), ("host", pa.string()), ("path", pa.string()), ("hashes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("free", pa.list_(pa.bool_()))])
    kinds = [("kind", pa.string()), ("run", pa.string()), ("host", pa.string()), ("stretch", pa.int64()), ("key", pa.string()), ("gone", pa.list_(pa.int32()))]
    kinds += [("page", page), ("before", page), ("after", page), ("joined", pa.bool_())]
    return pa.Table.from_pylist(out, pa.schema(kinds))


def late_differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, gone = [], []
        for r in batch.to_pylist():
            lines = deleted_lines(*(None if r[c] is None else as_page(r[c]) for c in ("page", "before", "after")))
            if lines:
                keys.append(r["page"]["key"])
                gone.append(lines)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(gone, pa.list_(pa.int32()))], names=["key", "gone"])


def deletions(lined: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """The numbers of the lines that go, for each page that has any.

    Pages in the order of their addresses are cut into stretches by their number of lines, whatever the number of
    partitions; each stretch also sees the page before and the one behind it. Of the table of segments, a window
    takes a row for each end of a stretch in a run of copies.
    """
    spread = lined.withColumn("weight", 1 + F.size("hashes").cast("bigint")).repartitionByRange("host", "path", "key").withColumn("part", F.spark_partition_id())
    spread = durable(spread, "addresses")
    sums = spread.groupBy("part").agg(F.sum("weight").alias("sum"))
    offsets = sums.select("part", (F.sum("sum").over(Window.orderBy("part")) - F.col("sum")).alias("offset"))  # a row per partition
    running = F.sum("weight").over(Window.partitionBy("part").orderBy("host", "path", "key").rowsBetween(Window.unboundedPreceding, 0))
    dealt = spread.withColumn("running", running).join(F.broadcast(offsets), "part")
    dealt = dealt.withColumn("start", F.col("offset") + F.col("running") - F.col("weight")).withColumn("next", F.col("start") + F.col("weight"))
    dealt = durable(dealt.withColumn("stretch", F.floor(F.col("start") / stretch)).drop("part", "offset", "running", "weight"), "stretches")

    lasts = dealt.where(F.floor(F.col("next") / stretch) != F.col("stretch"))
    columns = ["key", "host", "path", "hashes", "sizes", "free", "start", "stretch", "edge"]
    behind = lasts.select(F.col("next").alias("start"), F.col("stretch").alias("of"))
    seen = dealt.withColumn("edge", F.lit(False)).select(columns)
    seen = seen.union(lasts.withColumn("stretch", F.floor(F.col("next") / stretch)).withColumn("edge", F.lit(True)).select(columns))
    seen = seen.union(dealt.join(behind, "start").withColumn("stretch", F.col("of")).withColumn("edge", F.lit(True)).select(columns))
    paired = seen.groupBy("stretch").applyInArrow(differ, PAIRED)
    # A stretch of which only the page before it is there (past the last page) has nothing to say.
    paired = durable(paired, "paired")
    done = paired.where("kind = 'done'").select("key", "gone")
    segments = paired.where("kind = 'segment'")
    if not segments.isEmpty():
        # Segments that are joined make up one run of copies.
        opened = F.sum(F.when(F.col("joined"), 0).otherwise(1)).over(Window.partitionBy("host").orderBy("stretch", F.col("joined").desc()))
        order = durable(segments.select("run", "host", opened.alias("copies"), "before", "after"), "segments")
        ends = order.groupBy("host", "copies").agg(F.first("before", ignorenulls=True).alias("before"), F.first("after", ignorenulls=True).alias("after"))
        known = order.select("run", "host", "copies").join(ends, ["host", "copies"]).select("run", "before", "after")
        waiting = paired.where("kind = 'wait'").select("run", "page").join(known, "run").select("page", "before", "after")
        done = done.union(waiting.mapInArrow(late_differ, "key string, gone array<int>"))
    return done.groupBy("key").agg(F.min("gone").alias("gone"))


TEXTS = "page_id bigint, url string, text string, n_chars bigint, n_lines int, n_deleted int"


def extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        texts, lined, cut = [], [], []
        for page, gone in zip(batch.column("html").to_pylist(), batch.column("gone").to_pylist(), strict=True):
            lines, away = page_lines(page), set(gone or ())
            texts.append(" ".join(line.text for i, line in enumerate(lines) if not line.never and i not in away))
            lined.append(len(lines))
            cut.append(len(away))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(lined, pa.int32()), pa.array(cut, pa.int32())],
            names=["page_id", "url", "text", "n_chars", "n_lines", "n_deleted"],
        )


def main_texts(pages: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """The main text of pages (page_id, url, html).

    Returns per row page_id, url, text (blocks in page order, white space
    collapsed, joined by one space; empty if there is none), n_chars (code
    points), n_lines and n_deleted (lines found, and deleted for being shared
    with the neighbour, those that markup would drop included). A null html
    counts as empty, a null url as no host and no path. A page alone on its
    host, or with copies only, has no partner and loses nothing by differencing.
    Rows that are alike in all three columns get the same text. Other columns
    are not looked at; an empty table gives an empty table.
    """
    pages = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    ).withColumn("key", F.concat(F.hex(F.xxhash64("page_id", "url", "html")), F.lit("-"), F.hex(F.xxhash64("html", F.lit(1), "url", "page_id"))))
    lined = durable(pages.select("key", "url", "html").mapInArrow(liner, LINED), "lines")
    gone = durable(deletions(lined, stretch), "deletions")
    n_pages, n_lines = gone.agg(F.count("*"), F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()
    few = n_pages <= BROADCAST_PAGES and n_lines <= BROADCAST_LINES
    both = pages.join(F.broadcast(gone) if few else gone.hint("merge"), "key", "left")
    return both.select("page_id", "url", "html", "gone").mapInArrow(extractor, TEXTS)
