import random
import tracemalloc

import pytest

from postsift.llm import html_text as h


def text(page):
    return " ".join(line.text for line in h.page_lines(page) if not line.never)


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b <b>c</b>d<br>e", "a b cd e"),
        ("<html><head><title>t</title><style>p{}</style></head><body><nav>menu</nav><article><h1>H</h1><p>x  y\n z</p></article><footer>f</footer>", "H x y z"),
        ("<div class='ad'>buy</div><main><p>m</p><aside>s</aside></main><p>outside</p>", "m"),
        ("<article>a<div class=comments><article>c</article></div></article>", "a"),
        ("<script>var t='</p><p>no'</script>yes<!-- <p>no</p> -->", "yes"),
        ("<script>never closed <p>x", ""),
        ("a < b and <3 c > d", "a < b and <3 c > d"),
        ("<p title='a > b'>x</p><p title='open>y</p>", "x y"),
        ("<div class='site-header'>top</div><div class='entry-header'><h1>T</h1></div><p>p</p>", "T p"),
        ("<div id=cookie-notice>c</div>t<form>f<input>g</form>", "t"),
        ("&eacute;&#233;&#xe9;&nbsp;x", "ééé x"),
        ("<div class='ad'>ad<article>in</article>", "in"),
        ("<ul><li>a</li><li>b</li></ul>", "a b"),
        ("<aside class='related'><article>Teaser</article></aside><article>own</article>", "own"),
        ("<div class='ad'><article>Advert</article></div><article>own</article>", "own"),
        ("<article>own<aside><article>Teaser</article></aside> end</article>", "own end"),
        ("<aside><article>Teaser</article></aside><p>own</p>", "own"),
        ("<form id=whole><article>own</article></form>", "own"),
        ("<nav><ul><li>menu<article>own</article></ul></body>", "own"),
        ("<article>a<section id='notice-of-meeting'>b</section><p class='search-results-explained'>c</p><section id=discussion>d</section></article>", "a b c d"),
        ("<article>a<h2 id=comments>b</h2><div class='ad-box'>x</div><div id=comments>y</div><div class='related-posts'>z</div></article>", "a b"),
        ("<p class=notice-of-meeting>a</p><div id=cookie-notice-2>b</div>", "a"),
    ],
)
def test_lines(page, expected):
    assert text(page) == expected


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_lines_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(2))
        taken = h.common_lines(a, b)
        assert len(taken) == lcs(a, b) and taken == sorted(set(taken))
        it = iter(b)
        assert all(x in it for x in (a[i] for i in taken))


def test_long_pages_need_little_memory():
    rng = random.Random(9)
    a, b = ([rng.randrange(40_000) for _ in range(30_000)] for _ in range(2))
    tracemalloc.start()
    taken = h.common_lines(a, b)
    assert tracemalloc.get_traced_memory()[1] < 40_000_000
    tracemalloc.stop()
    it = iter(b)
    assert taken == sorted(set(taken)) and all(x in it for x in (a[i] for i in taken))
    assert h.common_lines(a, a) == list(range(len(a)))


def page(lines):
    return "<body>" + "".join(f"<div>{x}</div>" for x in lines)


def test_shared_lines_of_neighbours_go(spark):
    own = {i: [f"text {i} {j} of this page alone" for j in range(6)] for i in range(12)}
    rows = [(i, f"http://h.example/a/{i:03}", page(["Top", *own[i], "Bottom"]), "x") for i in range(12)]
    rows += [(100, "http://lone.example/", page(["Top", "alone", "Bottom"]), "x"), (101, None, None, "x"), (102, "http://h.example/b", "", "x")]
    copies = [(200 + i, f"http://copy.example/{i}", page(["same one", "same two"]), "x") for i in range(4)]
    df = spark.createDataFrame(rows + copies + copies[:1], "page_id bigint, url string, html string, text string")
    got = {r.page_id: r for r in h.main_texts(df).collect()}
    assert h.main_texts(df).count() == len(rows) + 5
    for i in range(11):
        assert got[i].text == " ".join(own[i]) and got[i].n_deleted == 2 and got[i].n_chars == len(got[i].text)
    assert got[100].text == "Top alone Bottom" and got[101].text == got[102].text == ""
    assert got[201].text == "same one same two"


def brute(rows):
    """Per host: the pages in order, runs of copies, and lines shared with the nearer page around the run."""
    out, hosts = {}, {}
    for number, url, html in rows:
        host, path = h.address(url)
        lines = h.page_lines(html or "")
        made = h.Page(str(number), host, path, [hash(x.text) for x in lines], [0 if x.never else len(x.text) for x in lines], [x.never or not x.main for x in lines])
        hosts.setdefault(host, []).append((path, number, made, lines))
    for found in hosts.values():
        found.sort(key=lambda f: f[:2])
        linked = [h.copies(a[2], b[2]) for a, b in zip(found, found[1:], strict=False)]
        for i, (_, number, made, lines) in enumerate(found):
            low, high = i, i
            while low and linked[low - 1]:
                low -= 1
            while high + 1 < len(found) and linked[high]:
                high += 1
            around = found[low - 1][2] if low else None, found[high + 1][2] if high + 1 < len(found) else None
            gone = h.deleted_lines(made, *around)
            out[number] = (" ".join(x.text for j, x in enumerate(lines) if not x.never and j not in gone), len(gone))
    return out


@pytest.mark.parametrize("stretch", [12, 60, 1 << 18])
def test_pairs_as_found_by_brute_force_past_runs_of_copies(spark, stretch):
    rng = random.Random(7)
    rows = []
    for host in range(3):
        i = 0
        while i < 90:
            menu = [f"menu {host} {j}" for j in range(3)]
            body = [f"text {host} {i} {j} of a page of some length" for j in range(rng.randrange(1, 12))]
            wrap = "<article>{}</article>" if rng.random() < 0.3 else "{}"
            for _ in range(rng.choice([1, 1, 1, 2, 5, 30])):  # copies, some with a line of their own
                own = [f"seen {i}"] if rng.random() < 0.3 else []
                rows.append((host * 1000 + i, f"http://h{host}.example/{i:04}", f"<nav>all</nav>{page(menu)}{wrap.format(page(body + own))}{page(['foot'])}"))
                i += 1
    rows.append((9000, "http://same.example/1", page(["one", "two"])))
    rows += [(9001 + i, f"http://same.example/{i + 2}", page(["one", "two"])) for i in range(40)]
    rng.shuffle(rows)
    got = {r.page_id: (r.text, r.n_deleted) for r in h.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string"), stretch).collect()}
    expected = brute(rows)
    assert got == expected
    assert all("menu" not in text and "foot" not in text for i, (text, _) in got.items() if i < 9000)
    assert got[9020] == ("one two", 0)


def test_passages_within_articles_stay(spark):
    rows = [(i, f"http://h/{i}", f"<nav>n</nav><article><p>shared passage</p><p>own {i} and more of it</p></article>") for i in range(20)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.page_id: r.text for r in h.main_texts(df).collect()} == {i: f"shared passage own {i} and more of it" for i in range(20)}


def test_empty_table(spark):
    assert h.main_texts(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_addresses():
    assert h.address("HTTP://User@Host.Example:80/a/b?q#f") == ("host.example", "/a/b")
    assert h.address("no url") == ("", "no url") and h.address(None) == ("", "")
