import math
import random
from collections import Counter, defaultdict

from postsift.llm import language as g

SYLLABLES = {"en": "the ing and tion of er th on".split(), "de": "der sch ung ich und ein keit ge".split(), "fr": "que ment les eau ou ai re et".split(), "es": "que ado los ción ar os mente la".split()}


def text(rng, language, n):
    return " ".join("".join(rng.choice(SYLLABLES[language]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_held_out_accuracy(spark):
    """Of texts whose declared language is missing or wrong, nearly all are told right."""
    rng = random.Random(2)
    rows, truth = [], {}
    for i in range(400):
        true = rng.choice(list(SYLLABLES))
        declared = true if i % 4 else rng.choice([None, "zz", *SYLLABLES])
        rows.append((i, text(rng, true, 40), declared, f"host{i % 9}.example.{true}", 0))
        truth[i] = true
    got = g.document_languages(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int")).collect()
    asked = [r for r in got if r.doc_id % 4 == 0]
    assert sum(r.language == truth[r.doc_id] for r in asked) / len(asked) > 0.95
    assert all(0 < r.probability <= 1 for r in got)


def test_host_and_declaration_decide_where_the_text_says_little(spark):
    rng = random.Random(4)
    rows = [(i, text(rng, "de", 50), "de", "a.example.de", 0) for i in range(60)] + [(100 + i, text(rng, "en", 50), "en", "b.example.com", 0) for i in range(60)]
    rows += [(500, "???", None, "a.example.de", 0), (501, "???", None, "b.example.com", 0), (502, "???", None, "new.example.de", 0), (503, "???", "en", None, 0)]
    got = {r.doc_id: r for r in g.document_languages(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int")).collect()}
    assert [got[i].language for i in (500, 501, 502, 503)] == ["de", "en", "de", "en"]


def test_edges(docs, no_docs):
    got = g.document_languages(docs).collect()
    assert len(got) == docs.count() and g.document_languages(no_docs).count() == 0
    for r in got:
        if r.doc_id in (0, 1):
            assert (r.language, r.probability, r.kept) == ("und", 0.0, False)
    kept = g.accepted(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)
    assert {r.row_key for r in kept.collect()} <= {"y", None}


def test_pages(spark):
    pages = [
        (1, "https://x.example.de/a", '<html lang="de"><script>the the</script><body><p>der sch ung und ein keit der sch</p></body>'),
        (2, None, None),
        (3, "//www.example.com", "<HTML LANG=en-US><p>the ing and tion of the ing and tion"),
    ]
    rows = spark.createDataFrame(pages * 5, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in g.page_languages(rows).collect()}
    assert (got[1].declared, got[1].host, got[1].language) == ("de", "x.example.de", "de")
    assert (got[2].declared, got[2].host, got[2].language, got[2].kept) == ("", "", "und", False)
    assert (got[3].declared, got[3].host, got[3].language) == ("en", "www.example.com", "en")


LATER = {"it": "zione che gli dell per sono una perché".split(), "pt": "ção não uma dos você são lhe mento".split(), "zh": "的 一 是 不 了 人 我 在 有 他 这 中".split()}


def test_languages_come_from_the_rows_and_others_are_none(spark):
    """What enough rows declare is a language; texts in none are "und" and go, whatever they declare."""
    rng = random.Random(6)
    rows = [(i, text(rng, x, 60), x, f"h{i % 7}", 0) for i, x in enumerate(list(SYLLABLES) * 60)]
    foreign = {x: [" ".join("".join(rng.choice(LATER[x]) for _ in range(rng.randrange(1, 4))) for _ in range(60)) for _ in range(30)] for x in LATER}
    kind = "doc_id bigint, text string, lang string, source string, n_chars int"
    few = rows + [(1000 + i, foreign[x][i], declared, "h1", 0) for i, (x, declared) in enumerate([(x, d) for x in LATER for d in (x, None)])]
    few.append((1100, "το και της των για με από στην είναι που δεν ένα " * 9, "es", "h1", 0))  # declared wrongly
    got = {r.doc_id: r for r in g.document_languages(spark.createDataFrame(few, kind)).collect()}
    assert all((got[i].language, got[i].kept) == ("und", False) for i in got if i >= 1000)
    assert all(got[i].kept and got[i].language == got[i].declared for i in got if i < 1000)
    more = rows + [(1000 + i, foreign[x][i // 3], x if i >= 3 else None, "h1", 0) for i, x in enumerate(list(LATER) * 30)]
    got = {r.doc_id: r for r in g.document_languages(spark.createDataFrame(more, kind)).collect()}
    assert all(got[1000 + i].language == x and got[1000 + i].kept for i, x in enumerate(list(LATER) * 30))


def buckets(value):
    data = bytes(g.LOWER[c] for c in (value or "").encode())
    return [(((data[i] << 16 | data[i + 1] << 8 | data[i + 2]) * 2654435761 & 0xFFFFFFFF) >> 8) % g.BUCKETS for i in range(len(data) - 2)]


def by_hand(rows):
    """The rule, a row at a time."""
    rows = [(i, buckets(t), (d or "").lower(), h or "") for i, t, d, h, _ in rows]
    support = Counter(d for _, b, d, _ in rows if b and len(d) in (2, 3) and d not in g.NOT_LANGUAGES)
    names = sorted(d for d, n in support.items() if n >= g.FLOOR)
    counts, pool = {x: Counter() for x in names}, Counter()
    for _, b, d, _ in rows:
        pool.update(b)
        if d in counts:
            counts[d].update(b)
    background = {b: (n / sum(pool.values()) + 1 / g.BUCKETS) / 2 for b, n in pool.items()}
    evidence, units = [], []
    for _, bs, d, _ in rows:
        sums = []
        for x in names:
            own = Counter(bs) if x == d else Counter()
            size = sum(counts[x].values()) - sum(own.values()) + g.SMOOTHING
            lent = g.SMOOTHING + g.DISCOUNT * len(counts[x])
            sums.append(sum(math.log((max(counts[x][b] - own[b] - g.DISCOUNT, 0) + lent * background[b]) / size) for b in bs))
        sums.append(sum(math.log(g.UND_POOL * pool[b] / sum(pool.values()) + (1 - g.UND_POOL) / g.BUCKETS) for b in bs))
        sums = [s * min(len(bs), g.EVIDENCE) / max(len(bs), 1) for s in sums]
        top = max(sums)
        shares = [math.exp(s - top) for s in sums]
        evidence.append([s - top for s in sums])
        units.append([math.floor(s / sum(shares) * g.UNIT + 0.5) if bs else 0 for s in shares])
    every = range(len(names) + 1)
    host, suffix, stated, whole = (defaultdict(lambda: [0] * len(every)) for _ in range(4))
    for (_, _, d, h), u in zip(rows, units, strict=True):
        for table, key in ((host, h), (suffix, h.rpartition(".")[2].lower() if "." in h else ""), (whole, 0), *([(stated, d)] if d in names else [])):
            table[key] = [a + b for a, b in zip(table[key], u, strict=True)]
    base = [(n + g.UNIT) / (sum(whole[0]) + len(every) * g.UNIT) for n in whole[0]]

    def smooth(n, u, prior):
        left = [max(a - b, 0) / g.UNIT for a, b in zip(n, u, strict=True)]
        return [(x + g.STRENGTH * p) / (sum(left) + g.STRENGTH) for x, p in zip(left, prior, strict=True)]

    out = {}
    for (i, bs, d, h), e, u in zip(rows, evidence, units, strict=True):
        prior = smooth(host[h], u, smooth(suffix[h.rpartition(".")[2].lower() if "." in h else ""], u, base))
        logs = [a + math.log(b) for a, b in zip(e, prior, strict=True)]
        for k in every if d in names else ():
            total = (sum(stated[x][k] for x in names) - u[k]) / g.UNIT
            right = k < len(names) and names[k] == d
            logs[k] += math.log(((stated[d][k] - u[k]) / g.UNIT + (4 if right else 1)) / (total + len(names) + (3 if k < len(names) else 0)))
        top = max(logs)
        out[i] = ([*names, "und"][logs.index(top)], 1 / sum(math.exp(x - top) for x in logs)) if bs else ("und", 0.0)
    return out


def test_fusion_as_by_hand(spark):
    rng = random.Random(8)
    rows = []
    for i in range(150):
        true = rng.choice(list(SYLLABLES))
        value = rng.choice([text(rng, true, rng.choice([1, 2, 30])), text(rng, true, 3), "", None, "ab", "?? 12", "的一是不了人"])
        rows.append((i, value, rng.choice([true, true, true, None, "zz", "und", "EN"]), rng.choice([f"a{i % 4}.example.{true}", "b", None]), 0))
    got = {r.doc_id: (r.language, r.probability) for r in g.document_languages(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int")).collect()}
    expected = by_hand(rows)
    assert got.keys() == expected.keys()
    for i, (language, chance) in expected.items():
        assert abs(got[i][1] - chance) < 1e-4 and (got[i][0] == language or abs(chance - 0.5) < 1e-3), (i, got[i], expected[i])
