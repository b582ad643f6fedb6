import re

from postsift.llm import mixing as m


def targets(sizes, weights=(1, 2, 3), most=3):
    """Share, cut and share the excess again, source by source."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        unit = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if unit * weight[s] >= most * sizes[s]}
        if not above:
            return out | {s: unit * weight[s] for s in open_}
        for s in above:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= above
    return out


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, got):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    expected = targets(sizes)
    assert sorted((str(i), size(t), str(s)) for i, t, s in rows) == sorted((str(r.doc_id), r.size, str(r.source)) for r in got)
    taken = dict.fromkeys(sizes, 0)
    longest = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - expected[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= longest[s]


def test_targets_and_taken(spark):
    rows = [(i, "w " * (1 + i * i % 90), f"s{i % 7}" if i % 11 else None) for i in range(600)]
    rows += [(1000 + i, "w " * 3, "tiny") for i in range(3)] + [(2000, "w " * 5000, "long")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = m.mixed_sizes(df).collect()
    check(rows, got)
    again = m.mixed_sizes(df.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_chances_are_unequal_and_fit_their_odds(spark):
    # With twice the documents of one length as of the other, shorter ones are taken more often.
    rows = [(i, "w " * (10 if i % 2 else 40), "a") for i in range(3000)] + [(5000 + i, "w " * 400, "b") for i in range(300)]
    got = m.mixed_sizes(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).where("source = 'a'").collect()
    short = [r.copies for r in got if r.size == 10]
    long = [r.copies for r in got if r.size == 40]
    assert sum(short) / len(short) > sum(long) / len(long)
    assert max(short + long) - min(short + long) <= 1


def test_edges(spark, docs, no_docs):
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    check(rows, m.mixed_sizes(docs).collect())
    assert m.mixed_sizes(no_docs).count() == 0 and m.mixed_documents(no_docs).count() == 0
    mixed = m.mixed_documents(docs)
    assert mixed.columns == docs.columns
    total = sum(r.taken for r in m.mixed_sizes(docs).collect())
    assert sum(size(r.text) for r in mixed.collect()) == total


def test_all_empty(spark):
    got = m.mixed_sizes(spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id bigint, text string, source string")).collect()
    assert all((r.size, r.target, r.taken) == (0, 0.0, 0) for r in got)
