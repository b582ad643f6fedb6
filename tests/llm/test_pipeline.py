"""The pipeline against stages worked out by brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
import xxhash
from tests.llm.test_mixing import size, targets
from tests.llm.test_quality import facts
from tests.llm.test_superminhash import brute as near

from postsift.llm import mixing, packing, quality

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SYLLABLES = {"en": "the ing and tion of er th on re at".split(), "de": "der sch ung ich und ein keit ge ver zu".split()}


def prose(rng, language, n):
    return " ".join("".join(rng.choice(SYLLABLES[language]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def documents():
    rng = random.Random(11)
    rows = []
    for i in range(160):
        language = "en" if i % 3 else "de"
        text = prose(rng, language, rng.randrange(55, 160))
        if i % 20 == 7:
            text = " ".join(f"{w}%%%" for w in text.split())  # junk
        if i % 20 == 11:
            text = "too short"
        if i % 20 == 13:
            text = "over and over again " * 40
        rows.append((i, text, language, f"src{i % 4 if i % 2 else 0}", len(text)))
    for j in range(30):  # copies and near copies
        base = rows[j * 2][1].split()
        if j % 2:
            base[len(base) // 2] = "changed"
        rows.append((200 + j, " ".join(base), rows[j * 2][2], "src0", 0))
    return rows, [(i, 0 if i % 20 in (7, 11, 13) else 1, 0) for i in range(0, 160, 2)]


def bucket(*words):
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed - (1 << 64 if seed >> 63 else 0)


def features(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text.lower()) if x]
    return [bucket(x) % quality.BUCKETS for x in w] + [bucket(a, b) % quality.BUCKETS for a, b in zip(w, w[1:], strict=False)]


def kept_by_quality(rows, labels):
    good = {i for i, q, toxic in labels if q == 1 and not toxic}
    raw, target = Counter(), Counter()
    for i, text, *_ in rows:
        raw.update(features(text))
        if i in good:
            target.update(features(text))
    n, m, b = sum(raw.values()), sum(target.values()), quality.BUCKETS

    def weight(x):
        p = (raw[x] + 1) / (n + b)
        return math.log((target[x] + b * p) / (m + b) / p)

    out = []
    for row in rows:
        f = features(row[1])
        if not facts(row[1])[-1] and math.fsum(map(weight, f)) / len(f) >= quality.THRESHOLD:
            out.append(row)
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    home = str(tmp_path_factory.mktemp("tables"))
    rows, labels = documents()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{home}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{home}/labels.parquet")
    return home


def test_run_against_brute_force(spark, folder):
    rows, labels = documents()
    good = kept_by_quality(rows, labels)
    assert {r[0] % 20 for r in rows if r[0] < 160} - {r[0] % 20 for r in good if r[0] < 160} == {7, 11, 13}
    component, _ = near([(r[0], r[1]) for r in good], 5, 80)
    single = [r for r in good if component[r[0]] == r[0]]
    assert len(single) < len(good)
    sizes = defaultdict(int)
    for r in single:
        sizes[r[3]] += size(r[1])
    wanted = targets(dict(sizes))

    got = corpus_pipeline.run(spark, folder).collect()
    by_id = {r[0]: r for r in single}
    copies, bins, taken = Counter(), defaultdict(list), Counter()
    for r in got:
        copies[r.doc_id] += r.piece == 0
        bins[r.bin_id].append(r)
        taken[by_id[r.doc_id][3]] += r.size
    whole = {s: int(wanted[s] // sizes[s]) for s in sizes}
    for i, r in by_id.items():
        assert whole[r[3]] <= copies[i] <= min(3, whole[r[3]] + 1)
    for s in sizes:
        assert abs(taken[s] - wanted[s]) <= max(size(r[1]) for r in single if r[3] == s)
    for held in bins.values():
        assert sum(r.size for r in held) <= packing.CAPACITY and len({r.doc_id for r in held}) == len(held)
        assert max(Counter(r.source for r in held).values()) <= packing.PER_SOURCE
    assert mixing.MOST_COPIES == 3


def test_stages_keep_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, folder).count() == 0, name
        assert stage(spark, docs.limit(20), folder).columns == docs.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, empty, folder).count() == 0
