import random
import re

import pytest
from pyspark.sql import functions as F

from postsift.functions import text as T
from postsift.functions.tables import CONTRACTIONS, MASKED_WORDS
from postsift.operators.rows import drop_short, head_tail, normalize_rows, show_tokens, with_tokens


def apply(spark, texts, made):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, data string")
    return [r.out for r in df.select("id", made(F.col("data")).alias("out")).orderBy("id").collect()]


NORMALIZED = {
    "' don't don't can't won't '": " do not don't cannot will not",
    "'ab'": "a",
    "a \\ b": "a   b",
    "a\\b": "a   b",
    "x f*ck y": "x f * ck y",
    "DON'T we’re im sure im ok": "don't we’re i am sure i am ok",
    "😁 hi 𝘊 🇺🇸 ﬁ Straße": " hi ﬁ straße",
    "C++ [x]^-y & z": "c + + [ x ] ^ - y & z",
    "tab\there\r\n\nnl": "tab here nl",
    "": "",
    "'": "",
    "Привет мир": "привет мир",
    "日本 エンジ": "日本 エンジ",
    "ภาษาไทย, 한국어!": "ภาษาไทย , 한국어 ! ",
    " i'm i'm i'm ": " i am i'm i am ",
    "it's a dog's life, it's ok": "it's a dog's life , it is ok",
    "end'": "en",
    '"quoted"': ' " quoted " ',
    "é ñ ü kept, … not": "é ñ ü kept , … not",
    "a​b\xa0c": "a b c",
    "100% #1 $5": "100 % # 1 $ 5",
}


def test_normalize_examples(spark):
    out = apply(spark, list(NORMALIZED), T.normalize_text)
    assert dict(zip(NORMALIZED, out)) == NORMALIZED


def test_null_stays_null(spark):
    for made in (T.normalize_text, T.tokenize, T.demask, T.strip_edge_quotes):
        assert apply(spark, [None], made) == [None]


def test_every_contraction_expands(spark):
    texts = [f"so {k} so" for k, _ in CONTRACTIONS]
    assert apply(spark, texts, T.expand_contractions) == [f"so {v} so" for _, v in CONTRACTIONS]


def test_contraction_needs_spaces_on_both_sides(spark):
    texts = ["don't go", "go don't", "x don't, y", "x\ndon't y", "x  don't  y"]
    assert apply(spark, texts, T.expand_contractions) == [*texts[:4], "x  do not  y"]


def test_no_value_holds_a_key():
    keys = {k for k, _ in CONTRACTIONS}
    assert len(keys) == len(CONTRACTIONS) == 127
    assert not any(keys & set(v.split()) for _, v in CONTRACTIONS)


ISOLATED = "!#*-/:]^_~…™€«»¿×÷±→∞■☆♥✓“”„–—•·°©®²½①～｡・。、"
DELETED = "\n\r\t\x00\x7f\x9f\xa0\xad\u200b\u200d\u2003\u2028\ufeff\ufe0f\ue000\uf8ff😁🐵🇺🇸𝘊𝟗\U000e0041"


def test_symbols_of_the_rule(spark):
    assert apply(spark, [f"a{c}b" for c in ISOLATED], T.isolate_symbols) == [f"a {c} b" for c in ISOLATED]
    assert apply(spark, [f"a{c}b" for c in DELETED], T.delete_symbols) == ["a b"] * len(DELETED)


def test_letters_marks_and_digits_of_all_scripts_are_kept(spark):
    texts = ["ภาษาไทย", "한국어 글", "日本 エンジ", "हिन्दी में", "Привет мир", "العربية", "עברית", "ქართული", "αβγ ΔΩ", "ḷṑẽệ ꜥ ƽ", "٣४"]
    assert apply(spark, texts, lambda c: T.isolate_symbols(T.delete_symbols(c))) == texts
    kept = normalize_rows(spark.createDataFrame([(t,) for t in texts], "data string"))
    assert kept.count() == len(texts)


def test_kept_characters(spark):
    kept = "abc XYZ 019 '‘’éàüßñçøłőžþœ"
    assert apply(spark, [kept], lambda c: T.isolate_symbols(T.delete_symbols(c))) == [kept]


def test_ascii_punctuation_is_isolated_but_for_the_apostrophe(spark):
    marks = [chr(p) for p in range(33, 127) if not chr(p).isalnum() and p != 39]
    assert apply(spark, [f"a{m}b" for m in marks], T.isolate_symbols) == [f"a {m} b" for m in marks]


def test_given_symbols_take_the_place_of_the_rule(spark):
    assert apply(spark, ["a😁b.c"], lambda c: T.delete_symbols(c, "😁.")) == ["a b c"]
    assert apply(spark, ["a]b^c-d\\e.f"], lambda c: T.isolate_symbols(c, "]^-\\")) == ["a ] b ^ c - d \\ e.f"]
    both = apply(spark, ["Don.x,y"], lambda c: T.normalize_text(c, delete=".", isolate=","))
    assert both == ["don x , y"]


def test_demask(spark):
    out = apply(spark, [m for m, _ in MASKED_WORDS], T.demask)
    # a shorter mask written out before it reaches inside of a longer one
    assert out == [w for _, w in MASKED_WORDS]
    assert apply(spark, ["what the h*ll"], lambda c: T.normalize_text(c, demask_first=True)) == ["what the hell"]


def test_tokenize(spark):
    assert apply(spark, ["Well, I can't go!  a bc"], T.tokenize) == [["well", "cannot", "go", "bc"]]
    assert apply(spark, ["A  Bc\tDef\nx"], lambda c: T.tokenize(c, normalized=True)) == [["bc", "def"]]
    assert apply(spark, ["one two three"], lambda c: T.cap_tokens(T.tokenize(c), 2)) == [["one", "two"]]


@pytest.mark.parametrize("size, cut", [(253, False), (254, True), (400, True)])
def test_head_tail(spark, size, cut):
    words = [f"Word{i}" for i in range(size)]
    text = " ".join(words)
    row = head_tail(spark.createDataFrame([(text,)], "data string"), 256).first()
    lowered = [w.lower() for w in words]
    assert row.original == text
    assert row.data == (" ".join(lowered[:118] + lowered[-128:]) if cut else text)


def test_head_tail_needs_room(spark):
    with pytest.raises(ValueError):
        head_tail(spark.createDataFrame([("x",)], "data string"), 21)


def test_rows(spark):
    df = spark.createDataFrame([(1, "Hello!"), (2, "x"), (3, ""), (4, None), (5, "'")], "id int, data string")
    assert [r.data for r in normalize_rows(df).collect()] == ["hello ! "]
    assert normalize_rows(df).columns == ["id", "data"]
    assert drop_short(df, n=1).count() == 3
    assert with_tokens(df).count() == 5
    assert [tuple(r) for r in show_tokens(df, ("id",)).collect()] == [(1, 0, "hello")]


def test_normalisation_runs_once_below_a_filter(spark):
    df = normalize_rows(spark.range(3).select(F.col("id").cast("string").alias("data")))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("array_intersect", plan)) == 1


def test_what_holds_for_any_text(spark):
    """Random texts of letters, signs and odd code points, in any partitions."""
    rng = random.Random(5)
    isolated, deleted = {ord(c) for c in ISOLATED}, {ord(c) for c in DELETED}
    letters = "abc dé'ñ" + "  " + "'im dont it's "
    alphabet = [*letters, *map(chr, sorted(isolated)), *map(chr, sorted(deleted))]
    weights = [40] * len(letters) + [1] * (len(alphabet) - len(letters))
    texts = ["".join(rng.choices(alphabet, weights, k=rng.randrange(60))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, data string")
    outs = []
    for parts in (1, 5):
        rows = df.repartition(parts).select("id", T.normalize_text("data").alias("out"))
        outs.append({r.id: r.out for r in rows.collect()})
    assert outs[0] == outs[1]
    isolated_lower = {p for p in isolated if chr(p).lower() == chr(p)}
    for i, text in enumerate(texts):
        out = outs[0][i]
        assert out == out.lower()
        assert not {ord(c) for c in out} & (deleted - {32})
        assert "  " not in out
        for at, c in enumerate(out):
            if ord(c) in isolated_lower:
                assert out[at - 1 : at] in ("", " ") and out[at + 1 : at + 2] in ("", " ")


def test_words_of_scripts_without_blanks(spark):
    texts = {
        "我喜欢你": ["我喜", "喜欢", "欢你"],
        "これはペンです": ["これ", "れは", "はペ", "ペン", "ンで", "です"],
        "ภาษาไทย": ["ภา", "าษ", "ษา", "าไ", "ไท", "ทย"],
        "ที่นี่ดี": ["ที่นี่", "นี่ดี"],  # a letter goes with the marks on it
        "iphone手机very好": ["iphone", "手机", "very"],
        "好": [],  # shorter than two characters, as any other word
        "don't stop café naïve": ["don't", "stop", "café", "naïve"],
        "한국어 문장": ["한국어", "문장"],
        "𠀀𠀁𠀂": ["𠀀𠀁", "𠀁𠀂"],
        "": [],
    }
    df = spark.createDataFrame([(t,) for t in texts], "data string")
    got = {r.data: r.tokens for r in df.select("data", T.tokenize("data", normalized=True).alias("tokens")).collect()}
    assert {k: v for k, v in got.items() if k != "don't stop café naïve"} == {k: v for k, v in texts.items() if k != "don't stop café naïve"}
    assert got["don't stop café naïve"] == texts["don't stop café naïve"]


def test_pairs_of_random_texts_and_how_they_are_found(spark):
    """The texts are cut by one pattern, not word by word, and a word may be as long as it likes."""
    rng = random.Random(3)
    unspaced, marks = "我𠀀あアーกไ်", "ี့่"  # letters, and marks that go with them
    other = "abé한\u0301😀.\x01"
    texts = ["".join(rng.choices(unspaced + marks + other + " \n\u00a0", k=rng.randrange(30))) for _ in range(600)] + ["b" * 60_000 + "我" * 60_000 + "ก" + "่" * 60_000]

    def expected(text):
        out = []
        for word in re.split(r"[ \t\n\x0b\f\r]+", text.lower()):
            for run in re.findall(f"[{unspaced}{marks}]+|[^{unspaced}{marks}]+", word):
                if run[0] in other or run[0] == "\u00a0":
                    out.append(run)
                    continue
                signs = marks + "်"
                units = re.findall(f"[^{signs}][{signs}]*|[{signs}]+", run)
                out += [a + b for a, b in zip(units, units[1:])] if len(units) > 1 else units
        return [t for t in out if len(t) >= 2]

    df = spark.createDataFrame(list(enumerate(texts)), "id int, data string").select("id", T.tokenize("data", normalized=True).alias("tokens"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    for row in df.collect():
        assert row.tokens == expected(texts[row.id]), texts[row.id][:40]
