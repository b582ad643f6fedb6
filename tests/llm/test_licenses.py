import re

from postsift.llm import licenses as n

PLAIN = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def brute(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = []
    for phrase, label in PLAIN.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]
    return len(words), sorted(places)


def test_base_against_brute_force(spark, docs, no_docs):
    texts = ["Released under the MIT License.", "CC BY-NC; cc by nc cc by nc", "under the mit\nlicense", "thunder the mit license", "under the mit licenses"]
    texts += ["Apache License, Version 2.0", "apache license version 20", "é under the mit license é", "cc by", "under the mit license under the mit license", "_"]
    rows = [(100 + i, t) for i, t in enumerate(texts)] + [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = n.license_digest(n.license_spans(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect()
    expected = []
    for i, text in rows:
        count, places = brute(text)
        starts = [p for p, _ in places]
        expected.append((str(i), count, len(places), str(min(starts, default=None)), str(max(starts, default=None)), ",".join(sorted({x for _, x in places}))))
    assert sorted(expected) == sorted((str(r.doc_id), r.n_words, r.n_base, str(r.first_word), str(r.last_word), r.base_labels) for r in got)
    for r in got:
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    assert n.license_spans(no_docs).count() == 0


def spans(text):
    prepared = n.prepared(n.NOTICES)
    return n.fuzzy_spans(text.encode() + b"\n", prepared)


def test_edits_are_found_and_counted():
    for notice, label, edits in n.NOTICES:
        assert [(s[2], s[4]) for s in spans(f"some words {notice} more words")] == [(0, label)]
        if edits >= 2 and not label.startswith("gpl"):
            broken = notice[:3] + "q" + notice[4:-2] + notice[-1]
            found = spans(f"aa {broken} bb")
            assert [(s[4], s[2] <= 2) for s in found] == [(label, True)], notice


def test_every_single_edit_is_found():
    """Pigeonhole: whatever the place of the edits, a piece stays whole."""
    notice, label, edits = n.NOTICES[0]
    for i in range(len(notice)):
        text = notice[:i] + "#" + notice[i + 1 :]
        assert [s[4] for s in spans("x " + text + " y")] == [label]
        j = (i + 11) % len(notice)
        both = text[:j] + text[j + 1 :]
        assert [s[4] for s in spans("x " + both + " y")] == [label]


def test_versions_are_told_apart_and_far_texts_are_left_alone():
    assert [s[4] for s in spans("licensed under the gnu general public license version 2")] == ["gpl-2"]
    assert spans("permission was given to nobody in particular and the people read the license") == []


def test_spans_name_words(spark):
    row = n.license_spans(spark.createDataFrame([(1, "Words. Licensed under the Apache Licence, Version 2.0; more")], "doc_id bigint, text string")).first()
    span = row.spans[0]
    assert (span.label, span.first_word, span.last_word, span.edits) == ("apache-2", 1, 8, 1)  # "2.0" is two words


def test_other_licences_and_parts_of_words_are_no_notices():
    for text in ("licensed under cc by nd 4 0", "small rights reserved", "unlicensed under cc by 4 0", "licensed under cc by 4 05", "licensed under cc by 3 0"):
        assert spans(f"aa {text} bb") == [], text
    assert [(s[2], s[4]) for s in spans("x xall rights reserved x")] == [(1, "all-rights-reserved")]
    assert [(s[2], s[4]) for s in spans("licensed under cc by nc 4 0")] == [(0, "cc-by-nc")]


def test_many_notices_in_one_text():
    assert len(spans("all rights reserved " * 5000)) == 5000
