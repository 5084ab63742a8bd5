"""Segments, scoring, matching, the cascade and tables against goldens."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from termloom.config import Config
from termloom.functions import text
from termloom.operators import abbreviations, defined, matching, scoring, spans, tables
from termloom.plans import pipeline

# Definitions, their spans and what each setting of the cascade finds.
DEFINITIONS = ["'this' or 'that this' means something this", "this or that and 'more'", "some sentence", ""]
TOKENS = [("this", 1, 5, -2.0), ("this", 16, 20, -2.0), ("this", 38, 42, -2.0), ("this", 43, 47, -2.0), ("that this", 11, 20, -2.0), ("more", 61, 65, -2.0), ("that", 51, 55, -1.0), ("that and", 51, 59, -1.0), ("something", 28, 37, 0.23), ("some", 67, 71, 0.74), ("some sentence", 67, 80, 0.72)]
SOME, EXTRA = [(16, 20)], [(16, 20), (52, 54), (67, 71)]


@pytest.fixture(scope="module")
def cascade(spark):
    text = "\n".join(DEFINITIONS)
    rows, at = [], 0
    for k, d in enumerate(DEFINITIONS):
        rows.append((1, k, at, at + len(d), d))
        at += len(d) + 1
    defs = spark.createDataFrame(rows, "doc_id long, def_id long, begin long, end long, text string")
    c = Config()
    quoted = matching.quoted_term_spans(defs, c.regex_terms, c.regex_abbreviations).join(defs.select("def_id", F.col("begin").alias("at")), "def_id")
    quoted = quoted.select("doc_id", "def_id", "term", (F.col("begin") + F.col("at")).alias("begin"), (F.col("end") + F.col("at")).alias("end"))
    tokens = spark.createDataFrame([(1, *t) for t in TOKENS], "doc_id long, term string, begin long, end long, score double")

    def run(deps, config):
        dep = spark.createDataFrame([(1, text[b:e], b, e) for b, e in deps], "doc_id long, term string, begin long, end long")
        found = defined.defined_terms(defs.drop("text"), tokens, dep, quoted, config)
        return sorted((r["begin"], r["end"]) for r in found.collect())

    return run


OFF = {"use_regex": False, "use_whitelist": False, "use_tf_idf": False, "use_tagger": False}


@pytest.mark.parametrize(
    ("deps", "config", "want"),
    [
        (EXTRA, Config(**OFF | {"use_regex": True}, fallback_to_regex=False), [(11, 20)]),
        (EXTRA, Config(**OFF | {"use_regex": True}), [(11, 20), (61, 65)]),
        (EXTRA, Config(**OFF | {"use_whitelist": True}), [(11, 20), (51, 59)]),
        (EXTRA, Config(**OFF | {"use_whitelist": True}, fallback_to_whitelist=True), [(11, 20), (51, 59)]),
        (SOME, Config(**OFF | {"use_whitelist": True}, fallback_to_whitelist=True), [(11, 20), (43, 47), (51, 59), (61, 65)]),
        (EXTRA, Config(**OFF | {"use_tf_idf": True}), [(11, 20), (51, 59), (67, 80)]),
        (EXTRA, Config(**OFF | {"use_tf_idf": True}, fallback_to_tf_idf=True), [(11, 20), (51, 59), (67, 80)]),
        (SOME, Config(**OFF | {"use_tf_idf": True}, fallback_to_tf_idf=True), [(11, 20), (43, 47), (51, 59), (61, 65), (67, 80)]),
        (EXTRA, Config(**OFF | {"use_tagger": True}, tagger_bio=True), [(16, 20), (52, 54), (67, 71)]),
        (EXTRA, Config(), [(11, 20), (61, 65), (67, 80)]),
        (SOME, Config(), [(11, 20), (61, 65)]),
        (EXTRA, Config(fallback_to_regex=False), [(11, 20), (51, 59), (67, 80)]),
        (EXTRA, Config(**OFF | {"use_regex": True, "use_tagger": True}, tagger_bio=True, fallback_to_regex=False), [(11, 20), (52, 54), (67, 71)]),
    ],
)
def test_cascade(cascade, deps, config, want):
    assert cascade(deps, config) == want


def test_idf(spark):
    text = ["This is the first sentence about the European Union (EU).", "The EU is in the second sentence, and the European Union too.", "Nothing here."]
    segments = spark.createDataFrame([(1, k, t.lower()) for k, t in enumerate(text)], "doc_id long, seg_id long, text string")
    terms = spark.createDataFrame([(1, t) for t in ("first sentence", "second sentence", "eu", "unseen", "a b")], "doc_id long, term string")
    got = {r["term"]: r["score"] for r in scoring.idf(segments, terms, 4).collect()}
    assert got == {"first sentence": 1.6931, "second sentence": 1.6931, "eu": 1.2877, "unseen": 2.3863, "a b": 2.3863}


def test_abbreviations(spark):
    text = ["The European Union (EU) was founded.", "part IV of it", "Bank of the West (BW) here", "NATO alone"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(text)], "doc_id long, text string").select("doc_id", abbreviations.sentence_tokens(F.col("text")).alias("tokens"))
    got = sorted((r["doc_id"], r["short"], r["long"]) for r in abbreviations.abbreviation_pairs(rows).collect())
    assert got == [(0, "EU", "European Union"), (2, "BW", "Bank of the West")]


def test_matches_equal_a_scan(spark):
    texts = ["the cat, the cats and the-cat", "cat cat+cat 1cat (the cat)", "", None, "İstanbul cat", "de la la de la"]
    terms = ["cat", "the cat", "la", "de la", "1cat", " ", "Cat"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["term"], r["begin"], r["end"]) for r in matching.dictionary_matches(docs, spark.createDataFrame([(t,) for t in terms], "term string"), ["doc_id"]).collect()}
    want = set()
    for k, t in enumerate(texts):
        for term in terms:
            for m in re.finditer(f"(?={re.escape(term)})", (t or "").lower()) if term.strip() else ():
                b, e, low = m.start(), m.start() + len(term), t.lower()
                if not re.match(r"[^\W\d]|[-+]", low[b - 1 : b] if b else "") and not re.match(r"[^\W\d]|[-+]", low[e : e + 1]):
                    want.add((k, term, b, e))
    assert got == want
    assert matching.dictionary_matches(docs, spark.createDataFrame([], "term string"), ["doc_id"]).count() == 0


def test_span_operators(spark):
    a = spark.createDataFrame([(1, 0, 10), (1, 2, 5), (1, 2, 5), (2, 0, 3), (1, 4, 4)], "doc_id long, begin long, end long")
    small = spark.createDataFrame([(1, 2, 5), (1, 9, 12), (2, 3, 4)], "doc_id long, begin long, end long")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(spans.longest(a)) == [(1, 0, 10), (2, 0, 3)]
    assert rows(spans.overlapping(a, small)) == [(1, 0, 10), (1, 2, 5), (1, 2, 5)]
    assert rows(spans.not_covered(small, a)) == [(1, 9, 12), (2, 3, 4)]
    assert rows(spans.without_equal(small, a)) == [(1, 9, 12), (2, 3, 4)]
    assert rows(spans.covered(a, small)) == rows(spans.covered(a, small, bucketed=True))


def test_leaf_tags(spark):
    text = "aaa bbb   ccc"
    rows = [(1, 1, "p", 0, 13), (1, 2, "p", 0, 3), (1, 3, "p", 8, 9), (1, 4, "div", 0, 13), (1, 5, "p", 10, 13), (1, 6, "p", 10, 13), (2, 7, "p", 0, 13)]
    tags = spark.createDataFrame([(*r[:3], None, *r[3:]) for r in rows], "doc_id long, tag_id long, tag_name string, attributes string, begin long, end long")
    texts = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    assert sorted((r["tag_id"], r["text"]) for r in spans.leaf_tags(tags, texts).collect()) == [(2, "aaa"), (7, text)]


def test_user_annotations(spark):
    text = "a significant supervised entity or significant supervised group means"
    tags = spark.createDataFrame([(1, 1, 0, len(text))], "doc_id long, tag_id long, begin long, end long")
    users = spark.createDataFrame([(1, "user1", 2, 31), (1, "user2", 35, 63), (1, "user3", 35, 63)], "doc_id long, user string, begin long, end long")
    texts = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = spans.user_annotations(users, tags, texts, ("user1", "user2")).collect()
    assert [list(r["terms"]) for r in got] == [["significant supervised entity", "significant supervised group"]]
    tagged = pipeline.training_data(users, tags, texts, ("user1",)).orderBy("pos").collect()
    assert [r["tag"] for r in tagged] == ["O", "B", "I", "I", "O", "O", "O", "O", "O"]


def table_document():
    text, tags, n = "", [], 0

    def add(name, attributes, content):
        nonlocal text, n
        begin = len(text)
        text += content + "\n"
        n += 1
        tags.append((1, n, name, attributes, begin, begin + len(content)))
        return begin

    start = len(text)
    add("p", tables.HEADER_ATTRIBUTES, "Legal references and instructions")
    for term, rest in (("1.1. Own funds", "means capital"), ("1.2. of which: Tier 1", "means part"), ("2. Assets", "means things")):
        begin = len(text)
        add("p", tables.TERM_ATTRIBUTES, term)
        add("p", "", rest)
        n += 1
        tags.append((1, n, "td", "valign='top'class='table'", begin, len(text) - 1))
    n += 1
    tags.append((1, n, "tbody", "", start, len(text)))
    return text, tags


def test_tables(spark):
    text, rows = table_document()
    tags = spark.createDataFrame(rows, "doc_id long, tag_id long, tag_name string, attributes string, begin long, end long")
    texts = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = tables.table_terms(tags, texts).orderBy("begin").collect()
    assert [r["name"] for r in got] == ["own funds", "own funds of which: tier 1", "assets"]
    assert [text[r["begin"] : r["end"]].lower() for r in got] == ["own funds", "of which: tier 1", "assets"]
    inside = spark.createDataFrame([(1, "x", 0, 5, 1.0)], "doc_id long, term string, begin long, end long, score double")
    after = tables.table_annotations(tags, texts, {"token": inside, "dependency": inside})
    assert sorted(r["term"] for r in after["token"].collect()) == ["assets", "own funds", "own funds of which: tier 1"]
    assert after["dependency"].count() == 1


def test_concept_extraction(spark):
    text = "‘Own funds’ means the sum of regulatory capital.\nThe capital buffer protects own funds of banks."
    texts = spark.createDataFrame([(1, text)], "doc_id long, text string")
    segments = spans.line_segments(texts)
    definitions = spark.createDataFrame([(1, 0, 0, 48)], "doc_id long, def_id long, begin long, end long")
    lists = lambda *w: spark.createDataFrame([(x,) for x in w], "term string")
    deps = spark.createDataFrame([(1, "Own funds", 1, 10)], "doc_id long, term string, begin long, end long")
    got = pipeline.concept_extraction(texts, segments, definitions, lists("capital buffer"), lists("banks"), deps)
    scores = {r["term"]: r["origin"] for r in got["scores"].collect()}
    assert scores["own funds"] == "regex" and scores["capital buffer"] == "whitelist" and "banks" not in scores
    assert sorted((r["begin"], r["end"]) for r in got["token"].filter("term = 'own funds'").collect()) == [(1, 10), (77, 86)]
    assert [(r["begin"], r["end"]) for r in got["defined"].collect()] == [(1, 10)]


def test_listed_terms_of_many_segments(spark):
    rows = [(d, s, "x " * s + "the capital buffer of banks") for d in range(3) for s in range(8)]
    segments = spark.createDataFrame(rows, "doc_id long, seg_id long, text string").repartition(5)
    listed = scoring.listed_terms(segments, spark.createDataFrame([("capital buffer",), ("banks the",)], "term string"), ("doc_id", "seg_id"))
    assert sorted(map(tuple, listed.collect())) == [(d, "capital buffer") for d in range(3)]


def _joins(df):
    """The plan as it would run, adaptive changes apart."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_parse_is_never_broadcast(spark):
    tokens = spark.range(30).selectExpr("id div 3 as doc_id", "0L as sent_id", "id % 3 as i", "'bank' as text", "'NOUN' as pos", "2L as head_i", "0L as left_edge_i", "2L as right_edge_i", "0L as idx", "'nsubj' as dep")
    chunks = spark.range(10).selectExpr("id as doc_id", "0L as sent_id", "0L as first", "2L as last")
    found = scoring.parsed_candidates(tokens, chunks)
    assert "Broadcast" not in _joins(found) and found.count() == 10


def test_span_tables_are_never_broadcast(spark):
    rows = spark.range(10).selectExpr("id as doc_id", "0L as def_id", "'bank' as term", "0L as begin", "4L as end", "1.0D as score", "'bank' as text")
    quoted = rows.select("doc_id", "def_id", "term", "begin", "end")
    found = defined.defined_terms(quoted, rows, quoted, quoted)
    hits = matching.dictionary_matches(rows, rows, ["doc_id"], ["doc_id"], most=1)
    assert "Broadcast" not in _joins(found) and found.count() == 10
    # the distinct first pieces of terms alone are left to the size check
    assert _joins(hits).count("BroadcastHashJoin") <= 1 and hits.count() == 10


def test_runs_of_a_document_are_not_shuffled(spark):
    rng = random.Random(5)
    rows = [(d, s, " ".join(rng.choice(("aa", "bb", "cc", "x", "Dd")) for _ in range(rng.randrange(9)))) for d in range(6) for s in range(7)]
    segments = spark.createDataFrame([*rows, (9, 0, "x")], "doc_id long, seg_id long, text string")
    found = scoring.document_ngrams(segments, 3)
    want: dict = {}
    for d, _, t in rows:
        w = [x for x in t.lower().split() if len(x) > 1]
        for g in {" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)}:
            want[d, g] = want.get((d, g), 0) + 1
    assert {(r["doc_id"], r["term"]): r["df"] for r in found.collect()} == want
    assert {r["n"] for r in found.collect()} == {7}
    plan = _joins(scoring.idf(segments, None, 2))
    assert plan.count("Exchange hashpartitioning(doc_id") == plan.count("Exchange") == 1


def test_document_precedence(spark, monkeypatch):
    """The choice inside a document's row: what idf and precedence give, from one shuffle of texts and none of runs."""
    rng = random.Random(6)
    words = ("aa", "bb", "Über", "12", "x", "the", "naïve-ish")
    rows = [(d, s, " ".join(rng.choice(words) for _ in range(rng.randrange(12)))) for d in range(9) for s in range(5)]
    segments = spark.createDataFrame([*rows, (20, 0, ""), (21, 0, None), (22, 0, "bb bb bb bb")], "doc_id long, seg_id long, text string")
    pairs = lambda *x: spark.createDataFrame(list(x), "doc_id long, term string")
    regex = pairs((0, "the"), (0, "the"), (1, "aa bb"), (3, "not there"), (20, "only here"), (50, "no text"), (4, " "))
    listed, tagger = pairs((0, "the"), (1, "bb"), (2, "aa"), (2, "7 7")), pairs((0, "aa"), (5, "tagged"), (3, "not there"))
    blacklist = spark.createDataFrame([("bb aa",), ("über",)], "term string")
    scored = scoring.idf(segments, scoring.segment_ngrams(segments, 3), 2)
    want = scoring.precedence(scored.select("doc_id", "term", "score"), regex, listed, blacklist, tagger)
    want = {(r["doc_id"], r["term"]): (r["score"], r["origin"]) for r in want.collect()}
    for size, n in ((scoring.RUN_BYTES, scoring.RUN_ROWS), (40, 7)):
        monkeypatch.setattr(scoring, "RUN_BYTES", size)
        monkeypatch.setattr(scoring, "RUN_ROWS", n)
        found = scoring.document_precedence(segments, regex, listed, blacklist, tagger, most=2)
        got = found.collect()
        assert len(got) == len(want) and {(r["doc_id"], r["term"]): (r["score"], r["origin"]) for r in got} == want
    plan = _joins(scoring.document_precedence(segments, regex, listed, blacklist, tagger, most=2))
    assert plan.count("Exchange hashpartitioning(doc_id") == 1 and "hashpartitioning(doc_id, term" not in plan
    empty = scoring.document_precedence(segments.limit(0), regex.limit(0), listed.limit(0), blacklist, most=2)
    assert empty.collect() == []


def test_dictionary_terms_shuffles_no_pieces(spark):
    rng = random.Random(7)
    rows = [(d, "".join(rng.choice(("aa", "bb", " ", " ", "-", ".", "É", "aa bb")) for _ in range(rng.randrange(30)))) for d in range(60)]
    texts = spark.createDataFrame([*rows, (90, None), (91, "")], "doc_id long, text string")
    terms = spark.createDataFrame([(x,) for x in ("aa", "aa bb", "bb.", "é", "-", "bb aa bb", " ")], "term string")
    found = matching.dictionary_terms(texts, terms, ["doc_id"])
    want = matching.dictionary_matches(texts, terms, ["doc_id"]).select("doc_id", "term").distinct()
    assert found.count() and sorted(found.collect()) == sorted(want.collect())
    assert "Window" not in _joins(scoring.listed_terms(texts, terms))


def test_spans_in_buckets_and_longest(spark, monkeypatch):
    rng = random.Random(12)
    rand = lambda n: [(rng.randrange(3), b, b + rng.choice((0, 1, 5, 40))) for b in (rng.randrange(200) for _ in range(n))]
    a, b = rand(150), rand(60)
    monkeypatch.setattr(spans, "BUCKET", 16)
    x, y = (spark.createDataFrame(r, "doc_id long, begin long, end long") for r in (a, b))
    for way in (spans.overlapping, spans.not_covered):
        assert sorted(map(tuple, way(x, y).collect())) == sorted(map(tuple, way(x, y, bucketed=True).collect()))
    inside = lambda s, o: o[0] == s[0] and o[1] <= s[1] and o[2] >= s[2] and o != s
    assert sorted(map(tuple, spans.longest(x).collect())) == sorted(s for s in a if not any(inside(s, o) for o in a))
    assert sorted(map(tuple, spans.longest(x, y).collect())) == sorted(s for s in a if not any(inside(s, o) for o in b))


def test_offsets_of_long_arrays(spark):
    lengths = [[], [3], list(range(200)), [1] * 64, [2] * 65, [5] * 5000]
    got = spark.createDataFrame([(x,) for x in lengths], "x array<long>").select(text.running_totals(F.col("x")).alias("t")).collect()
    assert [r["t"] for r in got] == [[sum(x[:k]) for k in range(len(x))] for x in lengths]
