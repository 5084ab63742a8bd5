"""Text functions against goldens."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from termloom.config import Config
from termloom.functions import text as T
from termloom.functions import vectors as V


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize(
    ("text", "begin", "last", "special", "expected"),
    [
        ("test term text", 5, 8, "-_+", True), ("test termtext", 5, 8, "-_+", False), ("test termtext", 5, 12, "-_+", True),
        ("test-termtext", 5, 12, "-_+", False), ("term termtext", 0, 3, "-_+", True), ("term-termtext", 0, 3, "-_+", False),
        ("term-termtext", 0, 0, "-_+", False), ("term-termtext", 0, 12, "-_+", True), ("f g", 2, 2, "-_+", True),
        ("fg ", 1, 1, "-_+", False), ("test-termtext", 5, 12, "_+", True), ("term-termtext", 0, 3, "_+", True), ("1term", 1, 4, "-_+", True),
    ],
)
def test_boundaries(spark, text, begin, last, special, expected):
    assert values(spark, [(text, begin, last + 1)], "t string, b long, e long", T.is_bounded(F.col("t"), F.col("b"), F.col("e"), tuple(special))) == [expected]


# Sentences and the quoted terms that they hold.
QUOTED = [
    ("test sentence 'term'", [("term", 15, 19)]),
    ("test •term • •term• and 'AA' sentence", [("aa", 25, 27), ("term", 14, 18)]),
    ("test • term• •term• and 'AA' sentence", [("aa", 25, 27), ("term", 14, 18)]),
    ("some sentence", []),
    ("• test test'f 'something' 'and'  •ABC• more ‧s‧  ‧sss‧ ‧‧df", [("abc", 34, 37), ("something", 15, 24), ("and", 27, 30), ("sss", 50, 53)]),
    ('‘management company’s host member state’: some   "term"', [("management company’s host member state", 1, 39), ("term", 50, 54)]),
    ('‘management company’s host member state’ some "term"  ', [("management company’s host member state", 1, 39), ("term", 47, 51)]),
    ('‘management company’s host member state’": some   "term" ', [("management company’s host member state’", 1, 40), ("term", 51, 55)]),
    ('‘management company’s host member state""": some   "term" ', [("management company’s host member state", 1, 39), ("term", 52, 56)]),
    ('"the equity method in the investor’s share": test ', [("the equity method in the investor’s share", 1, 42)]),
    ('"the equity method in the investor’s share" test ', [("the equity method in the investor’s share", 1, 42)]),
    ("'AA’s' ", [("aa’s", 1, 5)]),
    ("test 'AAs'", [("aas", 6, 9)]),
    ("", []),
]


def test_quoted_terms(spark):
    c = Config()
    got = values(spark, [(t,) for t, _ in QUOTED], "t string", T.quoted_terms(F.col("t"), c.regex_terms, c.regex_abbreviations))
    assert [[tuple(x) for x in row] for row in got] == [want for _, want in QUOTED]


def test_symbols_only(spark):
    terms = ["level a assets", "level 1 assets", "?test", "%^[ 4445 44.f", "11  ", "> <  ", "—", "&", "%,", "…", "+", "÷"]
    assert values(spark, [(t,) for t in terms], "t string", T.is_symbols_only(F.col("t"))) == [False] * 4 + [True] * 8


def test_markers(spark):
    spans = [[(0, 4), (10, 14)], [(0, 4), (8, 9), (10, 14)], [(0, 4)], []]
    want = [" ★ This ☆  is a  ★ test ☆  sentence", " ★ This ☆  is  ★ a ☆   ★ test ☆  sentence", " ★ This ☆  is a test sentence", ""]
    assert values(spark, [("This is a test sentence", s) for s in spans], "t string, s array<struct<begin: long, end: long>>", T.mark_spans(F.col("t"), F.col("s"))) == want


def test_quotes_around_terms(spark):
    text = [" ★ `test`★ ` ", " ` ★ ` test`★ ` ` ", "‘ ★ significant supervised entity ☆ ’ or ‘ ★ significant supervised group ☆ ’ means an entity"]
    want = ["  ★ test ★   ", "  ★   test ★   ` ", " ★  significant supervised entity  ☆  or  ★  significant supervised group  ☆  means an entity"]
    assert values(spark, [(t,) for t in text], "t string", T.strip_quotes(F.col("t"))) == want


def test_words(spark):
    one = lambda t, **k: values(spark, [(t,)], "t string", T.preprocess_word(F.col("t"), **k))[0]
    assert one("UPPERlowerCaSe", lower=False) == "UPPERlowerCaSe"
    assert one("UPPERlowerCaSe") == "upperlowercase"
    assert one(" a  big   space   ") == "a_big_space"
    assert one("a     b") == "a__b"


def test_steps(spark):
    rows = [(" A  b ", k) for k in range(32)]

    def plain(t, k):
        for bit, f in enumerate((str.lower, str.strip, lambda x: x.replace("  ", " "), lambda x: x.replace(" ", "_"), lambda x: x.replace("__", "_"))):
            t = f(t) if k >> bit & 1 else t
        return t

    assert values(spark, rows, "t string, k int", T.with_steps(F.col("t"), F.col("k"))) == [plain(*r) for r in rows]


def test_cells_and_terms(spark):
    assert values(spark, [("a\nb",), ("a\r\nb",), ("a \r  b",), ("  x   y ",)], "t string", T.clean_string(F.col("t"))) == ["a b", "a b", "a b", "x y"]
    assert values(spark, [("a. x",), ("1.1. x",), ("1.1* x",), ("(-) x",), ("plain term",)], "t string", T.clean_term(F.col("t"))) == ["x", "x", "x", "x", "plain term"]


def test_offsets_and_ids(spark):
    at = spark.createDataFrame([("Term", "a term x"), ("no", "x")], "n string, h string").select(T.offset_in(F.col("n"), F.col("h"))).collect()
    assert tuple(at[0][0]) == (2, 6) and at[1][0] is None
    assert values(spark, [(123, "n")], "o int, p string", T.synset_id(F.col("o"), F.col("p"))) == ["00000123-n"]


def test_vectors(spark):
    row = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, z array<double>")
    a = row.select(V.unit(F.col("a")), V.unit(F.col("z")), V.cosine(F.col("a"), F.col("z")), V.argmax(F.col("a")), V.padded(F.array(F.lit(5).cast("long")), 3), V.attention_mask(V.padded(F.array(F.lit(5).cast("long")), 3))).first()
    assert a[0] == [0.6, 0.8] and a[1] == [0, 0] and a[2] == 0 and a[3] == 1 and a[4] == [5, 0, 0] and a[5] == [1, 0, 0]


def test_config():
    c = Config.from_ini("[DefinedTerm]\nUSE_REGEX=False\n[Annotation]\nTAG_NAMES=p, td\n[TermExtraction]\nMAX_LEN_NGRAM = 3\n")
    assert (c.use_regex, c.tag_names, c.max_len_ngram, c.use_whitelist) == (False, ("p", "td"), 3, True)
