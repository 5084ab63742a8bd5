"""Sequence tags against goldens."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from termloom.operators import bio, evaluate
from termloom.operators.matching import flexible_matches

# Tokens, their tags, and both after merging.
PIECES = [
    ("Test swap ##tion ' means", "O B O O O", ["Test", "swaption", "'", "means"], ["O", "B", "O", "O"]),
    ("Test swap ##tion ' means", "O B I O O", ["Test", "swaption", "'", "means"], ["O", "B", "O", "O"]),
    ("Test swap ##tion ' means", "O O B O O", ["Test", "swaption", "'", "means"], ["O", "O", "O", "O"]),
    ("Test swap ##tion ' means swap ##tion", "O O B O O B I", ["Test", "swaption", "'", "means", "swaption"], ["O", "O", "O", "O", "B"]),
    ("##tion test", "O O", ["##tion", "test"], ["O", "O"]),
]


def tagged(spark, rows):
    flat = [(k, i, t, g) for k, (tokens, tags) in enumerate(rows) for i, (t, g) in enumerate(zip(tokens.split(), tags.split(), strict=True))]
    return spark.createDataFrame(flat, "sent_id long, pos long, token string, tag string")


def test_pieces(spark):
    got = bio.sentences_of(bio.merge_pieces(tagged(spark, [p[:2] for p in PIECES])), "sent_id", "pos").orderBy("sent_id").collect()
    assert [(r["words"], r["tags"]) for r in got] == [p[2:] for p in PIECES]


def test_runs(spark):
    words = "start some sentence position start end f g h--- start end"
    rows = [(words, "B O O B B I O O O B B"), (words, "O O O O B O O O O O O"), (words, "O O O O O O O O O O O")]
    got = sorted((r["sent_id"], r["begin"], r["end"], r["term"]) for r in bio.tag_runs(tagged(spark, rows)).collect())
    assert got == [(0, 0, 5, "start"), (0, 20, 38, "position start end"), (0, 48, 57, "start end"), (1, 29, 34, "start")]


# Tagged sentences and the spans that they give.
FOUND = [
    ("swaption-shops are swaption    --- shops (swaption () shops)  swaption.shops swaption.shops- swaption shops. swaption? shops swaption^shops swaption - shops", "swaption - shops", [(0, 14), (140, 156)]),
    ("swaption.shops are swaption    --- shops (swaption () shops)  swaption.shopsss swaption.shops- swaption shops. swaption? shops swaption^shops swaption . shops", "swaption . shops", [(0, 14), (79, 93), (142, 158)]),
    ('test swaption shops test. swaption? shops test swaption^shops swaption - shops "swaption shops test', "swaption shops test", [(5, 24), (80, 99)]),
    ("test sentence swaption - shops some more swaption - shops test swaption - shopsswaption - shops swaption - shops", "swaption - shops", [(14, 30), (41, 57), (96, 112)]),
]


def test_flexible_places(spark):
    rows = spark.createDataFrame([(k, t, w) for k, (t, w, _) in enumerate(FOUND)], "id long, text string, term string")
    got = {k: [] for k in range(len(FOUND))}
    for r in flexible_matches(rows, "text", "term").orderBy("id", "begin").collect():
        got[r["id"]].append((r["begin"], r["end"]))
    assert list(got.values()) == [w for *_, w in FOUND]


S = "For the purpose of this regulation, Swaption-shops means a contract. Swaption-ships. Swaption-shops"
DECODED = [
    (S, "for the purpose of this regulation , swaption - shops means a contract . swaption - ships . swaption - shops", "O O O O O O O B I I O O O O B I I O O O O", [("Swaption-shops", 36, 50), ("Swaption-ships", 69, 83)]),
    ("test sentence. some-()term. some-() term. some -(termm ", "test sentence . some - ( ) term . some - ( ) term . some - ( termm", "O O O B I I I I O B I I I I O O O O O", [("some-()term", 15, 26), ("some-() term", 28, 40)]),
    ("test sentence'-. Some-()term. some-() term. Some -(termm ", "test sentence ' - . some - ( ) term . some - ( ) term . some - ( termm", "O O O O O B I I I O O B I I I I O O O O O", [("Some", 17, 21), ("some-() term", 30, 42)]),
    ("‧own funds‧ shall mean ‧own funds‧", "[UNK] own funds [UNK] shall mean [UNK] own funds [UNK]", "B I I O O O O O O O", [("own funds", 1, 10)]),
    ("‧own funds‧ shall mean ‧own funds‧", "[UNK] own funds [UNK] shall mean [UNK] own funds [UNK]", "O O O O O O I I I I", [("own funds", 24, 33)]),
    ("‧own funds‧ shall mean ‧own funds‧", "[UNK] own funds [UNK] shall mean [UNK] own funds [UNK]", "B I I O O O I I I I", [("own funds", 1, 10), ("own funds", 24, 33)]),
]


def test_decode(spark):
    texts = spark.createDataFrame([(k, d[0]) for k, d in enumerate(DECODED)], "sent_id long, text string")
    got = {k: [] for k in range(len(DECODED))}
    for r in bio.decode(texts, tagged(spark, [d[1:3] for d in DECODED])).orderBy("sent_id", "begin").collect():
        got[r["sent_id"]].append((r["term"], r["begin"], r["end"]))
    assert list(got.values()) == [d[3] for d in DECODED]


def test_tags_of_marked_sentences(spark):
    rows = spark.createDataFrame([(0, "a ★ b c ☆ d"), (1, "★ x ☆ ★ y ☆"), (2, "")], "sent_id long, text string")
    got = bio.sentences_of(bio.bio_tags(rows), "sent_id", "pos").orderBy("sent_id").collect()
    assert [(r["words"], r["tags"]) for r in got] == [(["a", "b", "c", "d"], ["O", "B", "I", "O"]), (["x", "y"], ["B", "B"])]
    table = bio.tag_table(bio.bio_tags(rows), most=2).orderBy("sent_id", "place").collect()
    assert [(r["Sentence #"], r["Word"]) for r in table] == [("Sentence: 1", "a"), ("", "b"), ("Sentence: 2", "x"), ("", "y")]


def test_scores(spark):
    gold, said = tagged(spark, [("a b c d e", "B I O B O"), ("f g", "O I")]), tagged(spark, [("a b c d e", "B I O O B"), ("f g", "O B")])
    r = evaluate.chunk_scores(gold, said).first()
    assert (r["tp"], r["n_gold"], r["n_predicted"]) == (2, 3, 3) and r["precision"] == pytest.approx(2 / 3)
    one = tagged(spark, [("a b c", "B B B")])
    assert evaluate.chunk_scores(one, gold, swapped=True).first()["recall"] == evaluate.chunk_scores(one, gold).first()["precision"]
    assert evaluate.timings(spark.createDataFrame([("x", 1.0), ("x", 3.0)], "name string, seconds double")).first()["sd"] == pytest.approx(2**0.5)
    assert evaluate.mean_similarity(spark.createDataFrame([("x", float("nan")), ("x", 1.0)], "m string, sim double"), "m").first()["mean_sim"] == 0.5


def test_sampled_pairs(spark):
    labels = spark.createDataFrame([(f"c{k // 3}", f"v{k}") for k in range(30)], "uri string, label string")
    same = evaluate.sampled_pairs(labels, 5, seed=1)
    assert same.count() == 5 and {r["label"] for r in same.collect()} == {1}
    assert same.collect() == evaluate.sampled_pairs(labels, 5, seed=1).collect()
    assert evaluate.balanced_pairs(labels, 4).select(F.sum("label")).first()[0] == 4


def test_whole_tables_are_filled_in_strides(spark, monkeypatch):
    monkeypatch.setattr(bio, "STRIDE", 7)
    rows = [(k, f"s{k}" if k % 23 == 3 else "", k % 2) for k in range(200)]
    df = spark.createDataFrame(rows, "i long, x string, g int")
    last, want = None, {}
    for k, x, _ in rows:
        last = x or last
        want[k] = last
    assert {r["i"]: r["x"] for r in bio.forward_fill(df, "x", "i").collect()} == {k: v if v is not None else None for k, v in want.items()}
    by = {(r["g"], r["i"]): r["x"] for r in bio.forward_fill(df, "x", "i", ["g"], strided=True).collect()}
    assert by == {(r["g"], r["i"]): r["x"] for r in bio.forward_fill(df, "x", "i", ["g"]).collect()}


def test_draws_and_splits(spark):
    df = spark.createDataFrame([(f"k{i}",) for i in range(300)], "k string")
    again = [r["k"] for r in evaluate.drawn(df, 400, 1, "k", replacement=True).orderBy("draw").collect()]
    assert len(again) == 400 and len(set(again)) < 300 and again == [r["k"] for r in evaluate.drawn(df.repartition(7), 400, 1, "k", replacement=True).orderBy("draw").collect()]
    assert again != [r["k"] for r in evaluate.drawn(df, 400, 2, "k", replacement=True).orderBy("draw").collect()]
    once = [r["k"] for r in evaluate.drawn(df, 50, 1, "k").collect()]
    assert len(once) == len(set(once)) == 50
    assert evaluate.drawn(df.limit(0), 5, 1, "k", replacement=True).count() == 0
    train, valid = evaluate.split(df, 0.2, 1, "k")
    assert train.count() + valid.count() == 300 and 20 < valid.count() < 110 and train.join(valid, "k").count() == 0
