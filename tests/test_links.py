"""Similarity, glossaries, sources, sinks and the stream."""

from __future__ import annotations

import base64
import json
from xml.etree import ElementTree

import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.operators import glossary, similarity
from termloom.plans import pipeline
from termloom.sources import readers, writers
from termloom.streaming import documents


@pytest.fixture(scope="module")
def vectors(spark):
    x = np.random.default_rng(3).standard_normal((300, 8))
    x[17] = x[3]
    x[40] = 0
    return x, spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")


def test_exact_similarity_in_blocks(vectors):
    x, df = vectors
    n = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, n, out=np.zeros_like(x), where=n > 0)
    s = u @ u.T
    got = {(r["query"], r["match"]): r["sim"] for r in similarity.similar_pairs(df, df, 0.7, block_rows=64).collect()}
    assert set(got) == {(int(i), int(j)) for i, j in zip(*np.nonzero(s >= 0.7), strict=True)}
    assert max(abs(v - s[k]) for k, v in got.items()) < 1e-12
    np.fill_diagonal(s, -np.inf)
    want = np.argsort(-np.round(s, 12), axis=1, kind="stable")[:, :4]
    near = {}
    for r in similarity.top_k(df, df, 4, block_rows=100).orderBy("query", "rank").collect():
        near.setdefault(r["query"], []).append(r["match"])
    assert [near[k] for k in range(300) if k != 40] == [w.tolist() for k, w in enumerate(want) if k != 40]
    with pytest.raises(ValueError, match="positive"):
        similarity.top_k(df, df, 0)
    assert similarity.top_k(df.limit(3), df.limit(3), 10).count() == 6


def test_vocabulary(spark):
    rows = spark.createDataFrame([(0, "A b"), (1, "c"), (2, "a B")], "idx long, term string")
    assert sorted(map(tuple, similarity.vocabulary(rows).collect())) == [(0, "a_b", "a B"), (1, "c", "c")]
    words = spark.createDataFrame([("a", [2.0, 0.0]), ("b", [0.0, 1.0])], "word string, embedding array<double>")
    got = {r["idx"]: r["embedding"] for r in similarity.phrase_vectors(spark.createDataFrame([(0, "a_b"), (1, "a")], "idx long, term string"), words).collect()}
    assert got[1] == [1.0, 0.0] and got[0] == pytest.approx([2**-0.5, 2**-0.5])
    own = spark.createDataFrame([("word", [1.0, 0.0]), ("other", [0.0, 1.0])], "term string, embedding array<double>")
    assert {r["term"]: r["matches"] for r in similarity.align_self(own).collect()} == {"word": ["word"], "other": ["other"]}
    made = similarity.map_vectors(own.select("term"), lambda t: np.array([[len(x), 1] for x in t], dtype=float)).collect()
    assert {r["term"]: r["embedding"] for r in made} == {"word": [4.0, 1.0], "other": [5.0, 1.0]}


def test_glossary_round_trip(spark, tmp_path):
    path = tmp_path / "glossary.csv"
    rows = ["name⬤definition⬤lemma⬤acceptance_state", "Bank⬤a  place⬤bank⬤Accepted", "Loan⬤⬤loan⬤Accepted", "Old⬤x⬤old⬤Rejected", "Own funds⬤y⬤own funds⬤Accepted", "Tax⬤a \"levy\" \\ due⬤tax⬤Accepted"]
    path.write_text("\n".join(rows))
    kept = glossary.clean_glossary(readers.read_glossary(spark, str(path)))
    assert sorted(r["lemma"] for r in kept.collect()) == ["bank", "tax"]
    assert "own funds" in [r["lemma"] for r in glossary.clean_glossary(readers.read_glossary(spark, str(path)), strict_alnum=False).collect()]
    terms = kept.select(F.col("lemma").alias("term"), "definition")
    vectors = spark.createDataFrame([("bank", [1.0, 0.1]), ("tax", [1.0, 0.2]), ("levy", [1.0, 0.2])], "term string, embedding array<double>")
    concepts = spark.createDataFrame([("http://example.org/c1", "levy")], "uri string, label string")
    triples = pipeline.export_glossary(terms, vectors, concepts).cache()
    assert triples.filter(F.col("p") == glossary.RELATED).count() == 4
    writers.write_triples(triples, str(tmp_path / "out"))
    again = readers.read_triples(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, triples.collect()), key=repr)
    assert glossary.labels_with_definitions(again).count() == 2
    assert glossary.pattern(again, [("?a", glossary.RELATED, "?b"), ("?b", glossary.PREF_LABEL, "?l")], values={"l": ["tax"]}).count() == 1


def test_relations(spark):
    r = spark.createDataFrame([("a", "b", "related", 1), ("a", "b", "broader", 2), ("c", "d", "exactMatch", 3)], "uri1 string, uri2 string, relation string, ord long")
    assert sorted(map(tuple, glossary.keep_last(glossary.symmetric(r)).collect())) == [("a", "b", "broader"), ("b", "a", "related"), ("c", "d", "exactMatch"), ("d", "c", "exactMatch")]


XMI = """<?xml version="1.0"?><xmi:XMI xmlns:xmi="http://www.omg.org/XMI" xmlns:cas="http:///uima/cas.ecore" xmlns:type2="http:///t.ecore">
<type2:ValueBetweenTagType xmi:id="1" sofa="9" begin="0" end="5" tagName="p" attributes="class='x'"/>
<type2:ValueBetweenTagType xmi:id="2" sofa="8" begin="0" end="5" tagName="p"/>
<cas:Sofa xmi:id="9" sofaNum="1" sofaID="html2textView" mimeType="text" sofaString="hello world"/>
<cas:Sofa xmi:id="8" sofaNum="2" sofaID="_InitialView" mimeType="text" sofaString="raw"/>
<cas:Token_user xmi:id="3" user="u1" datetime="now" sofa="9" begin="6" end="11"/></xmi:XMI>"""


def test_annotated_documents(spark, tmp_path):
    (tmp_path / "a.xmi").write_text(XMI)
    docs, tags = readers.read_xmi(spark, str(tmp_path / "*.xmi"))
    assert [r["text"] for r in docs.collect()] == ["hello world"]
    assert [(r["tag_name"], r["attributes"], r["begin"], r["end"]) for r in tags.collect()] == [("p", "class='x'", 0, 5)]
    assert [(r["user"], r["begin"], r["end"]) for r in readers.read_user_spans(spark, str(tmp_path / "*.xmi"), docs).collect()] == [("u1", 6, 11)]


def test_requests_as_texts(spark, tmp_path):
    """What comes in a column is read as files are; only the chosen view counts."""
    rows = spark.createDataFrame([(1, XMI), (2, None), (3, "<x/>"), (4, XMI.replace("html2textView", "other"))], "doc_id long, xmi string")
    docs, tags, users = readers.parse_xmi(rows, user_elements=("Token_user",))
    assert [tuple(r) for r in docs.collect()] == [(1, "html2textView", "hello world")]
    assert [(r["doc_id"], r["tag_name"], r["attributes"], r["begin"], r["end"]) for r in tags.collect()] == [(1, "p", "class='x'", 0, 5)]
    assert [(r["doc_id"], r["user"], r["begin"], r["end"]) for r in users.collect()] == [(1, "u1", 6, 11)]
    (tmp_path / "b.xmi").write_text(XMI.replace('user="u1" datetime="now" sofa="9"', 'user="u1" datetime="now" sofa="8"'))
    of_files, _ = readers.read_xmi(spark, str(tmp_path / "*.xmi"))
    assert readers.read_user_spans(spark, str(tmp_path / "*.xmi"), of_files).count() == 0


def test_service(spark, tmp_path):
    """A request is answered with its text annotated; a broken one comes back as it was."""
    text = "The own funds of a bank are its capital. A bank is here."
    xmi = XMI.replace("hello world", text).replace('begin="0" end="5" tagName="p" attributes', f'begin="0" end="{len(text)}" tagName="p" attributes')
    body = json.dumps({"cas_content": base64.b64encode(xmi.encode()).decode(), "content_type": "html"})
    bodies = spark.createDataFrame([(body,), (json.dumps({"cas_content": "?", "content_type": "x"}),)], "value string")
    lists = spark.createDataFrame([("bank",), ("capital",)], "term string")
    answers = pipeline.answer_requests(bodies, lists, lists.filter("term = 'capital'"), store=pipeline.stored_in(str(tmp_path))).collect()
    got = {json.loads(r["value"])["content_type"]: json.loads(r["value"])["cas_content"] for r in answers}
    assert got["x"] == "?"
    tree = ElementTree.fromstring(base64.b64decode(got["html"]))
    tokens = [(e.get("term"), int(e.get("begin")), int(e.get("end"))) for e in tree if e.tag.endswith("Tfidf")]
    assert all(text[b:e].lower() == t for t, b, e in tokens)
    assert {("bank", b, b + 4) for b in (19, 43)} <= set(tokens) and "capital" not in {t for t, *_ in tokens}


def test_rdf_files(spark, tmp_path):
    (tmp_path / "a.ttl").write_text('@prefix s: <http://s#> . @base <http://e/> .\n<a> a s:C ; s:l "x;y"@en , \'\'\'two\nlines\'\'\' ; s:n 1.5 , true , [ s:k s:a.b ] . # end.\n<b> s:list ( <a> "z" ) .')
    (tmp_path / "b.rdf").write_text('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:s="http://s#" xml:lang="fr"><s:C rdf:about="http://e/a"><s:l xml:lang="en">x;y</s:l><s:l>été</s:l><s:r rdf:resource="http://e/b"/><s:n><rdf:Description s:k="v"/></s:n></s:C></rdf:RDF>')
    turtle = {(r["s"], r["p"][9:], r["o"], r["o_lang"]) for r in readers.read_rdf(spark, str(tmp_path / "*.ttl")).collect() if r["p"].startswith("http://s#")}
    assert {x for x in turtle if not x[0].startswith("_:") and not x[2].startswith("_:")} == {("http://e/a", "l", "x;y", "en"), ("http://e/a", "l", "two\nlines", None), ("http://e/a", "n", "1.5", None), ("http://e/a", "n", "true", None)}
    assert {x[1:] for x in turtle if x[0].startswith("_:")} == {("k", "http://s#a.b", None)}
    xml = {(r["p"].split("#")[1], r["o"], r["o_is_literal"], r["o_lang"]) for r in readers.read_rdf(spark, str(tmp_path / "*.rdf")).collect() if not r["o"].startswith("_:")}
    assert xml == {("type", "http://s#C", False, None), ("l", "x;y", True, "en"), ("l", "été", True, "fr"), ("r", "http://e/b", False, None), ("k", "v", True, "fr")}
    (tmp_path / "c.nt").write_text('<http://a> <http://p> "x" .\n\n# note\nno triple\n')
    assert readers.read_triples(spark, str(tmp_path / "c.nt"), broken="drop").count() == 1
    with pytest.raises(Exception, match="no triple"):
        readers.read_triples(spark, str(tmp_path / "c.nt")).collect()


def test_small_sources(spark, tmp_path):
    (tmp_path / "list.txt").write_text("means\n\nshall\n")
    assert [r["term"] for r in readers.read_list(spark, str(tmp_path / "list.txt")).collect()] == ["means", "shall"]
    (tmp_path / "bio.csv").write_text("Sentence #˳Word˳POS˳Tag\nSentence: 1˳a˳--˳B\n˳\"˳--˳O\nSentence: 2˳nan˳--˳O\n")
    got = readers.read_tag_table(spark, str(tmp_path / "bio.csv")).orderBy("row").collect()
    assert [(r["sentence"], r["token"]) for r in got] == [("Sentence: 1", "a"), ("Sentence: 1", '"'), ("Sentence: 2", "nan")]
    (tmp_path / "c.json").write_text(json.dumps({"u1": ["a", "b"], "u2": ["c"]}))
    assert sorted(map(tuple, readers.read_concepts(spark, str(tmp_path / "c.json")).collect())) == [("u1", "a"), ("u1", "b"), ("u2", "c")]
    (tmp_path / "r.json").write_text(json.dumps({"u1": {"u2": "related"}}))
    assert [tuple(r) for r in readers.read_relations(spark, str(tmp_path / "r.json")).collect()] == [("u1", "u2", "related")]
    bodies = spark.createDataFrame([('{"cas_content": "aGVsbG8=", "content_type": "html"}',), ('{"cas_content": "?", "content_type": "x"}',), ('{"voc": ["a"]}',)], "value string")
    assert [r["xmi"] for r in readers.decode_requests(bodies).collect()] == ["hello", None, None]
    assert readers.align_requests(bodies).collect()[2]["two"] == ["a"]
    names = spark.createDataFrame([(7, "n", ["big_cat"])], "offset int, pos string, names array<string>")
    assert tuple(readers.synset_labels(names).first()) == ("00000007-n", "big cat")


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(0, 0, "a", "B"), (0, 1, "b", "I"), (1, 0, "c", "O")], "sent_id long, pos long, token string, tag string")
    writers.write_tag_table(rows, str(tmp_path / "bio"))
    again = readers.read_tag_table(spark, str(tmp_path / "bio"))
    assert sorted((r["sentence"], r["token"], r["tag"]) for r in again.collect()) == [("Sentence: 1", "a", "B"), ("Sentence: 1", "b", "I"), ("Sentence: 2", "c", "O")]
    spans = spark.createDataFrame([(1, 0, 3, "abc")], "doc_id long, begin long, end long, term string")
    requests = spark.createDataFrame([(1, "c1", "html", XMI), (2, "c2", "pdf", None), (3, "c3", "x", "<no><view/></no>")], "doc_id long, cas_content string, content_type string, xmi string")
    out = {r["doc_id"]: json.loads(r["value"]) for r in writers.responses(requests, {"defined": spans, "token": spans.withColumn("term", F.lit('<"&'))}).collect()}
    assert out[1]["content_type"] == "html" and out[2] == {"cas_content": "c2", "content_type": "pdf"}
    assert base64.b64decode(out[3]["cas_content"]).decode() == "<no><view/></no>"
    tree = ElementTree.fromstring(base64.b64decode(out[1]["cas_content"]))
    added = {e.tag.split("}")[1]: dict(e.attrib) for e in tree if "termloom" in e.tag}
    assert added["Token"]["begin"] == "0" and added["Tfidf"]["term"] == '<"&' and added["Tfidf"]["sofa"] == "9"
    ids = [v for e in tree for k, v in e.attrib.items() if k.endswith("}id")]
    assert len(ids) == len(set(ids)) == 7
    pairs = spark.createDataFrame([("a", "b", 0.5), ("a", "c", 0.9)], "query string, match string, sim double")
    assert writers.response_map(pairs).first()["matches"] == ["c", "b"]
    writers.write_annotated(spark.createDataFrame([("d", ["t"], "m")], "text string, terms array<string>, annotated string"), str(tmp_path / "an"))
    writers.write_spans({"token": spans}, str(tmp_path / "spans"))
    assert spark.read.parquet(str(tmp_path / "spans")).count() == 1


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"doc_id": 1, "view": "v", "text": "one\\ntwo"}\n{"doc_id": 2, "view": "v", "text": ""}\n')
    from termloom.operators.spans import line_segments

    query = documents.annotate_stream(documents.read_documents(spark, str(tmp_path / "in")), lambda d: {"segments": line_segments(d)}, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(120)
    assert sorted(r["text"] for r in spark.read.parquet(str(tmp_path / "out" / "segments")).collect()) == ["one", "two"]
