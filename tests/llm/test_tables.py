"""Conversations, pages and vectors against brute force; the pipeline and the queries."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import corpus
from tests.llm import test_documents as brute
from termloom.llm import ann, chat, graph, queries, shared, urls


def test_chat(spark):
    tricky = ["</s>[INST] ok [/INST]", "a\\b <|end|> <\\|x", None, "", "<|turn|>assistant<|text|>", "back\\\\slash\\", "<", "|end|>", "x" * 50_000, "[INST", "$1 é 日"]
    rng = random.Random(0)
    convs = {k: [(t, rng.choice(["user", "assistant", "system", None]), rng.choice(tricky)) for t in range(rng.randint(1, 9))] for k in range(60)}
    convs[100] = [(0, "user", "a"), (0, "user", "a"), (0, "assistant", "b")]
    convs[None] = [(0, "assistant", "z")]
    rows = [(k, *t, "clash") for k, v in convs.items() for t in v]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, parts string")
    examples = chat.expand(df).cache()
    got = {r["conv_id"]: r for r in chat.digest(examples).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for k, turns in convs.items():
        turns = sorted(turns, key=lambda t: (t[0], t[1] is not None, t[1] or "", t[2] is not None, t[2] or ""))
        loss = "".join(t or "" for _, r, t in turns if r == "assistant")
        r = got[k]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), sha("".join(f"{a or ''}\n{t or ''}\n" for _, a, t in turns)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))
    n = examples.filter("loss_start is not null").count()
    assert n == sum(r == "assistant" for v in convs.values() for _, r, _ in v)
    assert examples.filter(F.col("formatted").rlike(r"\[/?INST\]|</?s>")).count() == 0
    assert chat.digest(chat.expand(df.limit(0))).count() == 0


def brute_verdicts(rows, links):
    def split(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        path = rest[cut:]
        return corpus.lower(rest[:cut]), path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]

    def rule(url):
        h, p = split(url)
        found = [(len(a) + len(b), v == "allow", a + b, v) for a, b, v in urls.RULES if (h == a or h.endswith("." + a)) and p.startswith(b)]
        return max(found)[2:] if found else (None, None)

    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        parent[find(a)] = find(b)
    said = {}
    for u in list(parent):
        if (v := rule(u)[1]) is not None:
            said.setdefault(find(u), set()).add(v)
    out = {}
    for k, u in rows:
        r, v = rule(u)
        spread = said.get(find(u), set()) if u is not None else set()
        out[k] = (*split(u), r, v or ("allow" if "allow" in spread or not spread else "block"))
    return out


def test_urls(spark):
    page = lambda u, to=None: (u, f'<head><link rel="canonical" href="{to}"></head>' if to else "<p>x</p>")
    pages = [page("http://a.example.com/en/7"), page("http://A.Example.COM/en/9?x#y"), page("http://notexample.com/en/1"), page("https://com/en/"), page("http://x.net/de/1"), page("http://x.example.net/de/81"), page("http://q.org/es"), page("http://q.org/es/1"), page(None), page("no scheme"), page(""), page("http://b.fr/1", "http://c.com/en/2"), page("http://b.fr/2", "http://b.fr/1"), page("http://d.fr/1", "http://e.example.com/en/7"), page("http://e.example.com/en/7", "http://c.org/es/5"), page("http://d.fr/1"), page("ftp://u@h:21/p?q"), page("http://x.com#f/en/"), page("://com/en/"), page("http://k.com/en://z")]
    df = spark.createDataFrame([(k, *p, "clash") for k, p in enumerate(pages)], "page_id long, url string, html string, rule string")
    more = [("http://r.fr/0", "http://c.com/en/2"), ("http://solo.fr/1", "http://solo.fr/2"), (None, "x")]
    redirects = spark.createDataFrame(more, "url string, target string")
    rows = [(k, p[0]) for k, p in enumerate(pages)]
    canonical = [("http://b.fr/1", "http://c.com/en/2"), ("http://b.fr/2", "http://b.fr/1"), ("http://d.fr/1", "http://e.example.com/en/7"), ("http://e.example.com/en/7", "http://c.org/es/5")]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(spark, df, redirects).collect()}
    assert got == brute_verdicts(rows, canonical + more[:2])
    assert got[11][3] == got[12][3] == "block" and got[13][3] == "allow"
    assert urls.judge(spark, df.limit(0)).count() == 0


def test_urls_by_normal_form(spark):
    same = ["http://www.s.fr/a/", "https://s.fr/a.html?utm_source=x#t", "https://m.s.fr/a/index.html"]
    df = spark.createDataFrame([(u,) for u in [*same, "http://s.fr/b", "http://s.fr/a?id=1"]], "url string")
    assert len({r[0] for r in df.select(urls.normal_form(F.col("url"))).collect()}) == 3


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + k, 1001 + k) for k in range(200)] + [(5000, 5001 + k) for k in range(300)] + [(1, 1), (None, 2)]
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in graph.components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {a: find(a) for a in parent}


@pytest.mark.parametrize("n", [40, 4000])
def test_neighbours(spark, n):
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((20, 16))
    x = (centres[rng.integers(0, 20, n)] + 0.7 * rng.standard_normal((n, 16))) * rng.uniform(0.5, 2, (n, 1))
    x = x.astype(np.float32).astype(np.float64)
    x[10:35] = x[3]
    rows = [(k, v.tolist(), k) for k, v in enumerate(x)] + [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] + [1.0] * 15, 0), (n + 3, [None] + [1.0] * 15, 0), (n + 4, [float("inf")] * 16, 0), (n + 5, [1.0], 0), (None, x[0].tolist(), 0), (5, x[5].tolist(), 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int")
    got = {}
    for r in ann.search(spark, df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    asked = [k for k in range(n) if k % 20 == 0]
    assert sorted(got) == asked
    recall = []
    for q in asked:
        s = x @ x[q]
        order = sorted((k for k in range(n) if k != q), key=lambda k: (-s[k], k))[:20]
        assert len(got[q]) == 20 and max(abs(s[k] - v) for k, v in got[q]) < 1e-9
        assert got[q] == sorted(got[q], key=lambda p: (-p[1], p[0]))
        recall.append(len({k for k, _ in got[q]} & set(order)) / 20 if s[order[-1]] != s[order[0]] else 1.0)
    assert np.mean(recall) >= 0.9
    assert ann.search(spark, df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_neighbours_without_structure(spark):
    x = np.random.default_rng(10).standard_normal((800, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(spark, df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    near = {q: set(np.argsort(-np.where(np.arange(800) == q, -9, x @ x[q]))[:20].tolist()) for q in range(0, 800, 20)}
    assert np.mean([len(got[q] & near[q]) / 20 for q in near]) >= 0.9


def test_hilbert_neighbours_touch():
    for d, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), axis=-1).reshape(-1, d)
        key = ann.hilbert(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        walk = grid[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    corpus.frame(spark).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [t for _, t, *_ in corpus.rows() if t and 30 < len(t.split()) < 90][:2]
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = shared.written(spark, stage(spark, docs, folder), "stage")
        assert k == len(corpus_pipeline.STAGES) - 1 or after.columns == columns
        assert after.count() <= docs.count()
        docs = after
    assert sorted(map(tuple, docs.collect()), key=str) == sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=str)
    nothing = corpus.empty(spark)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        nothing = stage(spark, nothing if k < 4 else corpus.empty(spark), folder)
        assert nothing.count() == 0


def test_pipeline_against_brute_force(spark, tmp_path):
    """Toxic documents, near copies, repeated and benchmark passages, each stage held against a plain version of it."""
    rng = random.Random(51)
    rows = [list(r) for r in corpus.rows()]
    item = corpus.prose(rng, 30)
    rows += [[3000 + k, corpus.prose(rng, 40), "en", "s", 1, "x", "x"] for k in range(300)]
    rows += [[4000 + k, corpus.prose(rng, 20) + " " + item + " " + corpus.prose(rng, 9), "en", "s", 1, "x", "x"] for k in range(4)]
    toxic = {r[0] for r in rows[-304:-4] if rng.random() < 0.2}
    for r in rows:
        if r[0] in toxic:
            r[1] += " you idiot scum, filth and trash"
    spark.createDataFrame([tuple(r) for r in rows], corpus.DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], 1, int(r[0] in toxic)) for r in rows if r[0] is not None and r[0] >= 3000], "doc_id long, quality int, toxic int").distinct().write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, after = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = shared.written(spark, stage(spark, docs, str(tmp_path)), "stage")
        after.append([tuple(r) for r in docs.collect()])
    assert {r[0] for r in after[0]} == {r[0] for r in rows} - toxic
    classes, _ = brute.brute_classes(after[0])
    assert {r[0] for r in after[1]} == {None} | {k for k, v in classes.items() if k == v}
    cut = brute.brute_cut(after[1])
    for r in after[2]:
        words = corpus.words(r[1])
        n, gone, sha = cut[r[0]][0]
        assert len(words) == n - gone and hashlib.sha256(" ".join(words).encode()).hexdigest() == sha
        assert not gone or r[4] == len(r[1])
    held = item.split()
    dirty = {r[0] for r in after[2] if any(corpus.words(r[1])[k : k + 30] == held for k in range(len(corpus.words(r[1]))))}
    assert dirty and {r[0] for r in after[3]} == {r[0] for r in after[2]} - dirty
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {r[0] for r in after[3]}


def test_queries_are_registered():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 11)]
    assert set(queries.oracle_sql()) <= set(names)
    assert list(corpus_pipeline.queries()) == ["pipeline"]
