"""Document operators against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import corpus
from termloom.llm import bpe, contamination, filters, graph, licenses, lm, neardup, substrings, toxicity


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.frame(spark).cache()


def collected(df, key="doc_id"):
    out = defaultdict(list)
    for r in df.collect():
        out[r[key]].append(r.asDict())
    return out


def brute_cut(rows, width=50):
    first = {}
    for i, text, *_ in rows:
        w = corpus.words(text)
        for a in range(len(w) - width + 1) if i is not None else ():
            k = tuple(w[a : a + width])
            first[k] = min(first.get(k, i), i)
    out = defaultdict(list)
    for i, text, *_ in rows:
        w = corpus.words(text)
        keep = [True] * len(w)
        for a in range(len(w) - width + 1) if i is not None else ():
            if first[tuple(w[a : a + width])] < i:
                keep[a : a + width] = [False] * width
        kept = [x for x, k in zip(w, keep, strict=True) if k]
        out[i].append((len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def test_substrings(spark, docs):
    got = {k: sorted((r["n_words"], r["n_removed"], r["kept_sha256"]) for r in v) for k, v in collected(substrings.prune(spark, docs, digest=True)).items()}
    assert got == {k: sorted(v) for k, v in brute_cut(corpus.rows()).items()}
    assert sum(x[1] for v in got.values() for x in v) > 0
    whole = substrings.prune(spark, docs)
    assert set(docs.columns) <= set(whole.columns)
    for r in whole.collect():
        if not r["n_removed"]:
            assert r["text"] in [t for i, t, *_ in corpus.rows() if i == r["doc_id"]] or r["text"] is None
    assert substrings.prune(spark, corpus.empty(spark), digest=True).count() == 0


def test_substrings_in_batches(spark, docs):
    """Batches in the order of their ids cut what one batch of all would; runs are merged and refuse older ids."""
    want = {k: v[0] for k, v in brute_cut(corpus.rows()).items() if k is not None}
    for fan_in in (2,):
        index = substrings.FingerprintIndex(spark, fan_in=fan_in)
        got, history, edges = {}, docs.limit(0), (0, 25, 26, 50, 10_000)
        for low, high in zip(edges, edges[1:], strict=False):
            batch = docs.filter((F.col("doc_id") >= low) & (F.col("doc_id") < high))
            spans = index.add(batch, history)
            for r in substrings.prune(spark, batch, digest=True, spans=spans).collect():
                got[r["doc_id"]] = (r["n_words"], r["n_removed"], r["kept_sha256"])
            index.compact()
            assert max(Counter(r.level for r in index.windows).values()) < fan_in and len(index.anchors) < 5
            history = history.unionByName(batch)
        assert got == want
        with pytest.raises(ValueError, match="order"):
            index.add(docs.filter("doc_id = 25"))
        index.drop()


def test_substring_batches_are_whole(spark, docs):
    ids = sorted(r["doc_id"] for r in docs.select("doc_id").collect() if r["doc_id"] is not None)
    for n in (1, 4, 200):
        parts = [sorted(r["doc_id"] for r in b.collect()) for b, _ in substrings.batches_of(docs, n)]
        assert sorted(x for p in parts for x in p) == ids and all(not set(p) & set(q) for p, q in combinations(parts, 2))


def test_clashing_columns(spark, docs):
    """Columns that are named as the operators' own pass through unchanged."""
    odd = docs.select("doc_id", "text", *(F.lit(f"kept {c}").alias(c) for c in ("_found", "_gone", "_doc", "_crc", "_spans", "_c0", "_text", "class_id", "hash", "a b", "h1", "stop", "ids_", "bands")))
    others = [c for c in odd.columns if c not in ("doc_id", "text")]
    items = spark.createDataFrame([(1, corpus.rows()[7][1], "x")], "item_id long, text string, _found string")
    for got in (contamination.clean(spark, odd, items), neardup.thin(spark, odd), substrings.prune(spark, odd), bpe.encode(odd)):
        assert set(odd.columns) <= set(got.columns)
        assert {tuple(r) for r in got.select(*(f"`{c}`" for c in others)).distinct().collect()} == {tuple(f"kept {c}" for c in others)}


def test_sliding_least():
    x = np.random.default_rng(0).integers(0, 99, 200).astype(np.uint64)
    for n in (1, 2, 3, 35, 64, 200):
        assert substrings.sliding_least(x, n).tolist() == [x[k : k + n].min() for k in range(len(x) - n + 1)]


def brute_classes(rows):
    def counts(text):
        w = corpus.words(corpus.lower(text))
        return Counter(tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))) if w else Counter()

    shingles = {i: counts(text) for i, text, *_ in rows if i is not None and corpus.words(text)}
    n = len(rows)
    df = Counter(k for _, text, *_ in rows for k in counts(text))
    weight = lambda k: math.log((1 + n) / (1 + df[k])) + 1
    parent = {i: i for i, *_ in rows if i is not None}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    close = []
    for a in shingles:
        for b in shingles:
            if a < b:
                common = sum(min(c, shingles[b][k]) * weight(k) for k, c in shingles[a].items())
                total = sum(c * weight(k) for s in (shingles[a], shingles[b]) for k, c in s.items())
                if (s := common / (total - common)) >= 0.8:
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
                elif s > 0.78:
                    close.append((a, b, s))
    return {i: find(i) for i in parent}, close


def test_near_duplicates(spark, docs):
    want, _ = brute_classes(corpus.rows())
    got = collected(neardup.classes(spark, docs))
    assert {r["class_id"] for r in got.pop(None)} == {None}
    assert {k: {r["class_id"] for r in v} for k, v in got.items()} == {k: {v} for k, v in want.items()}
    thin = neardup.thin(spark, docs)
    assert thin.columns == docs.columns
    assert {r["doc_id"] for r in thin.collect()} == {None} | {k for k, v in want.items() if k == v}
    assert neardup.classes(spark, corpus.empty(spark)).count() == 0


def test_one_large_group(spark):
    """Many loosely similar copies: links are found, and far fewer pairs are compared than there are."""
    rng = random.Random(4)
    base = corpus.prose(rng, 120)
    texts = [(k, corpus.edited(rng, base, rng.choice([0.005, 0.02, 0.04]))) for k in range(120)]
    want, _ = brute_classes(texts)
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(spark, spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == want


def test_near_duplicate_plans_are_small(spark, docs, monkeypatch):
    """Each written table has a small plan, and small rows are never broadcast: both would stay in the driver's memory."""
    plans = {}

    def noted(session, df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return written(session, df, name)

    written = neardup.written
    monkeypatch.setattr(neardup, "written", noted)
    monkeypatch.setattr(graph, "written", noted)
    neardup.classes(spark, docs)
    assert max(len(re.findall(r"\bExchange ", p)) for x in plans.values() for p in x) <= 16
    with_texts = {"signatures", "candidates", "similarities", "prefixes"}
    assert plans.keys() > with_texts
    assert not [k for k, x in plans.items() if k not in with_texts and any("BroadcastExchange" in p for p in x)]
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"


def test_samples_agree_as_often_as_texts_are_similar():
    sampler = neardup.Sampler()
    rng = np.random.default_rng(1)
    hits = []
    for _ in range(30):
        h = rng.integers(1, 1 << 62, 90).astype(np.uint64)
        w = rng.uniform(1, 5, 90)
        a, b = slice(0, 80), slice(10, 90)
        similar = w[10:80].sum() / w.sum()
        x, y = sampler.bands(np.zeros(80, dtype=int), h[a], w[a], 1)[0], sampler.bands(np.zeros(80, dtype=int), h[b], w[b], 1)[0]
        hits.append(((x == y).mean(), similar**neardup.ROWS))
    assert abs(np.mean([p for p, _ in hits]) - np.mean([q for _, q in hits])) < 0.06


def test_contamination(spark, docs):
    rng = random.Random(8)
    items = [(k, corpus.prose(rng, n)) for k, n in enumerate((40, 25, 14, 9, 5))] + [(9, None), (10, ""), (None, "x")]
    passage = lambda k, share=0.0: re.sub("[a-z]", lambda m: m[0].upper(), corpus.edited(rng, items[k][1], share))
    planted = [(1000, corpus.prose(rng, 60) + ". " + passage(0) + ", " + corpus.prose(rng, 9)), (1001, passage(1)), (1002, passage(0, 0.1)), (1003, passage(2)), (1004, passage(3)), (1005, " ".join(items[0][1].split()[5:25])), (1006, items[0][1].split()[0] + " " + corpus.prose(rng, 30)), (1007, items[4][1])]
    own = docs.select("doc_id", "text", F.lit(1).alias("item_id")).unionByName(spark.createDataFrame([(*p, 1) for p in planted], "doc_id long, text string, item_id int"))
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["n_same"], r["n_words"]) for r in contamination.overlaps(spark, own, tests).collect()}
    assert set(got) == {(1000, 0), (1001, 1), (1002, 0), (1003, 2), (1004, 3), (1005, 0)}
    assert got[1000, 0] == (40, 40) and got[1005, 0] == (20, 20)
    kept = contamination.clean(spark, own, tests)
    assert kept.count() == own.count() - 6 and kept.columns == own.columns
    assert contamination.overlaps(spark, own, tests.limit(0)).count() == 0
    assert contamination.overlaps(spark, own.limit(0), tests).count() == 0


def brute_stretch(same):
    """(words, words that agree) of the longest stretch of which 80 % agree."""
    sums = [0, *np.cumsum(same).tolist()]
    return max(((z - a, sums[z] - sums[a]) for z in range(len(sums)) for a in range(z + 1) if 5 * (sums[z] - sums[a]) >= 4 * (z - a)), default=(0, 0))


def test_best_stretch():
    rng = random.Random(21)
    for _ in range(400):
        same = np.array([rng.random() < rng.choice((0.5, 0.8, 0.95)) for _ in range(rng.randint(0, 40))], dtype=bool)
        a, z = contamination.best_stretch(same)
        assert (z - a, int(same[a:z].sum())) == brute_stretch(same)


def test_masks_lose_nothing():
    for n in range(contamination.SHORT, 21):
        left = [set(range(n)) - {at + k for k, c in enumerate(m) if c == "1"} for m in contamination.MASKS for at in range(n - len(m) + 1)]
        assert all(any(x.issuperset(differ) for x in left) for differ in combinations(range(n), n // 5)), n


def test_substituted_passages(spark):
    rng = random.Random(22)
    items = [(k, [f"w{k}x{i}" for i in range(n)]) for k, n in enumerate((*range(7, 31), 60))]
    docs, want = [], {}
    for k, item in items:
        for subs in (0, 1, 2, 3, 4):
            for _ in range(6):
                n = rng.randint(min(len(item), 8), len(item))
                a = rng.randint(0, len(item) - n)
                there = item[a : a + n]
                for i in rng.sample(range(n), subs):
                    there[i] = f"other{rng.randrange(10**9)}"
                before = rng.randint(0, 80)
                text = [f"b{i}" for i in range(before)] + there + [f"c{i}" for i in range(rng.randint(0, 80))]
                lo, hi = max(0, a - before), min(len(item), a - before + len(text))
                best = brute_stretch([text[before - a + i] == item[i] for i in range(lo, hi)])
                if best[0] >= max(8, min(13, len(item))):
                    want[len(docs), k] = best
                docs.append((len(docs), " ".join(text)))
    tests = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = contamination.overlaps(spark, spark.createDataFrame(docs, "doc_id long, text string"), tests).collect()
    assert {(r["doc_id"], r["item_id"]): (r["n_words"], r["n_same"]) for r in got} == want
    assert {k for _, k in want} == set(range(1, 25)) and len(want) < len(docs)


def test_filter_holds_all(spark):
    h = np.random.default_rng(0).integers(0, 1 << 63, 5000)
    flags, bits = filters.bloom(spark, spark.createDataFrame([(int(x),) for x in h], "hash long"))
    assert filters.held(flags, bits, h.astype(np.uint64)).all()
    assert filters.held(flags, bits, np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)).mean() < 0.05


def test_round_trip(spark, docs):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rng = random.Random(2)
    odd = ["<|endoftext|>" * 30, "a <|endoftext|> b", "we'll 's  x\n\n y", "日本語" * 3000, " " * 500, "é" * 3000]
    odd += ["".join(rng.choices(["a", "b", " ", "  ", "\n", "é", "'s", "日", "1", "!!", " ", "<|endoftext|>"], k=3000)) for _ in range(4)]
    rows = [(r[0], r[1]) for r in corpus.rows()] + [(5000 + k, x) for k, x in enumerate(odd)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = defaultdict(list)
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want[i].append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = collected(bpe.round_trip(df))
    assert {k: sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert bpe.encode(df.withColumn("ids", F.lit(1))).filter("doc_id = 5001").first()["ids"] == t.encode(odd[1], add_special_tokens=False).ids
    assert bpe.round_trip(corpus.empty(spark)).count() == 0


def test_shared_chunks_are_encoded_once():
    pytest.importorskip("public_tokenizers")
    enc = bpe.encoder()
    passage = corpus.prose(random.Random(11), 3000)
    enc.cache.clear()
    enc.encoded = enc.reused = 0
    enc.encode_column(pa.array(["start " + passage, "another beginning " + passage]))
    assert enc.reused >= 0.8 * enc.encoded > 0


def test_licences(spark, docs):
    cases = [
        ("Released under the MIT License.", 1, "mit", "mit"), ("mit-license mit license", 2, "mit", "mit"), ("Licensed under the Apache License, Version 2.0.", 1, "apache", "apache"),
        ("licensed under the GNU General Public License, version 3", 1, "gpl", "gpl"), ("Licensed under CC BY-NC 4.0.", 0, "", "cc-by-nc"), ("mit licenses; apachelicense", 0, "", ""),
        ("the license of mit", 0, "", ""), (None, 0, "", ""), ("", 0, "", ""), ("mit license " * 3000, 3000, "mit", "mit"),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", 0, "", "bsd"), ("MİT LICENSE", 0, "", ""),
    ]
    df = spark.createDataFrame([(k, c[0], "x", 1) for k, c in enumerate(cases)], "doc_id long, text string, words string, found int")
    got = {r["doc_id"]: r for r in licenses.scan(spark, df).collect()}
    for k, (text, n, base, labels) in enumerate(cases):
        r = got[k]
        assert (r["n_base"], r["base_labels"], r["labels"]) == (n, base, labels), text
        assert (r["first_word"] is None) == (n == 0) and 0 <= r["score"] <= 1
    assert got[1]["first_word"] == 0 and got[1]["last_word"] == 2 and got[9]["last_word"] == 5998
    assert licenses.scan(spark, corpus.empty(spark)).count() == 0


def test_licences_of_several_notices(spark):
    texts = dict.fromkeys(t for _, t, _ in licenses.TEMPLATES)
    label = {t: x for x, t, _ in licenses.TEMPLATES}
    rng = random.Random(31)
    long = list(texts)
    cases = [rng.sample(long, n) for n in (2, 2, 3, 3, 4, 4, 5, 5, len(long))]
    named = lambda *labels: [t for t in long if label[t] in labels and "released" not in t]
    cases += [named("bsd", "mpl"), named("bsd", "isc", "mpl"), named("bsd", "isc", "mpl", "epl")]
    rows = [(k, (" " + corpus.prose(rng, 400) + " ").join(c)) for k, c in enumerate(cases)]
    # a long document: one notice at its end, after all rare words of the others in an order that no template has
    rows.append((100, " ".join([*sorted(licenses.vocabulary(), reverse=True) * 40, corpus.prose(rng, 5000), *named("epl")])))
    rows += [(1000 + k, corpus.prose(rng, 50)) for k in range(300)]
    got = {r["doc_id"]: r for r in licenses.scan(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, c in enumerate(cases):
        assert {label[t] for t in c} <= set(got[k]["labels"].split(",")) and got[k]["score"] == 1, c
    assert "epl" in got[100]["labels"].split(",") and got[100]["score"] == 1
    assert got[1000]["labels"] == ""


def brute_scores(rows):
    tokens = [(i, [*corpus.words(corpus.lower(t)), "\0end"]) for i, t, *_ in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    c, seen, before = Counter(), Counter(), Counter()
    for i, w in tokens:
        if i is not None and not held(i):
            c.update(w)
            full = ["\0begin", *w]
            for k in range(1, len(full)):
                for n in (1, 2):
                    if k >= n:
                        seen[tuple(full[k - n : k + 1])] += 1
                        before[tuple(full[k - n : k])] += 1
    n, v = sum(c.values()), len(c)
    out = defaultdict(list)
    for i, w in tokens:
        base = [(c[x] + 0.1) / (n + 0.1 * (v + 1)) for x in w]
        s, full = 0.0, ["\0begin", *w]
        for k, p in enumerate(base, 1):
            for mu, m in ((200, 1), (20, 2)):
                if k >= m:
                    p = (seen[tuple(full[k - m : k + 1])] + mu * p) / (before[tuple(full[k - m : k])] + mu)
            s += math.log10(p)
        out[i].append((held(i), len(w), sum(c[x] > 0 for x in w), n, sum(map(math.log10, base)), s))
    return out


def same_scores(got, want):
    assert set(got) == set(want)
    for k, rows in want.items():
        mine = sorted((r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got[k])
        for a, b in zip(mine, sorted(rows), strict=True):
            assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], abs=1e-6) and abs(a[5] - b[5]) < 0.02 * a[1] + 0.02


def test_language_model(spark, docs):
    same_scores(collected(lm.score(spark, docs)), brute_scores(corpus.rows()))
    assert lm.score(spark, corpus.empty(spark)).count() == 0


def test_language_model_in_many_shards(spark, monkeypatch):
    """Many chunks and shards, with hot words, beginnings and pairs that are spread."""
    monkeypatch.setattr(lm, "CHUNK_BYTES", 8000)
    monkeypatch.setattr(lm, "LEAST_HOT", 5)
    rng = random.Random(41)
    rows = [*corpus.rows(), *((2000 + k, "of the " * rng.randint(1, 40) + corpus.prose(rng, 20) + " of the " + corpus.prose(rng, 3)) for k in range(60)), *[(3000, "of the x")] * 30]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = []
    first = lm.hot_contexts
    monkeypatch.setattr(lm, "hot_contexts", lambda *a: found.append((a[-1], first(*a))) or found[-1][1])
    same_scores(collected(lm.score(spark, df)), brute_scores(rows))
    shards, hot = found[0]
    t = lm.Tokens(pa.array(["of the"]))
    pair = lm.pair_of(t.before[1:2], t.word[1:2] >> np.uint64(32))
    assert shards > 5 and hot.parts.max() > 3 and hot.find(pair)[1].all() and hot.find(t.before[:2])[1].all()


def test_elias_fano():
    rng = np.random.default_rng(5)
    for top in (1, 50, 1 << 20, (1 << 64) - 1):
        for n in (0, 1, 5, 3000):
            x = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
            e = lm.EliasFano.of(lm.EliasFano.arrays(x))
            assert e.all().view(np.uint64).tolist() == x.tolist()
            q = np.concatenate([x, rng.integers(0, top, 200, dtype=np.uint64, endpoint=True)])
            at, equal = e.successor(q)
            assert at.tolist() == np.searchsorted(x, q).tolist()
            assert equal.tolist() == np.isin(q, x).tolist()


def test_elias_fano_searches_end_by_themselves(monkeypatch):
    """One high part with very many numbers does not lengthen the searches among the others."""
    x = np.concatenate([np.arange(4000), (np.arange(1, 3000) << 32) + 7]).astype(np.uint64)
    e, looked = lm.EliasFano.of(lm.EliasFano.arrays(x)), []
    for name in ("lows", "values"):
        if f := getattr(lm.EliasFano, name, None):
            monkeypatch.setattr(lm.EliasFano, name, lambda self, i, *a, f=f: looked.append(len(i)) or f(self, i, *a))
    q = np.repeat(x[4000:], 20)
    at, equal = e.successor(np.concatenate([q, x[:5]]))
    assert equal.all() and at.tolist() == np.searchsorted(x, np.concatenate([q, x[:5]])).tolist()
    assert sum(looked) < 3 * len(q)


def toxic_corpus(n=900, seed=6):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        bad = rng.random() < 0.15
        w = corpus.prose(rng, rng.randint(40, 90)).split()
        for _ in range(rng.randint(2, 4) if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["idiot", "scum", "zwat" + rng.choice("aeiou"), "Zwat" + rng.choice("aeiou") + "ra"]))
        rows.append((k, " ".join(w), "clash", 0.5))
        if rng.random() < 0.8:
            labels.append((k, 1, int(bad)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_corpus()
    df = spark.createDataFrame([*rows, (None, "idiot scum", None, None), (5001, None, None, None), (5002, "", None, None), rows[4]], "doc_id long, text string, toxic string, toxicity double")
    known = spark.createDataFrame([*labels, (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(df, known)
    got = collected(toxicity.score(df, model))
    held = {k for k, *_ in labels if zlib.crc32(str(k).encode()) % 3 == 1}
    right = [(got[k][0]["toxic"] == t) for k, _, t in labels if k in held]
    assert np.mean(right) > 0.97
    assert got[5001][0]["toxicity"] == got[5002][0]["toxicity"] < 0.5
    assert got[None][0]["toxic"] == 1 and len(got[4]) == 2
    flipped = spark.createDataFrame([(k, q, 1 - t if k in held else t) for k, q, t in labels], "doc_id long, quality int, toxic int")
    same = toxicity.fit(df, flipped)
    assert np.allclose(same.weights, model.weights)
    bare = toxicity.fit(df, known.limit(0))
    assert toxicity.score(corpus.empty(spark), bare).count() == 0
    assert toxicity.fit(corpus.empty(spark), known.limit(0)).weights is not None


def test_label_model_counts_copies_of_a_voter_down():
    rng = np.random.default_rng(2)
    y = rng.random(4000) < 0.2
    vote = lambda a, b: np.where(y, rng.random(4000) < a, rng.random(4000) < b).astype(float)
    x = vote(0.6, 0.05)
    fired = np.stack([x, x, x, vote(0.7, 0.03), np.zeros(4000), np.zeros(4000), np.zeros(4000), 1.0 * (rng.random(4000) < 0.5)], axis=1)
    known = np.where(rng.random(4000) < 0.5, y.astype(int), -1)
    p, parts = toxicity.label_model(fired, known)
    assert parts["discount"][0] < 0.5 < parts["discount"][3]
    assert ((p > 0.5) == y)[known < 0].mean() > 0.85
