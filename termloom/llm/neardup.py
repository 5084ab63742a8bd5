"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A text's shingles are its runs of five words (A-Z lower-cased); a text of fewer words is one shingle.  A shingle weighs its
count times idf = ln((1 + n) / (1 + df)) + 1.  df comes from a count-min sketch over all documents: its error is a fixed
share of n, so idf has the same floor at every size and the sketch does not grow.

1. Equal texts are one class from the start; one of them stands for all.
2. Each text gets 48 consistent weighted samples (two texts agree in one with probability equal to their weighted Jaccard similarity) in 12
   bands of 4.  At similarity 0.8 a pair shares a band with probability 0.998.
3. In each band's bucket every text is compared with the smallest member; pairs of 0.8 or more are links, and
   links' connected components are classes.
4. Buckets whose members are still in different classes are looked at again, by prefixes: if a text's shingles are put in one order
   for all texts, rarest first, two texts of similarity t share a shingle among those that come before the last t of
   their weight.  So members that share a band and such a shingle are compared: first with the smallest member that
   has the shingle, then all that are still in different classes, unless the weight of what comes before the shingle in either is
   too much for t: what comes from there on is all that they can share.  This is exact, so no link that shares a band is missed, while
   loosely similar texts, which share a band but differ in their rare shingles, never meet (`still_apart`).

Defined results: texts without words (null, empty) are classes of their own, as are rows without doc_id (class_id null); rows that repeat
a doc_id share its fate; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.filters import merged_pages
from termloom.llm.graph import components
from termloom.llm.shared import discard, give_back, settings, small_batches, unused, written
from termloom.llm.tokens import BLOCK, U, byte_table, mix, spaces, text_buffer, words_of

SHINGLE, BANDS, ROWS, SIMILAR = 5, 12, 4, 0.8
#: bytes of texts that are compared at once
PAIR_BYTES = 1 << 20
#: cells of the sketch: rows by columns; a page is what one row of the sum holds
DEPTH, COLUMNS, PAGE = 2, 1 << 19, 1 << 13


def _cells(h: np.ndarray) -> list[np.ndarray]:
    return [(mix(h ^ U(0x1234567 * (k + 1))) & U(COLUMNS - 1)).astype(np.int64) + k * COLUMNS for k in range(DEPTH)]


def shingles(column: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, row, hash, count) of the distinct shingles of rows i to j, by row; rows without words have none."""
    table, sep = byte_table(201, fold=True), spaces()
    for i, j, w in words_of(column, sep, size):
        one = w.hashes(table)
        at, h = w.windows(one, SHINGLE)
        row = w.row[at]
        n = np.diff(w.first)
        short = np.flatnonzero((n > 0) & (n < SHINGLE))
        if len(short):
            whole = [mix(one[w.first[r] : w.first[r + 1]] * (U(2) * np.arange(1, n[r] + 1, dtype=np.uint64) + U(1))).sum(dtype=np.uint64) for r in short]
            row, h = np.concatenate([row, short]), np.concatenate([h, np.array(whole, dtype=np.uint64)])
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])) if len(h) else np.zeros(0, dtype=np.int64)
        yield i, j, row[first], h[first], np.diff(np.concatenate([first, [len(h)]]))


def idf_table(docs: DataFrame) -> np.ndarray:
    """idf by cell of the sketch, summed by executors; its size is fixed (DEPTH * COLUMNS float32)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(DEPTH * COLUMNS, dtype=np.int64)
        n = 0
        for b in batches:
            n += b.num_rows
            for _, _, _, h, _ in shingles(b.column("text")):
                for c in _cells(h):
                    cells += np.bincount(c, minlength=len(cells)) if len(c) > len(cells) // 16 else 0
                    if len(c) <= len(cells) // 16:
                        np.add.at(cells, c, 1)
        if n:
            pack = zstandard.ZstdCompressor(level=1).compress
            pages = [pack(p.tobytes()) for p in cells.astype(np.int64).reshape(-1, PAGE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(pages)), pa.int64()), pa.array([pack(np.array([n]).tobytes()), *pages], pa.binary())], ["page", "counts"])
        give_back()

    def add(values: pd.Series) -> bytes:
        total: np.ndarray | int = 0
        for x in values:
            total = total + np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=np.int64)
        return zstandard.ZstdCompressor(level=1).compress(np.asarray(total).tobytes())

    sums = merged_pages(docs.select("text").mapInArrow(count, "page long, counts binary"), "counts", add)
    df, n = np.zeros(DEPTH * COLUMNS, dtype=np.int64), 0
    for r in sums.collect():
        x = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["counts"]), dtype=np.int64)
        if r["page"] < 0:
            n = int(x[0])
        else:
            df[r["page"] * PAGE : (r["page"] + 1) * PAGE] = x
    return (np.log((1.0 + n) / (1.0 + df)) + 1).astype(np.float32)


def weights(h: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Count times idf; a sketch's rows overrate df, so the largest idf is nearest."""
    best = idf[_cells(h)[0]]
    for c in _cells(h)[1:]:
        best = np.maximum(best, idf[c])
    return count * np.maximum(best, 1e-3)


class Sampler:
    """Consistent weighted samples; the random numbers of a shingle come from its hash through tables of quantiles."""

    BITS = 16

    def __init__(self) -> None:
        n = 1 << self.BITS
        grid = (np.arange(n) + 0.5) / n
        gamma = np.sort(np.random.default_rng(7).permutation(self._gamma2(grid)))
        self.r = gamma.astype(np.float32)
        self.per_r = (1 / gamma).astype(np.float32)
        self.log_c = np.log(gamma).astype(np.float32)

    @staticmethod
    def _gamma2(p: np.ndarray) -> np.ndarray:
        """Quantiles of the Gamma(2, 1) distribution: 1 - (1 + x) exp(-x) = p, by bisection."""
        low, high = np.zeros_like(p), np.full_like(p, 60.0)
        for _ in range(70):
            mid = (low + high) / 2
            below = 1 - (1 + mid) * np.exp(-mid) < p
            low, high = np.where(below, mid, low), np.where(below, high, mid)
        return (low + high) / 2

    def bands(self, row: np.ndarray, h: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
        """A hash for each row and band (n by BANDS); rows without shingles get 0."""
        out = np.zeros((n, BANDS), dtype=np.uint64)
        if not len(row):
            return out
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        sizes = np.diff(np.concatenate([first, [len(row)]]))
        rows = row[first]
        log_w = np.log(w).astype(np.float32)
        mask = U((1 << self.BITS) - 1)
        band = np.zeros(len(first), dtype=np.uint64)
        for k in range(BANDS * ROWS):
            x = mix(h + U(0x9E3779B97F4A7C15 * (k + 1) & 0xFFFFFFFFFFFFFFFF))
            i = (x & mask).astype(np.int32)
            r = self.r[i]
            beta = ((x >> U(32)).astype(np.uint32) >> np.uint32(8)).astype(np.float32) * np.float32(2**-24)
            t = np.floor(log_w * self.per_r[i] + beta)
            log_a = self.log_c[((x >> U(self.BITS)) & mask).astype(np.int32)] - r * (t + 1 - beta)
            least = np.minimum.reduceat(log_a, first)
            hit = np.flatnonzero(log_a == np.repeat(least, sizes))
            group = np.searchsorted(first, hit, side="right") - 1
            keep = np.concatenate([[True], group[1:] != group[:-1]])
            at = hit[keep]
            sample = mix(h[at] ^ mix(t[at].astype(np.int64).view(np.uint64) + U(k + 1)))
            band = mix(band * U(0xD1342543DE82EF95) + sample) if k % ROWS else mix(sample + U(k))
            if k % ROWS == ROWS - 1:
                out[rows, k // ROWS] = band
        return out


def signatures(docs: DataFrame, idf) -> DataFrame:
    """(doc_id, h1, h2, bands): bands are null in all but one of a batch's equal texts, and empty for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sampler = np.frombuffer(idf.value, dtype=np.float32), Sampler()
        for b in batches:
            h1 = b.column("h1").to_numpy(zero_copy_only=False)
            h2 = b.column("h2").to_numpy(zero_copy_only=False)
            _, first = np.unique(np.stack([h1, h2]), axis=1, return_index=True)
            first.sort()
            lists: list[list[int] | None] = [None] * b.num_rows
            for i, j, row, h, count in shingles(b.column("text").take(pa.array(first))):
                made = sampler.bands(row, h, weights(h, count, table), j - i).view(np.int64)
                there = np.zeros(j - i, dtype=bool)
                there[row] = True
                for r in range(j - i):
                    lists[first[i + r]] = made[r].tolist() if there[r] else []
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h1"), b.column("h2"), pa.array(lists, pa.list_(pa.int64()))], ["doc_id", "h1", "h2", "bands"])
        give_back()

    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(11), "text").alias("h2"))
    return rows.mapInArrow(run, "doc_id long, h1 long, h2 long, bands array<long>")


def prefixes(texts: DataFrame, idf, similar: float) -> DataFrame:
    """(node, shingle, before, total): for each text (doc_id, text), its rarest shingles, up to those that begin the last `similar` of its weight.

    before is the weight of the shingles that come before this one, total that of all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(idf.value, dtype=np.float32)
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            for i, j, row, h, count in shingles(b.column("text")):
                one = weights(h, np.ones(len(h)), table)
                order = np.lexsort((h, -one, row))
                row, h, w = row[order], h[order], (one * count)[order].astype(np.float64)
                total = np.bincount(row, weights=w, minlength=j - i)
                first = np.searchsorted(row, np.arange(j - i))
                run_ = np.cumsum(w) - w
                before = run_ - run_[np.minimum(first, max(len(run_) - 1, 0))][row]
                keep = before <= (1 - similar + 1e-6) * total[row]
                yield pa.RecordBatch.from_arrays([pa.array(ids[row[keep] + i]), pa.array(h[keep].view(np.int64)), pa.array(before[keep]), pa.array(total[row[keep]])], ["node", "shingle", "before", "total"])
        give_back()

    return texts.mapInArrow(run, "node long, shingle long, before double, total double")


def similarities(pairs: DataFrame, idf) -> DataFrame:
    """(a, b, similarity) of pairs (a, b, text_a, text_b): weighted Jaccard similarity of their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(idf.value, dtype=np.float32)
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            out = np.zeros(n)
            # pairs whose texts come to about PAIR_BYTES at once
            ends = np.cumsum(sum(np.diff(text_buffer(b.column(c))[1]) for c in ("text_a", "text_b")))
            s = 0
            while s < n:
                m = max(1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + PAIR_BYTES, side="right")) - s)
                both = pa.concat_arrays([b.column("text_a").slice(s, m), b.column("text_b").slice(s, m)])
                parts = [(row + i, h, count) for i, _, row, h, count in shingles(both)]
                row, h, count = (np.concatenate(x) for x in zip(*parts, strict=True))
                w = weights(h, count, table).astype(np.float64)
                total = np.bincount(row, weights=w, minlength=2 * m)
                pair = np.where(row < m, row, row - m)
                order = np.lexsort((row, h, pair))
                p, g, v = pair[order], h[order], w[order]
                same = np.flatnonzero((p[1:] == p[:-1]) & (g[1:] == g[:-1]))
                common = np.bincount(p[same], weights=np.minimum(v[same], v[same + 1]), minlength=m)
                out[s : s + m] = common / np.maximum(total[:m] + total[m:] - common, 1e-12)
                s += m
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(out)], ["a", "b", "similarity"])
        give_back()

    return pairs.mapInArrow(run, "a long, b long, similarity double")


def still_apart(entries: DataFrame, similar: float) -> DataFrame:
    """Pairs (a, b) that share a shingle of entries (shingle, node, before, total, component, bands), are of different components and may be similar.

    Two texts share at most what stands from a shingle of their prefixes on, in either.  So the lighter one must hold the
    shingle so early that its rest could do for a text of its own weight at least, and the other's weight is bounded by that
    rest: this is the light side of an equi-join on shingle and a step of weight.  Copies of one block with
    differing surroundings have it too late in their order, and give no rows however many they are.
    """
    # the weight that a partner may have at most: rest >= similar / (1 + similar) * (own weight + partner's)
    most = (F.col("total") - F.col("before")) * ((1 + similar) / similar) * (1 + 1e-6) - F.col("total")
    mask = F.aggregate("bands", F.lit(0).cast("long"), lambda m, x: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(x, F.lit(64)).cast("int"))))
    step = lambda c: F.floor(F.log(c) / math.log(1 / similar))
    rows = entries.select("shingle", "node", "component", F.col("total").alias("w"), most.alias("most"), mask.alias("mask"))
    side = lambda df, x: df.select("shingle", "step", F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("component", "w", "most", "mask")))
    light = rows.filter(F.col("most") >= F.col("w") * (1 - 1e-6)).withColumn("step", F.explode(F.sequence(step(F.col("w") * (1 - 1e-6)), step(F.greatest("w", "most")))))
    met = side(light, "a").join(side(rows.withColumn("step", step(F.col("w"))), "b"), ["shingle", "step"])
    fits = F.expr("component_a <> component_b and w_b >= w_a * (1 - 1e-6) and w_b <= most_a and w_a <= most_b and (mask_a & mask_b) <> 0")
    return met.filter(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def by_shuffle(spark: SparkSession):
    """Inside the block joins are by shuffle, never by broadcast: for small rows on both sides, many joins, and a driver that would hold each broadcast table."""
    return settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")


def classes(spark: SparkSession, docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, class_id) of docs (doc_id, text): class_id is the smallest doc_id of the class."""
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    idf = spark.sparkContext.broadcast(idf_table(docs).tobytes())
    signed = written(spark, signatures(docs, idf), "signatures")

    # small plans: the driver keeps each one and its every change, and one over all steps would fill its memory
    def kept(df: DataFrame, name: str) -> DataFrame:
        with by_shuffle(spark):
            return written(spark, df, name)

    def linked(edges: DataFrame) -> DataFrame:
        with by_shuffle(spark):
            return components(spark, edges)

    # one row for each distinct text with words, named by its smallest document
    texts = signed.groupBy("h1", "h2").agg(F.min("doc_id").alias("node"), F.first("bands", ignorenulls=True).alias("bands")).filter(F.size("bands") > 0)
    texts = kept(texts, "texts")
    buckets = texts.select("node", F.explode("bands").alias("bucket"))
    heads = buckets.groupBy("bucket").agg(F.min("node").alias("head"), F.count("*").alias("n")).filter("n > 1").drop("n")
    members = kept(buckets.join(heads, "bucket"), "buckets")
    named = members.select(F.col("node").alias("doc_id")).distinct()
    wanted = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("h1")).join(texts.join(named, texts["node"] == named["doc_id"], "left_semi").select(F.col("node").alias("doc_id"), "h1"), ["doc_id", "h1"])
    wanted = written(spark, wanted.select("doc_id", "text"), "candidates")

    def compare(pairs: DataFrame) -> DataFrame:
        pairs = kept(pairs, "pairs")
        left = wanted.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
        right = wanted.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
        out = written(spark, similarities(pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b"), idf), "similarities")
        discard(spark, pairs)
        return out

    stars = compare(members.filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct())
    first = linked(stars.filter(F.col("similarity") >= similar).select("a", "b"))
    # buckets that still hold several classes
    placed = kept(members.join(first, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component")), "placed")
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("bucket")
    open_nodes = placed.join(mixed, "bucket").groupBy("node").agg(F.first("component").alias("component"), F.collect_set("bucket").alias("bands"))
    open_nodes = kept(open_nodes, "open")
    discard(spark, members, placed)
    rare = written(spark, prefixes(wanted.join(open_nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi"), idf, similar), "prefixes")
    done = stars.select("a", "b")

    def open_pairs(pairs: DataFrame, classes_: DataFrame) -> DataFrame:
        """Pairs (a, b) of nodes in different classes that share a band and were not compared yet."""
        side = lambda x: classes_.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"), F.col("bands").alias(f"s{x}"))
        apart = pairs.filter("a <> b").join(side("a"), "a").join(side("b"), "b").filter((F.col("ca") != F.col("cb")) & F.arrays_overlap("sa", "sb"))
        return apart.select("a", "b").join(done, ["a", "b"], "left_anti")

    heads = rare.groupBy("shingle").agg(F.min("node").alias("a"), F.count("*").alias("n")).filter("n > 1").drop("n")
    meeting = kept(rare.join(heads, "shingle").select("a", F.col("node").alias("b")).distinct(), "meeting")
    second = compare(open_pairs(meeting, open_nodes))
    done = done.unionByName(second.select("a", "b"))
    # the classes found so far, each a star, and the links among them
    links = first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(second.filter(F.col("similarity") >= similar).select("a", "b"))
    again = linked(links)
    now = kept(open_nodes.join(again.withColumnRenamed("component", "_c"), "node", "left").select("node", F.coalesce("_c", "component").alias("component"), "bands"), "now")
    entries = rare.join(now, "node")
    several = entries.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("shingle")
    entries = kept(entries.join(several, "shingle", "left_semi"), "entries")
    discard(spark, meeting, rare)
    met = kept(still_apart(entries, similar), "met")
    rest = compare(open_pairs(met, now))
    links = again.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(rest.filter(F.col("similarity") >= similar).select("a", "b"))
    found = kept(linked(links), "components")
    discard(spark, wanted, open_nodes, stars, second, now, entries, met, rest)
    by_text = texts.join(found, "node", "left").select("h1", "h2", F.coalesce("component", "node").alias("class_id"))
    with_words = signed.select("doc_id", "h1", "h2").join(by_text, ["h1", "h2"], "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    return with_words.unionByName(docs.filter("doc_id is null").select(F.col("doc_id").cast("long"), F.lit(None).cast("long").alias("class_id")))


def thin(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs less those of which a smaller document of the same class is there; rows without doc_id stay."""
    key = unused(docs, "_gone")
    gone = classes(spark, docs).filter("class_id <> doc_id").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(key), "left_anti")
