"""Benchmark decontamination by spaced seeds.

A seed is a mask over consecutive words: only the words at its ones are hashed, so a hit survives substitutions at its zeros.
The masks lose nothing: wherever the words that differ lie in a stretch that is long enough and agrees enough, one of them fits.
Test items give a hash for each mask and position.  A scan of the training texts keeps the positions whose hashes pass a Bloom
filter of the test hashes (of bounded size; its false positives are turned down later), gathered in stretches with
the words around them.  The hits meet the test hashes by an equi-join; each pair of document and item is then verified on the diagonal
of its hit: the longest stretch in which at least 80 % of the words agree must hold 13 words, or the whole item if that is shorter.

Words are runs of ASCII letters and digits and of all other non-ASCII characters, A-Z lower-cased.

Defined results: null and empty texts hold nothing; items of fewer words than the least stretch (8) are never found; rows
without id are left out; documents that repeat an id count as one; an empty table on either side gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.filters import bloom, held
from termloom.llm.shared import small_batches, unused, written
from termloom.llm.tokens import U, Words, byte_table, mix, non_alnum, words_of

#: Ones are compared, zeros may differ.  The first row fits any 8 words of which one differs, with the second any 10 of which two do,
#: with the last any 15 of which three do; a longer stretch of which 80 % agree holds one of these.  Weight 7, the last 10.
MASKS = (
    "1111111", "10111111", "11011111", "11101111", "11110111", "11111011", "11111101",
    "110011111", "110110111", "1101011011", "1101110011", "1110101011", "1111000111",
    "111110000011111",
)
#: words of a verified stretch, the least for short items, share of them that agree
LEAST, SHORT, SHARE = 13, 8, 0.8
#: bits of the filter at least
FILTER_BITS = 1 << 24


def seeds(w: Words, hashes: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the words at which the mask fits into a row, and its hash there."""
    n, span = len(hashes), len(mask)
    if n < span:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    total = np.zeros(n - span + 1, dtype=np.uint64)
    for k, c in enumerate(mask):
        if c == "1":
            total = (total + hashes[k : n - span + 1 + k]) * U(0x9E3779B97F4A7C15)
    at = np.flatnonzero(w.row[: n - span + 1] == w.row[span - 1 :])
    return at, mix(total[at] + U(MASKS.index(mask) + 1))


def _hashed(column: pa.Array) -> Iterator[tuple[int, int, Words, np.ndarray]]:
    table, sep = byte_table(301, fold=True), non_alnum()
    for i, j, w in words_of(column, sep):
        yield i, j, w, w.hashes(table)


def item_seeds(items: DataFrame) -> DataFrame:
    """(hash, item_id, item_at) of the test items (item_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("item_id").to_numpy(zero_copy_only=False)
            for i, _, w, h in _hashed(b.column("text")):
                for mask in MASKS:
                    at, s = seeds(w, h, mask)
                    yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.array(ids[w.row[at] + i]), pa.array((at - w.first[w.row[at]]).astype(np.int32))], ["hash", "item_id", "item_at"])

    return items.filter("item_id is not null").select(F.col("item_id").cast("long"), "text").mapInArrow(run, "hash long, item_id long, item_at int")


def item_words(items: DataFrame) -> DataFrame:
    """(item_id, item_words): each item's word hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, w, h in _hashed(b.column("text")):
                yield pa.RecordBatch.from_arrays([b.column("item_id").slice(i, j - i), pa.array([h[w.first[r] : w.first[r + 1]].tobytes() for r in range(j - i)], pa.binary())], ["item_id", "item_words"])

    return items.filter("item_id is not null").select(F.col("item_id").cast("long"), "text").mapInArrow(run, "item_id long, item_words binary")


def stretches(docs: DataFrame, sent, bits: int, around: int) -> DataFrame:
    """(doc_id, base, words, hashes, places): stretches of documents around seeds that pass the filter.

    base: the stretch's first word; words: hashes of its words; hashes and places: the seeds' and where they begin.
    around: words kept on both sides of a seed, at least those of the longest item, so that an item's whole diagonal is there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(sent.value, dtype=np.uint8)
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            out: list[list] = [[], [], [], [], []]
            for i, _, w, h in _hashed(b.column("text")):
                found = []
                for mask in MASKS:
                    at, s = seeds(w, h, mask)
                    ok = held(flags, bits, s)
                    found.append((at[ok], s[ok]))
                at, s = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, s = at[order], s[order]
                cut = np.flatnonzero((np.diff(at) > around) | (np.diff(w.row[at]) != 0)) + 1
                for x, y in zip(np.split(at, cut), np.split(s, cut), strict=True):
                    r = w.row[x[0]]
                    lo, hi = max(w.first[r], x[0] - around), min(w.first[r + 1], x[-1] + around)
                    for column, value in zip(out, (ids[r + i], lo - w.first[r], h[lo:hi].tobytes(), y.view(np.int64), (x - w.first[r]).astype(np.int32)), strict=True):
                        column.append(value)
            if out[0]:
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["doc_id", "base", "words", "hashes", "places"])

    return docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, base int, words binary, hashes array<long>, places array<int>")


def best_stretch(same: np.ndarray) -> tuple[int, int]:
    """Begin and end of the longest stretch of which at least SHARE agree; of equally long ones the first with the most that agree."""
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -round(SHARE / (1 - SHARE))))])
    # a stretch agrees enough if the total does not fall over it; its farthest begin is where the total first was that low
    begin = np.searchsorted(-np.minimum.accumulate(total), -total)
    length = np.arange(len(total)) - begin
    end = int(np.argmax(np.where(length == length.max(), total - total[begin], -1)))
    return int(begin[end]), end


def verify(pairs: DataFrame) -> DataFrame:
    """(doc_id, item_id, at, item_at, n_words, n_same) of the pairs (doc_id, base, words, item_id, item_words, diagonal) that agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                doc, item = np.frombuffer(r["words"], dtype=np.uint64), np.frombuffer(r["item_words"], dtype=np.uint64)
                shift = r["diagonal"] - r["base"]  # the item's first word stands here in the stretch
                lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
                if hi <= lo:
                    continue
                same = doc[lo + shift : hi + shift] == item[lo:hi]
                a, z = best_stretch(same)
                if z - a >= max(SHORT, min(LEAST, len(item))):
                    rows.append((r["doc_id"], r["item_id"], r["diagonal"] + lo + a, lo + a, z - a, int(same[a:z].sum())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "item_id", "at", "item_at", "n_words", "n_same"])

    return pairs.mapInArrow(run, "doc_id long, item_id long, at long, item_at long, n_words long, n_same long")


def overlaps(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, at, item_at, n_words, n_same): for each document and item that overlap, their longest verified stretch."""
    small_batches(spark)
    tests = written(spark, item_seeds(items), "seeds")
    flags, bits = bloom(spark, tests, least=FILTER_BITS)
    whole = item_words(items)
    longest = (whole.agg(F.max(F.length("item_words"))).first()[0] or 0) // 8
    found = written(spark, stretches(docs, spark.sparkContext.broadcast(flags.tobytes()), bits, longest), "stretches")
    hits = found.select("doc_id", "base", F.explode(F.arrays_zip("hashes", "places")).alias("s")).select("doc_id", "base", F.col("s.hashes").alias("hash"), F.col("s.places").alias("place"))
    diagonals = hits.join(tests, "hash").select("doc_id", "base", "item_id", (F.col("place") - F.col("item_at")).alias("diagonal")).distinct()
    pairs = diagonals.join(found.select("doc_id", "base", "words"), ["doc_id", "base"]).join(whole, "item_id")
    best = F.max(F.struct("n_words", "n_same", (-F.col("at")).alias("a"), (-F.col("item_at")).alias("i"))).alias("b")
    return verify(pairs).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", (-F.col("b.a")).alias("at"), (-F.col("b.i")).alias("item_at"), "b.n_words", "b.n_same")


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without those that overlap an item; documents without id stay."""
    key = unused(docs, "_found")
    found = overlaps(spark, docs, items).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(found, F.col("doc_id").cast("long") == F.col(key), "left_anti")
