"""Substring deduplication over a log-structured fingerprint index.

A window is 50 consecutive words of one document; words of it go if the same 50 words also begin in a document with a smaller
id.  Words are separated by white space and compared unchanged.  Documents come in batches of rising ids.

* **Fingerprints.** Of each 35 consecutive 16-word hashes the smallest is an *anchor*.  Any 50-word window holds
  35 of them, so equal windows hold equal anchors: about one word in 18 needs an entry, and nothing is lost.
* **Runs.** A batch's anchors become an immutable run, bucketed and sorted by hash: (hash, smallest and largest document
  that has it).  It is merge-joined with the runs before it, bucket by bucket and without a shuffle; anchors that two documents have are *shared*.
* **Verification.** Only windows around shared anchors are looked at.  They become a second run, bucketed and sorted by a 64-bit
  window hash: (hash, a second, independent hash of 32 bits, smallest document that has the window).  The batch's windows are merge-joined with
  this run and all runs of windows before it.  Within a batch of rows, all but the smallest document's copy of a window are settled on
  the spot, so a passage that a third of all documents hold never gathers in one task.
* **History.** A text is read again only if an anchor that it alone had turns up in a later batch, once for each such batch; its windows join the
  batch's run.  All other windows that matter are in the runs already.
* **Compaction.** `fan_in` runs of one level are merged into one of the next, which keeps the smallest document of each entry, and are deleted.

Shared anchors reach the scan as a Bloom filter of bounded size: its false positives only add windows that
verification turns down, so results never depend on it.

Defined results: a null or empty text has no words; a row without doc_id is kept unchanged and matches nothing; rows that repeat a doc_id are one
document, so they don't remove each other's words; texts of under 50 words stay; an empty table gives no rows; a batch whose ids are
not above those before it is refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.filters import bloom, held
from termloom.llm.shared import bucketed, buckets_for, discard, small_batches, written
from termloom.llm.tokens import BLOCK, U, Words, blocks, byte_table, mix, spaces, text_buffer, words_of

WIDTH, GRAM = 50, 16
#: batches that a table is dealt into, runs of one level that are merged
BATCHES, FAN_IN = 3, 2


def sliding_least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each n consecutive values."""
    out, have = x, 1
    while 2 * have <= n:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(x) - n + 1], out[n - have :][: len(x) - n + 1]) if have < n else out


def anchors(w: Words, hashes: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices of the words that begin a window, each window's anchor hash, and the anchors' own row and hash once a run."""
    none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    if len(hashes) < width:
        return none
    up = np.uint64
    at, gram = w.windows(hashes, min(GRAM, width))
    full = np.full(len(hashes), np.iinfo(up).max, dtype=up)
    full[at] = gram
    span = width - min(GRAM, width) + 1
    least = sliding_least(full, span)
    begins = np.flatnonzero(w.row[: len(hashes) - width + 1] == w.row[width - 1 :])
    own = least[begins]
    new = np.ones(len(begins), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (w.row[begins[1:]] != w.row[begins[:-1]])
    return begins, own, np.flatnonzero(new)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """doc_ids as int64 and where they are present."""
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), ~np.asarray(column.is_null())


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(hash, least, most) of the documents' anchors; hashes that recur in a batch of rows are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sep = byte_table(501), spaces()
        for b in batches:
            ids, there = _ids(b.column("doc_id"))
            hs, ds = [], []
            for i, _, w in words_of(b.column("text"), sep):
                begins, own, new = anchors(w, w.hashes(table))
                rows = w.row[begins[new]] + i
                keep = there[rows]
                hs.append(own[new][keep])
                ds.append(ids[rows[keep]])
            if not hs or not sum(map(len, hs)):
                continue
            h, d = np.concatenate(hs), np.concatenate(ds)
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            last = np.concatenate([first[1:], [len(h)]]) - 1
            yield pa.RecordBatch.from_arrays([_signed(h[first]), pa.array(d[first]), pa.array(d[last])], ["hash", "least", "most"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "hash long, least long, most long")


def window_rows(docs: DataFrame, sent, bits: int, width: int = WIDTH) -> DataFrame:
    """Windows around shared anchors: (h, v, doc_id, crc, at, stop).

    stop is null for windows that must still meet other rows'; else words at to stop of the document go, because a smaller
    document of the same batch of rows has the windows that cover them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(sent.value, dtype=np.uint8)
        table, other, sep = byte_table(501), byte_table(502), spaces()
        for b in batches:
            ids, there = _ids(b.column("doc_id"))
            crcs = b.column("crc").to_numpy(zero_copy_only=False).astype(np.int64) if b.num_rows else np.zeros(0, dtype=np.int64)
            hs, vs, rs, ps = [], [], [], []
            for i, _, w in words_of(b.column("text"), sep):
                one = w.hashes(table)
                begins, own, _ = anchors(w, one, width)
                if not len(begins):
                    continue
                keep = held(flags, bits, own) & there[w.row[begins] + i]
                if not keep.any():
                    continue
                at = begins[keep]
                _, h = w.windows(one, width)
                _, v = w.windows(w.hashes(other), width)
                hs.append(h[keep])
                vs.append(v[keep])
                rs.append(w.row[at] + i)
                ps.append(at - w.first[w.row[at]])
            if not hs:
                continue
            h, v, r, p = map(np.concatenate, (hs, vs, rs, ps))
            d = ids[r]
            order = np.lexsort((p, d, v, h))
            h, v, r, p, d = h[order], v[order], r[order], p[order], d[order]
            head = np.concatenate([[True], (h[1:] != h[:-1]) | (v[1:] != v[:-1])])
            least = d[np.flatnonzero(head)][np.cumsum(head) - 1]
            gone = d > least
            # settled here: as covered stretches of words
            s = np.flatnonzero(gone)
            s = s[np.lexsort((p[s], r[s]))]
            if len(s):
                new = np.concatenate([[True], (r[s][1:] != r[s][:-1]) | (p[s][1:] > p[s][:-1] + width)])
                f = np.flatnonzero(new)
                l = np.concatenate([f[1:], [len(s)]]) - 1  # noqa: E741
                apart = mix(d[s][f].view(np.uint64) * U(0x9E3779B97F4A7C15) + p[s][f].view(np.uint64))
                yield pa.RecordBatch.from_arrays([_signed(apart), pa.nulls(len(f), pa.int32()), pa.array(d[s][f]), pa.array(crcs[r[s][f]]), pa.array(p[s][f].astype(np.int32)), pa.array((p[s][l] + width).astype(np.int32))], ["h", "v", "doc_id", "crc", "at", "stop"])
            # to meet the rest: a document's repeats of one window are one row each
            o = np.flatnonzero(~gone)
            yield pa.RecordBatch.from_arrays([_signed(h[o]), pa.array(v[o].astype(np.uint32).view(np.int32)), pa.array(d[o]), pa.array(crcs[r[o]]), pa.array(p[o].astype(np.int32)), pa.nulls(len(o), pa.int32())], ["h", "v", "doc_id", "crc", "at", "stop"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.crc32(F.coalesce("text", F.lit(""))).alias("crc"))
    return rows.mapInArrow(run, "h long, v int, doc_id long, crc long, at int, stop int")


@dataclass
class Run:
    """An immutable sorted run and how often it was merged."""

    rows: DataFrame
    level: int


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


class FingerprintIndex:
    """Sorted runs of anchors and of windows in the shared folder; `add` takes batches in the order of their doc_ids."""

    def __init__(self, spark: SparkSession, width: int = WIDTH, fan_in: int = FAN_IN, buckets: int | None = None) -> None:
        self.spark, self.width, self.fan_in, self.buckets = spark, width, fan_in, buckets
        self.anchors: list[Run] = []
        self.windows: list[Run] = []
        self.most: int | None = None

    def _anchors_merged(self, rows: DataFrame) -> DataFrame:
        merged = rows.groupBy("hash").agg(F.min("least").alias("least"), F.max("most").alias("most"))
        return bucketed(self.spark, merged, "anchors", "hash", self.buckets)

    def _windows_merged(self, rows: DataFrame) -> DataFrame:
        merged = rows.groupBy("h", "v").agg(F.min("doc_id").alias("doc_id"))
        return bucketed(self.spark, merged, "windows", "h", self.buckets)

    def _shared(self, run: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(hash) of the run's anchors that two documents have, and (doc_id) of the earlier ones that had one of these alone."""
        alone = run.filter("least < most").select("hash")
        if not self.anchors:
            return alone, run.select(F.col("least").alias("doc_id")).limit(0)
        past = [r.rows.select("hash", "least", "most").join(run.select("hash"), "hash") for r in self.anchors]
        seen = written(self.spark, _all(past).groupBy("hash").agg(F.min("least").alias("least"), F.max("most").alias("most")), "seen")
        return alone.unionByName(seen.select("hash")).distinct(), seen.filter("least = most").select(F.col("least").alias("doc_id")).distinct()

    def add(self, docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
        """(doc_id, crc, at, stop): stretches of words of docs (doc_id, text) that repeat smaller documents of docs or of earlier batches.

        history holds the texts of earlier batches, if there were any; crc tells apart rows of one doc_id.
        """
        spark = self.spark
        run = self._anchors_merged(anchor_rows(docs))
        ends = run.agg(F.min("least").alias("low"), F.max("most").alias("high")).first()
        if self.most is not None and ends["low"] is not None and ends["low"] <= self.most:
            raise ValueError(f"batches must come in the order of their ids: {ends['low']} after {self.most}")
        shared, again = self._shared(run)
        shared = written(spark, shared, "shared")
        flags, bits = bloom(spark, shared)
        sent = spark.sparkContext.broadcast(flags.tobytes())
        rows = bucketed(spark, window_rows(docs, sent, bits, self.width), "window_rows", "h", self.buckets)
        open_ = rows.filter("stop is null")
        known = open_.select("h", "v", "doc_id")
        if history is not None and self.anchors:
            texts = history.select(F.col("doc_id").cast("long"), "text").join(again, "doc_id", "left_semi")
            known = known.unionByName(window_rows(texts, sent, bits, self.width).select("h", "v", "doc_id"))
        self.windows.append(Run(self._windows_merged(known), 0))
        self.anchors.append(Run(run, 0))
        self.most = max(x for x in (self.most, ends["high"]) if x is not None) if (self.most, ends["high"]) != (None, None) else None
        found = [rows.filter("stop is not null")]
        for r in self.windows:
            past = r.rows.select(F.col("h").alias("_h"), F.col("v").alias("_v"), F.col("doc_id").alias("_least"))
            # h alone is the key that both sides are bucketed by, so the second hash is compared as a range
            same = (F.col("h") == F.col("_h")) & F.col("v").between(F.col("_v"), F.col("_v")) & (F.col("_least") < F.col("doc_id"))
            found.append(open_.join(past, same, "left_semi"))
        spans = written(spark, _all(found).select("doc_id", "crc", "at", F.coalesce("stop", F.col("at") + self.width).alias("stop")), "spans")
        discard(spark, rows, shared)
        return spans

    def compact(self) -> None:
        """Merges runs of one level, once there are fan_in of them, and deletes them."""
        self.anchors = self._compacted(self.anchors, self._anchors_merged)
        self.windows = self._compacted(self.windows, self._windows_merged)

    def _compacted(self, runs: list[Run], merge) -> list[Run]:
        levels = [r.level for r in runs]
        for level in sorted(set(levels)):
            own = [r for r in runs if r.level == level]
            if len(own) >= self.fan_in:
                made = Run(merge(_all([r.rows for r in own])), level + 1)
                discard(self.spark, *(r.rows for r in own))
                return self._compacted([*(r for r in runs if r.level != level), made], merge)
        return runs

    def drop(self) -> None:
        """Deletes all runs."""
        discard(self.spark, *(r.rows for r in (*self.anchors, *self.windows)))
        self.anchors, self.windows = [], []


def batches_of(docs: DataFrame, n: int) -> list[tuple[DataFrame, DataFrame]]:
    """(batch, all before it): docs cut by doc_id into n batches of about as many rows; rows without id are in none."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    found = ids.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 1000).alias("c")).first()["c"] if n > 1 else []
    cuts = sorted(set(found or []))
    own = F.col("doc_id")
    out = []
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        above, upto = (own > low) if low is not None else F.lit(True), (own <= high) if high is not None else F.lit(True)
        out.append((ids.filter(above & upto), ids.filter(own <= low) if low is not None else ids.limit(0)))
    return out


def covered(spark: SparkSession, docs: DataFrame, width: int = WIDTH, batches: int = BATCHES) -> DataFrame:
    """(doc_id, crc, at, stop): stretches of words that repeat smaller documents of docs, which go through an index batch by batch."""
    small_batches(spark)
    index, spans = FingerprintIndex(spark, width, buckets=buckets_for(docs)), []
    own = batches_of(docs, batches)
    for k, (batch, before) in enumerate(own):
        spans.append(index.add(batch, before))
        if k < len(own) - 1:
            index.compact()
    index.drop()
    return _all(spans)


def _kept(words: Words, row: int, spans: np.ndarray, data: bytes) -> tuple[int, int, bytes]:
    """A row's number of words, number removed and kept words joined by one space."""
    a, b = int(words.first[row]), int(words.first[row + 1])
    n = b - a
    if len(spans):
        edge = np.zeros(n + 1, dtype=np.int64)
        np.add.at(edge, spans[:, 0], 1)
        np.add.at(edge, np.minimum(spans[:, 1], n), -1)
        keep = np.cumsum(edge[:-1]) == 0
        at = a + np.flatnonzero(keep)
    else:
        at = np.arange(a, b)
    return n, n - len(at), b" ".join([data[s:e] for s, e in zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)])


def prune(spark: SparkSession, docs: DataFrame, digest: bool = False, spans: DataFrame | None = None) -> DataFrame:
    """docs with n_words and n_removed, and with the kept words as text (texts that lose nothing stay as they are).

    digest: the kept words' SHA-256 as kept_sha256 instead, of texts that lose nothing too.  spans: what an index said of docs,
    batch by batch; else docs go through one of their own.
    """
    packed = F.shiftleft(F.col("at").cast("long"), 32) + F.col("stop")
    spans = covered(spark, docs) if spans is None else spans
    spans = spans.groupBy(F.col("doc_id").alias("_doc"), F.col("crc").alias("_crc")).agg(F.collect_list(packed).alias("_spans"))
    named = docs if not digest else docs.select("doc_id", "text")
    kept = [c for c in named.columns if c != "text" and c not in ("n_words", "n_removed")]
    # the columns under names that nothing here uses, so that none clashes
    aside = {c: f"_c{k}" for k, c in enumerate(kept)}
    text = F.col("_text")
    rows = named.select(*(F.col(f"`{c}`").alias(a) for c, a in aside.items()), F.col("text").alias("_text"))
    rows = rows.join(spans, (F.col(aside["doc_id"]).cast("long") == F.col("_doc")) & (F.crc32(F.coalesce(text, F.lit(""))) == F.col("_crc")), "left").drop("_doc", "_crc")
    last = "kept_sha256" if digest else "text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sep = spaces()
        for b in batches:
            raw, offsets = text_buffer(b.column("_text"))
            lists = b.column("_spans")
            packed = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            n_words, n_removed, texts = [], [], []
            for i, j in blocks(offsets, BLOCK):
                part = raw[offsets[i] : offsets[j]]
                w, data = Words(part, offsets[i : j + 1] - offsets[i], sep), part.tobytes()
                for r in range(j - i):
                    own_spans = packed[ends[i + r - 1] if i + r else 0 : ends[i + r]]
                    at = np.stack([own_spans >> 32, own_spans & 0xFFFFFFFF], axis=1)
                    if not digest and not len(at):
                        n_words.append(int(w.first[r + 1] - w.first[r]))
                        n_removed.append(0)
                        texts.append(None)
                        continue
                    n, gone, text = _kept(w, r, at, data)
                    n_words.append(n)
                    n_removed.append(gone)
                    texts.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
            new = pa.array(texts, pa.string())
            if not digest:
                was = b.column("_text")
                new = pa.compute.if_else(pa.array(np.array(n_removed) > 0), new, was.cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*(b.column(a) for a in aside.values()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), new], [*aside.values(), "n_words", "n_removed", last])

    types = [f.dataType.simpleString() for f in rows.select(*aside.values()).schema.fields]
    schema = ", ".join([*(f"{a} {t}" for a, t in zip(aside.values(), types, strict=True)), "n_words long", "n_removed long", f"{last} string"])
    out = rows.mapInArrow(run, schema)
    return out.select(*(F.col(a).alias(c) for c, a in aside.items()), "n_words", "n_removed", last)
