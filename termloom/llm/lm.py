"""Language-model scores from an Elias-Fano trie of unigrams, bigrams and trigrams, in shards.

Tokens are words between white space, A-Z lower-cased, and an end after each text; each text begins in a context of its own.
With c counting training texts, M = 200 and L = 20,
p(w | u v) = c(u v w) / (c(u v) + L) + L / (c(u v) + L) * p(w | v),
p(w | v) = c(v w) / (c(v) + M) + M / (c(v) + M) * p(w) and p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)); u v of a text's second token
are its beginning and first token, and its first token has p(w | v) alone.

The model grows with the corpus, so no process holds all of it:

1. Word counts give N, V and the *hot* words, which would fill an eighth of a shard by themselves; a second count of pairs of
   hot words gives the hot pairs.  These lists hold at most eight contexts a shard and order.
2. Texts are dealt into chunks, a table in buckets that is read twice without a shuffle.  A chunk sends each shard its distinct bigrams and, under them,
   its distinct trigrams, once, with their counts in training texts: one message for each chunk and shard, as a shuffle has one block.  The shard
   is that of the first word; a hot word's bigrams, and a hot pair's trigrams, are spread by their last word over as many shards as the
   count asks for.
3. A shard merges what the chunks sent into its part of the trie, in levels that are written to a file and mapped into memory: words
   (Elias-Fano over sorted hashes) with their counts (over running totals), and for bigrams and trigrams pointers to each node's successors, the
   successors' 32-bit hashes relative to their node (over node index and hash together), and an 8-bit code of each smoothed share.
   A chunk's n-grams are searched level by level among the successors of the node found before, and answered in the order they came, with a byte each.
   The file is the task's own: a lost task builds it again.
4. The chunk finds its tokens' codes by that order and sums log10 p over each text.

Words are known by 64-bit hashes, successors of a context by 32 bits: of a context with s distinct successors, an unseen word is taken for
one of them with probability s / 2**32.

Defined results: a null or empty text is one end; rows without doc_id are scored, never learnt from; repeated rows count and are scored as often as
they occur; with no training texts the counts are 0 and p(w) is uniform; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.shared import MOST_BUCKETS, bucketed, discard, give_back, small_batches, written
from termloom.llm.tokens import U, Words, blocks, byte_table, mix, spaces, text_buffer

#: weight of the shorter context after one and two words
MU = np.array([200.0, 20.0])
ADD, HOLD_OUT = 0.1, 10
#: bytes of text in a chunk and, about, behind a shard; a context is hot with so much of a shard's share, and with so many words at least
CHUNK_BYTES, HOT, LEAST_HOT = 10 << 20, 8, 1000
BEGIN, END = U(0x0123456789ABCDEF), U(0xFEDCBA9876543210)
#: codes of log10 shares: 0 is none, else evenly from LOWEST to 0
LOWEST, CODES = -8.0, 255


class EliasFano:
    """A non-decreasing sequence of 64-bit numbers: whole bytes of low bits, and the rest in unary, whose zeros tell where a high part's numbers stand."""

    def __init__(self, n: int, low_bytes: int, low: np.ndarray, high: np.ndarray) -> None:
        self.n, self.low_bytes, self.low, self.high = n, low_bytes, low, high
        # low parts of 1, 2 and 4 bytes are numbers as they stand
        self.low_numbers = low.reshape(-1).view(f"u{low_bytes}") if low_bytes in (1, 2, 4) else None

    @staticmethod
    def arrays(x: np.ndarray) -> dict[str, np.ndarray]:
        """The parts to be stored."""
        x = x.astype(np.uint64)
        n = len(x)
        top = int(x[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        k = min(7, -(-bits // 8))
        low = np.ascontiguousarray(x.view(np.uint8).reshape(n, 8)[:, :k]) if n else np.zeros((0, k), dtype=np.uint8)
        high = (x >> U(8 * k)).astype(np.int64)
        flags = np.zeros((int(high[-1]) if n else 0) + n + 1, dtype=np.uint8)
        flags[high + np.arange(n)] = 1
        packed = np.packbits(np.concatenate([flags, np.zeros(-len(flags) % 64, dtype=np.uint8)]), bitorder="little")
        return {"meta": np.array([n, k]), "low": low.reshape(-1), "high": packed}

    @staticmethod
    def of(parts: dict[str, np.ndarray]) -> EliasFano:
        n, k = (int(v) for v in parts["meta"])
        # plain views of mapped arrays, which are indexed faster
        return EliasFano(n, k, np.asarray(parts["low"]).reshape(n, k), np.asarray(parts["high"]).view(np.uint64))

    @functools.cached_property
    def buckets(self) -> np.ndarray:
        """How many numbers have a high part under each, and all: the unary part's zeros, selected once for all searches."""
        zeros = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little") == 0)
        return np.concatenate([[0], zeros - np.arange(len(zeros))])

    def lows(self, i: np.ndarray) -> np.ndarray:
        """The low parts at places i."""
        if self.low_numbers is not None:
            return self.low_numbers[i]
        wide = np.zeros((len(i), 8), dtype=np.uint8)
        wide[:, : self.low_bytes] = self.low[i]
        return wide.view(np.uint64).reshape(-1)

    def values(self, i: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The numbers at places i, their high parts being known."""
        return self.lows(i).astype(np.uint64) | (high.astype(np.uint64) << U(8 * self.low_bytes))

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the first number that is not under x, for each x, and whether it equals x. x as uint64."""
        if not self.n:
            return np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=bool)
        h = np.minimum(x >> U(8 * self.low_bytes), U(len(self.buckets) - 1)).astype(np.int64)
        begin, last = self.buckets[h], self.buckets[np.minimum(h + 1, len(self.buckets) - 1)]
        low = x & U((1 << 8 * self.low_bytes) - 1)
        # only searches that are not settled go on: most high parts have a number or two
        open_ = np.flatnonzero(begin < last)
        first, end, wanted = begin[open_], last[open_], low[open_]
        while len(open_):
            middle = (first + end) >> 1
            under = self.lows(middle) < wanted
            first, end = np.where(under, middle + 1, first), np.where(under, end, middle)
            more = first < end
            done = ~more
            begin[open_[done]] = first[done]
            open_, first, end, wanted = open_[more], first[more], end[more], wanted[more]
        there = begin < last
        return begin, there & (self.lows(np.minimum(begin, self.n - 1)) == low)

    def all(self) -> np.ndarray:
        """The sequence as int64."""
        flags = np.unpackbits(self.high.view(np.uint8), bitorder="little")
        places = np.flatnonzero(flags)[: self.n]
        return self.values(np.arange(self.n), places - np.arange(self.n)).view(np.int64)


def code_of(share: np.ndarray) -> np.ndarray:
    """8-bit codes of shares."""
    with np.errstate(divide="ignore"):
        at = np.rint((np.log10(share) - LOWEST) / -LOWEST * (CODES - 1)) + 1
    return np.where(share > 0, np.clip(at, 1, CODES), 0).astype(np.uint8)


SHARES = np.concatenate([[0.0], 10.0 ** (LOWEST + np.arange(CODES) * -LOWEST / (CODES - 1))])


class Trie:
    """A shard's words, bigrams and trigrams, in levels mapped from one file."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.parts: dict[str, dict[str, np.ndarray]] = {}

    def build(self, words: np.ndarray, counts: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Trie:
        """words sorted, with counts.  Each level: the node above and the 32-bit hash of each of its nodes in order, together as a key; their codes; their counts as contexts."""
        parts = {"words": EliasFano.arrays(words), "counts": EliasFano.arrays(np.concatenate([[0], np.cumsum(counts)]))}
        above = len(words)
        for k, (keys, codes, own) in enumerate(levels):
            sizes = np.bincount((keys >> U(32)).astype(np.int64), minlength=above)
            parts |= {f"pointers{k}": EliasFano.arrays(np.concatenate([[0], np.cumsum(sizes)])), f"successors{k}": EliasFano.arrays(keys), f"codes{k}": {"x": codes}, f"counts{k}": EliasFano.arrays(np.concatenate([[0], np.cumsum(own)]))}
            above = len(keys)
        with open(self.path, "wb") as f:
            table = []
            for part, arrays in parts.items():
                for name, x in arrays.items():
                    f.write(b"\0" * (-f.tell() % 8))
                    table.append((part, name, f.tell(), x.dtype, len(x)))
                    f.write(x.tobytes())
        for part, name, at, kind, n in table:
            self.parts.setdefault(part, {})[name] = np.memmap(self.path, dtype=kind, mode="r", offset=at, shape=(n,)) if n else np.zeros(0, dtype=kind)
        of = lambda name: EliasFano.of(self.parts[name])
        self.words, self.counts = of("words"), np.diff(of("counts").all())
        self.levels = [(of(f"successors{k}"), self.parts[f"codes{k}"]["x"], np.diff(of(f"counts{k}").all())) for k in range(len(levels))]
        return self

    @staticmethod
    def _at(x: np.ndarray, place: np.ndarray, there: np.ndarray) -> np.ndarray:
        """x at each place, 0 where nothing is there."""
        return np.where(there, x[np.minimum(place, len(x) - 1)], 0).astype(x.dtype) if len(x) else np.zeros(len(place), dtype=x.dtype)

    def ask(self, words: np.ndarray, below: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Counts of words (0: not there) and, for each level, the codes and counts of the nodes asked for.

        below: for each level how many nodes are asked for under each of the level above, and their 32-bit hashes.
        """
        place, there = self.words.successor(words)
        counts, out = self._at(self.counts, place, there), []
        for (sizes, hashes), (successors, codes, own) in zip(below, self.levels, strict=True):
            above, known = np.repeat(np.where(there, place, 0), sizes), np.repeat(there, sizes)
            place, equal = successors.successor((above.astype(np.uint64) << U(32)) | hashes.astype(np.uint64))
            there = known & equal
            out.append((self._at(codes, place, there), self._at(own, place, there)))
        return counts, out


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x for a in arrays for x in (len(a), a.dtype.itemsize))], dtype=np.int64)
    # bytes of equal weight together, which compresses better
    body = b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() if len(a) else b"" for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head.tobytes() + body)


def _unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    m = int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
    sizes = np.frombuffer(raw, dtype=np.int64, count=2 * m, offset=8).reshape(m, 2)
    at, out = 8 + 16 * m, []
    for n, width in sizes.tolist():
        x = np.frombuffer(raw, dtype=np.uint8, count=n * width, offset=at)
        kind = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[width]
        out.append(np.ascontiguousarray(x.reshape(width, n).T).reshape(-1).view(kind))
        at += n * width
    return out


def _narrow(x: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as they need."""
    top = int(x.max(initial=0))
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint64)


def pair_of(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of two words, of the second one by its first 32 bits."""
    return mix(first * U(0x9E3779B97F4A7C15) + last)


class Tokens:
    """The tokens of some texts: how many each text has and where they begin, their hashes and those of the words before them."""

    def __init__(self, texts: pa.ChunkedArray | pa.Array) -> None:
        table, sep = byte_table(401, fold=True), spaces()
        raw, offsets = text_buffer(texts)
        hs, ns = [], []
        for i, j in blocks(offsets):
            w = Words(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], sep)
            hs.append(w.hashes(table))
            ns.append(np.diff(w.first))
        one = np.concatenate(hs) if hs else np.zeros(0, dtype=np.uint64)
        self.n_tokens = (np.concatenate(ns) if ns else np.zeros(0, dtype=np.int64)) + 1
        ends = np.cumsum(self.n_tokens)
        self.begins = ends - self.n_tokens
        total = int(ends[-1]) if len(ends) else 0
        self.is_end = np.zeros(total, dtype=bool)
        self.is_end[ends - 1] = True
        self.word = np.empty(total, dtype=np.uint64)
        self.word[self.is_end] = END
        self.word[~self.is_end] = one
        self.before = np.empty(total, dtype=np.uint64)
        self.before[1:] = self.word[:-1]
        self.before[self.begins] = BEGIN


@dataclass(frozen=True)
class HotContexts:
    """Sorted hashes of hot contexts, their counts, and how many parts the n-grams of each are spread over."""

    contexts: np.ndarray
    counts: np.ndarray
    parts: np.ndarray

    @staticmethod
    def of(counts: dict[int, int], least: float) -> HotContexts:
        known = sorted(counts.items())
        n = np.array([c for _, c in known], dtype=np.int64)
        return HotContexts(np.array([h for h, _ in known], dtype=np.uint64), n, np.ceil(n / least).astype(np.uint64))

    def find(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where contexts stand here, and which of them do."""
        if not len(self.contexts):
            return np.zeros(len(contexts), dtype=np.int64), np.zeros(len(contexts), dtype=bool)
        at = np.minimum(np.searchsorted(self.contexts, contexts), len(self.contexts) - 1)
        return at, self.contexts[at] == contexts


class Chunk:
    """The n-grams of some texts: distinct bigrams by word before and word, distinct trigrams by bigram and word, and those of each token."""

    def __init__(self, texts: pa.ChunkedArray | pa.Array, train: np.ndarray, hot: HotContexts, shards: int) -> None:
        t = Tokens(texts)
        self.n_tokens, self.begins, self.is_end, n = t.n_tokens, t.begins, t.is_end, len(t.word)
        trained = np.repeat(train, self.n_tokens)
        low = t.word >> U(32)
        self.words, self.before = np.unique(t.before, return_inverse=True)
        del t
        keys, self.bigram = np.unique((self.before.astype(np.uint64) << U(32)) | low, return_inverse=True)
        self.bigrams, self.owner = (keys & U(0xFFFFFFFF)).astype(np.uint32), (keys >> U(32)).astype(np.int64)
        # a token's trigram is the bigram of the token before it, and itself; first tokens have none
        later = np.ones(n, dtype=bool)
        later[self.begins] = False
        self.later = np.flatnonzero(later)
        keys, self.trigram = np.unique((self.bigram[self.later - 1].astype(np.uint64) << U(32)) | low[self.later], return_inverse=True)
        self.trigrams, self.parent = (keys & U(0xFFFFFFFF)).astype(np.uint32), (keys >> U(32)).astype(np.int64)
        del keys, low, later
        self.counts = np.bincount(self.bigram[trained], minlength=len(self.bigrams)), np.bincount(self.trigram[trained[self.later]], minlength=len(self.trigrams))
        del trained
        first = self.words[self.owner]
        home = self._spread(first, first, self.bigrams, hot, shards)
        pair = pair_of(first, self.bigrams.astype(np.uint64))
        k, is_hot = hot.find(pair)
        of = home[self.parent]
        if is_hot.any():
            loose = is_hot[self.parent]
            of[loose] = self._spread(pair[self.parent[loose]], pair[self.parent[loose]], self.trigrams[loose], hot, shards)
        # what is sent: each bigram to its shard and, without its count, to those of its trigrams that are elsewhere
        m = max(len(self.bigrams), 1)
        away = of != home[self.parent]
        carried = np.unique(of[away] * m + self.parent[away])
        entries = np.concatenate([home * m + np.arange(len(home)), carried])
        at_home = np.concatenate([np.ones(len(home), dtype=bool), np.zeros(len(carried), dtype=bool)])
        order = np.argsort(entries, kind="stable")
        self.entries, self.at_home = entries[order], at_home[order]
        del entries, at_home, order, first, home, pair
        self.order = np.argsort(of, kind="stable")
        under = np.searchsorted(self.entries, of[self.order] * m + self.parent[self.order])
        self.below = np.bincount(under, minlength=len(self.entries))
        self.shard, self.entry = self.entries // m, self.entries % m

    @staticmethod
    def _spread(key: np.ndarray, context: np.ndarray, words: np.ndarray, hot: HotContexts, shards: int) -> np.ndarray:
        """The shards of contexts; of hot ones by the words that follow."""
        out = mix(key + U(0)) % U(shards)
        k, is_hot = hot.find(context)
        if is_hot.any():
            out[is_hot] = mix(key[is_hot] + mix(words[is_hot].astype(np.uint64)) % hot.parts[k[is_hot]] + U(1)) % U(shards)
        return out.astype(np.int64)

    def messages(self) -> Iterator[Message]:
        """What each shard is sent."""
        if not len(self.entry):
            return
        cut = np.flatnonzero(np.diff(self.shard)) + 1
        edges = np.concatenate([[0], cut, [len(self.shard)]])
        ends = np.concatenate([[0], np.cumsum(self.below)])
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            entry = self.entry[i:j]
            own = self.owner[entry]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            yield Message(int(self.shard[i]), own[first], np.diff(np.append(first, j - i)), entry, self.at_home[i:j], self.below[i:j], self.order[ends[i] : ends[j]])

    def packed(self, m: Message) -> bytes:
        """A message's hashes and counts."""
        n2, n3 = self.counts
        return _pack(self.words[m.word], _narrow(m.sizes), self.bigrams[m.bigram], _narrow(np.where(m.at_home, n2[m.bigram], 0)), _narrow(m.below), self.trigrams[m.trigram], _narrow(n3[m.trigram]))


@dataclass(frozen=True)
class Message:
    """Places in a chunk's lists: words, how many bigrams follow each, bigrams, which of them are counted here, how many trigrams follow each, trigrams."""

    shard: int
    word: np.ndarray
    sizes: np.ndarray
    bigram: np.ndarray
    at_home: np.ndarray
    below: np.ndarray
    trigram: np.ndarray


def merged(asked: list[list[np.ndarray]], hot: HotContexts) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Words, their counts, and the levels of a trie of what training texts hold of the messages."""
    together = lambda k, kind: np.concatenate([a[k].astype(kind) for a in asked])
    words, which = np.unique(together(0, np.uint64), return_inverse=True)
    keys, at = np.unique((np.repeat(which, together(1, np.int64)).astype(np.uint64) << U(32)) | together(2, np.uint64), return_inverse=True)
    n2 = np.bincount(at, weights=together(3, np.float64), minlength=len(keys)).astype(np.int64)
    key3 = (np.repeat(at, together(4, np.int64)).astype(np.uint64) << U(32)) | together(5, np.uint64)
    del which, at
    n3 = together(6, np.int64)
    key3, n3 = key3[n3 > 0], n3[n3 > 0]
    order = np.argsort(key3)
    key3, n3 = key3[order], n3[order]
    first = np.flatnonzero(np.concatenate([[True], key3[1:] != key3[:-1]])) if len(key3) else np.zeros(0, dtype=np.int64)
    key3, n3 = key3[first], np.add.reduceat(n3, first) if len(first) else n3
    del order, first
    parent = (key3 >> U(32)).astype(np.int64)
    after = np.bincount(parent, weights=n3, minlength=len(keys)).astype(np.int64)
    # bigrams of other texts alone are not kept; those carried here for their trigrams are
    kept = (n2 > 0) | (after > 0)
    place = np.cumsum(kept) - 1
    keys, n2, after = keys[kept], n2[kept], after[kept]
    key3 = (place[parent].astype(np.uint64) << U(32)) | (key3 & U(0xFFFFFFFF))
    parent = place[parent]
    owner = (keys >> U(32)).astype(np.int64)
    counts = np.bincount(owner, weights=n2, minlength=len(words)).astype(np.int64)
    k, is_hot = hot.find(words)
    counts[is_hot] = hot.counts[k[is_hot]]
    k, is_hot = hot.find(pair_of(words[owner], keys & U(0xFFFFFFFF)))
    after[is_hot] = hot.counts[k[is_hot]]
    two = code_of(n2 / (counts[owner] + MU[0]))
    three = code_of(n3 / (after[parent] + MU[1]))
    return words, counts, [(keys, two, after), (key3, three, np.zeros(len(key3), dtype=np.int64))]


def counted(docs: DataFrame) -> DataFrame:
    """(hash, n): how often each word occurs in training texts; docs (text, train)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sep = byte_table(401, fold=True), spaces()
        for b in batches:
            raw, offsets = text_buffer(b.column("text"))
            train = np.asarray(b.column("train"))
            hs = []
            for i, j in blocks(offsets):
                w = Words(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], sep)
                hs.append(w.hashes(table)[train[i:j][w.row]])
            if not hs:
                continue
            h, n = np.unique(np.concatenate([*hs, np.full(int(train.sum()), END)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["hash", "n"])

    return docs.select("text", "train").mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def paired(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """(hash, n): how often each pair of two of the given words is followed in training texts; docs (text, train)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = HotContexts(words, words, words)
        for b in batches:
            t = Tokens(b.column("text").filter(b.column("train")))
            both = known.find(t.before)[1] & known.find(t.word)[1] & ~t.is_end
            h, n = np.unique(pair_of(t.before[both], t.word[both] >> U(32)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["hash", "n"])

    return docs.select("text", "train").mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def hot_contexts(rows: DataFrame, words: DataFrame, n_train: int, n_ends: int, shards: int) -> HotContexts:
    """The words and pairs with over 1 / HOT of a shard's share: at most HOT * shards of each."""
    least = max(LEAST_HOT, n_train / (HOT * shards))
    unsigned = lambda h: int(np.int64(h).view(np.uint64))
    hot = {unsigned(r["hash"]): r["n"] for r in words.filter(F.col("n") > least).collect()}
    hot.pop(int(END), None)  # nothing follows an end
    if n_ends > least:
        hot[int(BEGIN)] = n_ends
    if hot:
        pairs = paired(rows, np.array(sorted(hot), dtype=np.uint64)).filter(F.col("n") > least)
        hot |= {unsigned(r["hash"]): r["n"] for r in pairs.collect()}
    return HotContexts.of(hot, least)


def score(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of docs (doc_id, text)."""
    small_batches(spark)
    kind = dict(docs.dtypes)["doc_id"]
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % HOLD_OUT == 0, F.lit(False))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held.alias("held_out"), (F.col("doc_id").isNotNull() & ~held).alias("train"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = int(size // CHUNK_BYTES) + 1
    words = written(spark, counted(rows), "words")
    totals = words.agg(F.count("*").alias("v"), F.sum("n").alias("n"), F.sum(F.when(F.col("hash") == int(END.view(np.int64)), F.col("n"))).alias("ends")).first()
    n_train, n_distinct, n_ends = int(totals["n"] or 0), int(totals["v"]), int(totals["ends"] or 0)
    hot = hot_contexts(rows, words, n_train, n_ends, n_parts)
    discard(spark, words)
    # rows are dealt by their place, so that repeated rows spread; the table fixes who is where
    chunk = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_parts)).cast("int")
    dealt = bucketed(spark, rows.withColumn("chunk", chunk), "dealt", "chunk", n_parts)

    def send(key: tuple, t: pa.Table) -> pa.Table:
        c = Chunk(t["text"], np.asarray(t["train"]), hot, n_parts)
        out: list[list] = [[], []]
        for m in c.messages():
            out[0].append(m.shard)
            out[1].append(c.packed(m))
        del c
        give_back()
        return pa.table({"shard": pa.array(out[0], pa.int32()), "chunk": pa.array([key[0].as_py()] * len(out[0]), pa.int32()), "asked": pa.array(out[1], pa.binary())})

    def serve(_: tuple, t: pa.Table) -> pa.Table:
        asked = [_unpack(x.as_py()) for x in t["asked"]]
        with tempfile.TemporaryDirectory() as folder:
            trie = Trie(os.path.join(folder, "levels")).build(*merged(asked, hot))
            answers = []
            for words, sizes, two, _, below, three, _ in asked:
                counts, ((codes2, after), (codes3, _)) = trie.ask(words, [(sizes.astype(np.int64), two), (below.astype(np.int64), three)])
                answers.append(_pack(_narrow(counts), codes2, _narrow(after), codes3))
            del trie
        del asked
        give_back()
        return pa.table({"chunk": t["chunk"], "shard": t["shard"], "told": pa.array(answers, pa.binary())})

    def sum_up(key: tuple, t: pa.Table, told: pa.Table) -> pa.Table:
        c = Chunk(t["text"], np.asarray(t["train"]), hot, n_parts)
        answers = dict(zip(told["shard"].to_pylist(), told["told"].to_pylist(), strict=True))
        two, three = np.zeros(len(c.bigrams), dtype=np.uint8), np.zeros(len(c.trigrams), dtype=np.uint8)
        counts, after = np.zeros(len(c.words), dtype=np.int64), np.zeros(len(c.bigrams), dtype=np.int64)
        for m in c.messages():
            counts[m.word], codes, own, three[m.trigram] = _unpack(answers[m.shard])
            two[m.bigram[m.at_home]], after[m.bigram[m.at_home]] = codes[m.at_home], own[m.at_home]
        base = (np.append(counts, n_ends) + ADD) / (n_train + ADD * (n_distinct + 1))
        # a token is what stands before the next one; an end has the last place
        token = np.append(c.before[1:], 0)
        token[c.is_end] = len(counts)
        known = np.append(counts, n_ends)[token] > 0
        p1 = base[token]
        p = SHARES[two[c.bigram]] + MU[0] / (counts[c.before] + MU[0]) * p1
        follows = after[c.bigram[c.later - 1]]
        p[c.later] = SHARES[three[c.trigram]] + MU[1] / (follows + MU[1]) * p[c.later]
        by = lambda x: np.add.reduceat(x, c.begins) if len(x) else np.zeros(0)
        out = pa.table(
            {
                "doc_id": t["doc_id"],
                "held_out": t["held_out"],
                "n_tokens": pa.array(c.n_tokens.astype(np.int64)),
                "n_known": pa.array(by(known.astype(np.int64)).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(c.n_tokens), n_train, dtype=np.int64)),
                "base_score": pa.array(by(np.log10(p1))),
                "score": pa.array(by(np.log10(p))),
            }
        )
        del c, answers
        give_back()
        return out

    asked = dealt.groupBy("chunk").applyInArrow(send, "shard int, chunk int, asked binary")
    told = bucketed(spark, asked.repartition(min(MOST_BUCKETS, n_parts), "shard").groupBy("shard").applyInArrow(serve, "chunk int, shard int, told binary"), "told", "chunk", n_parts)
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(sum_up, schema)
