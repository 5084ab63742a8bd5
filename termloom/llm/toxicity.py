"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model, a linear classifier.

1. **Voters.** Fixed insult words, patterns (shouting, exclamations, direct address) and stems learnt from labelled rows:
   beginnings of 4 to 9 bytes of a word that toxic training texts hold and clean ones lack.  Each fires or abstains.
2. **Label model.** Expectation maximisation over the votes estimates how often each voter fires in either class, and the
   correlations of voters within a class; votes that say the same thing are counted down by them.  A known label of a
   training row is one more voter with a fixed accuracy.
3. **Classifier.** Ridge logistic regression on the votes and their density is trained on the posterior labels, then scores every
   whole text with array operations.

The model is fitted on a bounded sample, `sample` texts each of toxic, clean and unlabelled training rows in the order of a hash of
their id, one text an id, and has MOST_STEMS stems at most, those that most toxic texts hold; scoring covers all rows.  Without labels the fixed
lexicon's prior accuracies stand.

Defined results: a null or empty text gets the score of a text without votes; rows without doc_id are scored, never learnt from; repeated
rows repeat; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.shared import small_batches
from termloom.llm.tokens import _BYTES, U, Words, blocks, byte_table, mix, non_alnum, text_buffer, words_of

#: English insults, a voter each.
LEXICON = (
    "bastard", "clown", "crap", "cretin", "degenerate", "despicable", "disgusting", "dumb", "dumbass", "filth", "fool",
    "freak", "garbage", "hate", "idiot", "imbecile", "loser", "lunatic", "maggot", "moron", "nasty", "parasite",
    "pathetic", "pig", "repulsive", "retard", "rubbish", "scum", "shut", "stupid", "subhuman", "trash", "ugly", "vermin",
    "vile", "worthless",
)
STEM_LENGTHS = (4, 5, 6, 7, 8, 9)
PATTERNS = ("shouting", "exclamations", "censored", "no_votes")
#: rows of each kind to learn from, stems at most, evidence that a stem needs: toxic texts, share of toxic among its texts, log-likelihood ratio
SAMPLE, MOST_STEMS, STEM_TEXTS, STEM_SHARE, STEM_EVIDENCE = 8000, 240, 4, 0.9, 12.0
THRESHOLD = 0.7


class Prefixes:
    """Words of a run of rows with the hashes of their beginnings and of themselves; A-Z lower-cased."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray) -> None:
        self.words = w = Words(raw, offsets, non_alnum())
        n = len(raw)
        up, self.down = _BYTES.get(n + 1)
        self.total = np.empty(n + 1, dtype=np.uint64)
        self.total[0] = 0
        np.cumsum(byte_table(901, fold=True)[raw] * up[:n], out=self.total[1:])
        self.size = w.ends - w.starts

    def of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the words of at least so many bytes, and the hashes of those bytes; 0: all words, whole."""
        if not length:
            at = np.arange(len(self.size))
            end = self.words.ends
        else:
            at = np.flatnonzero(self.size >= length)
            end = self.words.starts[at] + length
        s = self.words.starts[at]
        return at, mix((self.total[end] - self.total[s]) * self.down[s] + U(length * 2 + 1))


def word_hash(word: str) -> int:
    """The hash of a whole word."""
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(Prefixes(raw, np.array([0, len(raw)])).of(0)[1][0])


def stem_counts(sample: DataFrame) -> DataFrame:
    """(length, hash, parent, toxic, clean): how many distinct texts of each label hold a word that begins so. sample: (text, toxic)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = text_buffer(b.column("text"))
            label = b.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            out: list[list[np.ndarray]] = [[], [], [], []]
            for i, j in blocks(offsets):
                p = Prefixes(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                for length in STEM_LENGTHS:
                    at, h = p.of(length)
                    if not len(at):
                        continue
                    _, first = np.unique(mix(h + p.words.row[at].astype(np.uint64)), return_index=True)
                    s = p.words.starts[at[first]]
                    parent = mix((p.total[s + length - 1] - p.total[s]) * p.down[s] + U(length * 2 - 1))
                    for x, y in zip(out, (np.full(len(first), length), h[first], parent, label[p.words.row[at[first]] + i]), strict=True):
                        x.append(y)
            if not out[0]:
                continue
            length, h, parent, toxic = map(np.concatenate, out)
            _, first, which = np.unique(h, return_index=True, return_inverse=True)
            t = np.bincount(which, weights=toxic).astype(np.int64)
            n = np.bincount(which)
            yield pa.RecordBatch.from_arrays([pa.array(length[first]), pa.array(h[first].view(np.int64)), pa.array(parent[first].view(np.int64)), pa.array(t), pa.array(n - t)], ["length", "hash", "parent", "toxic", "clean"])

    rows = sample.select("text", F.col("toxic").cast("int")).mapInArrow(run, "length long, hash long, parent long, toxic long, clean long")
    return rows.groupBy("length", "hash", "parent").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_stems(counts: DataFrame, n_toxic: int, n_clean: int) -> np.ndarray:
    """(length, hash) of the stems with enough evidence, the shortest of a family only."""
    share = F.col("toxic") / (F.col("toxic") + F.col("clean") + 0.5)
    base = n_toxic / max(1, n_toxic + n_clean)
    evidence = 2 * F.col("toxic") * F.log(share / base)
    # as many stems are tried, some look like a sign by chance: by Bonferroni's rule the evidence must grow with their logarithm
    tried = counts.filter("toxic + clean >= 2").count()
    good = counts.filter((F.col("toxic") >= STEM_TEXTS) & (share >= STEM_SHARE * F.lit(1.0) * (1 - 0.5 / (F.col("toxic") + 1))) & (evidence >= max(STEM_EVIDENCE, 2 * float(np.log(max(1, tried))))))
    found = good.orderBy(F.desc("toxic"), "length", "hash").limit(8 * MOST_STEMS).toPandas()
    chosen, inside = [], set()
    for length in STEM_LENGTHS:
        for r in found[found["length"] == length].itertuples():
            if r.parent in inside:
                inside.add(r.hash)
            else:
                inside.add(r.hash)
                chosen.append((r.toxic, r.length, r.hash))
    chosen.sort(key=lambda x: (-x[0], x[1], x[2]))
    return np.array([(b, c) for _, b, c in chosen[:MOST_STEMS]], dtype=np.int64).reshape(-1, 2)


@dataclass(frozen=True)
class Voters:
    """The lexicon's and the stems' hashes by length (0: whole words); patterns come after them."""

    by_length: dict[int, tuple[np.ndarray, np.ndarray]]
    n: int

    @staticmethod
    def of(stems: np.ndarray) -> Voters:
        by: dict[int, list[tuple[int, int]]] = {0: [(word_hash(w), i) for i, w in enumerate(LEXICON)]}
        for i, (length, h) in enumerate(stems):
            by.setdefault(int(length), []).append((int(np.int64(h).view(np.uint64)), len(LEXICON) + i))
        packed = {k: (np.array([x for x, _ in sorted(v)], dtype=np.uint64), np.array([i for _, i in sorted(v)])) for k, v in by.items()}
        return Voters(packed, len(LEXICON) + len(stems) + len(PATTERNS))

    def votes(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Counts of each voter's hits in each row, and the number of words in the last column."""
        p = Prefixes(raw, offsets)
        n = len(offsets) - 1
        out = np.zeros((n, self.n + 1), dtype=np.float32)
        for length, (hashes, index) in self.by_length.items():
            at, h = p.of(length)
            if not len(at):
                continue
            k = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = np.flatnonzero(hashes[k] == h)
            np.add.at(out, (p.words.row[at[hit]], index[k[hit]]), 1)
        words = np.diff(p.words.first)
        total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
        upper, letters = total((raw >= 65) & (raw <= 90)), total(((raw | 32) >= 97) & ((raw | 32) <= 122))
        star = total(raw == 42)
        base = self.n - len(PATTERNS)
        out[:, base] = (upper > 0.5 * letters) & (letters > 20)
        out[:, base + 1] = total(raw == 33) > 0.05 * words + 2
        out[:, base + 2] = star > 0.05 * words + 2
        out[:, base + 3] = (out[:, :base] > 0).sum(axis=1) == 0
        out[:, -1] = words
        return out


def vote_rows(docs: DataFrame, voters: Voters) -> DataFrame:
    """(known, votes) of a sample; known: 1 toxic, 0 clean, -1 not known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = text_buffer(b.column("text"))
            for i, j in blocks(offsets):
                v = voters.votes(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays([b.column("known").slice(i, j - i), pa.array([x.tobytes() for x in v], pa.binary())], ["known", "votes"])

    return docs.select(F.col("known").cast("int"), "text").mapInArrow(run, "known int, votes binary")


def label_model(fired: np.ndarray, known: np.ndarray, rounds: int = 12, trust: float = 0.98) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Posterior probabilities of toxicity, and the voters' firing rates by class and discounts for correlation.

    fired: rows by voters, 0 or 1; known: 1, 0 or -1 by row; trust: accuracy of a known label.  A voter that abstains says
    nothing; that none fires is a voter of its own.
    """
    n, m = fired.shape
    clean_voter = np.zeros(m, dtype=bool)
    clean_voter[-1] = True
    a = np.where(clean_voter, 0.1, 0.15)
    b = np.where(clean_voter, 0.95, 0.01)
    a[-2:-1], b[-2:-1] = 0.05, 0.04
    prior, discount = 0.1, np.ones(m)
    label = np.where(known == 1, np.log(trust / (1 - trust)), np.where(known == 0, -np.log(trust / (1 - trust)), 0.0))
    p = np.zeros(n)
    for _ in range(rounds):
        score = np.log(prior / (1 - prior)) + label + fired @ (discount * np.log(a / b))
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        up, down = p.sum() + 1e-9, (1 - p).sum() + 1e-9
        a = np.clip((p @ fired + 0.5) / (up + 1.5), 1e-4, 0.9999)
        b = np.clip(((1 - p) @ fired + 0.05) / (down + 1.5), 1e-5, 0.9999)
        prior = float(np.clip(up / n, 0.005, 0.6))
        # correlations within the classes, by the posterior
        joint = np.zeros((m, m))
        for w, rate, size in ((p, a, up), (1 - p, b, down)):
            cov = (fired * w[:, None]).T @ fired / size - np.outer(rate, rate)
            sd = np.sqrt(np.clip(rate * (1 - rate), 1e-6, None))
            joint += np.clip(cov / np.outer(sd, sd), 0, 1) * (size / n)
        np.fill_diagonal(joint, 0)
        discount = 1 / (1 + np.where(joint > 0.1, joint, 0).sum(axis=1))
    return p, {"toxic": a, "clean": b, "discount": discount}


def features(votes: np.ndarray) -> np.ndarray:
    """What the classifier sees: each voter fired or not, how many, and how densely."""
    hits = votes[:, : -1 - len(PATTERNS)]
    fired = votes[:, :-1] > 0
    total = hits.sum(axis=1)
    return np.concatenate([fired, np.log1p(total)[:, None], np.minimum((hits > 0).sum(axis=1), 4)[:, None], (10 * total / (votes[:, -1] + 20))[:, None], np.ones((len(votes), 1))], axis=1).astype(np.float64)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Ridge logistic regression on probabilities, by Newton's method; the last column is not held back."""
    w = np.zeros(x.shape[1])
    hold = np.full(x.shape[1], ridge)
    hold[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + hold * w
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(hold)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class Model:
    """Voters and the classifier's weights."""

    voters: Voters
    weights: np.ndarray

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The probability that each row is toxic."""
        return 1 / (1 + np.exp(-np.clip(features(self.voters.votes(raw, offsets)) @ self.weights, -30, 30)))


def remainder(doc_id: str | Column, by: int) -> Column:
    """crc32 of the id's decimal text, modulo by."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % by


def without_copies(rows: DataFrame, sketches: int = 3) -> list[int]:
    """Ids of rows (doc_id, text) less those whose text shares the least of its five-word hashes, under any of a few seeds, with another kept one.

    Copies of one text would make each of its words look like a sign of its label.  Takes a bounded sample: one short row each goes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sep = byte_table(903, fold=True), non_alnum()
        for b in batches:
            ids = b.column("doc_id")
            for i, j, w in words_of(b.column("text"), sep):
                at, h = w.windows(w.hashes(table), 5)
                out = np.zeros((j - i, sketches), dtype=np.int64)
                row = w.row[at]
                if len(row):
                    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                    for k in range(sketches):
                        out[row[first], k] = np.minimum.reduceat(mix(h + U(k)) >> U(1), first).astype(np.int64)
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), *(pa.array(out[:, k]) for k in range(sketches))], ["doc_id", *(f"s{k}" for k in range(sketches))])

    got = rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ", ".join(["doc_id long", *(f"s{k} long" for k in range(sketches))])).toPandas().sort_values("doc_id")
    kept, seen = [], set()
    for doc, *least in got.itertuples(index=False):
        marks = [(k, x) for k, x in enumerate(least) if x]
        if not any(m in seen for m in marks):
            kept.append(int(doc))
        seen.update(marks)
    return kept


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, toxic); labels count where crc32(doc_id) mod 3 is not 1."""
    small_batches(docs.sparkSession)
    known = labels.select("doc_id", "toxic").filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(remainder("doc_id", 3) != 1)
    spread = F.xxhash64("doc_id", F.lit(5))
    picked = [known.filter(F.col("toxic") == y).orderBy(spread).limit(sample).select("doc_id", F.col("toxic").alias("known")) for y in (1, 0)]
    others = docs.select("doc_id").filter("doc_id is not null").filter(remainder("doc_id", 3) != 1).distinct().join(known.select("doc_id"), "doc_id", "left_anti").orderBy(spread).limit(sample).select("doc_id", F.lit(-1).alias("known"))
    ids = picked[0].unionByName(picked[1]).unionByName(others)
    # at most 3 * sample ids: a proven bound
    drawn = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.max("known").alias("known"), F.min("text").alias("text")).persist()
    try:
        kept = docs.sparkSession.createDataFrame(pd.DataFrame({"doc_id": np.array(without_copies(drawn), dtype=np.int64)}), "doc_id long")
        rows = drawn.join(F.broadcast(kept), "doc_id").select("text", "known")
        sizes = {r["known"]: r["count"] for r in rows.groupBy("known").count().collect()}
        n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
        counts = stem_counts(rows.filter("known >= 0").withColumnRenamed("known", "toxic")).persist()
        stems = choose_stems(counts, n_toxic, n_clean) if n_toxic and n_clean else np.zeros((0, 2), dtype=np.int64)
        counts.unpersist()
        voters = Voters.of(stems)
        got = vote_rows(rows, voters).toPandas()
    finally:
        drawn.unpersist()
    votes = np.frombuffer(b"".join(got["votes"]), dtype=np.float32).reshape(-1, voters.n + 1) if len(got) else np.zeros((1, voters.n + 1), dtype=np.float32)
    known_rows = got["known"].to_numpy() if len(got) else np.array([-1])
    fired = (votes[:, :-1] > 0).astype(np.float64)
    p, _ = label_model(fired, known_rows)
    return Model(voters, logistic(features(votes), p))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with toxicity double and toxic int (1 from 0.7 on). Narrow: no shuffle."""
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("toxicity", "toxic")]
    types = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = text_buffer(b.column("text"))
            parts = [model.score(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in blocks(offsets)]
            s = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], [*kept, "toxicity", "toxic"])

    return docs.select(kept).mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in kept), "toxicity double", "toxic int"]))
