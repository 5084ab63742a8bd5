"""Vocabularies and embeddings: cleaning, similarity joins by threshold, top k, alignment."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions import text as T
from termloom.functions import vectors as V

#: rows of either side that one task multiplies at once
BLOCK_ROWS = 8192


def vocabulary(terms: DataFrame, preprocessor: Callable[[Column], Column] = T.preprocess_word) -> DataFrame:
    """(idx, word, term) of terms (idx, term): one row a preprocessed word, at its first place, with its last spelling."""
    words = terms.select("idx", F.col("term").cast("string").alias("term")).withColumn("word", preprocessor(F.col("term")))
    return words.groupBy("word").agg(F.min("idx").alias("idx"), F.max_by("term", "idx").alias("term")).select("idx", "word", "term")


def phrase_vectors(terms: DataFrame, word_vectors: DataFrame) -> DataFrame:
    """(idx, embedding) of terms (idx, term): the mean of their words' unit vectors (word, embedding), at length 1."""
    words = terms.select("idx", F.explode(F.split("term", r"[ _]+")).alias("word"))
    parts = words.join(word_vectors, "word").select("idx", F.posexplode(V.unit(F.col("embedding"))).alias("at", "x"))
    means = parts.groupBy("idx", "at").agg(F.avg("x").alias("x")).groupBy("idx").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v"))
    return means.select("idx", V.unit(F.transform("v", lambda p: p["x"])).alias("embedding"))


def _blocks(df: DataFrame, key: str, name: str, n: int) -> DataFrame:
    return df.select(F.col(key).alias(name), V.unit(F.col("embedding")).alias(f"{name}_v"), F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias(f"{name}_block"))


def similar_pairs(left: DataFrame, right: DataFrame, threshold: float, key: str = "vec_id", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query, match, sim) of all pairs with cosine >= threshold; exact.

    Both sides are cut into blocks; each pair of blocks is one matrix product in one task, and only pairs over the threshold
    leave it.  A task holds two blocks whatever the tables' sizes; equal keys are kept (see exclude_self).
    """
    n_left, n_right = (max(1, -(-df.count() // block_rows)) for df in (left, right))
    a = _blocks(left, key, "query", n_left).withColumn("match_block", F.explode(F.sequence(F.lit(0), F.lit(n_right - 1))))
    b = _blocks(right, key, "match", n_right).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(n_left - 1))))
    kind = dict(left.dtypes)[key]

    def product(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({"query": [], "match": [], "sim": []})
        m, out = np.stack(y["match_v"]), []
        for s in range(0, len(x), 512):
            sim = np.stack(x["query_v"].iloc[s : s + 512]) @ m.T
            i, j = np.nonzero(sim >= threshold)
            out.append(pd.DataFrame({"query": x["query"].to_numpy()[s + i], "match": y["match"].to_numpy()[j], "sim": sim[i, j]}))
        return pd.concat(out)

    at = ["query_block", "match_block"]
    return a.groupBy(*at).cogroup(b.groupBy(*at)).applyInPandas(product, f"query {kind}, match {kind}, sim double")


def exclude_self(pairs: DataFrame) -> DataFrame:
    """Pairs of different keys, once each."""
    return pairs.filter(F.col("query") != F.col("match")).distinct()


def top_k(left: DataFrame, right: DataFrame, k: int, key: str = "vec_id", include_self: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query, rank, match, sim): the k most similar rows of right for each row of left, ties to smaller keys; exact.

    Each pair of blocks leaves k rows a query at most, so what is shuffled for the last ranking grows with the
    number of queries and blocks, not with all pairs.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    n_left, n_right = (max(1, -(-df.count() // block_rows)) for df in (left, right))
    a = _blocks(left, key, "query", n_left).withColumn("match_block", F.explode(F.sequence(F.lit(0), F.lit(n_right - 1))))
    b = _blocks(right, key, "match", n_right).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(n_left - 1))))
    kind = dict(left.dtypes)[key]

    def product(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query": [], "match": [], "sim": []})]
        if len(x) and len(y):
            y = y.sort_values("match", kind="stable")
            m, names = np.stack(y["match_v"]), y["match"].to_numpy()
            for s in range(0, len(x), 512):
                q = x["query"].to_numpy()[s : s + 512]
                sim = np.stack(x["query_v"].iloc[s : s + 512]) @ m.T
                if not include_self:
                    sim[names[None, :] == q[:, None]] = -np.inf
                best = np.argsort(-sim, axis=1, kind="stable")[:, :k]
                out.append(pd.DataFrame({"query": np.repeat(q, best.shape[1]), "match": names[best].ravel(), "sim": np.take_along_axis(sim, best, 1).ravel()}))
        return pd.concat(out[1:] or out)

    at = ["query_block", "match_block"]
    lists = a.groupBy(*at).cogroup(b.groupBy(*at)).applyInPandas(product, f"query {kind}, match {kind}, sim double").filter(F.col("sim") > float("-inf"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "match"))
    return lists.withColumn("rank", rank).filter(F.col("rank") <= k).select("query", "rank", "match", "sim")


def pair_similarity(pairs: DataFrame, vectors: DataFrame, key: str = "vec_id") -> DataFrame:
    """pairs (a, b) with sim, the cosine of their vectors."""
    x = vectors.select(F.col(key).alias("a"), F.col("embedding").alias("_x"))
    y = vectors.select(F.col(key).alias("b"), F.col("embedding").alias("_y"))
    return pairs.join(x, "a").join(y, "b").withColumn("sim", V.cosine(F.col("_x"), F.col("_y"))).drop("_x", "_y")


def align(one: DataFrame, two: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(term, matches): for each term of one (term, embedding), the terms of two at least so similar, best first; terms without any are left out."""
    names = lambda df: df.dropDuplicates(["term"]).select(F.col("term").alias("vec_id"), "embedding")
    pairs = similar_pairs(names(one), names(two), threshold)
    return pairs.groupBy(F.col("query").alias("term")).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("sim")).alias("s"), "match"))), lambda x: x["match"]).alias("matches"))


def align_self(vectors: DataFrame, threshold: float = 0.8) -> DataFrame:
    """A vocabulary aligned with itself; each term matches itself too."""
    return align(vectors, vectors, threshold)


def map_vectors(rows: DataFrame, model: Callable[[list[str]], np.ndarray], text: str = "term") -> DataFrame:
    """rows with embedding array<float> from a model that a worker calls with batches of texts."""
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), "embedding array<float>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = pa.array([list(map(float, v)) for v in model(b.column(text).to_pylist())], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*b.columns, made], [*b.schema.names, "embedding"])

    return rows.mapInArrow(run, schema)
