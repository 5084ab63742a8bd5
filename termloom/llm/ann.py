"""Nearest neighbours by shifted space-filling curves.

Vectors are projected by several random rotations, shifted, and ordered along a Hilbert curve each time.  Every ordering is
range-partitioned into key ranges of about equal size (from quantiles of the keys).  A query is sent to the range
of its own key and the ranges next to it, in each ordering; ranges are searched by blocks of matrix products, and the short lists
of all ranges and orderings are merged and ranked by the exact inner product in double precision.

How wide a range must be depends on the vectors: clustered ones lie close together on some curve, vectors without structure don't.
So the width is measured, at every size in the same way: SAMPLE queries are searched exactly, and a range gets as wide as is needed for
TARGET of their neighbours to stand no farther than that from the query on some curve (ranges beside the query's own bring more).

Equal vectors are one node, with its k + 1 smallest ids (no more of them can be among k nearest), so a vector that many rows
share is searched once.  A range's vectors and queries are both split, so that a task holds at most CHUNK of one and ASKED of the other.

Inner products of vectors of different length: vectors get a coordinate more, sqrt(M**2 - |v|**2), M being the
largest length, which makes the nearest direction the largest product.

Defined results: vectors that are null, zero, of another dimension than most, or hold null or non-finite components take no part, nor do
rows without id; rows that repeat an id and vector count once; ties go to smaller ids; too few candidates give shorter lists; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom.llm.shared import written
from termloom.llm.tokens import U

#: orderings, dimensions and bits of a key, vectors and queries that a task searches at once, candidates kept beyond those wanted
ORDERINGS, DIMS, BITS, CHUNK, ASKED, SPARE = 32, 12, 4, 40_000, 20_000, 12
#: queries that are searched exactly to measure how wide ranges must be, share of their neighbours that must be met, quantiles of the keys, ranges at most
SAMPLE, TARGET, QUANTILES, MOST_BLOCKS = 100, 0.88, 2000, 500


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """The place of integer points (n by d, below 2**bits) along a Hilbert curve, as int64 (d * bits < 64).

    Gray code by coordinate bit planes, undone from the most significant bit on (Skilling's transform).
    """
    axes = [c.copy() for c in x.T.astype(np.uint32)]
    d = len(axes)
    for b in range(bits - 1, 0, -1):
        low = np.uint32((1 << b) - 1)
        for i in range(d):
            up = (axes[i] >> np.uint32(b)) & np.uint32(1) == 1
            swap = np.where(up, np.uint32(0), (axes[0] ^ axes[i]) & low)
            axes[0] ^= np.where(up, low, swap)
            axes[i] ^= swap
    for i in range(1, d):
        axes[i] ^= axes[i - 1]
    flip = np.zeros_like(axes[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((axes[-1] >> np.uint32(b)) & np.uint32(1) == 1, np.uint32((1 << b) - 1), np.uint32(0))
    key = np.zeros(len(x), dtype=np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << U(1)) | (((axes[i] ^ flip) >> np.uint32(b)) & np.uint32(1)).astype(np.uint64)
    return key.view(np.int64)


@dataclass(frozen=True)
class Curves:
    """The orderings over vectors of `size` components; mean and spread are those of the projections, longest the largest length."""

    size: int
    longest: float
    mean: np.ndarray
    spread: np.ndarray

    @staticmethod
    def rotations(size: int) -> list[np.ndarray]:
        rng = np.random.default_rng(61)
        return [np.linalg.qr(rng.standard_normal((size + 1, size + 1)))[0][:, :DIMS] for _ in range(ORDERINGS)]

    @staticmethod
    def lifted(x: np.ndarray, longest: float, query: bool) -> np.ndarray:
        """Vectors on the unit sphere with the coordinate more (0 for queries)."""
        n = np.linalg.norm(x, axis=1)
        if query:
            return np.concatenate([x / n[:, None], np.zeros((len(x), 1))], axis=1)
        return np.concatenate([x, np.sqrt(np.maximum(longest**2 - n**2, 0))[:, None]], axis=1) / longest

    def keys(self, x: np.ndarray, query: bool) -> list[np.ndarray]:
        """Each ordering's keys."""
        y = self.lifted(x.astype(np.float64), self.longest, query)
        rng, out = np.random.default_rng(62), []
        for k, r in enumerate(self.rotations(self.size)):
            a = slice(k * r.shape[1], (k + 1) * r.shape[1])
            z = (y @ r - self.mean[a]) / self.spread[a] + rng.uniform(-0.5, 0.5, r.shape[1])
            out.append(hilbert(np.clip((z / 6 + 0.5) * (1 << BITS), 0, (1 << BITS) - 1), BITS))
        return out


def _matrix(column: pd.Series, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.float32).reshape(-1, size)


def _lists(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), -1)


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, embedding array<double>) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.select(F.col("vec_id").cast("long"), v.alias("embedding")).filter("vec_id is not null and embedding is not null").filter(~F.coalesce(bad, F.lit(False)))
    return kept.filter(F.exists("embedding", lambda x: x != 0)).withColumn("embedding", F.transform("embedding", lambda x: x + 0.0))


def nodes_of(rows: DataFrame, keep: int) -> DataFrame:
    """(node, ids, embedding): a row for each distinct vector, with its smallest ids; node is the smallest."""
    h = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(3), "embedding").alias("h2")]
    ranked = rows.select("vec_id", "embedding", *h).dropDuplicates(["vec_id", "h1", "h2"]).withColumn("n", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))).filter(F.col("n") <= keep)
    first = F.first(F.when(F.col("n") == 1, F.col("embedding")), ignorenulls=True)
    return ranked.groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.array_sort(F.collect_list("vec_id")).alias("ids"), first.alias("embedding"))


def fit(nodes: DataFrame, size: int) -> Curves:
    """Means and spreads of the projections, summed by executors: (size + 1) * ORDERINGS numbers at most reach the driver."""
    longest = nodes.agg(F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()["m"]
    longest = float(np.sqrt(longest)) if longest else 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | int = 0
        for b in batches:
            if not b.num_rows:
                continue
            y = Curves.lifted(_lists(b.column("embedding")), longest, False)
            p = np.concatenate([y @ r for r in Curves.rotations(size)], axis=1)
            total = total + np.stack([p.sum(axis=0), (p * p).sum(axis=0), np.full(p.shape[1], len(p))])
        if not isinstance(total, int):
            yield pa.RecordBatch.from_arrays([pa.array(range(total.shape[1]), pa.int64()), *(pa.array(x) for x in total)], ["at", "s", "q", "n"])

    got = nodes.select("embedding").mapInArrow(run, "at long, s double, q double, n double").groupBy("at").agg(F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum("n").alias("n")).orderBy("at").toPandas()
    if not len(got):
        width = min(DIMS, size + 1) * ORDERINGS
        return Curves(size, longest, np.zeros(width), np.ones(width))
    mean = (got["s"] / got["n"]).to_numpy()
    return Curves(size, longest, mean, np.sqrt(np.maximum(got["q"] / got["n"] - mean**2, 1e-12)).to_numpy())


def keyed(nodes: DataFrame, curves: Curves, query: bool) -> DataFrame:
    """(ordering, key, node, v): a row for each node and ordering; v in single precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _lists(b.column("embedding"))
            v = pa.array([r.tobytes() for r in x.astype(np.float32)], pa.binary())
            for k, key in enumerate(curves.keys(x, query)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), k, dtype=np.int32)), pa.array(key), b.column("node"), v], ["ordering", "key", "node", "v"])

    return nodes.select("node", "embedding").mapInArrow(run, "ordering int, key long, node long, v binary")


def best_of(ids: np.ndarray, score: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n ids with the highest scores, each once, ties to smaller ids, and their scores."""
    ids, first = np.unique(ids, return_index=True)
    best = np.argsort(-score[first], kind="stable")[:n]
    return ids[best], score[first][best]


def exact(nodes: DataFrame, asked: np.ndarray, which: np.ndarray, k: int) -> dict[int, np.ndarray]:
    """The k nearest nodes of each of a few queries (vectors, and the nodes that they are): all are searched, k a partition leave it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = [(np.zeros(0, dtype=np.int64), np.zeros(0))] * len(asked)
        for b in batches:
            ids, score = b.column("node").to_numpy(), asked @ _lists(b.column("embedding")).T if b.num_rows else np.zeros((len(asked), 0))
            for q, (own_ids, own_score) in enumerate(lists):
                other = ids != which[q]
                lists[q] = best_of(np.concatenate([own_ids, ids[other]]), np.concatenate([own_score, score[q][other]]), k)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(which, [len(i) for i, _ in lists])), pa.array(np.concatenate([i for i, _ in lists])), pa.array(np.concatenate([x for _, x in lists]))], ["query", "node", "score"])

    ranked = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "node"))
    found = nodes.select("node", "embedding").mapInArrow(run, "query long, node long, score double").withColumn("n", ranked).filter(F.col("n") <= k).toPandas()
    return {q: rows["node"].to_numpy() for q, rows in found.groupby("query")}


def width(nodes: DataFrame, asked: DataFrame, curves: Curves, cuts: dict[int, np.ndarray], k: int) -> float:
    """How far apart, as a share of the keys, a query and its neighbours may stand on the curve that brings them closest, for TARGET of them.

    SAMPLE queries, their k neighbours and the keys of both reach the driver, whatever the tables' size.
    """
    sample = asked.orderBy(F.xxhash64("node")).limit(SAMPLE).toPandas()
    if not len(sample):
        return 1.0
    vectors = np.array(sample["embedding"].tolist(), dtype=np.float64)
    near = exact(nodes, vectors, sample["node"].to_numpy(), k)
    if not near:
        return 1.0
    wanted = nodes.sparkSession.createDataFrame(pd.DataFrame({"node": np.unique(np.concatenate(list(near.values())))}))
    there = keyed(nodes.join(wanted, "node", "left_semi"), curves, False).select("ordering", "node", "key").toPandas()
    places: dict[int, np.ndarray] = {}
    for node, rows in there.sort_values("ordering").groupby("node"):
        places[node] = np.array([np.searchsorted(cuts[o], key) for o, key in zip(rows["ordering"], rows["key"], strict=True)])
    own = np.stack([np.searchsorted(cuts[o], key) for o, key in enumerate(curves.keys(vectors, True))], axis=1)
    apart = [np.abs(places[v] - own[i]).min() for i, q in enumerate(sample["node"]) for v in near.get(q, [])]
    return float((np.quantile(apart, TARGET) + 1) / QUANTILES)


def search(spark: SparkSession, rows: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row for which is_query holds, among all other rows (vec_id, embedding)."""
    good = usable(rows)
    dims = good.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    size = dims[0]["d"] if dims else 1
    good = good.filter(F.size("embedding") == size)
    nodes = written(spark, nodes_of(good, k + 1), "nodes")
    queries = good.filter(is_query).select(F.col("vec_id").alias("query_id"), F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(3), "embedding").alias("h2")).distinct().join(nodes.select("h1", "h2", "node"), ["h1", "h2"]).select("query_id", "node")
    queries = written(spark, queries, "queries")
    curves = fit(nodes, size)
    asked = nodes.join(queries.select("node").distinct(), "node", "left_semi").select("node", "embedding")
    data = written(spark, keyed(nodes, curves, False), "keyed")
    # ORDERINGS rows of QUANTILES - 1 cuts
    found = data.groupBy("ordering").agg(F.percentile_approx("key", [i / QUANTILES for i in range(1, QUANTILES)], 10 * QUANTILES).alias("c")).collect()
    cuts = {r["ordering"]: np.array(r["c"], dtype=np.int64) for r in found}
    if not cuts:
        return rows.select(F.lit(0).cast("long").alias("query_id"), F.lit(0).alias("rank"), F.lit(0).cast("long").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    blocks = int(np.clip(1 / width(nodes, asked, curves, cuts, k), 3, MOST_BLOCKS))
    edges = {o: c[[round(QUANTILES * i / blocks) - 1 for i in range(1, blocks)]] for o, c in cuts.items()}
    edge_lists = F.expr(f"array({', '.join('array(' + ', '.join(f'{y}L' for y in edges[o]) + ')' for o in range(ORDERINGS))})")
    block = F.size(F.filter(F.get(edge_lists, F.col("ordering")), lambda c: c < F.col("key")))
    low = F.greatest(F.lit(0), F.least(F.col("block") - 1, F.lit(blocks - 3)))
    data = data.withColumn("block", block).drop("key")
    asked = keyed(asked, curves, True).withColumn("block", block).drop("key").withColumn("block", F.explode(F.sequence(low, low + 2)))
    # ORDERINGS * blocks rows at most, of how many parts each range has on either side
    count = lambda df, most: df.groupBy("ordering", "block").agg(F.ceil(F.count("*") / most).cast("int").alias("n"))
    sizes = count(data, CHUNK).withColumnRenamed("n", "parts").join(count(asked, ASKED).withColumnRenamed("n", "shares"), ["ordering", "block"])
    sizes = {(r["ordering"], r["block"]): (r["parts"], r["shares"]) for r in sizes.collect()}
    grid = [F.expr(f"array({', '.join(str(sizes.get((o, b), (0, 0))[k]) for o in range(ORDERINGS) for b in range(blocks))})") for k in (0, 1)]
    split = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # ranges without vectors or without queries have no parts
    place = lambda df: df.withColumns({n: F.get(x, F.col("ordering") * blocks + F.col("block")) for n, x in zip(("parts", "shares"), grid, strict=True)}).filter("parts > 0")
    data = place(data).withColumn("part", split("parts")).withColumn("share", every("shares")).drop("parts", "shares")
    asked = place(asked).withColumn("share", split("shares")).withColumn("part", every("parts")).drop("parts", "shares")
    keep = k + 1

    def near(_: tuple, q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"node": [], "found": [], "scores": []}
        if len(q) and len(v):
            a, b, ids = _matrix(q["v"], size), _matrix(v["v"], size), v["node"].to_numpy()
            order = np.argsort(ids, kind="stable")
            b, ids = b[order].T, ids[order]
            for s in range(0, len(a), 256):
                score = a[s : s + 256] @ b
                m = min(keep + SPARE, score.shape[1])
                top = np.sort(np.argpartition(-score, m - 1, axis=1)[:, :m], axis=1)
                out["node"] += q["node"].iloc[s : s + 256].tolist()
                out["found"] += [x.astype(np.int64).tobytes() for x in ids[top]]
                out["scores"] += [x.tobytes() for x in np.take_along_axis(score, top, 1)]
        return pd.DataFrame(out)

    at = ["ordering", "block", "part", "share"]
    lists = asked.groupBy(*at).cogroup(data.groupBy(*at)).applyInPandas(near, "node long, found binary, scores binary")
    # ORDERINGS * 3 short lists a part and query
    gathered = lists.groupBy("node").agg(F.collect_list(F.struct("found", "scores")).alias("lists"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.zeros(0, dtype=np.int64)]
            for own in b.column("lists").to_pylist():
                found.append(best_of(np.frombuffer(b"".join(x["found"] for x in own), dtype=np.int64), np.frombuffer(b"".join(x["scores"] for x in own), dtype=np.float32), keep + SPARE)[0])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column("node").to_numpy(), [len(x) for x in found[1:]])), pa.array(np.concatenate(found))], ["query", "found"])

    merged = gathered.mapInArrow(merge, "query long, found long")
    # the exact products of those that are left
    candidate = nodes.select(F.col("node").alias("found"), "ids", F.col("embedding").alias("v"))
    product = F.aggregate(F.zip_with("q", "v", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x).alias("score")
    by_id = merged.join(nodes.select(F.col("node").alias("query"), F.col("embedding").alias("q")), "query").join(candidate, "found").select("query", product, F.explode("ids").alias("vec_id"))
    first = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    short = by_id.withColumn("n", first).filter(F.col("n") <= keep).groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    own = queries.withColumnRenamed("node", "query").join(short, "query")
    listed = own.select("query_id", F.posexplode(F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("at", "x"))
    return listed.select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score")
