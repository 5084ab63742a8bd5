"""Figures of merit for taggers and similarity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def label_counts(labels: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row (tp, fp, fn) over (concept, label): gold are the concept's other labels, predictions are (label, match)."""
    gold = labels.groupBy("uri").agg(F.collect_set("label").alias("all")).select(F.explode("all").alias("label"), "all").select("label", F.array_remove("all", F.col("label")).alias("gold"))
    said = predictions.groupBy("label").agg(F.collect_set("match").alias("said"))
    rows = gold.join(said, "label", "left").withColumn("said", F.coalesce("said", F.array().cast("array<string>")))
    return rows.agg(F.sum(F.size(F.array_intersect("gold", "said"))).alias("tp"), F.sum(F.size(F.array_except("said", "gold"))).alias("fp"), F.sum(F.size(F.array_except("gold", "said"))).alias("fn"))


def related_counts(labels: DataFrame, relations: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row (tp, fp, fn) over (concept, label): gold are the labels of related concepts."""
    far = relations.join(labels.select(F.col("uri").alias("uri2"), F.col("label").alias("far")), "uri2").groupBy(F.col("uri1").alias("uri")).agg(F.collect_set("far").alias("gold"))
    said = predictions.groupBy("label").agg(F.collect_set("match").alias("said"))
    empty = F.array().cast("array<string>")
    rows = labels.join(far, "uri").join(said, "label", "left").withColumns({"gold": F.coalesce("gold", empty), "said": F.coalesce("said", empty)})
    return rows.agg(F.sum(F.size(F.array_intersect("gold", "said"))).alias("tp"), F.sum(F.size(F.array_except("said", "gold"))).alias("fp"), F.sum(F.size(F.array_except("gold", "said"))).alias("fn"))


def mean_labels(labels: DataFrame) -> DataFrame:
    """One row: labels a concept, on average."""
    return labels.groupBy("uri").agg(F.count("*").alias("n")).agg(F.avg("n").alias("mean_labels"))


def mean_predictions(predictions: DataFrame) -> DataFrame:
    """One row: predictions (label, match) a label that has any, on average."""
    return predictions.groupBy("label").agg(F.count("*").alias("n")).agg(F.avg("n").alias("mean_predictions"))


def link_counts(own: DataFrame, other: DataFrame) -> DataFrame:
    """One row (n_self, n_other): how many pairs two link tables hold."""
    return own.agg(F.count("*").alias("n_self")).join(F.broadcast(other.agg(F.count("*").alias("n_other"))), F.lit(True))


def confusion(scored: DataFrame, threshold: float) -> DataFrame:
    """(label, predicted, n) of (label, sim), predicted being sim >= threshold."""
    return scored.groupBy("label", (F.col("sim") >= threshold).cast("int").alias("predicted")).agg(F.count("*").alias("n"))


def decide_threshold(labels: DataFrame, relations: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row (k, threshold): k is the mean number of labels near a label; threshold the mean of the least similarity among its k nearest.

    pairs (query, match, sim) hold each label's similarities, itself left out.
    """
    own = labels.groupBy("uri").agg(F.count("*").alias("n"))
    far = relations.join(own.select(F.col("uri").alias("uri2"), F.col("n").alias("far")), "uri2").groupBy(F.col("uri1").alias("uri")).agg(F.sum("far").alias("far"))
    k = own.join(far, "uri", "left").agg(F.bround(F.avg(F.col("n") - 1 + F.coalesce("far", F.lit(0)))).cast("int").alias("k"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "match"))
    ranked = pairs.withColumn("rank", rank)
    # k is one row
    kept = ranked.join(F.broadcast(k), F.col("rank") <= F.col("k"))
    return kept.groupBy("k", "query").agg(F.min("sim").alias("least")).groupBy("k").agg(F.avg("least").alias("threshold"))


def chunks(rows: DataFrame, key: str = "sent_id") -> DataFrame:
    """(key, begin, end): entities of tagged tokens (key, pos, tag); B begins one, and so does I after O or at the start."""
    order = Window.partitionBy(key).orderBy("pos")
    own = rows.filter("tag <> 'PAD'").withColumn("before", F.coalesce(F.lag("tag").over(order), F.lit("O")))
    start = (F.col("tag") == "B") | ((F.col("tag") == "I") & (F.col("before") == "O"))
    at = own.withColumn("g", F.sum(start.cast("int")).over(order)).filter("tag <> 'O'")
    return at.groupBy(key, "g").agg(F.min("pos").alias("begin"), (F.max("pos") + 1).alias("end")).drop("g")


def chunk_scores(gold: DataFrame, predicted: DataFrame, key: str = "sent_id", swapped: bool = False) -> DataFrame:
    """One row (tp, n_gold, n_predicted, precision, recall, f1); swapped: precision and recall change places, as some reports have them."""
    g, p = chunks(gold, key), chunks(predicted, key)
    tp = g.join(p, [key, "begin", "end"]).agg(F.count("*").alias("tp"))
    sizes = g.agg(F.count("*").alias("n_gold")).join(F.broadcast(p.agg(F.count("*").alias("n_predicted"))), F.lit(True)).join(F.broadcast(tp), F.lit(True))
    ratio = lambda n: F.when(F.col(n) > 0, F.col("tp") / F.col(n)).otherwise(0.0)
    precision, recall = ratio("n_predicted"), ratio("n_gold")
    f1 = F.when(F.col("tp") > 0, 2.0 * F.col("tp") / (F.col("n_gold") + F.col("n_predicted"))).otherwise(0.0)
    return sizes.select("tp", "n_gold", "n_predicted", (recall if swapped else precision).alias("precision"), (precision if swapped else recall).alias("recall"), f1.alias("f1"))


def mean_similarity(scored: DataFrame, by: str) -> DataFrame:
    """(by, mean_sim): NaN counts as 0."""
    return scored.groupBy(by).agg(F.avg(F.nanvl(F.coalesce("sim", F.lit(0.0)), F.lit(0.0))).alias("mean_sim"))


def timings(runs: DataFrame, by: str = "name") -> DataFrame:
    """(by, mean, sd) of seconds, sd with n - 1."""
    return runs.groupBy(by).agg(F.avg("seconds").alias("mean"), F.stddev_samp("seconds").alias("sd"))


def sampled_pairs(labels: DataFrame, n: int, seed: int = 0, same: bool = True) -> DataFrame:
    """(label_i, label_j, label): n pairs of different labels of one concept (label 1), or of neighbouring concepts in a random order (0).

    The order is that of a hash with the seed, so a seed gives the same pairs on any cluster.
    """
    one = labels.select("uri", F.col("label").alias("label_i"))
    if same:
        two = labels.select("uri", F.col("label").alias("label_j"))
        pairs = one.join(two, "uri").filter("label_i < label_j").select("label_i", "label_j")
    else:
        order = Window.partitionBy(F.pmod(F.xxhash64("uri"), F.lit(64))).orderBy(F.xxhash64("label_i", F.lit(seed)), "label_i")
        pairs = one.withColumns({"label_j": F.lead("label_i").over(order), "other": F.lead("uri").over(order)}).filter("other <> uri").select("label_i", "label_j")
    return pairs.orderBy(F.xxhash64("label_i", "label_j", F.lit(seed)), "label_i", "label_j").limit(n).withColumn("label", F.lit(int(same)))


def in_relations(pairs: DataFrame, relations: DataFrame) -> DataFrame:
    """pairs (uri_i, uri_j, ...) with label: 1 if the second concept is among the related ones of the first (uri1, uri2), else 0."""
    known = relations.select(F.col("uri1").alias("uri_i"), F.col("uri2").alias("uri_j")).distinct().withColumn("_there", F.lit(1))
    return pairs.join(known, ["uri_i", "uri_j"], "left").withColumn("label", F.coalesce("_there", F.lit(0))).drop("_there")


def drawn(rows: DataFrame, n: int, seed: int, order: str, replacement: bool = False) -> DataFrame:
    """n rows in a random order that a seed fixes on any cluster, numbered by `draw`; with replacement, rows can come again.

    The n draws are what is wanted, so they are one short table.  Without replacement the rows come in the order of a hash.  With it, each
    draw is a hash modulo the number of rows, and rows are numbered by their order within ranges of it, never in one task.
    """
    if not replacement:
        first = rows.withColumn("_h", F.xxhash64(order, F.lit(seed))).orderBy("_h", order).limit(n)
        return first.withColumn("draw", (F.row_number().over(Window.orderBy("_h", order)) - 1).cast("long")).drop("_h")
    spark = rows.sparkSession
    blocks = rows.withColumn("_b", F.pmod(F.xxhash64(order), F.lit(1024)))
    sizes = blocks.groupBy("_b").agg(F.count("*").alias("_n"))
    offsets = sizes.withColumn("_at", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    numbered = blocks.withColumn("_i", F.row_number().over(Window.partitionBy("_b").orderBy(order)) - 1).join(F.broadcast(offsets), "_b").withColumn("_i", F.col("_i") + F.col("_at"))
    total = F.broadcast(rows.agg(F.count("*").alias("_total")).filter("_total > 0"))
    draws = spark.range(n).withColumnRenamed("id", "draw").join(total, F.lit(True)).select("draw", F.pmod(F.xxhash64("draw", F.lit(seed)), F.col("_total")).alias("_i"))
    return numbered.join(draws, "_i").drop("_i", "_b", "_at")


def split(rows: DataFrame, share: float, seed: int, key: str) -> tuple[DataFrame, DataFrame]:
    """(training, validation) rows: `share` of the keys, by a hash with the seed, are for validation; the same on any cluster."""
    low = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 20)) < int(share * (1 << 20))
    return rows.filter(~low), rows.filter(low)


def evaluation_pairs(labels: DataFrame, relations: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """(draw, uri_i, label_i, uri_j, label_j, label): n pairs of concepts drawn with replacement, one label of each, and whether they are related.

    Pairs of a concept with itself go, so there may be fewer than n.
    """
    concepts = labels.groupBy("uri").agg(F.array_sort(F.collect_set("label")).alias("own"))

    def side(which: str, salt: int) -> DataFrame:
        picked = F.get("own", F.pmod(F.xxhash64("draw", F.lit(salt), F.lit("label")), F.size("own")).cast("int"))
        return drawn(concepts, n, salt, "uri", replacement=True).select("draw", F.col("uri").alias(f"uri_{which}"), picked.alias(f"label_{which}"))

    pairs = side("i", 2 * seed).join(side("j", 2 * seed + 1), "draw").filter("uri_i <> uri_j")
    return in_relations(pairs, relations).select("draw", "uri_i", "label_i", "uri_j", "label_j", "label")


def similarity_report(labels: DataFrame, relations: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """One row: labels a concept and predictions a label on average, and right, wrong and missing predictions of labels of one concept and of related ones.

    pairs (query, match, sim) hold each label's similarities, itself left out; those of at least the threshold are predictions.
    """
    said = pairs.filter(F.col("sim") >= threshold).select(F.col("query").alias("label"), "match")
    same, far = label_counts(labels, said), related_counts(labels, relations, said)
    named = lambda df, x: df.select(*(F.col(c).alias(f"{x}_{c}") for c in ("tp", "fp", "fn")))
    out = mean_labels(labels)
    for one_row in (mean_predictions(said), named(same, "same"), named(far, "related")):
        out = out.join(F.broadcast(one_row), F.lit(True))
    return out


def balanced_pairs(labels: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n pairs of one concept and n of different ones."""
    return sampled_pairs(labels, n, seed, True).unionByName(sampled_pairs(labels, n, seed, False))


def best_flags(scored: DataFrame, names: Sequence[str], by: str = "mean_sim") -> DataFrame:
    """(flag, mean): the mean of `by` over rows where each bit of `steps` is set."""
    flags = F.explode(F.array(*[F.struct(F.lit(name).alias("flag"), (F.shiftright("steps", k).bitwiseAND(1) == 1).alias("on")) for k, name in enumerate(names)]))
    return scored.select(by, flags.alias("f")).filter("f.on").groupBy("f.flag").agg(F.avg(by).alias("mean"))
