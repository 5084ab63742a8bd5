"""Sequence tags: from marked sentences to tag tables, and from tags to spans in the text."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions import text as T
from termloom.operators.matching import flexible_matches


def bio_tags(sentences: DataFrame, key: str = "sent_id", begin: str = T.BEGIN, end: str = T.END) -> DataFrame:
    """(key, pos, token, tag) of marked sentences (key, text): the token after an opening marker is B, others inside I, the rest O."""
    tokens = sentences.select(key, F.posexplode(F.filter(F.split("text", r"(?U)\s+"), lambda t: t != "")).alias("pos", "token"))
    order = Window.partitionBy(key).orderBy("pos")
    depth = F.sum(F.when(F.col("token") == begin, 1).when(F.col("token") == end, -1).otherwise(0)).over(order)
    rows = tokens.withColumns({"depth": depth, "before": F.lag("token").over(order)}).filter(~F.col("token").isin(begin, end))
    rows = rows.withColumn("tag", F.when(F.col("depth") <= 0, "O").when(F.col("before") == begin, "B").otherwise("I"))
    return rows.select(key, (F.row_number().over(order) - 1).alias("pos"), "token", "tag")


#: rows of a stride of a whole table
STRIDE = 1 << 16


def forward_fill(rows: DataFrame, column: str, order: str, partition: list[str] | None = None, strided: bool | None = None) -> DataFrame:
    """rows with the last value that is neither null nor empty, up to each row of its partition (without one, of the whole table).

    strided, as it is without a partition: by a numeric order, strides of a partition are filled apart, and what each leaves to the next ones, a
    row a stride, is filled first; so no task holds a large partition.
    """
    keys = list(partition or [])
    value = F.when(F.col(column) != "", F.col(column))
    if not (strided if strided is not None else not keys):
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn(column, F.last(value, ignorenulls=True).over(window))
    own = rows.withColumn("_stride", F.floor(F.col(order) / STRIDE))
    ends = own.groupBy(*keys, "_stride").agg(F.max_by(value, F.when(value.isNotNull(), F.col(order))).alias("_left"))
    before = ends.select(*keys, "_stride", F.last("_left", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_stride").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    window = Window.partitionBy(*keys, "_stride").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = own.withColumn(column, F.last(value, ignorenulls=True).over(window)).join(before, [*keys, "_stride"], "left")
    return filled.withColumn(column, F.coalesce(column, "_before")).select(*rows.columns)


def sentences_of(rows: DataFrame, key: str, order: str) -> DataFrame:
    """(key, words, tags) of a tag table (key, order, token, tag), in the order of its rows."""
    ordered = F.array_sort(F.collect_list(F.struct(order, "token", "tag")))
    return rows.groupBy(key).agg(ordered.alias("x")).select(key, F.transform("x", lambda x: x["token"]).alias("words"), F.transform("x", lambda x: x["tag"]).alias("tags"))


def tag_table(rows: DataFrame, key: str = "sent_id", most: int | None = None) -> DataFrame:
    """The training table (Sentence #, Word, POS, Tag) of (key, pos, token, tag), with key and place: the id stands at a sentence's first token only."""
    kept = rows if most is None else rows.filter(F.col("pos") < most)
    name = F.when(F.col("pos") == 0, F.concat(F.lit("Sentence: "), (F.col(key) + 1).cast("string"))).otherwise("")
    return kept.select(key, F.col("pos").alias("place"), name.alias("Sentence #"), F.col("token").alias("Word"), F.lit("--").alias("POS"), F.col("tag").alias("Tag"))


def merge_pieces(rows: DataFrame, key: str = "sent_id") -> DataFrame:
    """(key, pos, token, tag) with ``##`` pieces appended to the token before them, whose tag stays; leading ones are left alone."""
    order = Window.partitionBy(key).orderBy("pos")
    numbered = rows.withColumn("_first", F.row_number().over(order) == 1)
    numbered = numbered.withColumn("g", F.sum((~F.col("token").startswith("##") | F.col("_first")).cast("int")).over(order))
    joined = numbered.groupBy(key, "g").agg(F.array_sort(F.collect_list(F.struct("pos", "token", "tag"))).alias("x"))
    first = F.get("x", F.lit(0))
    rest = F.transform(F.slice("x", 2, F.size("x")), lambda x: F.substring(x["token"], 3, 1 << 20))
    return joined.select(key, (F.col("g") - 1).alias("pos"), F.concat(first["token"], F.array_join(rest, "")).alias("token"), first["tag"].alias("tag"))


def tag_runs(rows: DataFrame, key: str = "sent_id") -> DataFrame:
    """(key, run, term, begin, end): the longest stretches of tags other than O, with offsets in the tokens joined by blanks."""
    order = Window.partitionBy(key).orderBy("pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    at = rows.withColumns({"begin": F.coalesce(F.sum(F.length("token") + 1).over(before), F.lit(0)), "g": F.sum((F.col("tag") == "O").cast("int")).over(order)})
    runs = at.filter(F.col("tag") != "O").groupBy(key, "g").agg(F.min("begin").alias("begin"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]), " ").alias("term"))
    return runs.select(key, F.col("g").alias("run"), "term", "begin", (F.col("begin") + F.length("term")).alias("end"))


def decode(sentences: DataFrame, tagged: DataFrame, key: str = "sent_id") -> DataFrame:
    """(key, term, begin, end): tag runs as spans of the plain sentences (key, text), from tagged tokens (key, pos, token, tag).

    A run's term without marks is looked up in the joined tokens and in the text; the k-th place in one is the k-th in the
    other, and places inside the run count.  A term that the text holds less often than the tokens is left out.
    """
    runs = tag_runs(tagged, key).withColumn("bare", T.tagger_term(F.col("term"))).filter("bare is not null")
    joined = tagged.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]), " ").alias("tokens_text"))
    rows = runs.join(joined, key).join(sentences.select(key, F.col("text").alias("_text")), key).select(key, "run", "bare", F.col("begin").alias("run_begin"), F.col("end").alias("run_end"), "tokens_text", "_text")
    there = flexible_matches(rows, "tokens_text", "bare").select(key, "run", "k", F.col("begin").alias("t_begin"), F.col("end").alias("t_end"), "run_begin", "run_end")
    here = flexible_matches(rows, "_text", "bare").select(key, "run", "k", "match", "begin", "end")
    counts = there.groupBy(key, "run").agg(F.count("*").alias("n_there")).join(here.groupBy(key, "run").agg(F.count("*").alias("n_here")), [key, "run"]).filter("n_here >= n_there")
    inside = there.filter("t_begin >= run_begin and t_end <= run_end").join(counts, [key, "run"], "left_semi")
    return inside.join(here, [key, "run", "k"]).select(key, F.col("match").alias("term"), "begin", "end").distinct()


#: tag of what fills sentences up to one length
PAD = "PAD"


def classify_tokens(sentences: DataFrame, model: Callable[[list[list[str]]], Sequence[np.ndarray]], tags: Sequence[str], key: str = "sent_id", length: int = 75, batch: int = 32) -> DataFrame:
    """(key, pos, token, tag) of sentences (key, tokens) by a token classifier that a worker calls with batches of equally long sentences.

    Sentences are cut, or filled with empty tokens, to `length`; the model gives an array (sentences, length, tags) of scores, of which each token
    gets the best tag.  Tokens beyond the length have no tag and are left out, as are those that fill up.
    """
    kind = dict(sentences.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, tokens = b.column("key").to_pylist(), b.column("tokens").to_pylist()
            for s in range(0, len(keys), batch):
                own = [(t or [])[:length] for t in tokens[s : s + batch]]
                scores = np.asarray(model([[*t, *[""] * (length - len(t))] for t in own]))
                best = scores.argmax(axis=2) if len(own) else scores
                rows = [(k, i, w, tags[best[n, i]]) for n, (k, t) in enumerate(zip(keys[s : s + batch], own, strict=True)) for i, w in enumerate(t)]
                rows = [r for r in rows if r[3] != PAD]
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(columns[0], b.column("key").type), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())], ["key", "pos", "token", "tag"])

    found = sentences.select(F.col(key).alias("key"), "tokens").mapInArrow(run, f"key {kind}, pos int, token string, tag string")
    return found.withColumnRenamed("key", key)


def tagged_terms(sentences: DataFrame, model: Callable[[list[list[str]]], Sequence[np.ndarray]], tags: Sequence[str], tokens: Column, key: str = "sent_id", length: int = 75) -> DataFrame:
    """(key, term, begin, end): sentences (key, text) cut into tokens, classified, word pieces merged and decoded to spans."""
    classified = classify_tokens(sentences.select(key, tokens.alias("tokens")), model, tags, key, length)
    return decode(sentences, merge_pieces(classified, key), key)
