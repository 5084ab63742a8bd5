"""Which term a definition defines: a cascade of sources, the first that finds anything decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.config import Config
from termloom.operators.matching import shuffled
from termloom.operators.spans import covered, in_larger

KEY = ["doc_id", "def_id"]


def subjects(tokens: DataFrame, chunks: DataFrame) -> DataFrame:
    """(doc_id, sent_id, term, begin, end): per noun chunk (doc_id, sent_id, first, last), its first token that is the subject of a root."""
    head = tokens.select("doc_id", "sent_id", F.col("i").alias("head_i"), F.col("dep").alias("head_dep"))
    named = tokens.filter("dep = 'nsubj'").join(shuffled(head), ["doc_id", "sent_id", "head_i"]).filter("head_dep = 'ROOT'")
    inside = chunks.join(shuffled(named), ["doc_id", "sent_id"]).filter("i between first and last")
    first = inside.groupBy("doc_id", "sent_id", "first").agg(F.min_by(F.struct(F.lower("text").alias("term"), F.col("idx").alias("begin"), (F.col("idx") + F.length("text")).alias("end")), "i").alias("x"))
    return first.select("doc_id", "sent_id", "x.term", "x.begin", "x.end")


def defined_terms(definitions: DataFrame, tokens: DataFrame, dependencies: DataFrame, quoted: DataFrame, config: Config | None = None, existing: DataFrame | None = None) -> DataFrame:
    """(doc_id, def_id, begin, end, term, stage): each definition's spans of the first stage that has any.

    definitions (doc_id, def_id, begin, end); tokens (doc_id, term, begin, end, score); dependencies (doc_id, term, begin, end);
    quoted (doc_id, def_id, term, begin, end) in the document's offsets; existing: spans that the last stage must not repeat.
    A stage's fallback (its terms without a dependency) ranks half a step after it.

    Tokens and dependencies are one table, which meets the definitions once; all else is windows by document and definition, over that
    join's partitioning.
    """
    c = config or Config()
    listed = F.col("score").isin(c.score_whitelist, c.score_regex)
    spans = tokens.select("doc_id", F.col("term"), "begin", "end", "score", F.lit(True).alias("is_token"))
    spans = spans.unionByName(dependencies.select("doc_id", "term", "begin", "end", F.lit(None).cast("double").alias("score"), F.lit(False).alias("is_token")))
    for name, counts in (("in_any", F.col("is_token")), ("in_listed", F.col("is_token") & listed)):
        reach, inside = in_larger("doc_id", counts)
        spans = spans.withColumn("_reach", reach).withColumn(name, inside).drop("_reach")
    joined = covered(definitions.select("doc_id", "def_id", "begin", "end"), spans)
    rows = joined.select("doc_id", F.col("o_def_id").alias("def_id"), *(F.col(f"i_{x}").alias(x) for x in spans.columns if x != "doc_id"))
    if c.use_regex:
        said = quoted.select(*KEY, "term", "begin", "end").distinct().withColumn("is_quoted", F.lit(True))
        rows = rows.join(shuffled(said), [*KEY, "term", "begin", "end"], "left")
    else:
        rows = rows.withColumn("is_quoted", F.lit(False))
    own = Window.partitionBy(*KEY)
    dependency = F.when(~F.col("is_token") & (F.col("begin") < F.col("end")), F.struct("begin", "end"))
    rows = rows.withColumn("deps", F.collect_set(dependency).over(own))
    near = (F.col("begin") < F.col("end")) & F.exists("deps", lambda d: (d["begin"] < F.col("end")) & (F.col("begin") < d["end"]))

    def staged(holds: Column, stage: float, fallback: bool) -> list[Column]:
        yes = F.col("is_token") & F.coalesce(holds, F.lit(False))
        return [F.when(yes & near, F.lit(stage)), *([F.when(yes, F.lit(stage + 0.5))] if fallback else [])]

    stages: list[Column] = []
    if c.use_regex:
        stages += staged(F.col("is_quoted"), 1.0, c.fallback_to_regex)
    if c.use_whitelist:
        stages += staged(listed & ~F.col("in_listed"), 2.0, c.fallback_to_whitelist)
    if c.use_tf_idf:
        stages += staged(~F.col("in_any"), 3.0, c.fallback_to_tf_idf)
    if c.use_tagger and c.tagger_bio:
        if existing is not None:
            rows = rows.join(shuffled(existing.select("doc_id", "begin", "end").distinct().withColumn("is_known", F.lit(True))), ["doc_id", "begin", "end"], "left")
        new = F.col("is_known").isNull() if existing is not None else F.lit(True)
        stages.append(F.when(~F.col("is_token") & new, F.lit(4.0)))
    rows = rows.withColumn("stages", F.array_compact(F.array(*stages)) if stages else F.array().cast("array<double>"))
    first = F.min(F.array_min("stages")).over(own)
    found = rows.withColumn("stage", first).filter(F.array_contains("stages", F.col("stage")))
    term = F.when(F.col("stage") == 4, F.lower("term")).otherwise(F.col("term"))
    return found.select(*KEY, "begin", "end", term.alias("term"), "stage").distinct()
