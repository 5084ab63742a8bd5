"""Terms and definitions in tables: cells of a legal-reference table hold one definition each, headed by its term."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions import text as T
from termloom.operators.spans import covered, not_covered

#: Attributes and texts by which such tables, cells and terms are known.
HEADER_ATTRIBUTES, HEADER_TEXT = "class='tbl-hdr'", "Legal references and instructions"
CELL_ATTRIBUTES, TERM_ATTRIBUTES = "valign='top'class='table'", "class='ti-grseq-1'"
CONTINUED = "of which"


def term_tables(tags: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, tag_id, begin, end) of the tbody elements that hold a header paragraph with the known text."""
    own = tags.join(texts.select("doc_id", F.col("text").alias("_text")), "doc_id")
    headers = own.filter((F.col("tag_name") == "p") & (F.col("attributes") == HEADER_ATTRIBUTES) & (T.strip(T.covered_text(F.col("_text"), F.col("begin"), F.col("end"))) == HEADER_TEXT))
    bodies = tags.filter("tag_name = 'tbody'").select("doc_id", "tag_id", "begin", "end")
    return covered(bodies, headers.select("doc_id", "begin", "end")).select("doc_id", F.col("o_tag_id").alias("tag_id"), F.col("o_begin").alias("begin"), F.col("o_end").alias("end")).distinct()


def carried(rows: DataFrame, table: list[str], order: str) -> DataFrame:
    """rows with `name`: a term that begins with "of which" follows the last one before it in its table that does not."""
    ordinary = F.when(~F.lower("term").startswith(CONTINUED), F.col("term"))
    before = F.last(ordinary, ignorenulls=True).over(Window.partitionBy(*table).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("name", F.when(F.lower("term").startswith(CONTINUED) & before.isNotNull(), F.concat_ws(" ", before, "term")).otherwise(F.col("term")))


def table_terms(tags: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_id, table_id, cell_begin, cell_end, term, name, begin, end): each cell's term, its full name and its place."""
    bodies = term_tables(tags, texts)
    cells = tags.filter((F.col("tag_name") == "td") & F.col("attributes").contains(CELL_ATTRIBUTES)).select("doc_id", "tag_id", "begin", "end")
    heads = tags.filter((F.col("tag_name") == "p") & (F.col("attributes") == TERM_ATTRIBUTES)).select("doc_id", "begin", "end")
    of_table = covered(bodies, cells).select("doc_id", F.col("o_tag_id").alias("table_id"), F.col("i_tag_id").alias("tag_id"), F.col("i_begin").alias("begin"), F.col("i_end").alias("end"))
    inside = covered(of_table, heads)
    first = inside.withColumn("_n", F.row_number().over(Window.partitionBy("doc_id", "o_table_id", "o_tag_id").orderBy("i_begin", "i_end"))).filter("_n = 1")
    own = first.join(texts.select("doc_id", F.col("text").alias("_text")), "doc_id").withColumn("raw", T.covered_text(F.col("_text"), F.col("i_begin"), F.col("i_end")))
    own = own.withColumn("term", F.lower(T.clean_term(F.col("raw")))).withColumn("at", T.offset_in(F.col("term"), F.col("raw"))).filter("at is not null and term <> ''")
    rows = own.select("doc_id", F.col("o_table_id").alias("table_id"), F.col("o_begin").alias("cell_begin"), F.col("o_end").alias("cell_end"), "term", (F.col("i_begin") + F.col("at.begin")).alias("begin"), (F.col("i_begin") + F.col("at.end")).alias("end"))
    return carried(rows, ["doc_id", "table_id"], "begin")


def table_annotations(tags: DataFrame, texts: DataFrame, spans: dict[str, DataFrame], score: float = -1.0) -> dict[str, DataFrame]:
    """The span tables token, defined, definition, paragraph, lemma after the tables' own terms took the place of what stood in them.

    Lemmas and dependencies that stood in a table stay.
    """
    bodies, found = term_tables(tags, texts), table_terms(tags, texts)
    out = {k: not_covered(v, bodies) if k in ("token", "defined", "definition", "paragraph") else v for k, v in spans.items()}
    add = {
        "token": found.select("doc_id", F.col("name").alias("term"), "begin", "end", F.lit(score).alias("score")),
        "defined": found.select("doc_id", "begin", "end"),
        "definition": found.select("doc_id", F.col("cell_begin").alias("begin"), F.col("cell_end").alias("end")),
        "lemma": found.select("doc_id", F.col("name").alias("value"), "begin", "end"),
    }
    return {k: v.unionByName(add[k].distinct(), allowMissingColumns=True) if k in add else v for k, v in out.items()}
