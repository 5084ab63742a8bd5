"""Span tables: segments, containment, covering and overlap, always inside one document.

Joins are hash or sort-merge joins on the document with the range as a residual; `bucketed` adds a second equality on
character buckets, for documents with very many spans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions import text as T
from termloom.operators.matching import shuffled

BUCKET = 512


def _sided(df: DataFrame, prefix: str, key: str) -> DataFrame:
    return df.select(F.col(key).alias(key), *(F.col(c).alias(f"{prefix}{c}") for c in df.columns if c != key))


def covers(outer: str, inner: str) -> Column:
    """The inner span lies in the outer one (equal spans too)."""
    return (F.col(f"{inner}begin") >= F.col(f"{outer}begin")) & (F.col(f"{inner}end") <= F.col(f"{outer}end"))


def overlaps(a: str, b: str) -> Column:
    """The spans share a character; empty spans never do."""
    return (F.col(f"{a}begin") < F.col(f"{b}end")) & (F.col(f"{b}begin") < F.col(f"{a}end")) & (F.col(f"{a}begin") < F.col(f"{a}end")) & (F.col(f"{b}begin") < F.col(f"{b}end"))


def covered(outer: DataFrame, inner: DataFrame, key: str = "doc_id", bucketed: bool = False) -> DataFrame:
    """Each outer span with the spans in it; columns get the prefixes o_ and i_."""
    o, i = _sided(outer, "o_", key), _sided(inner, "i_", key)
    if bucketed:
        o = o.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("o_begin") / BUCKET), F.floor(F.greatest("o_begin", "o_end") / BUCKET))))
        i = i.withColumn("_bucket", F.floor(F.col("i_begin") / BUCKET))
        joined = o.join(shuffled(i), [key, "_bucket"]).drop("_bucket")
        return joined.filter(covers("o_", "i_"))
    return o.join(shuffled(i), key).filter(covers("o_", "i_"))


def covering(inner: DataFrame, outer: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each inner span with the spans that cover it."""
    return covered(outer, inner, key)


def _buckets(begin: str, end: str) -> Column:
    """The character buckets that a span touches."""
    return F.explode(F.sequence(F.floor(F.col(begin) / BUCKET), F.floor(F.greatest(begin, end) / BUCKET)))


def _matching(a: DataFrame, b: DataFrame, key: str, holds: Column, how: str, bucketed: bool) -> DataFrame:
    """Rows of a for which some row of b fulfils the condition (left_semi), or none does (left_anti).

    bucketed: spans meet in the character buckets that both touch, so a document with very many spans is not gone through pair by pair.
    """
    x, y = _sided(a, "a_", key), _sided(b.select(key, "begin", "end").distinct(), "b_", key).withColumnRenamed(key, "_key")
    if not bucketed:
        kept = x.join(y, (F.col(key) == F.col("_key")) & holds, how)
    else:
        spans = x.select(key, "a_begin", "a_end").distinct().withColumn("_bucket", _buckets("a_begin", "a_end"))
        other = y.withColumn("_b_bucket", _buckets("b_begin", "b_end"))
        met = spans.join(other, (F.col(key) == F.col("_key")) & (F.col("_bucket") == F.col("_b_bucket")) & holds, "left_semi").drop("_bucket").distinct()
        kept = x.join(met, [key, "a_begin", "a_end"], how)
    return kept.select(*(F.col(c if c == key else f"a_{c}").alias(c) for c in a.columns))


def overlapping(a: DataFrame, b: DataFrame, key: str = "doc_id", bucketed: bool = False) -> DataFrame:
    """Rows of a that share a character with a row of b."""
    return _matching(a, b, key, overlaps("a_", "b_"), "left_semi", bucketed)


def not_covered(inner: DataFrame, outer: DataFrame, key: str = "doc_id", bucketed: bool = False) -> DataFrame:
    """Rows of inner that lie in no row of outer (clearing what stands inside, e.g., tables)."""
    return _matching(inner, outer, key, covers("b_", "a_"), "left_anti", bucketed)


def in_larger(key: str = "doc_id", counts: Column | None = None) -> tuple[Column, Column]:
    """Two steps that tell which spans lie in a strictly larger one of the same key: `_reach` and, with that column there, the flag.

    In the order of begin and, backwards, end, a span lies in one before it if that ends no earlier; equal spans share the answer
    of the first of them.  counts: which rows can be the larger one.
    """
    order = Window.partitionBy(key).orderBy("begin", F.desc("end"))
    end = F.col("end") if counts is None else F.when(counts, F.col("end"))
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    least = F.min(F.coalesce(F.col("_reach"), F.lit(-1))).over(Window.partitionBy(key, "begin", "end"))
    return reach, least >= F.col("end")


def longest(spans: DataFrame, among: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """Spans that no strictly larger span of `among` (themselves) covers; equal spans do not count. One shuffle by key, no pairs."""
    rows = spans.withColumn("_own", F.lit(True))
    if among is not None:
        rows = rows.unionByName(among.select(key, "begin", "end").withColumn("_own", F.lit(False)), allowMissingColumns=True)
    reach, inside = in_larger(key, None if among is None else ~F.col("_own"))
    return rows.withColumn("_reach", reach).withColumn("_inside", inside).filter(F.col("_own") & ~F.col("_inside")).select(*spans.columns)


def without_equal(spans: DataFrame, others: DataFrame, keys: Sequence[str] = ("doc_id", "begin", "end")) -> DataFrame:
    """Rows whose span is not exactly one of others."""
    return spans.join(others.select(*keys).distinct(), list(keys), "left_anti")


def leaf_tags(tags: DataFrame, texts: DataFrame, names: Sequence[str] = ("p",)) -> DataFrame:
    """(doc_id, tag_id, begin, end, text): tags of the names with text and at most one such tag, themselves counted, inside.

    Of two tags with one span, both go; a tag whose inner ones are all empty stays. text is stripped.
    """
    own = tags.filter(F.col("tag_name").isin(list(names))).join(texts.select("doc_id", F.col("text").alias("_text")), "doc_id")
    own = own.select("doc_id", "tag_id", "begin", "end", T.strip(T.covered_text(F.col("_text"), F.col("begin"), F.col("end"))).alias("text"))
    full = own.filter(F.col("text") != "")
    inside = covered(full.select("doc_id", "tag_id", "begin", "end"), full.select("doc_id", "begin", "end")).groupBy("doc_id", "o_tag_id").agg(F.count("*").alias("n"))
    single = inside.filter("n <= 1").select("doc_id", F.col("o_tag_id").alias("tag_id"))
    return full.join(single, ["doc_id", "tag_id"], "left_semi")


def line_segments(docs: DataFrame) -> DataFrame:
    """(doc_id, seg_id, begin, end, text): the non-blank lines of plain texts, stripped, with the lines' offsets. No shuffle."""
    lines = docs.select("doc_id", F.split("text", "\n").alias("lines"))
    lengths = F.transform("lines", lambda x: F.length(x).cast("long") + 1)
    placed = F.zip_with("lines", T.running_totals(lengths), lambda t, b: F.struct(t.alias("t"), b.alias("begin")))
    at = lines.select("doc_id", F.posexplode(placed).alias("seg_id", "x")).select("doc_id", F.col("seg_id").cast("long").alias("seg_id"), "x.begin", F.col("x.t").alias("t"))
    return at.select("doc_id", "seg_id", "begin", (F.col("begin") + F.length("t")).alias("end"), T.strip(F.col("t")).alias("text")).filter("text <> ''")


def html_paragraphs(pages: DataFrame) -> DataFrame:
    """(page_id, tag_id, text) of the bare, closed p elements of raw pages, scripts taken out first; inner tags stay."""
    html = F.regexp_replace("html", r"(?is)<script.*?</script>", "")
    found = pages.select("page_id", F.posexplode(F.regexp_extract_all(html, F.lit(r"(?s)<p>(.*?)</p>"), 1)).alias("tag_id", "text"))
    return found.select("page_id", F.col("tag_id").cast("long"), T.strip(F.col("text")).alias("text")).filter("text <> ''")


def user_annotations(user_spans: DataFrame, tags: DataFrame, texts: DataFrame, users: Sequence[str] = ()) -> DataFrame:
    """(doc_id, tag_id, text, terms, annotated): definitions with the chosen users' terms, those with crossing terms left out.

    A span counts in a tag that contains it; two spans may touch, not cross. All users count if none are named.
    """
    chosen = user_spans.filter(F.col("user").isin(list(users))) if users else user_spans
    inside = covered(tags.select("doc_id", "tag_id", "begin", "end"), chosen.select("doc_id", "begin", "end").distinct())
    order = Window.partitionBy("doc_id", "o_tag_id").orderBy("i_begin", "i_end")
    marked = inside.withColumn("crosses", F.col("i_begin") < F.lag("i_end").over(order))
    grouped = marked.groupBy("doc_id", F.col("o_tag_id").alias("tag_id"), F.col("o_begin").alias("begin"), F.col("o_end").alias("end")).agg(
        F.max(F.coalesce("crosses", F.lit(False))).alias("bad"),
        F.array_sort(F.collect_list(F.struct((F.col("i_begin") - F.col("o_begin")).alias("begin"), (F.col("i_end") - F.col("o_begin")).alias("end")))).alias("spans"),
    )
    full = grouped.filter(~F.col("bad")).join(texts.select("doc_id", F.col("text").alias("_text")), "doc_id")
    own = full.withColumn("text", T.covered_text(F.col("_text"), F.col("begin"), F.col("end")))
    return own.select("doc_id", "tag_id", "text", F.transform("spans", lambda s: T.covered_text(F.col("text"), s["begin"], s["end"])).alias("terms"), T.mark_spans(F.col("text"), F.col("spans")).alias("annotated"))
