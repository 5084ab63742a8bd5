"""Dictionary matches and quoted terms with exact offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions import text as T

#: a run of letters and joining marks, or one other character
PIECE = r"[\p{L}\-_+]+|[^\p{L}\-_+]"


def shuffled(df: DataFrame) -> DataFrame:
    """One side of a join whose tables both grow with the input: joined by a shuffle, never broadcast.

    Spark's size check goes by compressed files and takes exploded rows for none, so that millions of rows pass as a few MB and the
    driver's memory does not hold them.
    """
    return df.hint("merge")


def dictionary_matches(texts: DataFrame, terms: DataFrame, keys: list[str], term_keys: list[str] | None = None, most: int | None = None) -> DataFrame:
    """(keys, term, begin, end) of every bounded occurrence, nested and overlapping ones too, of terms in lower-cased texts.

    texts has keys and text; terms has term and, to restrict it, term_keys of the texts.  Texts are cut into pieces; at pieces that begin a term, as
    many are joined as the longest term has, so cost depends on the lengths of terms, not on how many there are, and the join is an
    equi-join.  Blank terms are ignored; upper-case terms never match.  most: pieces of the longest term, if that is known; else it is counted.
    Offsets come from a window by text: running sums inside the row, by higher-order functions, took more than twice as long when measured.
    """
    own, longest = _dictionary(terms, term_keys or [], most)
    if not longest:
        return texts.select(*keys, F.lit("").alias("term"), F.lit(0).cast("long").alias("begin"), F.lit(0).cast("long").alias("end")).limit(0)
    cut = texts.select(*keys, F.posexplode(_pieces(F.lower("text"))).alias("i", "p0"))
    order = Window.partitionBy(*keys).orderBy("i")
    placed = cut.withColumns({"stop": F.sum(F.length("p0").cast("long")).over(order), "before": F.lag("p0").over(order), **{f"p{k}": F.lead("p0", k).over(order) for k in range(1, longest + 1)}})
    hits = _looked_up(placed, own, longest, [*keys, (F.col("stop") - F.length("p0")).alias("begin")], [*keys, "begin"], term_keys or [])
    return hits.select(*keys, "term", "begin", (F.col("begin") + F.length("term")).alias("end"))


def dictionary_terms(texts: DataFrame, terms: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, term) of every such occurrence, without its place: pieces meet their neighbours inside the row, so only occurrences are shuffled, never pieces."""
    own, longest = _dictionary(terms, [], None)
    if not longest:
        return texts.select(*keys, F.lit("").alias("term")).limit(0)
    cut = texts.select(*keys, _pieces(F.lower("text")).alias("x"))
    after = [F.slice("x", k + 1, F.greatest(F.size("x"), F.lit(0))).alias(f"p{k}") for k in range(longest + 1)]
    zipped = F.arrays_zip(F.concat(F.array(F.lit(None).cast("string")), "x").alias("before"), *after)
    placed = cut.select(*keys, F.inline(zipped).alias("before", *(f"p{k}" for k in range(longest + 1)))).filter("p0 is not null")
    return _looked_up(placed, own, longest, list(keys), list(keys), []).select(*keys, "term").distinct()


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECE), 0)


def _dictionary(terms: DataFrame, term_keys: list[str], most: int | None) -> tuple[DataFrame, int]:
    """The distinct terms with their number of pieces and their first piece; how many pieces the longest has."""
    own = terms.filter(F.trim("term") != "").select(*term_keys, "term").distinct()
    parts = _pieces(F.col("term"))
    own = own.select("*", F.size(parts).alias("n_pieces"), F.get(parts, F.lit(0)).alias("first"))
    return own, (own.agg(F.max("n_pieces")).first()[0] or 0) if most is None else most


def _looked_up(placed: DataFrame, own: DataFrame, longest: int, columns: list, names: list[str], term_keys: list[str]) -> DataFrame:
    """(names, n_pieces, term) of terms that begin at pieces p0 with the piece before and the next ones p1 to p<longest>."""
    letters = lambda c: F.coalesce(c.rlike(r"^[\p{L}\-_+]"), F.lit(False))
    begun = placed.join(own.select("first").distinct(), F.col("p0") == F.col("first"), "left_semi").filter(~letters(F.col("before")))
    pieces = [F.col(f"p{k}") for k in range(longest + 1)]
    options = F.array(*[F.when(pieces[m - 1].isNotNull() & ~letters(pieces[m]), F.struct(F.lit(m).alias("n_pieces"), F.concat(*pieces[:m]).alias("term"))) for m in range(1, longest + 1)])
    found = begun.select(*columns, F.explode(F.array_compact(options)).alias("c")).select(*names, "c.n_pieces", "c.term")
    listed = own.drop("first")
    return found.join(shuffled(listed) if term_keys else listed, [*term_keys, "n_pieces", "term"])


def quoted_term_spans(definitions: DataFrame, terms: str, abbreviations: str) -> DataFrame:
    """(doc_id, def_id, term, begin, end) of quoted terms in definitions (doc_id, def_id, text)."""
    found = definitions.select("doc_id", "def_id", F.explode(T.quoted_terms(F.col("text"), terms, abbreviations)).alias("x"))
    return found.select("doc_id", "def_id", "x.term", "x.begin", "x.end")


def flexible_matches(rows: DataFrame, text: str, term: str) -> DataFrame:
    """rows with (match, begin, end, k): where a tokenised term stands in a text, bounded by non-letters, counted from 0."""
    plain = F.translate(F.col(text), " ", " ")
    spans = T.regex_spans(plain, T.flexible_pattern(F.col(term)))
    kept = F.filter(spans, lambda x: T.is_bounded(plain, x["begin"], x["end"], special=()))
    return rows.select("*", F.posexplode(kept).alias("k", "x")).select(*rows.columns, "k", "x.match", "x.begin", "x.end")
