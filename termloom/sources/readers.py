"""Readers: annotated documents, glossaries, tag tables, lists, concept maps, requests. Schemas are explicit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom import schema
from termloom.functions import text as X
from termloom.operators.bio import forward_fill
from termloom.sources import rdf

TAG_SEPARATOR, GLOSSARY_SEPARATOR = "˳", "⬤"
_TAG = T.StructType([T.StructField(n, T.StringType()) for n in ("_tagName", "_attributes", "_begin", "_end", "_sofa")])
USER = ("_user", "_datetime", "_term", "_begin", "_end", "_sofa")
_SOFA = T.StructType([T.StructField(n, T.StringType()) for n in ("_id", "_sofaID", "_sofaString")])


def decode_requests(bodies: DataFrame, column: str = "value") -> DataFrame:
    """bodies with cas_content, content_type and xmi of JSON bodies; xmi is null where the content is no base64."""
    parsed = bodies.withColumn("_r", F.from_json(column, schema.REQUEST))
    content = F.regexp_replace("_r.cas_content", r"\s", "")
    valid = content.rlike("^[A-Za-z0-9+/]*={0,2}$") & (F.length(content) % 4 == 0)
    return parsed.select("*", "_r.cas_content", "_r.content_type", F.when(valid, F.unbase64(content).cast("string")).alias("xmi")).drop("_r")


def _xml(spark: SparkSession, path: str, row_tag: str, kind: T.StructType) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True).schema(kind).load(path).withColumn("path", F.input_file_name())


def read_xmi(spark: SparkSession, path: str, view: str = "html2textView") -> tuple[DataFrame, DataFrame]:
    """(docs, tags) of annotated documents, a file each: the view's text (with path and sofa), and its tag spans; doc_id is the file's hash.

    Element prefixes differ between files, so they are ignored; a directory or a glob reads many files.
    """
    sofas = _xml(spark, path, "Sofa", _SOFA).filter(F.col("_sofaID") == view)
    key = F.xxhash64("path").alias("doc_id")
    docs = sofas.select(key, F.lit(view).alias("view"), F.col("_sofaString").alias("text"), "path", F.col("_id").alias("sofa"))
    rows = _xml(spark, path, "ValueBetweenTagType", _TAG).join(docs.select("path", F.col("sofa").alias("_sofa"), "doc_id"), ["path", "_sofa"])
    begin, end = F.col("_begin").cast("long"), F.col("_end").cast("long")
    tags = rows.select("doc_id", F.xxhash64("path", "_begin", "_end", "_tagName", "_attributes").alias("tag_id"), F.col("_tagName").alias("tag_name"), F.col("_attributes").alias("attributes"), begin.alias("begin"), end.alias("end"))
    return docs, tags


def read_user_spans(spark: SparkSession, path: str, docs: DataFrame, element: str = "Token_user") -> DataFrame:
    """(doc_id, kind, user, datetime, term, begin, end) of user annotations of one element, of the view that docs (path, doc_id, sofa) are texts of."""
    kind = T.StructType([T.StructField(n, T.StringType()) for n in USER])
    rows = _xml(spark, path, element, kind).join(docs.select("path", "doc_id", F.col("sofa").alias("_sofa")), ["path", "_sofa"])
    return rows.select("doc_id", *_user_columns(element))


def _user_columns(element: str) -> list[Column]:
    return [F.lit(element).alias("kind"), F.col("_user").alias("user"), F.col("_datetime").alias("datetime"), F.col("_term").alias("term"), F.col("_begin").cast("long").alias("begin"), F.col("_end").cast("long").alias("end")]


def parse_xmi(requests: DataFrame, view: str = "html2textView", user_elements: Sequence[str] = ("Token_user", "DefinedTerm_user", "Definition_user"), element: str = "ValueBetweenTagType") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(docs, tags, user_spans) of a column xmi of requests (doc_id, xmi): read_xmi over texts that came with requests.

    Texts that are null, or lack the view, have no rows; broken ones are read as far as Spark's parser gets.
    """
    user = T.StructType([T.StructField(n, T.StringType()) for n in USER])
    kind = T.StructType([T.StructField("Sofa", T.ArrayType(_SOFA)), T.StructField(element, T.ArrayType(_TAG)), *(T.StructField(e, T.ArrayType(user)) for e in user_elements)])
    parsed = requests.select("doc_id", F.from_xml("xmi", kind, {"ignoreNamespace": "true"}).alias("x")).filter("x is not null")
    sofa = F.get(F.filter("x.Sofa", lambda s: s["_sofaID"] == view), F.lit(0))
    own = parsed.withColumn("sofa", sofa["_id"]).withColumn("text", sofa["_sofaString"]).filter("sofa is not null")
    docs = own.select("doc_id", F.lit(view).alias("view"), "text")
    number = lambda c: F.col(f"t.{c}").cast("long")
    tags = own.select("doc_id", F.explode(F.filter(F.col(f"x.{element}"), lambda t: t["_sofa"] == F.col("sofa"))).alias("t"))
    tags = tags.select("doc_id", F.xxhash64("doc_id", "t._begin", "t._end", "t._tagName", "t._attributes").alias("tag_id"), F.col("t._tagName").alias("tag_name"), F.col("t._attributes").alias("attributes"), number("_begin").alias("begin"), number("_end").alias("end"))
    spans = None
    for e in user_elements:
        rows = own.select("doc_id", F.explode(F.filter(F.col(f"x.{e}"), lambda t: t["_sofa"] == F.col("sofa"))).alias("t")).select("doc_id", "t.*").select("doc_id", *_user_columns(e))
        spans = rows if spans is None else spans.unionByName(rows)
    return docs, tags, spans


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """(term) of a list file, one a line; blank lines are ignored."""
    return spark.read.text(path).select(F.col("value").alias("term")).filter(F.trim("term") != "")


def read_tag_table(spark: SparkSession, path: str, sep: str = TAG_SEPARATOR) -> DataFrame:
    """(row, sentence, token, pos, tag) of a tag table, sentence ids filled forward; rows rise with a line's place in its file."""
    rows = spark.read.option("quote", "").option("sep", sep).schema(schema.BIO).csv(path, header=True)
    own = rows.select("*", F.input_file_name().alias("path"), F.monotonically_increasing_id().alias("row")).withColumnRenamed("Sentence #", "sentence")
    return forward_fill(own, "sentence", "row", ["path"], strided=True).select("row", "sentence", F.col("Word").alias("token"), F.col("POS").alias("pos"), F.col("Tag").alias("tag"))


def read_glossary(spark: SparkSession, path: str) -> DataFrame:
    """(name, definition, lemma, acceptance_state) of a glossary with a header; blanks are empty texts, cells may hold line feeds."""
    return spark.read.option("sep", GLOSSARY_SEPARATOR).option("multiLine", True).schema(schema.GLOSSARY).csv(path, header=True).na.fill("")


def read_term_list(spark: SparkSession, path: str) -> DataFrame:
    """(term, definition) of a plain list, definitions empty."""
    return read_list(spark, path).select("term", F.lit("").alias("definition"))


def read_triples(spark: SparkSession, path: str, broken: str = "fail") -> DataFrame:
    """(s, p, o, o_is_literal, o_lang) of N-Triples lines (and of Turtle with one whole triple a line); splits within files.

    Blank lines and comments are passed over; another line that is no triple is an error, or is left out with broken="drop".
    """
    pattern = r'^\s*(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(?:<([^>]*)>|(_:\S+)|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z0-9\-]+)|\^\^<[^>]*>)?)\s*\.\s*(?:#.*)?$'
    lines = spark.read.text(path).filter(~F.col("value").rlike(r"^\s*(?:#.*)?$"))
    fits = F.col("value").rlike(pattern)
    if broken == "fail":
        lines = lines.withColumn("value", F.when(fits, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("no triple: "), "value")).cast("string")))
    rows = lines.filter(F.col("value").rlike(pattern))
    part = lambda k: F.regexp_extract("value", pattern, k)
    literal = F.col("value").rlike(r'^\s*\S+\s+<[^>]*>\s+"')
    plain = F.replace(part(5), F.lit("\\\\"), F.lit("\0"))
    for code, char in (('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\0", "\\")):
        plain = F.replace(plain, F.lit(code), F.lit(char))
    subject = F.regexp_replace(part(1), "^<|>$", "")
    return rows.select(subject.alias("s"), part(2).alias("p"), F.when(literal, plain).otherwise(F.concat(part(3), part(4))).alias("o"), literal.alias("o_is_literal"), F.when(part(6) != "", part(6)).alias("o_lang"))


def read_rdf(spark: SparkSession, path: str, syntax: str | None = None) -> DataFrame:
    """(s, p, o, o_is_literal, o_lang) of RDF/XML or Turtle files, whole files each, in parallel; syntax "xml" or "turtle", else by the ending."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(lambda batches: rdf.parsed(batches, syntax), schema.TRIPLES).distinct()


def read_concepts(spark: SparkSession, path: str) -> DataFrame:
    """(uri, label) of a JSON file that maps URIs to lists of labels."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,array<string>>").alias("m"))
    return whole.select(F.explode("m").alias("uri", "labels")).select("uri", F.explode("labels").alias("label"))


def read_relations(spark: SparkSession, path: str) -> DataFrame:
    """(uri1, uri2, relation) of a JSON file that maps URIs to URIs to relations."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,map<string,string>>").alias("m"))
    return whole.select(F.explode("m").alias("uri1", "to")).select("uri1", F.explode("to").alias("uri2", "relation"))


def synset_labels(synsets: DataFrame) -> DataFrame:
    """(uri, label) of an exported synset table (offset, pos, names)."""
    rows = synsets.select(X.synset_id(F.col("offset"), F.col("pos")).alias("uri"), F.explode("names").alias("name"))
    return rows.select("uri", F.translate("name", "_", " ").alias("label"))


def read_column(spark: SparkSession, path: str, position: int = 1, first: int | None = None) -> DataFrame:
    """(idx, term): one column of a CSV file with a header, in the file's order; `first` rows only if it is given."""
    rows = spark.read.csv(path, header=True)
    own = rows.select(F.monotonically_increasing_id().alias("idx"), F.col(f"`{rows.columns[position]}`").cast("string").alias("term"))
    return own if first is None else own.orderBy("idx").limit(first)


def read_pairs(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """(a, b): two columns of a CSV file, rows without either left out."""
    rows = spark.read.csv(path, header=True).select(F.col(f"`{columns[0]}`").alias("a"), F.col(f"`{columns[1]}`").alias("b"))
    return rows.dropna(subset=["a", "b"])


def align_requests(bodies: DataFrame, column: str = "value") -> DataFrame:
    """bodies with one and two: the vocabularies of alignment requests; a single vocabulary is aligned with itself."""
    two, one = F.from_json(column, schema.ALIGN_TWO), F.from_json(column, schema.ALIGN_ONE)
    return bodies.select("*", F.coalesce(two["voc1"], one["voc"]).alias("one"), F.coalesce(two["voc2"], one["voc"]).alias("two"))


def echo_or(result: Column, content: Column) -> Column:
    """The result, or the input as it came where there is none."""
    return F.coalesce(result, content)
