"""Registered queries over sources, sinks, functions and operators one by one, on derived rows with known results.

The tables hold no annotated documents, glossaries or parses, so both sides build the same ones; what goes through files is written to
the session's shared folder and read back.
"""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions import text as T
from termloom.functions import vectors as V
from termloom.functions.words import CONTRACTIONS, invalid_words
from termloom.operators import bio, defined, evaluate, glossary, matching, scoring, similarity, spans, tables
from termloom.plans import pipeline
from termloom.plans.registry import _PAIRS, _SEGMENTS, _SENTENCES, _TRIPLES, _UNIT, THRESHOLD, _list, _named_pairs, _segments, _sentences, _table, _triples, _vector_labels, _vectors, registered
from termloom.sources import readers, writers


def _folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; on one machine, without any, in a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _long(c: str) -> Column:
    return F.col(c).cast("long").alias(c)


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").withColumn("doc_id", F.col("p_partkey").cast("long"))


# Requests and annotated documents


def _bodies(docs: DataFrame) -> DataFrame:
    content = F.when(F.col("doc_id") % 10 == 0, "%%%").otherwise(F.base64(F.coalesce("text", F.lit("")).cast("binary")))
    return docs.select("doc_id", F.to_json(F.struct(content.alias("cas_content"), F.lit("html").alias("content_type"))).alias("value"))


@registered("select doc_id, 'html' as content_type, case when doc_id % 10 = 0 then null else coalesce(text, '') end as xmi from documents")
def decoded_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as request bodies, decoded; every tenth is no base64."""
    return readers.decode_requests(_bodies(_table(spark, sf_dir, "documents"))).select("doc_id", "content_type", "xmi")


@registered("select p_partkey as doc_id, string_split(p_name, ' ')[1] || '|' || string_split(p_name, ' ')[2] as one, case when p_partkey % 2 = 0 then string_split(p_name, ' ')[1] || '|' || string_split(p_name, ' ')[2] else p_type end as two from part")
def alignment_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as vocabularies of alignment requests, some with a second one."""
    words = F.split("p_name", " ")
    one, two = F.to_json(F.struct(words.alias("voc"))), F.to_json(F.struct(words.alias("voc1"), F.array("p_type").alias("voc2")))
    bodies = _part(spark, sf_dir).select("doc_id", F.when(F.col("doc_id") % 2 == 0, one).otherwise(two).alias("value"))
    return readers.align_requests(bodies).select("doc_id", F.array_join("one", "|").alias("one"), F.array_join("two", "|").alias("two"))


def _xmi(name: Column, key: Column) -> Column:
    """An annotated text: two views, a paragraph and a word tagged in the first one, one in the other, and users' spans."""
    head = '<?xml version="1.0" encoding="UTF-8"?><xmi:XMI xmlns:xmi="http://www.omg.org/XMI" xmlns:cas="http:///uima/cas.ecore" xmlns:t="http:///t.ecore" xmi:version="2.0"><cas:Sofa xmi:id="1" sofaNum="1" sofaID="html2textView" mimeType="text" sofaString="'
    tag = lambda i, sofa, b, e, n, a: F.concat(F.lit(f'<t:ValueBetweenTagType xmi:id="{i}" sofa="{sofa}" begin="{b}" end="'), e.cast("string"), F.lit(f'" tagName="{n}" attributes="{a}"/>'))
    user = lambda i, sofa, who: F.concat(F.lit(f'<t:Token_user xmi:id="{i}" sofa="{sofa}" user="'), who, F.lit('" datetime="2020" term="x" begin="0" end="'), F.length(F.substring_index(name, " ", 1)).cast("string"), F.lit('"/>'))
    other = '"/><cas:Sofa xmi:id="2" sofaNum="2" sofaID="other" sofaString="y z"/>'
    members = '<cas:View sofa="1" members="3 4 6"/><cas:View sofa="2" members="5 7"/></xmi:XMI>'
    who = F.concat(F.lit("u"), (key % 3).cast("string"))
    return F.concat(F.lit(head), name, F.lit(other), tag(3, 1, 0, F.length(name), "p", "class='a'"), tag(4, 1, 0, F.length(F.substring_index(name, " ", 1)), "b", ""), tag(5, 2, 0, F.lit(1), "p", ""), user(6, 1, who), user(7, 2, F.lit("other")), F.lit(members))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part(spark, sf_dir).select("doc_id", _xmi(F.col("p_name"), F.col("p_partkey")).alias("xmi"))


_WORD = "length(string_split(p_name, ' ')[1])"


@registered(f"""select p_partkey as doc_id, 'p' as tag_name, 'class=''a''' as attributes, cast(0 as bigint) as "begin", cast(length(p_name) as bigint) as "end" from part
union all select p_partkey, 'b', '', 0, {_WORD} from part""")
def xmi_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tags of annotated texts that came as a column, of one view."""
    return readers.parse_xmi(_requests(spark, sf_dir))[1].drop("tag_id")


@registered("select p_partkey as doc_id, 'html2textView' as view, p_name as text from part")
def xmi_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of annotated documents."""
    return readers.parse_xmi(_requests(spark, sf_dir))[0]


@registered(f"""select p_partkey as doc_id, 'Token_user' as kind, 'u' || (p_partkey % 3) as "user", '2020' as datetime, 'x' as term, cast(0 as bigint) as "begin", cast({_WORD} as bigint) as "end" from part""")
def xmi_user_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' annotations of one view."""
    return readers.parse_xmi(_requests(spark, sf_dir))[2]


def _xmi_files(spark: SparkSession, sf_dir: str) -> str:
    """A glob of annotated files, one a nation."""
    path = _folder(spark, "annotated")
    rows = _table(spark, sf_dir, "nation").select(_xmi(F.concat_ws(" ", F.lower("n_name"), F.lit("x")), F.col("n_nationkey")).alias("value"), F.col("n_nationkey").cast("int").alias("k"))
    rows.repartition(8, "k").write.partitionBy("k").text(path)
    return f"{path}/k=*/*.txt"


@registered("""select lower(n_name) || ' x' as text, 'p' as tag_name, cast(length(n_name) + 2 as bigint) as "end" from nation union all select lower(n_name) || ' x', 'b', length(n_name) from nation""")
def xmi_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and tags of many annotated files."""
    docs, tags = readers.read_xmi(spark, _xmi_files(spark, sf_dir))
    return tags.join(docs.select("doc_id", "text"), "doc_id").select("text", "tag_name", "end")


@registered("""select 'u' || (n_nationkey % 3) as "user", count(*) as n, cast(sum(length(n_name)) as bigint) as chars from nation group by 1""")
def user_span_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' annotations of many files, by user."""
    path = _xmi_files(spark, sf_dir)
    found = readers.read_user_spans(spark, path, readers.read_xmi(spark, path)[0])
    return found.groupBy("user").agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("begin")).alias("chars"))


@registered(f"""select p_partkey as doc_id, cast({_WORD} + 1 as bigint) as "begin", cast(length(p_name) as bigint) as "end", string_split(p_name, ' ')[2] as term, -1.0 as score, 'html' as content_type from part""")
def annotated_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans written into annotated texts, sent as responses, and read back from these."""
    rows = _part(spark, sf_dir)
    second = F.length(F.substring_index("p_name", " ", 1)).cast("long") + 1
    tokens = rows.select("doc_id", F.get(F.split("p_name", " "), F.lit(1)).alias("term"), second.alias("begin"), F.length("p_name").cast("long").alias("end"), F.lit(-1.0).alias("score"))
    requests = _requests(spark, sf_dir).withColumns({"cas_content": F.lit("x"), "content_type": F.lit("html")})
    sent = readers.decode_requests(writers.responses(requests, {"token": tokens, "defined": tokens.select("doc_id", "begin", "end")}))
    element = F.regexp_extract_all("xmi", F.lit("<tl:Tfidf [^>]*>"), 0)
    one = sent.select("doc_id", "content_type", F.explode(element).alias("e"))
    value = lambda name: F.regexp_extract("e", f' {name}="([^"]*)"', 1)
    return one.select("doc_id", value("begin").cast("long").alias("begin"), value("end").cast("long").alias("end"), value("term").alias("term"), value("tfidfValue").cast("double").alias("score"), "content_type")


@registered()
def service_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests answered as the service does: decoded, parsed, annotated, written back (no SQL: tests hold the stages)."""
    bodies = _requests(spark, sf_dir).select(F.to_json(F.struct(F.base64(F.col("xmi").cast("binary")).alias("cas_content"), F.lit("html").alias("content_type"))).alias("value"))
    words = spark.sql("select * from values ('anvil'), ('red ring') as w(term)")
    return pipeline.answer_requests(bodies, words, words.filter("term = 'red ring'"), store=pipeline.stored_in(_folder(spark, "service")))


# Files


@registered("select s_name as term from supplier")
def list_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list file with blank lines."""
    path = _folder(spark, "list")
    lines = _table(spark, sf_dir, "supplier").select(F.explode(F.array("s_name", F.when(F.col("s_suppkey") % 3 == 0, " ").otherwise(""))).alias("value"))
    lines.write.text(path)
    return readers.read_list(spark, path)


@registered("select s_name as term, '' as definition from supplier")
def term_list_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain list as a glossary."""
    path = _folder(spark, "terms")
    _table(spark, sf_dir, "supplier").select("s_name").write.text(path)
    return readers.read_term_list(spark, path)


@registered(f"""with {_SENTENCES} select 'Sentence: ' || (sent_id + 1) as sentence, token, '--' as pos, tag, count(*) as n from tags group by all""")
def tag_table_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training table written and read back, sentence ids filled forward."""
    path = _folder(spark, "tags")
    writers.write_tag_table(bio.bio_tags(_sentences(spark, sf_dir)), path)
    return readers.read_tag_table(spark, path).groupBy("sentence", "token", "pos", "tag").agg(F.count("*").alias("n"))


@registered("select p_name as name, case when p_partkey % 4 = 0 then '' else p_type || chr(10) || p_brand end as definition, p_type as lemma, 'Accepted' as acceptance_state from part")
def glossary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A glossary file with empty cells and line feeds."""
    path = _folder(spark, "glossary")
    definition = F.when(F.col("p_partkey") % 4 == 0, "").otherwise(F.concat("p_type", F.lit("\n"), "p_brand"))
    rows = _table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), definition.alias("definition"), F.col("p_type").alias("lemma"), F.lit("Accepted").alias("acceptance_state"))
    rows.write.option("sep", readers.GLOSSARY_SEPARATOR).option("quoteAll", True).csv(path, header=True)
    return readers.read_glossary(spark, path)


@registered(f"with {_TRIPLES} select s, p, o, lit as o_is_literal from triples")
def triple_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples written as lines and read back."""
    path = _folder(spark, "triples")
    writers.write_triples(_triples(spark, sf_dir), path)
    return readers.read_triples(spark, path).drop("o_lang")


def _one_text(lines: DataFrame, path: str, head: str, tail: str) -> None:
    """A file of a head, a few lines and a tail."""
    text = lines.agg(F.concat(F.lit(head), F.array_join(F.array_sort(F.collect_list("value")), "\n"), F.lit(tail)).alias("value"))
    text.coalesce(1).write.option("lineSep", "\n").text(path)


@registered(f"with {_TRIPLES} select s, p, o, lit as o_is_literal from triples")
def rdf_xml_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triples of nations as an RDF/XML file, read."""
    path = _folder(spark, "rdf")
    prefixed = F.regexp_replace(F.regexp_replace("p", f"^{glossary.SKOS}", "skos:"), "^.*22-rdf-syntax-ns#", "rdf:")
    value = F.when(F.col("o_is_literal"), F.concat(F.lit(">"), F.replace("o", F.lit("&"), F.lit("&amp;")), F.lit("</"), prefixed, F.lit(">"))).otherwise(F.concat(F.lit(' rdf:resource="'), F.col("o"), F.lit('"/>')))
    lines = _triples(spark, sf_dir).select(F.concat(F.lit('<rdf:Description rdf:about="'), "s", F.lit('"><'), prefixed, value, F.lit("</rdf:Description>")).alias("value"))
    _one_text(lines, path, f'<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:skos="{glossary.SKOS}">\n', "\n</rdf:RDF>")
    return readers.read_rdf(spark, path, "xml").drop("o_lang")


@registered(f"with {_TRIPLES} select s, p, o, lit as o_is_literal from triples")
def turtle_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triples of nations as a Turtle file of one statement a subject, read."""
    path = _folder(spark, "turtle")
    own = _triples(spark, sf_dir).withColumn("o", F.when(F.col("o_is_literal"), F.concat(F.lit('"""'), F.replace("o", F.lit('"'), F.lit('\\"')), F.lit('"""'))).otherwise(F.concat(F.lit("<"), F.col("o"), F.lit(">"))))
    named = F.when(F.col("p") == glossary.TYPE, "a").otherwise(F.regexp_replace("p", f"^{glossary.SKOS}", "skos:"))
    lines = own.groupBy("s", named.alias("p")).agg(F.array_join(F.array_sort(F.collect_list("o")), " , ").alias("o")).groupBy("s").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "p", "o"))), " ;\n  ").alias("po"))
    _one_text(lines.select(F.concat(F.lit("<"), "s", F.lit("> "), "po", F.lit(" .")).alias("value")), path, f"@prefix skos: <{glossary.SKOS}> . # nations\n", "\n")
    return readers.read_rdf(spark, path, "turtle").drop("o_lang")


@registered("select 'r' || n_regionkey as uri, n_name as label from nation")
def concept_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON map of regions to their nations."""
    path = _folder(spark, "concepts")
    own = _table(spark, sf_dir, "nation").groupBy(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("uri")).agg(F.collect_list("n_name").alias("labels"))
    own.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("uri", "labels")))).alias("value")).coalesce(1).write.text(path)
    return readers.read_concepts(spark, path)


@registered("select 'n' || a.n_nationkey as uri1, 'n' || b.n_nationkey as uri2, case when a.n_nationkey < b.n_nationkey then 'narrower' else 'broader' end as relation from nation a join nation b on a.n_regionkey = b.n_regionkey and a.n_nationkey <> b.n_nationkey")
def relation_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON map of nations to those of their region."""
    path = _folder(spark, "relations")
    n = _table(spark, sf_dir, "nation")
    pairs = n.select("n_regionkey", F.col("n_nationkey").alias("a")).join(n.select("n_regionkey", F.col("n_nationkey").alias("b")), "n_regionkey").filter("a <> b")
    name = lambda c: F.concat(F.lit("n"), F.col(c).cast("string"))
    own = pairs.groupBy(name("a").alias("k")).agg(F.map_from_entries(F.collect_list(F.struct(name("b"), F.when(F.col("a") < F.col("b"), "narrower").otherwise("broader")))).alias("m"))
    own.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("k", "m")))).alias("value")).coalesce(1).write.text(path)
    return readers.read_relations(spark, path)


@registered("select printf('%08d-n', p_partkey) as uri, unnest([p_name, p_type]) as label from part")
def synset_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as an exported table of synsets."""
    rows = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("offset"), F.lit("n").alias("pos"), F.array(F.translate("p_name", " ", "_"), "p_type").alias("names"))
    return readers.synset_labels(rows)


@registered("select c_name as term from customer order by c_custkey limit 7")
def column_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of a column of a CSV file."""
    path = _folder(spark, "column")
    _table(spark, sf_dir, "customer").select("c_custkey", "c_name").coalesce(1).sortWithinPartitions("c_custkey").write.csv(path, header=True)
    return readers.read_column(spark, path, 1, 7).select("term")


@registered("select p_name as a, p_type as b from part where p_partkey % 5 <> 0 and p_partkey % 7 <> 0")
def pair_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of a CSV file, rows without either left out."""
    path = _folder(spark, "pairs")
    key = F.col("p_partkey")
    _table(spark, sf_dir, "part").select(F.when(key % 5 != 0, F.col("p_name")).alias("one"), key.alias("k"), F.when(key % 7 != 0, F.col("p_type")).alias("two")).write.csv(path, header=True)
    return readers.read_pairs(spark, path, ["one", "two"])


_SPAN = """select p_partkey as doc_id, p_type as term, cast(p_partkey % 9 as bigint) as "begin", cast(p_partkey % 9 + p_size as bigint) as "end" from part"""


@registered(f"select 'token' as kind, * from ({_SPAN}) union all select 'lemma', doc_id, lower(term), \"begin\", \"end\" from ({_SPAN})")
def span_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Span tables written, a folder a kind, and read as one table."""
    path = _folder(spark, "spans")
    own = _part(spark, sf_dir).select("doc_id", F.col("p_type").alias("term"), (F.col("doc_id") % 9).alias("begin"), (F.col("doc_id") % 9 + F.col("p_size")).cast("long").alias("end"))
    writers.write_spans({"token": own, "lemma": own.withColumn("term", F.lower("term"))}, path)
    return spark.read.parquet(path)


@registered(f"with {_UNIT}, r as (select a.vec_id as q, b.vec_id as m, list_dot_product(a.v, b.v) as sim, row_number() over (partition by a.vec_id order by list_dot_product(a.v, b.v) desc, b.vec_id) as rank from e a, e b where a.vec_id <> b.vec_id) select q as query, m || '; ' || rank || '; ' || printf('%.4f', sim) as value from r where rank <= 3")
def similar_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The similar ones of each vector as text lines."""
    v = _vectors(spark, sf_dir)
    return writers.similar_lines(similarity.top_k(v, v, 3))


@registered(f"with {_PAIRS} select 'v' || query as query, string_agg('v' || match, ',' order by sim desc, 'v' || match) as matches from pairs where query <> match group by 1")
def response_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similar terms as a map, best first."""
    return writers.response_map(_named_pairs(spark, sf_dir)).select("query", F.array_join("matches", ",").alias("matches"))


# Functions

_clean_sql = "lower(replace(replace(line, chr(160), ' '), '’', ''''))"
for _short, _whole in CONTRACTIONS:
    _clean_sql = f"replace({_clean_sql}, '{_short.replace(chr(39), chr(39) * 2)}', '{_whole}')"


@registered(f"with l as (select p_partkey as doc_id, 'It''s ' || p_name || ', they’re' || chr(160) || p_type || ' that can''t' as line from part) select doc_id, {_clean_sql} as text from l")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contractions written out."""
    line = F.concat(F.lit("It's "), "p_name", F.lit(", they’re\xa0"), "p_type", F.lit(" that can't"))
    return _part(spark, sf_dir).select("doc_id", T.clean_text(line).alias("text"))


@registered(f'with {_SEGMENTS} select s.doc_id, seg_id, regexp_replace(substr(d.text, cast("begin" as bigint) + 1, cast("end" - "begin" as bigint)), \'^\\s+|\\s+$\', \'\', \'g\') as text from segments s join documents d using (doc_id)')
def covered_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the lines' offsets cover."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("whole"))
    return _segments(spark, sf_dir).join(docs, "doc_id").select("doc_id", "seg_id", T.strip(T.covered_text(F.col("whole"), F.col("begin"), F.col("end"))).alias("text"))


@registered("""with r as (select p_partkey as doc_id, p_name as hay, case when p_partkey % 3 = 0 then 'zz' else upper(string_split(p_name, ' ')[2]) end as needle from part)
select doc_id, cast(instr(hay, lower(needle)) - 1 as bigint) as "begin", cast(instr(hay, lower(needle)) - 1 + length(needle) as bigint) as "end" from r where instr(hay, lower(needle)) > 0""")
def offset_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a word stands in a name, ignoring case."""
    needle = F.when(F.col("doc_id") % 3 == 0, "zz").otherwise(F.upper(F.get(F.split("p_name", " "), F.lit(1))))
    return _part(spark, sf_dir).select("doc_id", T.offset_in(needle, F.col("p_name")).alias("x")).filter("x is not null").select("doc_id", "x.begin", "x.end")


def _steps_sql() -> str:
    steps = ("lower({x})", "trim({x})", "replace({x}, '  ', ' ')", "replace({x}, ' ', '_')", "replace({x}, '__', '_')")
    rows = "select p_partkey, ' ' || upper(p_name) || '  ' || p_type || ' ' as x from part"
    for k, f in enumerate(steps):
        rows = f"select p_partkey, case when (p_partkey >> {k}) % 2 = 1 then {f.format(x='x')} else x end as x from ({rows})"
    return f"select p_partkey, x as word, reverse(x) as backwards from ({rows})"


@registered(_steps_sql())
def word_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each choice of the steps of word preprocessing, and the words reversed."""
    raw = F.concat(F.lit(" "), F.upper("p_name"), F.lit("  "), "p_type", F.lit(" "))
    rows = _table(spark, sf_dir, "part").select("p_partkey", T.with_steps(raw, F.col("p_partkey") % 32).alias("word"))
    return rows.withColumn("backwards", F.reverse("word"))


@registered("select p_partkey as doc_id, array_to_string(list_transform(string_split(p_name, ' '), lambda w: case w when 'anvil' then 'tool' when 'red' then 'colour' else w end), ' ') as value from part")
def lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names by a table of lemmas."""
    lookup = F.create_map(F.lit("anvil"), F.lit("tool"), F.lit("red"), F.lit("colour"))
    return _part(spark, sf_dir).select("doc_id", T.lemmas(F.split("p_name", " "), lookup).alias("value"))


@registered("select p_partkey as doc_id, case when p_partkey % 2 = 0 then p_name else 'the ' || p_name end as kept from part")
def determiners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A leading determiner taken off; other words stay."""
    tokens = F.concat(F.array(F.lit("the")), F.split("p_name", " "))
    pos = F.concat(F.array(F.when(F.col("doc_id") % 2 == 0, "DET").otherwise("NOUN")), F.array(F.lit("DET"), F.lit("NOUN")))
    return _part(spark, sf_dir).select("doc_id", F.array_join(T.drop_determiner(tokens, pos), " ").alias("kept"))


@registered("select p_partkey as doc_id, case p_partkey % 4 when 0 then p_name when 1 then p_name when 2 then null else null end as term from part")
def tagger_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tagger's terms without marks; unknown tokens inside and mere marks give none."""
    key, name = F.col("doc_id") % 4, F.col("p_name")
    raw = F.when(key == 0, F.concat(F.lit("‘ "), name, F.lit(" ’ ."))).when(key == 1, F.concat(F.lit("[UNK] "), name)).when(key == 2, F.regexp_replace(name, " ", " [UNK] ")).otherwise(F.lit(" ( ’ "))
    return _part(spark, sf_dir).select("doc_id", T.tagger_term(raw).alias("term"))


@registered("""with r as (select p_partkey as doc_id, upper(p_name) || ' x ' || replace(p_name, ' ', chr(10)) as text, p_name from part)
select doc_id, cast(0 as bigint) as k, upper(p_name) as match, cast(0 as bigint) as "begin", cast(length(p_name) as bigint) as "end" from r
union all select doc_id, 1, replace(p_name, ' ', chr(10)), length(p_name) + 3, 2 * length(p_name) + 3 from r""")
def flexible_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokenised names in texts with other blanks and another case."""
    rows = _part(spark, sf_dir).select("doc_id", F.concat(F.upper("p_name"), F.lit(" x "), F.translate("p_name", " ", "\n")).alias("text"), F.col("p_name").alias("term"))
    return matching.flexible_matches(rows, "text", "term").select("doc_id", _long("k"), "match", "begin", "end")


@registered("""select vec_id, list_position(embedding, list_max(embedding)) - 1 as best, array_to_string(list_transform(range(5), lambda i: case when i < vec_id % 7 then vec_id + i else 0 end), ',') as ids,
array_to_string(list_transform(range(5), lambda i: case when i < vec_id % 7 and vec_id + i > 0 then 1 else 0 end), ',') as mask from embeddings""")
def classifier_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of a vector's largest number; sequences cut or filled, and where they hold tokens."""
    n = (F.col("vec_id") % 7).cast("int")
    ids = F.when(n > 0, F.sequence(F.col("vec_id"), F.col("vec_id") + n - 1)).otherwise(F.array().cast("array<bigint>"))
    filled = V.padded(ids, 5)
    shown = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return _vectors(spark, sf_dir).select("vec_id", V.argmax(F.col("embedding")).cast("long").alias("best"), shown(filled).alias("ids"), shown(V.attention_mask(filled)).alias("mask"))


@registered(f"""with {_UNIT}, pairs as (select a.vec_id as idx, list_transform(list_zip(a.v, b.v), lambda p: (p[1] + p[2]) / 2) as m from e a join e b on b.vec_id = a.vec_id + 1)
select idx, cast(unnest(range(64)) as bigint) as at, round(unnest(list_transform(m, lambda x: x / sqrt(list_dot_product(m, m)))), 4) + 0.0 as x from pairs""")
def phrase_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of two words as the means of their vectors."""
    name = lambda c: F.concat(F.lit("w"), c.cast("string"))
    v = _vectors(spark, sf_dir)
    words = v.select(name(F.col("vec_id")).alias("word"), "embedding")
    last = v.select((F.col("vec_id") - 1).alias("vec_id"))
    terms = v.join(last, "vec_id", "left_semi").select(F.col("vec_id").alias("idx"), F.concat_ws("_", name(F.col("vec_id")), name(F.col("vec_id") + 1)).alias("term"))
    return similarity.phrase_vectors(terms, words).select("idx", F.posexplode("embedding").alias("at", "x")).select("idx", _long("at"), (F.round("x", 4) + 0.0).alias("x"))


# Tags, tables and users' annotations


def _tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as p, under a p of the whole document and among other tags."""
    lines = _segments(spark, sf_dir).select("doc_id", F.col("seg_id").alias("tag_id"), F.when(F.col("seg_id") % 5 == 4, "td").otherwise("p").alias("tag_name"), F.lit("").alias("attributes"), "begin", "end")
    whole = _table(spark, sf_dir, "documents").select("doc_id", F.lit(-1).cast("long").alias("tag_id"), F.lit("p").alias("tag_name"), F.lit("").alias("attributes"), F.lit(0).cast("long").alias("begin"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("end"))
    return lines.unionByName(whole)


@registered(f"""with {_SEGMENTS}, t as (select doc_id, seg_id as tag_id, "begin", "end", text from segments where seg_id % 5 <> 4 union all select doc_id, -1, 0, length(text), regexp_replace(text, '^\\s+|\\s+$', '', 'g') from documents where regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> ''),
n as (select a.doc_id, a.tag_id, count(*) as n from t a join t b on b.doc_id = a.doc_id and b."begin" >= a."begin" and b."end" <= a."end" group by 1, 2)
select t.doc_id, cast(t.tag_id as bigint) as tag_id, cast(t."begin" as bigint) as "begin", cast(t."end" as bigint) as "end", t.text from t join n on n.doc_id = t.doc_id and n.tag_id = t.tag_id where n.n <= 1""")
def leaf_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as tags under a tag of the whole document: those that hold no other."""
    return spans.leaf_tags(_tags(spark, sf_dir), _table(spark, sf_dir, "documents").select("doc_id", "text"))


def _term_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A table of two cells a name: a header, an enumerated term, and one that goes on from it; every sixth lacks the known header."""
    rows = _part(spark, sf_dir)
    header = F.when(F.col("doc_id") % 6 == 0, "Other heading").otherwise(tables.HEADER_TEXT)
    one, two = F.concat(F.lit("1.1. "), F.initcap("p_name")), F.concat(F.lit("of which "), "p_type")
    rows = rows.select("doc_id", F.concat_ws("\n", header, one, two).alias("text"), F.length(header).cast("long").alias("h"), F.length(one).cast("long").alias("a"), F.length(two).cast("long").alias("b"))
    h, a, b = F.col("h"), F.col("h") + 1 + F.col("a"), F.col("h") + F.col("a") + F.col("b") + 2
    zero = F.lit(0).cast("long")
    cells = [("tbody", "", zero, b), ("p", tables.HEADER_ATTRIBUTES, zero, h), ("td", tables.CELL_ATTRIBUTES, h + 1, a), ("p", tables.TERM_ATTRIBUTES, h + 1, a), ("td", tables.CELL_ATTRIBUTES, a + 1, b), ("p", tables.TERM_ATTRIBUTES, a + 1, b)]
    each = F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("tag_id"), F.lit(n).alias("tag_name"), F.lit(t).alias("attributes"), x.alias("begin"), y.alias("end")) for k, (n, t, x, y) in enumerate(cells)]))
    return rows.select("doc_id", each.alias("t")).select("doc_id", "t.*"), rows.select("doc_id", "text")


_TABLES = f"""t as (select p_partkey as doc_id, lower(p_name) as term, lower('of which ' || p_type) as next, {len(tables.HEADER_TEXT)} as h, length(p_name) as n, length(p_type) + 9 as m from part where p_partkey % 6 <> 0)"""


@registered(f"""with {_TABLES} select doc_id, term, term as name, cast(h + 6 as bigint) as "begin", cast(h + 6 + n as bigint) as "end" from t
union all select doc_id, next, term || ' ' || next, h + 7 + n, h + 7 + n + m from t""")
def table_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The terms of tables with a known header."""
    return tables.table_terms(*_term_table(spark, sf_dir)).select("doc_id", "term", "name", "begin", "end")


@registered(f"""with {_TABLES}, own as (select doc_id, cast(h + 1 as bigint) as "begin", cast(h + 6 + n as bigint) as "end" from t union all select doc_id, h + 7 + n, h + 7 + n + m from t)
select doc_id, "begin", "end" from own union all select p_partkey, 0, 3 from part where p_partkey % 6 = 0 union all select p_partkey, 900, 903 from part""")
def table_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions after tables' cells took the place of what stood in them; what stands outside stays."""
    tags, texts = _term_table(spark, sf_dir)
    at = lambda b: texts.select("doc_id", F.lit(b).cast("long").alias("begin"), F.lit(b + 3).cast("long").alias("end"))
    return tables.table_annotations(tags, texts, {"definition": at(0).unionByName(at(900))})["definition"]


def _user_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Names as tags; each word is a user's span, and in every fifth one that crosses both."""
    rows = _part(spark, sf_dir)
    n, whole = F.length(F.substring_index("p_name", " ", 1)).cast("long"), F.length("p_name").cast("long")
    span = lambda u, b, e: F.struct(F.concat(F.lit("u"), u.cast("string")).alias("user"), b.cast("long").alias("begin"), e.cast("long").alias("end"))
    key = F.col("doc_id") % 3
    marks = F.array(span(key, F.lit(0), n), span(key, n + 1, whole), F.when(F.col("doc_id") % 5 == 0, span(key, F.lit(1), whole)))
    users = rows.select("doc_id", F.explode(F.array_compact(marks)).alias("x")).select("doc_id", "x.*")
    tags = rows.select("doc_id", F.lit(0).cast("long").alias("tag_id"), F.lit(0).cast("long").alias("begin"), whole.alias("end"))
    return users, tags, rows.select("doc_id", F.col("p_name").alias("text"))


@registered("""select p_partkey as doc_id, cast(0 as bigint) as tag_id, p_name as text, replace(p_name, ' ', '|') as terms, ' ★ ' || string_split(p_name, ' ')[1] || ' ☆   ★ ' || string_split(p_name, ' ')[2] || ' ☆ ' as annotated
from part where p_partkey % 5 <> 0 and p_partkey % 3 in (0, 2)""")
def user_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two users' terms in names, those with crossing terms left out."""
    found = spans.user_annotations(*_user_tables(spark, sf_dir), users=("u0", "u2"))
    return found.select("doc_id", "tag_id", "text", F.array_join("terms", "|").alias("terms"), "annotated")


@registered("select 'terms' as kind, unnest(string_split(p_name, ' ')) as value from part where p_partkey % 5 <> 0 union all select 'definitions', p_name from part where p_partkey % 5 <> 0 union all select 'annotated', ' ★ ' || replace(p_name, ' ', ' ☆   ★ ') || ' ☆ ' from part where p_partkey % 5 <> 0")
def training_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All users' terms, definitions and marked definitions, written and read back."""
    path = _folder(spark, "texts")
    writers.write_annotated(spans.user_annotations(*_user_tables(spark, sf_dir)), path)
    read = lambda kind: spark.read.text(f"{path}/{kind}").select(F.lit(kind).alias("kind"), "value")
    return read("terms").unionByName(read("definitions")).unionByName(read("annotated"))


@registered("select token, 'B' as tag, count(*) as n from (select unnest(string_split(p_name, ' ')) as token from part where p_partkey % 5 <> 0) group by token")
def training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' terms as tagged tokens."""
    users, tags, texts = _user_tables(spark, sf_dir)
    return pipeline.training_data(users, tags, texts).groupBy("token", "tag").agg(F.count("*").alias("n"))


# Sequence tags


@registered(f"with {_SENTENCES} select sent_id, string_agg(token, ' ' order by pos) as words, string_agg(tag, ' ' order by pos) as tags from tags group by sent_id")
def tag_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged tokens gathered by sentence."""
    found = bio.sentences_of(bio.bio_tags(_sentences(spark, sf_dir)), "sent_id", "pos")
    return found.select("sent_id", F.array_join("words", " ").alias("words"), F.array_join("tags", " ").alias("tags"))


@registered(f"""with {_SENTENCES} select sent_id, cast(pos as bigint) as place, case when pos = 0 then 'Sentence: ' || (sent_id + 1) else '' end as sentence, token as word, tag from tags where pos < 5""")
def tag_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training tables cut after five tokens."""
    found = bio.tag_table(bio.bio_tags(_sentences(spark, sf_dir)), most=5)
    return found.select("sent_id", _long("place"), F.col("Sentence #").alias("sentence"), F.col("Word").alias("word"), F.col("Tag").alias("tag"))


def _name_sentences(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sentences about names, twice each, and their tokens, of which those of the second name are tagged."""
    rows = _part(spark, sf_dir).select(F.col("doc_id").alias("sent_id"), F.concat_ws("", F.lit("The "), "p_name", F.lit(" is no\n"), F.initcap("p_name"), F.lit(".")).alias("text"), "p_name")
    words = F.split("p_name", " ")
    tokens = F.concat(F.array(F.lit("the")), words, F.array(F.lit("is"), F.lit("no")), words, F.array(F.lit(".")))
    tagged = rows.select("sent_id", F.posexplode(tokens).alias("pos", "token")).withColumn("tag", F.when(F.col("pos") == 5, "B").when(F.col("pos") == 6, "I").otherwise("O"))
    return rows.select("sent_id", "text"), tagged


@registered("""select p_partkey as sent_id, upper(left(p_name, 1)) || substr(string_split(p_name, ' ')[1], 2) || ' ' || upper(left(string_split(p_name, ' ')[2], 1)) || substr(string_split(p_name, ' ')[2], 2) as term,
cast(length(p_name) + 11 as bigint) as "begin", cast(2 * length(p_name) + 11 as bigint) as "end" from part""")
def decoded_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags as spans of the plain text, the second of two occurrences."""
    return bio.decode(*_name_sentences(spark, sf_dir)).select("sent_id", "term", "begin", "end")


def _by_length(batch: list[list[str]]) -> np.ndarray:
    """Scores of a stand-in for a tagger: words of an odd length begin a term, empty ones fill up, others are outside."""
    names = [["PAD" if not w else "B" if len(w) % 2 else "O" for w in s] for s in batch]
    return np.array([[[float(t == x) for x in ("O", "B", "PAD")] for t in s] for s in names])


@registered(f"""with {_SENTENCES} select sent_id, cast(pos as bigint) as pos, token, case when length(token) % 2 = 1 then 'B' else 'O' end as tag from tags where pos < 20""")
def classified_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens tagged by a classifier that workers call with batches of sentences of one length."""
    sentences = bio.sentences_of(bio.bio_tags(_sentences(spark, sf_dir)), "sent_id", "pos").select("sent_id", F.col("words").alias("tokens"))
    return bio.classify_tokens(sentences, _by_length, ("O", "B", "PAD"), length=20).select("sent_id", _long("pos"), "token", "tag")


# Parsed texts


def _parse(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A parse of "the <name> of metal [in stock] sells": the name is a noun chunk, its root's subtree goes on to what sells."""
    rows = _part(spark, sf_dir)
    more = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("in"), F.lit("stock"))).otherwise(F.array().cast("array<string>"))
    words = F.concat(F.array(F.lit("the")), F.split("p_name", " "), F.array(F.lit("of"), F.lit("metal")), more, F.array(F.lit("sells")))
    tokens = rows.select("doc_id", F.lit(0).cast("long").alias("sent_id"), F.size(words).cast("long").alias("n"), F.posexplode(words).alias("i", "text"), words.alias("w"))
    i, root = F.col("i").cast("long"), F.col("n") - 1
    pos = F.when(i == 0, "DET").when(F.col("text").isin("of", "in"), "ADP").when(i == root, "VERB").otherwise("NOUN")
    dep = F.when(i == 2, "nsubj").when(i == root, "ROOT").otherwise("x")
    head = F.when(i.isin(0, 1, 3), 2).when(i == 2, root).when(i == root, root).otherwise(i - 1)
    before = F.aggregate(F.slice("w", 1, F.col("i")), F.lit(0).cast("long"), lambda s, x: s + F.length(x) + 1)
    parsed = tokens.select("doc_id", "sent_id", i.alias("i"), "text", before.alias("idx"), pos.alias("pos"), dep.alias("dep"), head.cast("long").alias("head_i"), F.when(i == 2, 0).otherwise(i).cast("long").alias("left_edge_i"), F.when(i == 2, root - 1).otherwise(i).cast("long").alias("right_edge_i"))
    chunks = rows.select("doc_id", F.lit(0).cast("long").alias("sent_id"), F.lit(0).cast("long").alias("first"), F.lit(2).cast("long").alias("last"))
    return parsed, chunks


@registered(f"""with n as (select p_partkey as doc_id, p_name, string_split(p_name, ' ') as w from part) select doc_id, p_name as term from n where w[1] not in ({_list(invalid_words())}) and w[2] not in ({_list(invalid_words())})
union all select doc_id, p_name || ' of metal in stock' from n where doc_id % 2 = 0""")
def parsed_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noun chunks that are valid, and the subtrees of their roots: short ones must be valid too, long ones count as they are."""
    return scoring.parsed_candidates(*_parse(spark, sf_dir), most=4, supergrams=True)


@registered("""select p_partkey as doc_id, cast(0 as bigint) as sent_id, string_split(p_name, ' ')[2] as term, cast(5 + length(string_split(p_name, ' ')[1]) as bigint) as "begin", cast(4 + length(p_name) as bigint) as "end" from part""")
def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What parsed sentences define: the subject of each noun chunk."""
    return defined.subjects(*_parse(spark, sf_dir))


# Concepts, relations and evaluation


@registered("select 'c' || (vec_id // 2) as uri, string_agg('v' || vec_id, ',' order by 'v' || vec_id) as labels from embeddings group by 1")
def concept_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map of concepts to labels, taken apart and gathered again."""
    maps = _vector_labels(spark, sf_dir).groupBy("uri").agg(F.collect_list("label").alias("l")).select(F.create_map("uri", "l").alias("concepts"))
    return glossary.concept_labels(maps).groupBy("uri").agg(F.array_join(F.array_sort(F.collect_list("label")), ",").alias("labels"))


@registered("select distinct p_name as label from part")
def all_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each label of all concepts once."""
    return glossary.all_terms(_part(spark, sf_dir).select(F.col("doc_id").alias("uri"), F.col("p_name").alias("label")))


@registered("select 'p' || p_type as uri, min(p_name) as label from part group by 1")
def first_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A concept's smallest label."""
    return glossary.first_labels(_part(spark, sf_dir).select(F.concat(F.lit("p"), "p_type").alias("uri"), F.col("p_name").alias("label")))


def _tongues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of nations in one of two languages, and links inside regions."""
    own = _triples(spark, sf_dir)
    return own.withColumn("o_lang", F.when(F.col("o_is_literal"), F.when(F.length("o") % 2 == 0, "en").otherwise("fr")))


@registered(f"with {_TRIPLES} select a.uri as c1, b.uri as c2, b.term as label from n a join n b on a.r = b.r and a.k < b.k where length(b.term) % 2 = 0 and a.term in ('NATION_0', 'NATION_3', 'NATION_12')")
def bgp_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Related concepts of a few, with labels in one language."""
    few = [glossary.term_uri(F.lit(f"NATION_{k}")) for k in (0, 3, 12)]
    uris = list(spark.range(1).select(*(c.alias(f"u{k}") for k, c in enumerate(few))).first())
    return glossary.pattern(_tongues(spark, sf_dir), [("?c1", glossary.RELATED, "?c2"), ("?c2", glossary.PREF_LABEL, "?label")], lang={"label": "en"}, values={"c1": uris})


@registered(f"with {_TRIPLES} select distinct p from triples")
def relation_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which relations there are."""
    return glossary.pattern(_triples(spark, sf_dir).select("s", F.lit("is").alias("p"), F.col("p").alias("o"), "o_lang"), [("?s", "is", "?p")]).select("p").distinct()


@registered(f"with {_TRIPLES} select uri as concept, term as label from n order by uri limit 5")
def first_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five concepts by URI."""
    return glossary.pattern(_triples(spark, sf_dir), [("?concept", glossary.PREF_LABEL, "?label")]).orderBy("concept").limit(5)


_LAB = "lab as (select 'c' || (vec_id // 2) as uri, 'v' || vec_id as label, vec_id // 2 as c from embeddings), said as (select distinct 'v' || query as label, 'v' || match as match from pairs where query <> match)"
_FAR = "far as (select distinct a.label, b.label as other from lab a join lab b on b.c = a.c + 1)"


def _relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each concept is related to the next."""
    n = F.floor(F.col("vec_id") / 2)
    name = lambda c: F.concat(F.lit("c"), c.cast("string"))
    return _vectors(spark, sf_dir).select(name(n).alias("uri1"), name(n + 1).alias("uri2")).distinct()


def _said(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named_pairs(spark, sf_dir).select(F.col("query").alias("label"), "match")


_COUNTS = "(select count(*) from said s join {g} g on g.label = s.label and g.other = s.match) as {x}tp, (select count(*) from said s where s.label in (select label from {of}) and not exists (select 1 from {g} g where g.label = s.label and g.other = s.match)) as {x}fp, (select count(*) from {g} g where not exists (select 1 from said s where g.label = s.label and g.other = s.match)) as {x}fn"


@registered(f"with {_PAIRS}, {_LAB}, {_FAR} select {_COUNTS.format(g='far', x='', of='far')}")
def related_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right, wrong and missing predictions of labels of related concepts."""
    known = _relations(spark, sf_dir).join(_vector_labels(spark, sf_dir).select(F.col("uri").alias("uri2")).distinct(), "uri2", "left_semi")
    return evaluate.related_counts(_vector_labels(spark, sf_dir), known, _said(spark, sf_dir))


@registered(f"with {_PAIRS}, {_LAB} select round(avg(n), 6) as mean_labels, (select round(avg(m), 6) from (select count(*) as m from said group by label)) as mean_predictions from (select count(*) as n from lab group by uri)")
def mean_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels a concept and predictions a label, on average."""
    both = evaluate.mean_labels(_vector_labels(spark, sf_dir)).join(evaluate.mean_predictions(_said(spark, sf_dir)), F.lit(True))
    return both.select(*(F.round(c, 6).alias(c) for c in ("mean_labels", "mean_predictions")))


@registered(f"""with {_PAIRS}, {_LAB}, {_FAR}, same as (select a.label, b.label as other from lab a join lab b on a.uri = b.uri and a.label <> b.label)
select (select avg(n) from (select count(*) as n from lab group by uri)) as mean_labels, (select round(avg(m), 6) from (select count(*) as m from said group by label)) as mean_predictions, {_COUNTS.format(g='same', x='same_', of='lab')}, {_COUNTS.format(g='far', x='related_', of='far')}""")
def similarity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of merit of similar terms together."""
    labels = _vector_labels(spark, sf_dir)
    known = _relations(spark, sf_dir).join(labels.select(F.col("uri").alias("uri2")).distinct(), "uri2", "left_semi")
    return evaluate.similarity_report(labels, known, _named_pairs(spark, sf_dir), THRESHOLD).withColumn("mean_predictions", F.round("mean_predictions", 6))


@registered("select 'c' || a.vec_id as uri_i, 'c' || (a.vec_id + a.vec_id % 3) as uri_j, cast(a.vec_id % 3 = 1 and a.vec_id + 1 <= (select max(vec_id) // 2 + 1 from embeddings) as bigint) as label from embeddings a")
def pairs_in_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the second concept of a pair is among the related ones of the first."""
    v = _vectors(spark, sf_dir)
    name = lambda c: F.concat(F.lit("c"), c.cast("string"))
    pairs = v.select(name(F.col("vec_id")).alias("uri_i"), name(F.col("vec_id") + F.col("vec_id") % 3).alias("uri_j"))
    return evaluate.in_relations(pairs, _relations(spark, sf_dir)).withColumn("label", F.col("label").cast("long"))


@registered("select p_type as name, round(avg(case when p_partkey % 4 = 0 then 0.0 else p_size / 100.0 end), 6) as mean_sim from part group by p_type")
def mean_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean similarities by name; NaN and null count as 0."""
    key = F.col("p_partkey")
    sim = F.when(key % 8 == 0, float("nan")).when(key % 8 == 4, F.lit(None)).otherwise(F.col("p_size") / 100.0)
    return evaluate.mean_similarity(_table(spark, sf_dir, "part").select(F.col("p_type").alias("name"), sim.alias("sim")), "name").withColumn("mean_sim", F.round("mean_sim", 6))


@registered("select unnest(['lower', 'strip', 'space']) as flag, unnest([(select round(avg(p_size), 6) from part where p_partkey % 2 = 1), (select round(avg(p_size), 6) from part where (p_partkey >> 1) % 2 = 1), (select round(avg(p_size), 6) from part where (p_partkey >> 2) % 2 = 1)]) as mean")
def best_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean where each choice is made."""
    rows = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("steps"), F.col("p_size").alias("mean_sim"))
    return evaluate.best_flags(rows, ("lower", "strip", "space")).withColumn("mean", F.round("mean", 6))


@registered("select o_orderstatus as name, round(avg(o_totalprice), 4) as mean, round(stddev_samp(o_totalprice), 4) as sd from orders group by 1")
def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means and deviations by name."""
    rows = _table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("name"), F.col("o_totalprice").alias("seconds"))
    return evaluate.timings(rows).select("name", F.round("mean", 4).alias("mean"), F.round("sd", 4).alias("sd"))


@registered(f"with {_PAIRS}, links as (select query, match from pairs where query <> match) select (select count(*) from links) as n_self, (select count(*) from links where query < match) as n_other")
def link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pairs two link tables hold."""
    own = similarity.exclude_self(similarity.similar_pairs(_vectors(spark, sf_dir), _vectors(spark, sf_dir), THRESHOLD))
    return evaluate.link_counts(own, own.filter("query < match"))


@registered("select count(*) as n, cast(0 as bigint) as in_both, true as about_a_tenth from documents")
def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split by key: nothing is lost or on both sides, and about a tenth is for validation."""
    train, valid = evaluate.split(_table(spark, sf_dir, "documents").select("doc_id"), 0.1, 5, "doc_id")
    both = train.withColumn("v", F.lit(0)).unionByName(valid.withColumn("v", F.lit(1))).groupBy("doc_id").agg(F.sum("v").alias("v"), F.count("*").alias("m"))
    return both.agg(F.count("*").alias("n"), F.sum((F.col("m") > 1).cast("long")).alias("in_both"), F.avg("v").between(0.02, 0.25).alias("about_a_tenth"))


@registered("select cast(1500 as bigint) as drawn, cast(1500 as bigint) as known, true as repeats, cast(20 as bigint) as once, cast(20 as bigint) as different from (select 1)")
def draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows drawn with replacement, and others once each."""
    n = _table(spark, sf_dir, "nation").select("n_name")
    again, once = evaluate.drawn(n, 1500, 3, "n_name", replacement=True), evaluate.drawn(n, 20, 3, "n_name")
    one = again.join(n, "n_name").agg(F.countDistinct("draw").alias("drawn"), F.count("*").alias("known"), (F.countDistinct("n_name") < F.count("*")).alias("repeats"))
    return one.join(once.agg(F.count("*").alias("once"), F.countDistinct("n_name").alias("different")), F.lit(True))


@registered("select cast(count(*) as bigint) as n, cast(0 as bigint) as same, true as right from (select unnest(range(0)) as x)")
def evaluation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of concepts drawn with replacement: none of a concept with itself, all labelled as the relations say (0 wrong ones)."""
    labels = _vector_labels(spark, sf_dir)
    found = evaluate.evaluation_pairs(labels, _relations(spark, sf_dir), 2000, 1)
    number = lambda c: F.substring(c, 2, 20).cast("long")
    wrong = (F.col("label") == 1) != (number(F.col("uri_j")) == number(F.col("uri_i")) + 1)
    return found.agg(F.sum(wrong.cast("long")).alias("n"), F.sum((F.col("uri_i") == F.col("uri_j")).cast("long")).alias("same"), (F.count("*") > 1000).alias("right"))


@registered("select label, count(*) as n from (select 1 as label from range(30) union all select 0 from range(30)) group by label")
def balanced_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many pairs of one concept as of different ones."""
    found = evaluate.balanced_pairs(_vector_labels(spark, sf_dir), 30)
    return found.groupBy("label").agg(F.count("*").alias("n"))


@registered(f"""with {_PAIRS}, v as (select vec_id, 'v' || vec_id as term, 'http://example.org/terms/' || left(sha256('v' || vec_id), 32) as uri from embeddings),
own as (select * from v where vec_id % 3 <> 0), known as (select 'c' || (vec_id // 2) as uri, term, vec_id from v where vec_id % 2 = 0)
select uri as s, '{glossary.TYPE}' as p, '{glossary.CONCEPT}' as o, false as o_is_literal from own union all select uri, '{glossary.PREF_LABEL}', term, true from own union all select uri, '{glossary.DEFINITION}', 'about ' || term, true from own
union all select distinct a.uri, '{glossary.RELATED}', b.uri, false from pairs join own a on a.vec_id = query join own b on b.vec_id = match where query <> match
union all select distinct a.uri, '{glossary.RELATED}', b.uri, false from pairs join own a on a.vec_id = query join known b on b.vec_id = match""")
def glossary_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A glossary with links among its terms and to labelled concepts, as triples."""
    name = F.concat(F.lit("v"), F.col("vec_id").cast("string"))
    v = _vectors(spark, sf_dir).select("vec_id", name.alias("term"), "embedding")
    terms = v.select("term", F.when(F.col("vec_id") % 3 == 0, "").otherwise(F.concat(F.lit("about "), "term")).alias("definition"))
    known = v.filter("vec_id % 2 = 0").select(F.concat(F.lit("c"), F.floor(F.col("vec_id") / 2).cast("string")).alias("uri"), F.col("term").alias("label"))
    return pipeline.export_glossary(terms, v.select("term", "embedding"), known, THRESHOLD).drop("o_lang")


@registered("select p_partkey as doc_id, p_name as term, cast(0 as bigint) as k from part where false")
def term_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty and blank terms match nothing."""
    blank = spark.sql("select * from values (''), (' '), ('\\t') as w(term)").filter("trim(term) = ''")
    texts = _part(spark, sf_dir).select("doc_id", F.col("p_name").alias("text"))
    return matching.dictionary_matches(texts, blank, ["doc_id"]).select("doc_id", "term", F.col("begin").alias("k"))


def _concepts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Concept extraction over parsed names, of which every definition is one."""
    store = pipeline.stored_in(_folder(spark, "concepts"))
    tokens, chunks = _parse(spark, sf_dir)
    # a parse is a table that is read several times, not an expression to be worked out each time
    parse = store(tokens, "parsed-tokens"), store(chunks, "parsed-chunks")
    more = F.when(F.col("doc_id") % 2 == 0, " in stock").otherwise("")
    texts = _part(spark, sf_dir).select("doc_id", F.concat(F.lit("the "), "p_name", F.lit(" of metal"), more, F.lit(" sells")).alias("text"))
    whole = texts.select("doc_id", F.lit(0).cast("long").alias("seg_id"), F.lit(0).cast("long").alias("begin"), F.length("text").cast("long").alias("end"), "text")
    lists = spark.sql("select * from values ('metal') as w(term)")
    return pipeline.concept_extraction(texts, whole, whole.select("doc_id", F.col("seg_id").alias("def_id"), "begin", "end"), lists, lists.limit(0), parsed=parse, store=store)


_VALID = f"string_split(p_name, ' ')[1] not in ({_list(invalid_words())}) and string_split(p_name, ' ')[2] not in ({_list(invalid_words())})"


@registered(f"""select p_partkey as doc_id, 'metal' as term, cast(8 + length(p_name) as bigint) as "begin", -1.0 as score, 'whitelist' as origin from part union all select p_partkey, p_name, 4, 1.0, 'idf' from part where {_VALID}""")
def concept_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concept extraction from a parse: where terms stand, with the scores that they keep."""
    return _concepts(spark, sf_dir)["token"].select("doc_id", "term", "begin", "score", "origin")


@registered(f"""select p_partkey as doc_id, cast(4 as bigint) as "begin", cast(4 + length(p_name) as bigint) as "end" from part where {_VALID}""")
def concept_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concept extraction from a parse: which terms definitions define, by their subjects."""
    return _concepts(spark, sf_dir)["defined"]


@registered("""select p_partkey as doc_id, string_split(p_name, ' ')[2] as term, cast(5 + length(string_split(p_name, ' ')[1]) as bigint) as "begin", cast(4 + length(p_name) as bigint) as "end" from part""")
def concept_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concept extraction from a parse: its subjects."""
    return _concepts(spark, sf_dir)["dependency"]
