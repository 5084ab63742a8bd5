"""The registered queries over this package's operators and the SQL that gives the same rows.

Where the tables lack what an operator looks for, both sides build the same derived text.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.config import Config
from termloom.functions import text as T
from termloom.functions.words import EXTRA_SYMBOLS, STOP_WORDS, invalid_words
from termloom.operators import abbreviations, bio, defined, evaluate, glossary, matching, scoring, similarity, spans, tables

Query = Callable[[SparkSession, str], DataFrame]

#: what is looked up in the documents
TERMS = ("the", "and", "of the", "la", "und", "que", "en", "der", "ation", "is the")
WHITELIST, BLACKLIST = ("of the", "und", "be"), ("the", "de la")
#: terms that stand for quoted ones where they begin at an even place
QUOTED = ("of the", "la", "que")
THRESHOLD, NEIGHBOURS = 0.3, 5

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    """Adds a query under its function's name."""

    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql is not None:
            _sql[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _words(spark: SparkSession, words: tuple[str, ...]) -> DataFrame:
    """A fixed short list as a table."""
    return spark.sql("select * from values " + ", ".join(f"('{w}')" for w in words) + " as w(term)")


def _list(words: tuple[str, ...] | list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.line_segments(_table(spark, sf_dir, "documents"))


_SEGMENTS = r"""lines as (select doc_id, lang, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i from documents),
placed as (select doc_id, lang, i as seg_id, line, coalesce(sum(length(line) + 1) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as b from lines),
segments as (select doc_id, lang, seg_id, cast(b as bigint) as "begin", cast(b + length(line) as bigint) as "end", regexp_replace(line, '^\s+|\s+$', '', 'g') as text from placed where regexp_replace(line, '^\s+|\s+$', '', 'g') <> '')"""


@registered(f'with {_SEGMENTS} select doc_id, seg_id, "begin", "end", text from segments')
def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' lines with offsets."""
    return _segments(spark, sf_dir)


@registered(r"""with found as (select page_id, regexp_extract_all(regexp_replace(html, '(?is)<script.*?</script>', '', 'g'), '(?s)<p>(.*?)</p>', 1) as p from pages),
each as (select page_id, unnest(p) as t, unnest(range(len(p))) as tag_id from found)
select page_id, tag_id, regexp_replace(t, '^\s+|\s+$', '', 'g') as text from each where regexp_replace(t, '^\s+|\s+$', '', 'g') <> ''""")
def html_p_leaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' paragraphs."""
    return spans.html_paragraphs(_table(spark, sf_dir, "pages"))


#: tokens of the longest run that is scored, as Config().max_len_ngram has it
LONGEST = Config().max_len_ngram + 1
_GRAMS = (
    _SEGMENTS
    + r""",
words as (select doc_id, seg_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]{2,}') as w from segments),
grams as (select distinct doc_id, seg_id, term from ("""
    + " union all ".join(f"select doc_id, seg_id, unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) as term from words" for n in range(1, LONGEST + 1))
    + "))"
)


@registered(f"with {_GRAMS} select term, cast(count(*) as bigint) as df from grams group by term")
def ngram_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many segments hold each run of one to five words."""
    return scoring.segment_ngrams(_segments(spark, sf_dir), LONGEST).groupBy("term").agg(F.count("*").alias("df"))


_CORPUS = "with " + _GRAMS + ", n as (select count(*) as n from segments), scored as (select term, cast(count(*) as bigint) as df, round(ln((1.0 + any_value(n.n)) / (1.0 + count(*))) + 1, 4) as score from grams, n group by term)"


@registered(_CORPUS + " select term, df, score from scored")
def ngram_idf_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """idf over all segments."""
    return scoring.idf(_segments(spark, sf_dir), None, LONGEST - 1, "corpus").select("term", "df", "score")


@registered("with " + _GRAMS + ", n as (select doc_id, count(*) as n from segments group by doc_id) select doc_id, term, cast(count(*) as bigint) as df, round(ln((1.0 + any_value(n.n)) / (1.0 + count(*))) + 1, 4) as score from grams join n using (doc_id) group by doc_id, term")
def ngram_idf_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """idf over the segments of each document."""
    return scoring.idf(_segments(spark, sf_dir), None, LONGEST - 1, "document").select("doc_id", "term", "df", "score")


@registered(_CORPUS + " select term, df, score from scored order by score desc, term limit 100")
def top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 terms with the highest idf, ties by term."""
    return scoring.idf(_segments(spark, sf_dir), None, LONGEST - 1, "corpus").select("term", "df", "score").orderBy(F.desc("score"), "term").limit(100)


@registered(rf"with {_SEGMENTS}, w as (select distinct unnest(regexp_extract_all(lower(text), '[^\s]+')) as term from segments) select term from w where regexp_full_match(term, '\p{{L}}+') and length(term) > 1 and term not in ({_list(invalid_words())})")
def invalid_word_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct words of letters that a term may hold."""
    words = _segments(spark, sf_dir).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[^\s]+"), 0)).alias("term")).distinct()
    return words.filter(T.is_valid_term(F.array("term")))


@registered(rf"with {_SEGMENTS}, w as (select distinct unnest(regexp_extract_all(text, '[^\s]+')) as term from segments) select term from w where not regexp_full_match(term, '[0-9 !-/:-@\[-`{{-~{EXTRA_SYMBOLS}]+')")
def punct_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct strings between blanks that are more than marks and digits."""
    words = _segments(spark, sf_dir).select(F.explode(F.regexp_extract_all("text", F.lit(r"[^\s]+"), 0)).alias("term")).distinct()
    return words.filter(~T.is_symbols_only(F.col("term")))


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    # the longest term is two words and the blank between them
    return matching.dictionary_matches(docs, _words(spark, TERMS), ["doc_id"], most=3)


_MATCHES = f"""terms as (select unnest([{_list((*TERMS, *(w for w in WHITELIST if w not in TERMS)))}]) as term),
parts as (select doc_id, lower(text) as t, term, string_split(lower(text), term) as g from documents, terms where contains(lower(text), term)),
hits as (select doc_id, term, t, unnest(range(1, len(g))) as k, g from parts),
lens as (select doc_id, term, unnest(g) as x, unnest(range(1, len(g) + 1)) as k, t from parts),
ends as (select doc_id, term, t, k, sum(length(x)) over (partition by doc_id, term order by k) + (k - 1) * length(term) as b, count(*) over (partition by doc_id, term) as n from lens),
every_match as (select doc_id, term, cast(b as bigint) as "begin", cast(b + length(term) as bigint) as "end" from ends where k < n
  and not regexp_matches(case when b > 0 then substr(t, cast(b as bigint), 1) else '' end, '[\\p{{L}}_+-]') and not regexp_matches(substr(t, cast(b + length(term) + 1 as bigint), 1), '[\\p{{L}}_+-]')),
matches as (select * from every_match where term in ({_list(TERMS)}))""".replace("\\\\", "\\").replace("hits as (select doc_id, term, t, unnest(range(1, len(g))) as k, g from parts),\n", "")


@registered(f'with {_MATCHES} select doc_id, term, "begin", "end" from matches')
def dict_match_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where terms stand in whole documents, bounded by no letters."""
    return _matches(spark, sf_dir)


@registered(f'with {_MATCHES} select doc_id, term, "begin", "end" from matches a where not exists (select 1 from matches b where b.doc_id = a.doc_id and b."begin" <= a."begin" and b."end" >= a."end" and (b."begin" <> a."begin" or b."end" <> a."end"))')
def longest_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches in no larger match."""
    return spans.longest(_matches(spark, sf_dir))


@registered(f"""with {_GRAMS}, {_MATCHES}, n as (select doc_id, count(*) as n from segments group by doc_id),
scored as (select doc_id, term, round(ln((1.0 + any_value(n.n)) / (1.0 + count(*))) + 1, 4) as score from grams join n using (doc_id) group by doc_id, term),
regex as (select distinct doc_id, term from grams where term like 'the%'),
listed as (select distinct doc_id, term from every_match where term in ({_list(WHITELIST)})),
every as (select doc_id, term, score, 'idf' as origin, 1 as rank from scored union all select doc_id, term, -1.0, 'whitelist', 2 from listed union all select doc_id, term, -2.0, 'regex', 3 from regex)
select doc_id, term, arg_max(score, rank) as score, arg_max(origin, rank) as origin from every where term not in ({_list(BLACKLIST)}) and not regexp_full_match(term, '[0-9 _]+') group by doc_id, term""")
def score_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which score a term keeps, with runs of words that begin with "the" as the quoted ones."""
    segments = _segments(spark, sf_dir)
    tokens = segments.filter(F.lower("text").contains("the")).select("doc_id", T.word_tokens(F.col("text")).alias("w"))
    regex = tokens.select("doc_id", F.explode(F.array_distinct(T.ngrams_from(F.col("w"), LONGEST, lambda t: t.startswith("the")))).alias("term"))
    listed = scoring.listed_terms(_table(spark, sf_dir, "documents"), _words(spark, WHITELIST))
    return scoring.document_precedence(segments, regex, listed, _words(spark, BLACKLIST), most=LONGEST - 1)


def _definition_text() -> Column:
    return F.concat(F.lit("For this "), F.col("p_type"), F.lit(", ‘"), F.col("p_name"), F.lit("’ means •"), F.upper("p_type"), F.lit("• or "), F.col("p_brand"))


@registered("""with d as (select p_partkey as doc_id, p_type, p_name from part),
quoted as (select doc_id, lower(p_name) as term, length('For this ' || p_type || ', ‘') as b, length(p_name) as n from d union all
select doc_id, lower(p_type), length('For this ' || p_type || ', ‘' || p_name || '’ means •'), length(p_type) from d)
select doc_id, cast(0 as bigint) as def_id, term, cast(b as bigint) as "begin", cast(b + n as bigint) as "end" from quoted where n >= 2""")
def quoted_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted terms of derived definitions."""
    rows = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), F.lit(0).cast("long").alias("def_id"), _definition_text().alias("text"))
    return matching.quoted_term_spans(rows, Config().regex_terms, Config().regex_abbreviations)


_INITIALS = "array_to_string(list_transform(w, lambda x: upper(left(x, 1))), '')"


@registered(f"""with n as (select p_partkey as doc_id, string_split(p_name || case when p_partkey % 2 = 0 then ' of ' || lower(p_type) else '' end || case when p_partkey % 7 = 0 then ' plain old extra' else '' end, ' ') as w from part),
kept as (select doc_id, list_filter(w, lambda x: x <> 'of') as w, list_transform(w, lambda x: case when x = 'of' then x else upper(left(x, 1)) || substr(x, 2) end) as shown from n)
select distinct doc_id, {_INITIALS} as short, array_to_string(shown, ' ') as long from kept where len(w) between 2 and 5 and lower({_INITIALS}) not in ({_list(STOP_WORDS)})""")
def abbreviation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abbreviations of derived sentences: names of two to seven words in capitals, some with a stop word, then their initials in brackets."""
    key = F.col("p_partkey")
    name = F.concat("p_name", F.when(key % 2 == 0, F.concat(F.lit(" of "), F.lower("p_type"))).otherwise(""), F.when(key % 7 == 0, " plain old extra").otherwise(""))
    words = F.split(name, " ")
    shown = F.array_join(F.transform(words, lambda w: F.when(w == "of", w).otherwise(F.initcap(w))), " ")
    initials = F.array_join(F.transform(F.filter(words, lambda w: w != "of"), lambda w: F.upper(F.substring(w, 1, 1))), "")
    sentence = F.concat(F.lit("Here: "), shown, F.lit(" ("), initials, F.lit(") is sold."))
    return abbreviations.abbreviation_pairs(_table(spark, sf_dir, "part").select(key.alias("doc_id"), abbreviations.sentence_tokens(sentence).alias("tokens")))


_CASCADE = f"""{_SEGMENTS}, {_MATCHES},
defs as (select doc_id, seg_id as def_id, "begin", "end" from segments),
tok as (select doc_id, term, "begin", "end", case when term in ({_list(WHITELIST)}) then -1.0 else 1.0 end as score from matches where term not in ('the', 'der')),
dep as (select m.doc_id, def_id, m."begin", m."end" from matches m join defs d on d.doc_id = m.doc_id and m."begin" >= d."begin" and m."end" <= d."end" where term in ('the', 'der')),
inside as (select t.doc_id, def_id, t.term, t."begin", t."end", t.score from tok t join defs d on d.doc_id = t.doc_id and t."begin" >= d."begin" and t."end" <= d."end"),
long_all as (select * from inside a where not exists (select 1 from tok b where b.doc_id = a.doc_id and b."begin" <= a."begin" and b."end" >= a."end" and (b."begin" <> a."begin" or b."end" <> a."end"))),
long_listed as (select * from inside a where score = -1.0 and not exists (select 1 from tok b where b.score = -1.0 and b.doc_id = a.doc_id and b."begin" <= a."begin" and b."end" >= a."end" and (b."begin" <> a."begin" or b."end" <> a."end"))),
near as (select doc_id, def_id, "begin", "end", term, stage from (select *, 2.0 as stage from long_listed union all select *, 3.0 as stage from long_all) x
  where exists (select 1 from dep d where d.doc_id = x.doc_id and d.def_id = x.def_id and d."begin" < x."end" and x."begin" < d."end"))"""


def _cascade(spark: SparkSession, sf_dir: str, config: Config, said: bool = False) -> DataFrame:
    found = _matches(spark, sf_dir)
    defs = _segments(spark, sf_dir).select("doc_id", F.col("seg_id").alias("def_id"), "begin", "end")
    tok = found.filter(~F.col("term").isin("the", "der")).withColumn("score", F.when(F.col("term").isin(*WHITELIST), -1.0).otherwise(1.0))
    dep = found.filter(F.col("term").isin("the", "der"))
    quoted = defs.select("doc_id", "def_id", F.lit("").alias("term"), "begin", "end").limit(0)
    if said:
        inside = spans.covered(defs, found.filter(F.col("term").isin(*QUOTED) & (F.col("begin") % 2 == 0)))
        quoted = inside.select("doc_id", F.col("o_def_id").alias("def_id"), F.col("i_term").alias("term"), F.col("i_begin").alias("begin"), F.col("i_end").alias("end"))
    return defined.defined_terms(defs, tok, dep, quoted, config)


def _first_stage(rows: str) -> str:
    return f'with {_CASCADE}, every as ({rows}) select distinct doc_id, def_id, "begin", "end", term, cast(stage as double) as stage from (select *, min(stage) over (partition by doc_id, def_id) as m from every) where stage = m'


@registered(_first_stage("select * from near"))
def definition_cascade_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each line defines, without fallbacks."""
    return _cascade(spark, sf_dir, Config(use_regex=False))


@registered(_first_stage('select * from near union all select doc_id, def_id, "begin", "end", term, 2.5 from long_listed union all select doc_id, def_id, "begin", "end", term, 3.5 from long_all'))
def definition_cascade_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each line defines, listed and scored terms without a subject as fallbacks."""
    return _cascade(spark, sf_dir, Config(use_regex=False, fallback_to_whitelist=True, fallback_to_tf_idf=True))


_QUOTED_INSIDE = f"""(select * from inside where term in ({_list(QUOTED)}) and "begin" % 2 = 0)"""


@registered(_first_stage(f"""select * from near union all select doc_id, def_id, "begin", "end", term, 1.5 from {_QUOTED_INSIDE}
union all select doc_id, def_id, "begin", "end", term, 1.0 from {_QUOTED_INSIDE} x where exists (select 1 from dep d where d.doc_id = x.doc_id and d.def_id = x.def_id and d."begin" < x."end" and x."begin" < d."end")"""))
def definition_cascade_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each line defines, quoted terms first, with their fallback."""
    return _cascade(spark, sf_dir, Config(), said=True)


@registered(_first_stage('select * from near union all select doc_id, def_id, "begin", "end", (case when m.t is null then \'\' else m.t end) as term, 4.0 from (select d.*, (select any_value(term) from matches k where k.doc_id = d.doc_id and k."begin" = d."begin" and k."end" = d."end" and k.term in (\'the\', \'der\')) as t from dep d) m'))
def definition_cascade_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each line defines, a tagger's spans last."""
    return _cascade(spark, sf_dir, Config(use_regex=False, tagger_bio=True))


@registered(f"""with {_SEGMENTS}, {_MATCHES} select s.doc_id, seg_id, count(*) as n, cast(min(m."begin") as bigint) as first_begin from segments s join matches m on m.doc_id = s.doc_id and m."begin" >= s."begin" and m."end" <= s."end" group by s.doc_id, seg_id""")
def covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches in each line, joined on character buckets."""
    joined = spans.covered(_segments(spark, sf_dir).select("doc_id", "seg_id", "begin", "end"), _matches(spark, sf_dir), bucketed=True)
    return joined.groupBy("doc_id", F.col("o_seg_id").alias("seg_id")).agg(F.count("*").alias("n"), F.min("i_begin").alias("first_begin"))


@registered(f"""with {_MATCHES} select a.doc_id, a.term, a."begin", count(*) as n from matches a join matches b on b.doc_id = a.doc_id and b."begin" <= a."begin" and b."end" >= a."end" where a.term in ('the', 'der') group by a.doc_id, a.term, a."begin" """)
def covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many matches cover each short one."""
    found = _matches(spark, sf_dir)
    joined = spans.covering(found.filter(F.col("term").isin("the", "der")), found.select("doc_id", "begin", "end"))
    return joined.groupBy("doc_id", F.col("i_term").alias("term"), F.col("i_begin").alias("begin")).agg(F.count("*").alias("n"))


@registered(f"""with {_MATCHES} select doc_id, term, "begin", "end" from matches a where term = 'is the' and exists (select 1 from matches b where b.term = 'the' and b.doc_id = a.doc_id and b."begin" < a."end" and a."begin" < b."end")""")
def overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches that share a character with a word."""
    found = _matches(spark, sf_dir)
    return spans.overlapping(found.filter("term = 'is the'"), found.filter("term = 'the'"))


@registered(f"""with {_SEGMENTS}, {_MATCHES} select doc_id, term, "begin", "end" from matches m where not exists (select 1 from segments s where s.doc_id = m.doc_id and s.seg_id % 2 = 0 and m."begin" >= s."begin" and m."end" <= s."end")""")
def remove_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches outside even lines."""
    return spans.not_covered(_matches(spark, sf_dir), _segments(spark, sf_dir).filter("seg_id % 2 = 0"))


def _strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _clean_term_sql(x: str) -> str:
    """The look-aheads of the patterns said as groups that are put back."""
    out = rf"regexp_replace({_strip_sql(x)}, '^[.A-Za-z/]*?(\.+?\s)', '\1')"
    out = _strip_sql(rf"regexp_replace({out}, '^[0-9./]*?(\.*?[\s*])', '\1')")
    out = _strip_sql(rf"regexp_replace({out}, '^[*. ]+', '')")
    return _strip_sql(rf"regexp_replace(regexp_replace({out}, '^\([-+*]\)\s*', ''), '^[*. ]+', '')")


#: enumerations in front of terms
_MARKS = ("1.1. ", "a. ", "(-) ", "* ", "12.1* ", "", "ii/b.. ", "(+)  ")


@registered(f"with r as (select p_partkey, ([{', '.join(repr(m) for m in _MARKS)}])[1 + p_partkey % {len(_MARKS)}] || p_name as raw from part) select p_partkey, raw, {_clean_term_sql('raw')} as term from r")
def clean_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enumerations taken off derived terms."""
    raw = F.concat(F.get(F.array(*(F.lit(m) for m in _MARKS)), (F.col("p_partkey") % len(_MARKS)).cast("int")), F.col("p_name"))
    return _table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"), T.clean_term(raw).alias("term"))


@registered("select p_partkey, replace(replace(lower(replace(trim('  ' || p_type || '   ' || p_name || ' '), '  ', ' ')), ' ', '_'), '__', '_') as word from part")
def preprocess_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words as they are looked up."""
    return _table(spark, sf_dir, "part").select("p_partkey", T.preprocess_word(F.concat(F.lit("  "), "p_type", F.lit("   "), "p_name", F.lit(" "))).alias("word"))


@registered("select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\r\n$|\r$|\n$', ''), '\r\n|\r|\n', ' ', 'g'), ' +', ' ', 'g'), '^\\s+|\\s+$', '', 'g') as cell from documents".replace("\\\\", "\\"))
def clean_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents on one line."""
    return _table(spark, sf_dir, "documents").select("doc_id", T.clean_string(F.col("text")).alias("cell"))


@registered("""select p_partkey, 'x  ★  ' || p_name || ' ☆   y' as text from part""")
def strip_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marked terms without quotation marks around them."""
    marked = F.concat(F.lit("x `★ ‘"), F.col("p_name"), F.lit("’ ☆' y"))
    return _table(spark, sf_dir, "part").select("p_partkey", T.strip_quotes(marked).alias("text"))


@registered("""with r as (select l_orderkey, l_linenumber, case when l_linenumber % 3 = 0 then 'of which ' || l_shipdate::date else 'item ' || l_partkey end as term, l_partkey from lineitem),
o as (select *, case when term not like 'of which%' then term end as plain from r),
f as (select *, last_value(plain ignore nulls) over (partition by l_orderkey order by l_linenumber, l_partkey, term rows between unbounded preceding and 1 preceding) as before from o)
select l_orderkey, l_linenumber, l_partkey, term, case when term like 'of which%' and before is not null then before || ' ' || term else term end as name from f""")
def of_which_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms that go on from the one before them, over order lines."""
    term = F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("of which "), F.col("l_shipdate").cast("date").cast("string"))).otherwise(F.concat(F.lit("item "), F.col("l_partkey").cast("string")))
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", term.alias("term")).withColumn("at", F.struct("l_linenumber", "l_partkey", "term"))
    return tables.carried(rows, ["l_orderkey"], "at").drop("at")


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as sentences; the second and third words of those of four words and more are marked as a term."""
    rows = _table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("sent_id"), F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda t: t != "").alias("w"))
    marked = F.concat(F.slice("w", 1, 1), F.array(F.lit("★")), F.slice("w", 2, 2), F.array(F.lit("☆")), F.slice("w", 4, F.greatest(F.size("w"), F.lit(1))))
    return rows.select("sent_id", F.array_join(F.when(F.size("w") > 3, marked).otherwise(F.col("w")), " ").alias("text"))


_SENTENCES = r"""sentences as (select conv_id * 1000 + turn as sent_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '') as w from conversations),
tagged as (select sent_id, unnest(w) as token, unnest(range(len(w))) as pos, len(w) as m from sentences),
tags as (select sent_id, pos, token, case when m > 3 and pos = 1 then 'B' when m > 3 and pos = 2 then 'I' else 'O' end as tag from tagged)"""


@registered(f"with {_SENTENCES} select sent_id, cast(pos as bigint) as pos, token, tag from tags")
def bio_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marked sentences as tagged tokens."""
    return bio.bio_tags(_sentences(spark, sf_dir)).withColumn("pos", F.col("pos").cast("long"))


@registered(f"""with {_SENTENCES}, placed as (select sent_id, pos, token, tag, coalesce(sum(length(token) + 1) over (partition by sent_id order by pos rows between unbounded preceding and 1 preceding), 0) as b from tags)
select sent_id, string_agg(token, ' ' order by pos) as term, cast(min(b) as bigint) as "begin", cast(min(b) + length(string_agg(token, ' ' order by pos)) as bigint) as "end" from placed where tag <> 'O' group by sent_id""")
def bio_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tagged runs with offsets."""
    return bio.tag_runs(bio.bio_tags(_sentences(spark, sf_dir))).select("sent_id", "term", "begin", "end")


@registered(f"""with {_SENTENCES}, cut as (select sent_id, pos, unnest(case when length(token) > 4 then [token[1:4], '##' || token[5:]] else [token] end) as token, unnest(case when length(token) > 4 then [0, 1] else [0] end) as half, tag from tags)
select sent_id, cast(pos as bigint) as pos, string_agg(case when half = 1 then substr(token, 3) else token end, '' order by half) as token, any_value(tag) as tag from cut group by sent_id, pos""")
def bpe_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens cut after four characters and merged again."""
    rows = bio.bio_tags(_sentences(spark, sf_dir))
    halves = F.when(F.length("token") > 4, F.array(F.substring("token", 1, 4), F.concat(F.lit("##"), F.substring("token", 5, 1 << 20)))).otherwise(F.array("token"))
    cut = rows.select("sent_id", "pos", "tag", F.posexplode(halves).alias("half", "token"))
    cut = cut.select("sent_id", (F.col("pos") * 2 + F.col("half")).alias("pos"), "token", "tag")
    return bio.merge_pieces(cut).withColumn("pos", F.col("pos").cast("long"))


@registered(f"""with {_SENTENCES}, x as (select sent_id, pos, token, case when pos = 0 then 'Sentence: ' || (sent_id + 1) else '' end as sentence from tags)
select sent_id, cast(pos as bigint) as pos, token, last_value(nullif(sentence, '') ignore nulls) over (partition by sent_id order by pos rows between unbounded preceding and current row) as sentence from x""")
def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training table's sentence ids filled forward."""
    rows = bio.tag_table(bio.bio_tags(_sentences(spark, sf_dir))).select("sent_id", F.col("place").cast("long").alias("pos"), F.col("Word").alias("token"), F.col("Sentence #").alias("sentence"))
    return bio.forward_fill(rows, "sentence", "pos", ["sent_id"])


@registered("""select p_partkey, ' ★ ' || substr(p_name, 1, 3) || ' ☆ ' || substr(p_name, 4, 1) || ' ★ ' || substr(p_name, 5) || ' ☆ ' as text from part where length(p_name) > 5""")
def annotate_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markers put around spans."""
    long = lambda c: F.lit(c).cast("long")
    marks = F.array(F.struct(long(0).alias("begin"), long(3).alias("end")), F.struct(long(4).alias("begin"), F.length("p_name").cast("long").alias("end")))
    return _table(spark, sf_dir, "part").filter(F.length("p_name") > 5).select("p_partkey", T.mark_spans(F.col("p_name"), marks).alias("text"))


_UNIT = "u as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings), e as (select vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) as v from u)"
_PAIRS = f"{_UNIT}, pairs as (select a.vec_id as query, b.vec_id as match, list_dot_product(a.v, b.v) as sim from e a, e b where list_dot_product(a.v, b.v) >= {THRESHOLD})"


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vectors(spark, sf_dir)
    return similarity.similar_pairs(v, v, THRESHOLD)


@registered(f"with {_PAIRS} select query, match, round(sim, 4) as sim from pairs where query <> match")
def sim_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of vectors over a threshold."""
    return similarity.exclude_self(_pairs(spark, sf_dir)).withColumn("sim", F.round("sim", 4))


@registered(f"with {_UNIT}, r as (select a.vec_id as query, b.vec_id as match, list_dot_product(a.v, b.v) as sim, row_number() over (partition by a.vec_id order by list_dot_product(a.v, b.v) desc, b.vec_id) as rank from e a, e b where a.vec_id <> b.vec_id) select query, cast(rank as bigint) as rank, match, round(sim, 4) as sim from r where rank <= {NEIGHBOURS}")
def sim_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most similar vectors of each."""
    v = _vectors(spark, sf_dir)
    return similarity.top_k(v, v, NEIGHBOURS).select("query", F.col("rank").cast("long"), "match", F.round("sim", 4).alias("sim"))


@registered(f"with {_PAIRS} select 'v' || query as term, string_agg('v' || match, ',' order by sim desc, 'v' || match) as matches from pairs group by query")
def align_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vocabulary aligned with itself."""
    own = _vectors(spark, sf_dir).select(F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("term"), "embedding")
    return similarity.align_self(own, THRESHOLD).select("term", F.array_join("matches", ",").alias("matches"))


@registered(f"with {_UNIT} select a.vec_id as a, b.vec_id as b, round(list_dot_product(a.v, b.v), 4) as sim from e a join e b on b.vec_id = a.vec_id + 1")
def pair_sim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of each vector and the next."""
    v = _vectors(spark, sf_dir)
    pairs = v.select(F.col("vec_id").alias("a"), (F.col("vec_id") + 1).alias("b"))
    return similarity.pair_similarity(pairs, v).withColumn("sim", F.round("sim", 4))


@registered("with w as (select p_partkey as idx, upper(left(p_name, 1 + p_partkey % 2)) || substr(p_name, 2 + p_partkey % 2) as term from part) select cast(min(idx) as bigint) as idx, replace(lower(term), ' ', '_') as word, arg_max(term, idx) as term from w group by replace(lower(term), ' ', '_')")
def vocab_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vocabulary of names whose spellings differ."""
    n = 1 + F.col("p_partkey") % 2
    term = F.concat(F.upper(F.substring("p_name", F.lit(1), n.cast("int"))), F.substring("p_name", (n + 1).cast("int"), F.lit(1 << 20)))
    return similarity.vocabulary(_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("idx"), term.alias("term")))


_GLOSSARY = "g as (select p_partkey, p_name as name, case when p_partkey % 4 = 0 then '' else p_type || '  of ' || p_brand end as definition, case when p_partkey % 3 = 0 then string_split(p_name, ' ')[1] else p_name end as lemma, case when p_size > 40 then 'Rejected' else 'Accepted' end as acceptance_state from part)"


def _glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    definition = F.when(key % 4 == 0, "").otherwise(F.concat("p_type", F.lit("  of "), "p_brand"))
    lemma = F.when(key % 3 == 0, F.get(F.split("p_name", " "), F.lit(0))).otherwise(F.col("p_name"))
    return _table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"), definition.alias("definition"), lemma.alias("lemma"), F.when(F.col("p_size") > 40, "Rejected").otherwise("Accepted").alias("acceptance_state"))


@registered(f"with {_GLOSSARY} select p_partkey, name, regexp_replace(definition, ' +', ' ', 'g') as definition, lemma, acceptance_state from g where acceptance_state <> 'Rejected' and definition <> '' and length(lemma) >= 2 and regexp_matches(lemma, '[a-z]') and regexp_full_match(lemma, '[a-zA-Z0-9]+')")
def glossary_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a glossary keeps."""
    return glossary.clean_glossary(_glossary(spark, sf_dir))


def _vector_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts of two vectors each, labelled by vector."""
    return _vectors(spark, sf_dir).select(F.concat(F.lit("c"), F.floor(F.col("vec_id") / 2).cast("string")).alias("uri"), F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("label"))


def _named_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = lambda c: F.concat(F.lit("v"), F.col(c).cast("string")).alias(c)
    return similarity.exclude_self(_pairs(spark, sf_dir)).select(name("query"), name("match"), "sim")


_LINKS = f"{_PAIRS}, links as (select 'c' || (query // 2) as uri_i, 'c' || (match // 2) as uri_j from pairs where query <> match and query // 2 <> match // 2)"


@registered(f"with {_LINKS} select uri_i, uri_j from links")
def concept_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of concepts whose labels are similar."""
    labels = _vector_labels(spark, sf_dir)
    return glossary.similar_concepts(_named_pairs(spark, sf_dir), labels, labels)


def _triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts of nations, with definitions for most, and links between nations of a region."""
    n = _table(spark, sf_dir, "nation").join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    terms = n.select(F.col("n_name").alias("term"), F.when(F.col("n_nationkey") % 5 == 0, "").otherwise(F.concat(F.lit('a "nation" of '), "r_name")).alias("definition"))
    a = n.select(glossary.term_uri(F.col("n_name")).alias("uri_i"), F.col("n_regionkey").alias("r"), F.col("n_nationkey").alias("i"))
    b = n.select(glossary.term_uri(F.col("n_name")).alias("uri_j"), F.col("n_regionkey").alias("r"), F.col("n_nationkey").alias("j"))
    links = a.join(b, "r").filter("i < j").select("uri_i", "uri_j")
    return glossary.term_triples(terms).unionByName(glossary.link_triples(links))


_TRIPLES = f"""n as (select n_name as term, 'http://example.org/terms/' || left(sha256(n_name), 32) as uri, case when n_nationkey % 5 = 0 then '' else 'a "nation" of ' || r_name end as definition, n_regionkey as r, n_nationkey as k from nation join region on n_regionkey = r_regionkey),
triples as (select distinct uri as s, '{glossary.TYPE}' as p, '{glossary.CONCEPT}' as o, false as lit from n union all select uri, '{glossary.PREF_LABEL}', term, true from n union all select uri, '{glossary.DEFINITION}', definition, true from n where definition <> ''
union all select a.uri, '{glossary.RELATED}', b.uri, false from n a join n b on a.r = b.r and a.k < b.k)"""


@registered(f"""with {_TRIPLES} select '<' || s || '> <' || p || '> ' || case when lit then '"' || replace(o, '"', '\\"') || '"' else '<' || o || '>' end || ' .' as line from triples""")
def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples as lines."""
    return _triples(spark, sf_dir).select(glossary.n3().alias("line"))


@registered(f"with {_TRIPLES} select uri as concept, term as label, definition from n where definition <> ''")
def bgp_label_def(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts with labels and definitions."""
    return glossary.labels_with_definitions(_triples(spark, sf_dir)).select("concept", "label", "definition")


@registered(f"with {_TRIPLES} select a.uri as c1, a.term as l1, a.definition as d1, b.uri as c2, b.term as l2, b.definition as d2 from n a join n b on a.r = b.r and a.k < b.k where a.definition <> '' and b.definition <> '' and a.term <> b.term")
def bgp_related(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Related concepts with definitions."""
    return glossary.related_with_definitions(_triples(spark, sf_dir))


@registered(f"with {_TRIPLES} select a.uri as c1, a.term as l1, b.uri as c2, b.term as l2 from n a join n b on a.r = b.r and a.k < b.k where regexp_matches(a.uri, '(?i)TERMS/[0-9]') and regexp_matches(b.uri, '(?i)TERMS/[A-F0-9]')")
def bgp_uri_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Related concepts by their URIs."""
    return glossary.related_by_uri(_triples(spark, sf_dir), "TERMS/[0-9]", "TERMS/[A-F0-9]")


_RELATIONS = "rel as (select 'n' || s_nationkey as uri1, 'n' || (s_suppkey % 25) as uri2, case when s_suppkey % 3 = 0 then 'related' when s_suppkey % 3 = 1 then 'broader' else 'ExactMatch' end as relation, s_suppkey as ord from supplier)"


def _relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("s_suppkey") % 3 == 0, "related").when(F.col("s_suppkey") % 3 == 1, "broader").otherwise("ExactMatch")
    name = lambda c: F.concat(F.lit("n"), c.cast("string"))
    return _table(spark, sf_dir, "supplier").select(name(F.col("s_nationkey")).alias("uri1"), name(F.col("s_suppkey") % 25).alias("uri2"), kind.alias("relation"), F.col("s_suppkey").alias("ord"))


@registered(f"with {_RELATIONS} select uri1, uri2, relation, cast(ord as bigint) as ord from rel union all select uri2, uri1, relation, ord from rel where relation in ('related', 'ExactMatch')")
def relations_symmetric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations with the symmetric ones both ways."""
    return glossary.symmetric(_relations(spark, sf_dir)).withColumn("ord", F.col("ord").cast("long"))


@registered(f"with {_RELATIONS} select uri1, uri2, arg_max(relation, ord) as relation from rel group by uri1, uri2")
def relations_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last relation of each pair."""
    return glossary.keep_last(_relations(spark, sf_dir))


@registered(f"""with {_PAIRS}, lab as (select 'c' || (vec_id // 2) as uri, 'v' || vec_id as label from embeddings), said as (select distinct 'v' || query as label, 'v' || match as match from pairs where query <> match),
gold as (select a.label, b.label as other from lab a join lab b on a.uri = b.uri and a.label <> b.label)
select (select count(*) from said s join gold g on g.label = s.label and g.other = s.match) as tp, (select count(*) from said s where not exists (select 1 from gold g where g.label = s.label and g.other = s.match)) as fp, (select count(*) from gold g where not exists (select 1 from said s where g.label = s.label and g.other = s.match)) as fn""")
def tp_fp_fn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right, wrong and missing predictions of labels of one concept."""
    said = _named_pairs(spark, sf_dir).select(F.col("query").alias("label"), "match")
    return evaluate.label_counts(_vector_labels(spark, sf_dir), said)


@registered(f"with {_UNIT} select cast(a.label = b.label as bigint) as label, cast(list_dot_product(a.v, b.v) >= 0.1 as bigint) as predicted, count(*) as n from e a join e b on b.vec_id = a.vec_id + 1 group by 1, 2")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring vectors: one label or not, by similarity over a threshold."""
    v = _table(spark, sf_dir, "embeddings")
    pairs = v.select(F.col("vec_id").alias("a"), (F.col("vec_id") + 1).alias("b"), F.col("label").alias("la")).join(v.select(F.col("vec_id").alias("b"), F.col("label").alias("lb")), "b")
    scored = similarity.pair_similarity(pairs, v.select("vec_id", "embedding")).select((F.col("la") == F.col("lb")).cast("long").alias("label"), "sim")
    return evaluate.confusion(scored, 0.1).withColumn("predicted", F.col("predicted").cast("long"))


@registered(f"""with {_PAIRS}, r as (select query, sim, row_number() over (partition by query order by sim desc, 'v' || match) as rank from pairs where query <> match),
k as (select cast(round_even(avg(n - 1 + coalesce(far, 0)), 0) as bigint) as k from (select vec_id // 2 as c, count(*) as n, 2 * count(*) / 2 as far from embeddings group by 1))
select k, round(avg(least), 6) as threshold from (select k, query, min(sim) as least from r, k where rank <= k group by k, query) group by k""")
def decide_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The threshold that gives as many neighbours as labels lie near, concepts being related to themselves for want of others."""
    labels = _vector_labels(spark, sf_dir)
    related = labels.select(F.col("uri").alias("uri1"), F.col("uri").alias("uri2")).distinct()
    return evaluate.decide_threshold(labels, related, _named_pairs(spark, sf_dir)).select(F.col("k").cast("long"), F.round("threshold", 6).alias("threshold"))


@registered(f"""with {_SENTENCES}, s as (select sent_id, max(pos) as last from tags group by sent_id having max(pos) > 2),
x as (select count(*) as n_gold, sum(case when sent_id % 2 = 0 then 1 else 0 end) as tp, sum(1 + case when sent_id % 5 = 0 and last >= 3 then 1 else 0 end) as n_predicted from s)
select cast(tp as bigint) as tp, cast(n_gold as bigint) as n_gold, cast(n_predicted as bigint) as n_predicted, round(tp / n_predicted, 6) as precision, round(tp / n_gold, 6) as recall, round(2.0 * tp / (n_gold + n_predicted), 6) as f1 from x""")
def chunk_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision and recall of derived predictions by entity."""
    gold = bio.bio_tags(_sentences(spark, sf_dir))
    key, pos = F.col("sent_id"), F.col("pos")
    said = F.when(F.col("tag") == "B", "B").when((F.col("tag") == "I") & (key % 2 == 0), "I").when((pos == 3) & (key % 5 == 0), "B").otherwise("O")
    return evaluate.chunk_scores(gold, gold.withColumn("tag", said)).select("tp", "n_gold", "n_predicted", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


def queries() -> dict[str, Query]:
    """Queries by name."""
    importlib.import_module("termloom.plans.registry_parts")
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query name."""
    importlib.import_module("termloom.plans.registry_parts")
    return dict(_sql)
