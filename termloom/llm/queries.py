"""The queries over this subpackage's operators, with production parameters, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import ann, bpe, chat, contamination, licenses, lm, neardup, substrings, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder, read by Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, expanded and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"select * from values (-7L, 0L, 'user', '{said}'), (-7L, 1L, 'assistant', '{said}') as t(conv_id, turn, role, text)")
    return chat.digest(chat.expand(rows.unionByName(extra)))


def op2_neardup_icws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate class."""
    return neardup.classes(spark, table(spark, sf_dir, "documents"))


def op3_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licence phrases and labels."""
    return licenses.scan(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_url_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict."""
    return urls.judge(spark, table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark."""
    return contamination.overlaps(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op6_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return ann.search(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, less those that repeat a smaller document."""
    return substrings.prune(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)


def op8_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probabilities."""
    return lm.score(spark, table(spark, sf_dir, "documents"))


def op9_toxicity_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (toxicity.remainder("doc_id", 3) == 1).alias("held_out"), F.col("toxicity").alias("score"), F.col("toxic").alias("predicted"))


def op10_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    """The registered queries by name."""
    return {f.__name__: f for f in (op1_chat_prefix_targets, op2_neardup_icws, op3_license_index, op4_url_redirects, op5_spaced_seeds, op6_hilbert_ann, op7_substring_dedup, op8_elias_fano_lm, op9_toxicity_weak, op10_bpe_chunks)}


def _control_length(c: str) -> str:
    """SQL for the length of an escaped text: one more for each backslash and each control string."""
    held = [("\\", 1), ("<|", 2), ("<s>", 3), ("</s>", 4), ("[INST]", 6), ("[/INST]", 7)]
    return " + ".join([f"length({c})", *(f"(length({c}) - length(replace({c}, '{x}', ''))) // {n}" for x, n in held)])


def _op1_sql() -> str:
    mark = len(chat.TURN) + len(chat.TEXT) + len(chat.END)
    return f"""with rows as (select conv_id, turn, role, text from conversations union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
r as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as n, count(*) over (partition by conv_id) as m from rows),
c as (select *, sum({mark} + {_control_length("role")} + {_control_length("text")}) over (partition by conv_id order by n) as upto from r)
select conv_id, cast(max(m) as bigint) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars, sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256,
cast(sum(upto) filter (role = 'assistant' or n = m) as bigint) as formatted_chars, count(*) filter (role = 'assistant' or n = m) as n_examples from c group by conv_id"""


def _op4_sql() -> str:
    after = lambda u: f"(case when contains({u}, '://') then substr({u}, instr({u}, '://') + 3) end)"
    ascii_lower = lambda x: f"translate({x}, '{urls.UPPER}', '{urls.LOWER}')"
    host = lambda u: f"coalesce({ascii_lower(f'regexp_extract({after(u)}, ' + chr(39) + '^[^/?#]*' + chr(39) + ')')}, '')"
    path = lambda u: f"coalesce(regexp_extract({after(u)}, '^[^/?#]*([^?#]*)', 1), '')"
    bare = lambda u: f"regexp_replace(regexp_replace({host(u)}, '^(?:www\\.|m\\.)+([^.]+\\.)', '\\1'), ':(?:80|443)$', '')"
    kept = lambda u: f"array_to_string(list_sort(list_filter(string_split(regexp_extract({after(u)}, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '' and not regexp_matches(p, '^(?:utm_[^=]*|ref|fbclid|gclid)(?:=|$)'))), '&')"
    norm = lambda u: f"(case when contains({u}, '://') then 'norm://' || {bare(u)} || '/' || regexp_replace(regexp_replace(regexp_replace({path(u)}, '/(?:index\\.html?)?$', ''), '\\.html?$', ''), '^/+', '') || (case when {kept(u)} <> '' then '?' || {kept(u)} else '' end) end)"
    fits = lambda h, p: f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')"
    ranked = sorted(urls.RULES, key=lambda r: (-len(r[0]) - len(r[1]), r[2] != "allow"))
    rule = "case " + " ".join(f"when {fits(h, p)} then '{h}{p}'" for h, p, _ in ranked) + " end"
    verdict = "case " + " ".join(f"when {fits(h, p)} then '{v}'" for h, p, v in ranked) + " end"
    q = lambda x: x.replace("'", "''")
    value = " || ".join(f"regexp_extract(tag, '{q(urls.VALUE)}', {k})" for k in (1, 2, 3))
    rest, scheme = after("url"), "substr(url, 1, instr(url, '://') - 1)"
    site = f"{scheme} || '://' || regexp_extract({rest}, '^[^/?#]*')"
    tail, own = "regexp_extract(named, '[?#].*$')", "regexp_extract(named, '^[^?#]*')"
    dots = lambda p: f"list_reduce(list_prepend('', string_split(regexp_replace({p}, '^/', ''), '/')), lambda acc, x: case when x = '..' then regexp_replace(acc, '/[^/]*$', '') when x = '.' then acc else acc || '/' || x end)"
    resolved = f"""case when regexp_matches(named, '(?i)^[a-z][a-z0-9+.\\-]*://') then named when named = '' or starts_with(named, '#') or regexp_matches(named, '(?i)^[a-z][a-z0-9+.\\-]*:') then null
when starts_with(named, '//') then {scheme} || ':' || named when starts_with(named, '?') then {site} || {path("url")} || named when starts_with(named, '/') then {site} || {dots(own)} || {tail}
else {site} || {dots(f"regexp_replace({path('url')}, '[^/]*$', '') || {own}")} || {tail} end"""
    return f"""with recursive tags as (select url, unnest(regexp_extract_all(html, '{q(urls.TAG)}')) as tag from pages where contains(url, '://')),
values_ as (select url, tag, {value} as v from tags where regexp_matches(tag, '{q(urls.KIND)}')),
named as (select url, case when regexp_matches(tag, '(?i)http-equiv') then case when regexp_matches(v, '{q(urls.DELAY)}') then regexp_extract(regexp_replace(v, '{q(urls.DELAY)}', ''), '^[^"''\\s]*') end else regexp_extract(v, '^\\S*') end as named from values_),
links as (select distinct url, {resolved} as target from named),
edges as (select distinct url as a, {norm("url")} as b from pages where contains(url, '://') union select url, target from links where target is not null union select target, {norm("target")} from links where target is not null),
both_ways as (select a, b from edges union select b, a from edges),
reach as (select distinct a, a as b from edges union select r.a, e.b from reach r join both_ways e on e.a = r.b),
said as (select distinct a as u, {verdict} as v from (select a, {host("a")} as host, {path("a")} as path from edges)),
spread as (select reach.a as url, case when max(case when v = 'allow' then 1 else 0 end) = 1 then 'allow' else 'block' end as component_verdict from reach join said on said.u = reach.b where v is not null group by 1),
p as (select page_id, url, {host("url")} as host, {path("url")} as path from pages)
select page_id, host, path, {rule} as rule, coalesce({verdict}, component_verdict, 'allow') as verdict, component_verdict from p left join spread using (url)"""


#: each window of 50 words is looked up in full
_OP7_SQL = r"""with w as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
placed as (select doc_id, w, unnest(range(1, len(w) - 48)) as i from w where len(w) >= 50),
windows as (select doc_id, i, array_to_string(w[i:i + 49], ' ') as k from placed),
first as (select k, min(doc_id) as d from windows group by k),
cut as (select distinct doc_id, i + j as i from windows join first using (k), (select unnest(range(50)) as j) where d < doc_id),
kept as (select w.doc_id, string_agg(x, ' ' order by n) filter (cut.i is null) as text, count(cut.i) as gone from (select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as n from w) w left join cut on cut.doc_id = w.doc_id and cut.i = w.n group by 1)
select w.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(gone, 0) as bigint) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256 from w left join kept using (doc_id)"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for those queries that SQL can express."""
    return {"op1_chat_prefix_targets": _op1_sql(), "op4_url_redirects": _op4_sql(), "op7_substring_dedup": _OP7_SQL}
