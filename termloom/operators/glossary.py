"""Glossaries, concepts and links as triples, and graph patterns over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions import text as T

# Vocabulary terms of triples.
TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
SKOS = "http://www.w3.org/2004/02/skos/core#"
CONCEPT, PREF_LABEL, DEFINITION, RELATED = f"{SKOS}Concept", f"{SKOS}prefLabel", f"{SKOS}definition", f"{SKOS}relatedMatch"
BASE_URI = "http://example.org/terms/"


def clean_glossary(glossary: DataFrame, rejected: str = "Rejected", strict_alnum: bool = True) -> DataFrame:
    """Cleaned rows that are not rejected, have a definition and a lemma of two characters or more with a lower-case letter.

    strict_alnum: a lemma must be letters and digits only, which leaves out terms of several words.
    """
    rows = glossary.withColumns({c: T.clean_string(F.col(c)) for c in ("name", "definition", "lemma")})
    kept = rows.filter((F.col("acceptance_state") != rejected) & F.col("definition").rlike(r"\S") & (F.length("lemma") >= 2) & F.col("lemma").rlike("[a-z]"))
    return kept.filter(F.col("lemma").rlike(r"^[\p{L}\p{N}]+$")) if strict_alnum else kept


def term_uri(term: Column, base: str = BASE_URI) -> Column:
    """A URI that depends on the term alone."""
    return F.concat(F.lit(base), F.substring(F.sha2(term, 256), 1, 32))


def concept_labels(concepts: DataFrame) -> DataFrame:
    """(uri, label) of a map column concepts: map<uri, array<label>>."""
    return concepts.select(F.explode("concepts").alias("uri", "labels")).select("uri", F.explode("labels").alias("label"))


def all_terms(labels: DataFrame) -> DataFrame:
    """(label): each label once."""
    return labels.select("label").distinct()


def similar_concepts(similar: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(uri_i, uri_j) of similar terms (query, match) by their URIs (uri, label); equal URIs go, other repeats stay."""
    i = left.select(F.col("label").alias("query"), F.col("uri").alias("uri_i"))
    j = right.select(F.col("label").alias("match"), F.col("uri").alias("uri_j"))
    return similar.join(i, "query").join(j, "match").filter("uri_i <> uri_j").select("uri_i", "uri_j")


def _triples(rows: DataFrame, s: Column, p: str, o: Column, literal: bool, lang: str | None = None) -> DataFrame:
    return rows.select(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(literal).alias("o_is_literal"), F.lit(lang).cast("string").alias("o_lang"))


def term_triples(terms: DataFrame, base: str = BASE_URI, lang: str | None = None) -> DataFrame:
    """Triples of terms (term, definition): a concept each, its label and, where there is one, its definition."""
    uri = term_uri(F.col("term"), base)
    out = _triples(terms, uri, TYPE, F.lit(CONCEPT), False).unionByName(_triples(terms, uri, PREF_LABEL, F.col("term"), True, lang))
    return out.unionByName(_triples(terms.filter("definition <> ''"), uri, DEFINITION, F.col("definition"), True, lang)).distinct()


def link_triples(links: DataFrame) -> DataFrame:
    """relatedMatch triples of (uri_i, uri_j), each once."""
    return _triples(links, F.col("uri_i"), RELATED, F.col("uri_j"), False).distinct()


def n3() -> Column:
    """The columns of a triple as an N-Triples line."""
    quoted = F.col("o")
    for plain, code in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        quoted = F.replace(quoted, F.lit(plain), F.lit(code))
    literal = F.concat(F.lit('"'), quoted, F.lit('"'), F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), F.col("o_lang"))).otherwise(""))
    shown = F.when(F.col("o_is_literal"), literal).otherwise(F.concat(F.lit("<"), F.col("o"), F.lit(">")))
    return F.concat(F.lit("<"), F.col("s"), F.lit("> <"), F.col("p"), F.lit("> "), shown, F.lit(" ."))


def pattern(triples: DataFrame, patterns: Sequence[tuple[str, str, str]], *, lang: dict[str, str] | None = None, values: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Bindings of a basic graph pattern, each once. Names that begin with ? are variables; the rest are constants.

    lang: language of the literals that a variable binds; values: what a variable may be.  Each pattern is a scan with pushed
    constants, joined on the variables that it shares with those before it.
    """
    found: DataFrame | None = None
    for spo in patterns:
        part = triples
        names: dict[str, str] = {}
        for column, term in zip(("s", "p", "o"), spo, strict=True):
            if not term.startswith("?"):
                part = part.filter(F.col(column) == term)
            elif term[1:] in names:
                part = part.filter(F.col(column) == F.col(names[term[1:]]))
            else:
                names[term[1:]] = column
        if spo[2].startswith("?") and (tongue := (lang or {}).get(spo[2][1:])) is not None:
            part = part.filter(F.col("o_lang") == tongue)
        for name, allowed in (values or {}).items():
            if name in names:
                part = part.filter(F.col(names[name]).isin(list(allowed)))
        part = part.select(*(F.col(c).alias(n) for n, c in names.items()))
        if found is None:
            found = part
        else:
            shared = [n for n in names if n in found.columns]
            if not shared:
                raise ValueError("each pattern must share a variable with those before it")
            found = found.join(part, shared)
    if found is None:
        raise ValueError("a pattern is needed")
    return found.distinct()


def labels_with_definitions(triples: DataFrame) -> DataFrame:
    """(concept, label, definition)."""
    return pattern(triples, [("?concept", TYPE, CONCEPT), ("?concept", PREF_LABEL, "?label"), ("?concept", DEFINITION, "?definition")])


def related_with_definitions(triples: DataFrame) -> DataFrame:
    """(c1, l1, d1, c2, l2, d2): related concepts that both have definitions, with different labels."""
    found = pattern(triples, [("?c1", RELATED, "?c2"), ("?c1", PREF_LABEL, "?l1"), ("?c1", DEFINITION, "?d1"), ("?c2", PREF_LABEL, "?l2"), ("?c2", DEFINITION, "?d2")])
    return found.filter("l1 <> l2").select("c1", "l1", "d1", "c2", "l2", "d2")


def related_by_uri(triples: DataFrame, one: str, two: str) -> DataFrame:
    """(c1, l1, c2, l2): related concepts whose URIs match two patterns, ignoring case."""
    found = pattern(triples, [("?c1", RELATED, "?c2"), ("?c1", PREF_LABEL, "?l1"), ("?c2", PREF_LABEL, "?l2")])
    return found.filter(F.col("c1").rlike(f"(?i){one}") & F.col("c2").rlike(f"(?i){two}")).select("c1", "l1", "c2", "l2")


def symmetric(relations: DataFrame, kinds: Sequence[str] = ("related", "exactmatch")) -> DataFrame:
    """relations (uri1, uri2, relation, ord) with those whose name holds one of kinds also the other way round."""
    held = [F.lower("relation").contains(k) for k in kinds]
    both = held[0]
    for h in held[1:]:
        both = both | h
    return relations.unionByName(relations.filter(both).select(F.col("uri2").alias("uri1"), F.col("uri1").alias("uri2"), "relation", "ord"))


def keep_last(relations: DataFrame) -> DataFrame:
    """(uri1, uri2, relation): the last relation of each pair, by ord."""
    return relations.groupBy("uri1", "uri2").agg(F.max_by("relation", F.struct("ord", "relation")).alias("relation"))


def first_labels(labels: DataFrame) -> DataFrame:
    """(uri, label): the smallest label of each concept."""
    return labels.withColumn("_n", F.row_number().over(Window.partitionBy("uri").orderBy("label"))).filter("_n = 1").drop("_n")
