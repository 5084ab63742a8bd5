"""Whole plans: concept extraction, glossary export, training data. Lazily composed; only sinks run them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.config import Config
from termloom.functions import text as T
from termloom.operators import abbreviations, bio, defined, glossary, matching, scoring, similarity, spans, tables
from termloom.sources import readers, writers


Store = Callable[[DataFrame, str], DataFrame]


def _lazy(df: DataFrame, name: str) -> DataFrame:
    return df


def stored_in(folder: str) -> Store:
    """Writes tables below a folder that all executors share, and reads them again."""

    def store(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return store


def concept_extraction(texts: DataFrame, segments: DataFrame, definitions: DataFrame, whitelist: DataFrame, blacklist: DataFrame, dependencies: DataFrame | None = None, config: Config | None = None, candidates: DataFrame | None = None, lemma_lookup: DataFrame | None = None, parsed: tuple[DataFrame, DataFrame] | None = None, store: Store = _lazy) -> dict[str, DataFrame]:
    """Span tables token, lemma, dependency, defined, and term scores, of many documents at once.

    texts (doc_id, text); segments (doc_id, seg_id, begin, end, text), the leaf tags; definitions (doc_id, def_id, begin, end).
    parsed: tokens and noun chunks of a parse whose sentences are the segments (sent_id is seg_id, idx an offset in its text); they give
    the candidates and, without dependencies (doc_id, term, begin, end) from a tagger, the subjects as well.  candidates (doc_id, term) replace both
    those and the model-free ones.  store: writes what several steps read (see stored_in); without one, each step computes it again.
    """
    c = config or Config()
    own = definitions.join(matching.shuffled(texts), "doc_id").select("doc_id", "def_id", "begin", T.covered_text(F.col("text"), F.col("begin"), F.col("end")).alias("text"))
    quoted = matching.quoted_term_spans(own.select("doc_id", "def_id", "text"), c.regex_terms, c.regex_abbreviations)
    quoted = quoted.join(matching.shuffled(definitions.select("doc_id", "def_id", F.col("begin").alias("_at"))), ["doc_id", "def_id"]).select("doc_id", "def_id", "term", (F.col("begin") + F.col("_at")).alias("begin"), (F.col("end") + F.col("_at")).alias("end"))
    quoted = store(quoted, "quoted")
    if parsed is not None:
        tokens_, chunks_ = parsed
        candidates = scoring.parsed_candidates(tokens_, chunks_, c.max_len_ngram, c.extract_supergrams) if candidates is None else candidates
        if dependencies is None:
            found_ = defined.subjects(tokens_, chunks_).join(matching.shuffled(segments.select("doc_id", F.col("seg_id").alias("sent_id"), F.col("begin").alias("_at"))), ["doc_id", "sent_id"])
            dependencies = found_.select("doc_id", "term", (F.col("begin") + F.col("_at")).alias("begin"), (F.col("end") + F.col("_at")).alias("end"))
        words = tokens_.groupBy("doc_id", "sent_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "text"))), lambda x: x["text"]).alias("tokens")).select("doc_id", "tokens")
    else:
        words = segments.select("doc_id", abbreviations.sentence_tokens(F.col("text")).alias("tokens"))
    pairs = abbreviations.abbreviation_pairs(words)
    short = pairs.select("doc_id", F.lower("short").alias("term")).unionByName(pairs.select("doc_id", F.lower("long").alias("term")))
    terms = (scoring.candidates(segments, c.max_len_ngram) if candidates is None else candidates).unionByName(short).distinct()
    # small plans: the driver keeps each one and its every change, and a step over all of them would fill its memory
    terms = store(terms, "terms")
    scored = scoring.idf(segments.select("doc_id", "seg_id", T.clean_text(F.col("text")).alias("text")), terms, c.max_len_ngram)
    scored = store(scored.select("doc_id", "term", "score"), "scored")
    listed = scoring.listed_terms(segments, whitelist, ("doc_id", "seg_id"))
    kept = scoring.precedence(scored, quoted.select("doc_id", "term").distinct(), listed, blacklist, regex_score=c.score_regex, whitelist_score=c.score_whitelist)
    kept = store(kept, "scores")
    own_segments = segments.select("doc_id", "seg_id", F.col("begin").alias("_at"), "text")

    def annotate(scores: DataFrame) -> DataFrame:
        hits = matching.dictionary_matches(own_segments, scores, ["doc_id", "seg_id", "_at"], ["doc_id"])
        placed = hits.select("doc_id", "term", (F.col("begin") + F.col("_at")).alias("begin"), (F.col("end") + F.col("_at")).alias("end"))
        return placed.join(matching.shuffled(scores.select("doc_id", "term", "score", "origin")), ["doc_id", "term"])

    tokens = store(annotate(kept), "tokens")
    deps = definitions.select("doc_id", F.lit("").alias("term"), "begin", "end").limit(0) if dependencies is None else dependencies
    deps = store(deps, "dependencies")
    found = store(defined.defined_terms(definitions, tokens, deps, quoted, c), "defined")
    # what the last stage found, and no list has, is looked up in the whole document as well
    tagged = found.filter("stage = 4").select("doc_id", "term").distinct().join(matching.shuffled(kept.select("doc_id", "term")), ["doc_id", "term"], "left_anti").join(blacklist.select("term"), "term", "left_anti")
    more = tagged.filter(~T.is_symbols_only(F.col("term"))).select("doc_id", "term", F.lit(c.score_tagger).alias("score"), F.lit("tagger").alias("origin"))
    if c.use_tagger and c.tagger_bio:
        tokens = tokens.unionByName(annotate(store(more, "tagged")))
    values = tokens.select("doc_id", "term", "begin", "end")
    if lemma_lookup is not None:
        words = values.select("term").distinct().select("term", F.posexplode(F.split("term", " ")).alias("i", "token")).join(lemma_lookup, "token", "left")
        lemma = words.groupBy("term").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("lemma", "token").alias("l")))).alias("x")).select("term", F.array_join(F.transform("x", lambda x: x["l"]), " ").alias("value"))
        values = values.join(lemma, "term")
    else:
        values = values.withColumn("value", F.col("term"))
    return {"token": tokens, "lemma": values.select("doc_id", "value", "begin", "end"), "dependency": deps, "defined": found.select("doc_id", "begin", "end").distinct(), "scores": kept.unionByName(more), "definition": definitions.select("doc_id", "begin", "end")}


def annotate_documents(texts: DataFrame, tags: DataFrame, definitions: DataFrame, whitelist: DataFrame, blacklist: DataFrame, dependencies: DataFrame | None = None, config: Config | None = None, store: Store = _lazy) -> dict[str, DataFrame]:
    """Concept extraction over the leaf tags of tagged documents, then the table rules."""
    c = config or Config()
    segments = store(spans.leaf_tags(tags, texts, c.tag_names).withColumnRenamed("tag_id", "seg_id"), "segments")
    return tables.table_annotations(tags, texts, concept_extraction(texts, segments, definitions, whitelist, blacklist, dependencies, c, store=store))


def answer_requests(bodies: DataFrame, whitelist: DataFrame, blacklist: DataFrame, config: Config | None = None, column: str = "value", store: Store = _lazy) -> DataFrame:
    """(doc_id, value): request bodies answered with their texts annotated: decoded, parsed, concepts extracted, tables' rules, written back.

    Definitions are the users' annotations of that kind and, where a text has none, its leaf tags.  doc_id is the body's hash, equal bodies are
    answered once; what cannot be decoded is echoed.
    """
    c = config or Config()
    requests = readers.decode_requests(bodies.select(column).distinct(), column).withColumn("doc_id", F.xxhash64(column))
    requests = store(requests, "requests")
    docs, tags, users = readers.parse_xmi(requests, c.sofa_id)
    docs, tags = store(docs, "texts"), store(tags, "tags")
    leaves = spans.leaf_tags(tags, docs, c.tag_names)
    marked = users.filter(F.col("kind") == "Definition_user").select("doc_id", F.xxhash64("begin", "end").alias("def_id"), "begin", "end").distinct()
    rest = leaves.select("doc_id", F.col("tag_id").alias("def_id"), "begin", "end").join(marked.select("doc_id").distinct(), "doc_id", "left_anti")
    definitions = store(marked.unionByName(rest), "definitions")
    found = annotate_documents(docs.select("doc_id", "text"), tags, definitions, whitelist, blacklist, None, c, store)
    kinds = {k: store(found[k], k) for k in ("token", "lemma", "dependency", "defined", "definition")}
    return writers.responses(requests, kinds, c.sofa_id)


def export_glossary(terms: DataFrame, vectors: DataFrame, concept_labels: DataFrame, threshold: float = 0.8, base: str = glossary.BASE_URI) -> DataFrame:
    """Triples of a glossary (term, definition): concepts, links among them and to labelled concepts (uri, label).

    vectors (term, embedding) hold both vocabularies; what has no vector gets no links.
    """
    own = terms.filter("definition <> ''")
    labels = own.select(glossary.term_uri(F.col("term"), base).alias("uri"), F.col("term").alias("label")).distinct()
    mine = vectors.join(labels.select(F.col("label").alias("term")).distinct(), "term", "left_semi").select(F.col("term").alias("vec_id"), "embedding")
    theirs = vectors.join(concept_labels.select(F.col("label").alias("term")).distinct(), "term", "left_semi").select(F.col("term").alias("vec_id"), "embedding")
    inner = glossary.similar_concepts(similarity.similar_pairs(mine, mine, threshold), labels, labels)
    outer = glossary.similar_concepts(similarity.similar_pairs(mine, theirs, threshold), labels, concept_labels)
    return glossary.term_triples(own, base).unionByName(glossary.link_triples(inner)).unionByName(glossary.link_triples(outer)).distinct()


def training_data(user_spans: DataFrame, tags: DataFrame, texts: DataFrame, users: tuple[str, ...] = ()) -> DataFrame:
    """(sent_id, pos, token, tag): definitions with users' terms as tagged tokens, without the quotation marks around terms."""
    marked = spans.user_annotations(user_spans, tags, texts, users)
    return bio.bio_tags(marked.select(F.xxhash64("doc_id", "tag_id").alias("sent_id"), T.strip_quotes(F.col("annotated")).alias("text")))
