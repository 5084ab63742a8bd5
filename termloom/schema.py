"""Schemas of the tables that the operators exchange; offsets are 0-based, half-open, in code points."""

from __future__ import annotations

from pyspark.sql import types as T

_L, _S, _D = T.LongType(), T.StringType(), T.DoubleType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


DOCS = _schema(doc_id=_L, view=_S, text=_S)
TAGS = _schema(doc_id=_L, tag_id=_L, tag_name=_S, attributes=_S, begin=_L, end=_L)
SPANS = _schema(doc_id=_L, begin=_L, end=_L)
TERM_SPANS = _schema(doc_id=_L, term=_S, begin=_L, end=_L, score=_D, origin=_S)
LEMMA_SPANS = _schema(doc_id=_L, value=_S, begin=_L, end=_L)
USER_SPANS = _schema(doc_id=_L, kind=_S, user=_S, datetime=_S, term=_S, begin=_L, end=_L)
TERM_SCORES = _schema(doc_id=_L, term=_S, score=_D, origin=_S)
TOKENS = _schema(doc_id=_L, sent_id=_L, i=_L, text=_S, idx=_L, pos=_S, dep=_S, head_i=_L, lemma=_S, left_edge_i=_L, right_edge_i=_L)
VOCABULARY = _schema(idx=_L, term=_S)
TRIPLES = _schema(s=_S, p=_S, o=_S, o_is_literal=T.BooleanType(), o_lang=_S)
CONCEPT_LABELS = _schema(uri=_S, label=_S)
RELATIONS = _schema(uri1=_S, uri2=_S, relation=_S, ord=_L)
GLOSSARY = _schema(name=_S, definition=_S, lemma=_S, acceptance_state=_S)
BIO = T.StructType([T.StructField(n, _S) for n in ("Sentence #", "Word", "POS", "Tag")])
ALIGN_ONE = _schema(voc=T.ArrayType(_S))
ALIGN_TWO = _schema(voc1=T.ArrayType(_S), voc2=T.ArrayType(_S))
REQUEST = _schema(cas_content=_S, content_type=_S)
