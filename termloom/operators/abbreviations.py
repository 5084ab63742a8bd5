"""Abbreviations and the words that they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions import text as T
from termloom.functions.words import STOP_WORDS


def long_form(tokens: Column, i: Column) -> Column:
    """The words before place i (from 0) whose initials give the token there; null if they do not.

    The abbreviation's letters are read from the end.  For each upper-case letter, stop words, apostrophes and opening brackets
    before it are skipped unless they begin with it; then the next word must begin with it, in any case.  Other letters
    pass a word unchecked.
    """
    short = F.get(tokens, i)
    letters = F.reverse(F.filter(F.split(short, ""), lambda c: c != ""))
    stop = list(STOP_WORDS)
    place = lambda j, k: i - j - k
    word = lambda p: F.when(p >= 0, F.get(tokens, p))
    upper = lambda c: c.rlike(r"^\p{Lu}$")

    def skips(p: Column, c: Column) -> Column:
        return T.let(word(p), lambda w: F.coalesce((F.substring(w, 1, 1) != c) & (w.isin(stop) | (w == "’") | w.startswith("(")), F.lit(False)))

    def step(acc: Column, x: Column) -> Column:
        j, c = x["j"], x["c"]
        p = place(j, acc["k"])
        # how many places in a row are skipped, from p backwards
        back = F.filter(F.sequence(F.lit(0), F.greatest(p, F.lit(0))), lambda n: ~skips(p - n, c))
        skipped = F.when(upper(c) & (p >= 0), F.coalesce(F.array_min(back), p + 1)).otherwise(F.lit(0))

        def passed(k: Column) -> Column:
            q = place(j, k)
            fits = (q >= 0) & (~upper(c) | (F.lower(F.substring(word(q), 1, 1)) == F.lower(c)))
            return F.struct(k.alias("k"), (acc["ok"] & F.coalesce(fits, F.lit(False))).alias("ok"))

        return T.let((acc["k"] + skipped).cast("int"), passed)

    indexed = F.transform(letters, lambda c, j: F.struct(c.alias("c"), j.alias("j")))
    end = F.aggregate(indexed, F.struct(F.lit(1).alias("k"), F.lit(True).alias("ok")), step)

    def between(end: Column) -> Column:
        first = F.greatest(i - F.length(short) - end["k"] + 1, F.lit(0))
        words = F.filter(F.slice(tokens, first + 1, F.greatest(i - first, F.lit(0))), lambda w: ~w.isin("’", "(", "{", "["))
        return F.when(end["ok"], F.trim(F.array_join(words, " ")))

    return T.let(end, between)


def abbreviation_pairs(sentences: DataFrame) -> DataFrame:
    """(doc_id, short, long) of abbreviations in sentences (doc_id, tokens)."""
    at = sentences.select("doc_id", "tokens", F.posexplode("tokens").alias("i", "short")).filter(T.is_abbreviation(F.col("short"), STOP_WORDS))
    return at.select("doc_id", "short", long_form(F.col("tokens"), F.col("i")).alias("long")).filter("long is not null").distinct()


def sentence_tokens(text: Column) -> Column:
    """Words and single marks of a text, for texts that come without a parse."""
    return F.regexp_extract_all(text, F.lit(r"(?U)\w+|[^\w\s]"), 0)
