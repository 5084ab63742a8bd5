"""String functions and predicates as columns; all run in the JVM."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from termloom.functions.words import CONTRACTIONS, EXTRA_SYMBOLS, INVALID_POS, invalid_words

BEGIN, END = "★", "☆"
#: Quotation marks, and what stands for unknown tokens, as a class of single characters.
QUOTES = r"[‘\"`'’•“‧\[UNK\]]"


def strip(c: Column) -> Column:
    """Without white space at either end, in the Unicode sense."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def covered_text(text: Column, begin: Column, end: Column) -> Column:
    """The text of a span."""
    return F.substring(text, (begin + 1).cast("int"), (end - begin).cast("int"))


def clean_text(c: Column, contractions: Iterable[tuple[str, str]] = CONTRACTIONS) -> Column:
    """Lower case, plain blanks, contractions written out."""
    out = F.translate(F.lower(c), " ’", " '")
    for short, long in contractions:
        out = F.replace(out, F.lit(short), F.lit(long))
    return out


def clean_term(c: Column) -> Column:
    """A term without the enumeration in front of it: letters or numbers with dots, signs in brackets, stars."""
    # The four patterns.
    out = F.regexp_replace(strip(c), r"^[.A-Za-z/]*?(?=\.+?\s)", "")
    out = strip(F.regexp_replace(out, r"^[0-9./]*?(?=\.*?[\s*])", ""))
    out = strip(F.regexp_replace(out, r"^[*. ]+", ""))
    return strip(F.regexp_replace(F.regexp_replace(out, r"^\([-+*]\)\s*", ""), r"^[*. ]+", ""))


def offset_in(needle: Column, hay: Column) -> Column:
    """(begin, end) of the first occurrence, ignoring case; null if there is none."""
    at = F.instr(F.lower(hay), F.lower(needle))
    return F.when(at > 0, F.struct((at - 1).cast("long").alias("begin"), (at - 1 + F.length(needle)).cast("long").alias("end")))


def lower_case(c: Column) -> Column:
    return F.lower(c)


def single_space(c: Column) -> Column:
    """Two blanks become one, in a single pass."""
    return F.replace(c, F.lit("  "), F.lit(" "))


def join_words(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit("_"))


def single_underscore(c: Column) -> Column:
    return F.replace(c, F.lit("__"), F.lit("_"))


#: the steps of word preprocessing, in the order in which any choice of them applies
STEPS = (lower_case, strip, single_space, join_words, single_underscore)


def preprocess_word(c: Column, lower: bool = True, join: bool = True) -> Column:
    """A word in the form in which it is looked up: stripped, blanks halved, lower case, joined by underscores."""
    out = single_space(strip(c))
    out = F.lower(out) if lower else out
    return single_underscore(join_words(out)) if join else out


def with_steps(c: Column, chosen: Column | int) -> Column:
    """The steps whose bit is set in `chosen` (bit 0 is the first step); a column chooses for each row."""
    for k, step in enumerate(STEPS):
        if isinstance(chosen, int):
            c = step(c) if chosen >> k & 1 else c
        else:
            c = F.when(F.shiftright(chosen, k).bitwiseAND(1) == 1, step(c)).otherwise(c)
    return c


def clean_string(c: Column) -> Column:
    """A cell on one line with single blanks."""
    lines = F.regexp_replace(F.regexp_replace(c, r"\R$", ""), r"\R", " ")
    return strip(F.regexp_replace(lines, " +", " "))


def strip_quotes(c: Column, begin: str = BEGIN, end: str = END) -> Column:
    """Without the quotation marks next to term markers."""
    for mark in (begin, end):
        c = F.regexp_replace(c, f"{mark} *{QUOTES}", f" {mark} ")
        c = F.regexp_replace(c, f"{QUOTES} *{mark}", f" {mark} ")
    return c


def mark_spans(text: Column, spans: Column, begin: str = BEGIN, end: str = END) -> Column:
    """Text with markers around its spans, an array of (begin, end) in order; empty without spans."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(acc["out"], covered_text(text, acc["at"], s["begin"]), F.lit(f" {begin} "), covered_text(text, s["begin"], s["end"]), F.lit(f" {end} "))
        return F.struct(s["end"].cast("long").alias("at"), piece.alias("out"))

    whole = F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(F.lit(""))


def uppercase_share(c: Column) -> Column:
    """Upper-case letters by all characters."""
    return F.length(F.regexp_replace(c, r"[^\p{Lu}]", "")) / F.length(c)


def is_abbreviation(token: Column, stop_words: Sequence[str]) -> Column:
    """Mostly upper case, 2 to 5 letters, no stop word, no small Roman number."""
    return (uppercase_share(token) > 0.5) & (F.length(token) > 1) & (F.length(token) < 6) & ~F.lower(token).isin(list(stop_words)) & ~token.rlike("^[VI]+$") & token.rlike(r"^\p{L}+$")


def is_bounded(text: Column, begin: Column, end: Column, special: Sequence[str] = ("-", "_", "+")) -> Column:
    """No letter and no special character stands directly before or after the span."""
    extra = "".join(f"\\{c}" for c in special)
    letter = rf"^[\p{{L}}{extra}]"
    before = F.when(begin > 0, F.substring(text, begin.cast("int"), F.lit(1))).otherwise(F.lit(""))
    after = F.substring(text, (end + 1).cast("int"), F.lit(1))
    return ~before.rlike(letter) & ~after.rlike(letter)


def is_symbols_only(c: Column) -> Column:
    """Nothing but digits, punctuation, blanks and a few symbols."""
    ascii_marks = "".join(f"\\{x}" for x in string.punctuation)
    return c.rlike(rf"^[0-9 {ascii_marks}{EXTRA_SYMBOLS}]+\n?$")


def is_valid_term(tokens: Column, pos: Column | None = None) -> Column:
    """All tokens are letters, none is an invalid word, the term has over one character; no invalid part of speech."""
    ok = F.forall(tokens, lambda t: t.rlike(r"^\p{L}+$")) & ~F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in invalid_words()])) & (F.length(F.array_join(tokens, " ")) > 1)
    return ok if pos is None else ok & ~F.arrays_overlap(pos, F.array(*[F.lit(p) for p in INVALID_POS]))


def drop_determiner(tokens: Column, pos: Column) -> Column:
    """Tokens less a leading determiner."""
    return F.when(F.get(pos, F.lit(0)) == "DET", F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0)))).otherwise(tokens)


def lemmas(tokens: Column, lookup: Column) -> Column:
    """Tokens' lemmas by a map, identity where it has none, joined by blanks."""
    return F.array_join(F.transform(tokens, lambda t: F.coalesce(F.element_at(lookup, t), t)), " ")


def tagger_term(c: Column) -> Column:
    """A tagger's term without marks at its ends; null if an unknown token is left inside. U, N and K count as marks."""
    marks = "".join(f"\\{x}" for x in string.punctuation) + "‘’•”‧ UNK"
    bare = F.regexp_replace(c, f"^[{marks}]+|[{marks}]+$", "")
    return F.when((bare != "") & ~bare.contains("[UNK]"), bare)


def flexible_pattern(term: Column) -> Column:
    """A pattern that finds a tokenised term in plain text: blanks and line feeds may or may not stand between tokens."""
    quoted = F.transform(F.filter(F.split(term, r"\s+"), lambda t: t != ""), lambda t: F.regexp_replace(t, r"([^\p{L}\p{N}_])", r"\\$1"))
    return F.concat(F.lit("(?iu)"), F.array_join(quoted, "[ \\n]*"))


def synset_id(offset: Column, pos: Column) -> Column:
    """Eight digits, a hyphen and the part of speech."""
    return F.format_string("%08d-%s", offset, pos)


def ngrams(tokens: Column, most: int) -> Column:
    """All runs of 1 to `most` tokens, joined by blanks."""
    of = lambda n: F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))
    return F.flatten(F.array(*[of(n) for n in range(1, most + 1)]))


def ngrams_from(tokens: Column, most: int, begins: Callable[[Column], Column]) -> Column:
    """Those runs of 1 to `most` tokens, joined by blanks, whose first token is such a one."""
    starts = F.filter(F.sequence(F.lit(1), F.size(tokens)), lambda i: begins(F.get(tokens, i - 1)))
    of = lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(most), F.size(tokens) - i + 1)), lambda n: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) > 0, F.flatten(F.transform(starts, of)))


def word_tokens(c: Column) -> Column:
    """Lower-cased words of two characters and more; shorter ones vanish, so their neighbours come to stand together."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"(?U)\b\w\w+\b"), 0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often the body's lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: elements that are summed together by running_totals
STRIDE = 32


def running_totals(lengths: Column) -> Column:
    """What stands before each element of an array<long> in total: sums of strides first, so the work grows little faster than the array.

    Elements are taken one by one, for a slice inside a lambda would copy the whole array.
    """
    zero = F.lit(0).cast("long")
    none = F.array().cast("array<bigint>")

    def before(values: Column, start: Column) -> Column:
        """Totals before each value, from start on."""
        first = F.struct(start.alias("total"), none.alias("out"))
        return F.aggregate(values, first, lambda a, x: F.struct((a["total"] + x).alias("total"), F.concat(a["out"], F.array(a["total"])).alias("out")))["out"]

    def totals(x: Column) -> Column:
        n = F.size(x)
        within = lambda k: F.transform(F.sequence(k * STRIDE, F.least(k * STRIDE + STRIDE - 1, n - 1)), lambda i: F.get(x, i))
        strides = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / STRIDE).cast("int")), within)
        sums = lambda s: F.transform(s, lambda v: F.aggregate(v, zero, lambda a, y: a + y))
        return F.when(n > 0, let(strides, lambda s: F.flatten(F.zip_with(s, before(sums(s), zero), before)))).otherwise(none)

    return let(lengths, totals)


def regex_spans(text: Column, pattern: Column) -> Column:
    """Array of (match, begin, end) of all matches: lengths of the matches and of what lies between add up to offsets."""
    m, g = F.regexp_extract_all(text, pattern, 0), F.split(text, pattern, -1)
    size = lambda x: F.coalesce(F.length(x).cast("long"), F.lit(0).cast("long"))
    steps = F.zip_with(m, F.slice(g, 1, F.size(m)), lambda x, between: F.struct(x.alias("match"), size(between).alias("gap"), size(x).alias("n")))
    placed = lambda x, t: F.struct(x["match"].alias("match"), (t + x["gap"]).alias("begin"), (t + x["gap"] + x["n"]).alias("end"))
    return let(steps, lambda s: F.zip_with(s, running_totals(F.transform(s, lambda x: x["gap"] + x["n"])), placed))


def quoted_terms(text: Column, terms: str, abbreviations: str) -> Column:
    """Array of (term, begin, end): what stands in quotation marks, abbreviations first, without the marks and in lower case."""

    def inside(pattern: str) -> Column:
        spans = F.filter(regex_spans(text, F.lit(pattern)), lambda x: F.length(x["match"]) > 2)
        return F.transform(spans, lambda x: F.struct(F.lower(F.substring(x["match"], F.lit(2), F.length(x["match"]) - 2)).alias("term"), (x["begin"] + 1).alias("begin"), (x["end"] - 1).alias("end")))

    return F.array_union(inside(abbreviations), inside(f"(?iu){terms}"))
