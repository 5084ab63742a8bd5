"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all preceding turns are context and only that reply is
trainable.  The template is

    <|turn|>ROLE<|text|>TEXT<|end|>   (one after another)

Control strings inside roles and texts are escaped reversibly: a backslash is doubled, and one is put after the
first character of ``<|``, ``<s>``, ``</s>``, ``[INST]`` and ``[/INST]``, so that no control string of this or
another common template survives inside a text.

Defined results: a null role or text is empty; rows whose conversation or turn id is null form a conversation of their
own or come first in it, as any value would; repeated turn numbers keep all rows, ordered by turn, role, text; a
conversation that ends in other turns gets one example more, with nothing trainable, so that no turn is lost;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: first characters of control strings, by look-ahead at the rest
_CONTROL = r"<(?=\||/?s>)|\[(?=/?INST\])"


def escape(c: Column) -> Column:
    """The text without control strings; ``unescape`` undoes it."""
    return F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), _CONTROL, r"$0\\")


def unescape(c: Column) -> Column:
    """The text that was given to ``escape``: a lone backslash goes, a doubled one becomes single."""
    return F.regexp_replace(c, r"\\(\\?)", "$1")


def render(role: Column, text: Column) -> Column:
    """One turn in the template; a null role or text is empty."""
    part = lambda c: escape(F.coalesce(c.cast("string"), F.lit("")))
    return F.concat(F.lit(TURN), part(role), F.lit(TEXT), part(text), F.lit(END))


def expand(conversations: DataFrame) -> DataFrame:
    """Examples (conv_id, example, n_turns, formatted, loss_start, loss_length), loss in code points of formatted.

    example counts from 1 within a conversation. loss_start and loss_length are null in the example that only keeps
    the turns after the last assistant turn.  One shuffle, by conv_id; texts of a conversation grow with its
    turns squared, as the method has it.
    """
    turn = F.struct(F.col("turn"), F.col("role"), F.col("text"))
    by_conv = conversations.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    parts = by_conv.select("conv_id", F.transform("turns", lambda t: render(t["role"], t["text"])).alias("parts"), F.transform("turns", lambda t: F.coalesce(t["role"] == "assistant", F.lit(False))).alias("replies"))
    targets = F.filter(F.sequence(F.lit(1), F.size("parts")), lambda i: F.get("replies", i - 1) | (i == F.size("parts")))
    e = parts.select("conv_id", "parts", "replies", F.posexplode(targets).alias("at", "n_turns"))
    context = F.array_join(F.slice("parts", 1, F.col("n_turns") - 1), "")
    last = F.get("parts", F.col("n_turns") - 1)
    reply = F.get("replies", F.col("n_turns") - 1)
    head = F.lit(len(TURN) + len("assistant") + len(TEXT))
    return e.select(
        "conv_id",
        (F.col("at") + 1).alias("example"),
        "n_turns",
        F.concat(context, last).alias("formatted"),
        F.when(reply, F.length(context) + head).cast("long").alias("loss_start"),
        F.when(reply, F.length(last) - head - len(END)).cast("long").alias("loss_length"),
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a formatted example holds."""
    parts = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")
    pair = lambda p: F.split(F.substring(p, len(TURN) + 1, 1 << 30), r"<\|text\|>", 2)
    return F.transform(parts, lambda p: F.struct(unescape(F.get(pair(p), F.lit(0))).alias("role"), unescape(F.get(pair(p), F.lit(1))).alias("text")))


def digest(examples: DataFrame) -> DataFrame:
    """A row for each conversation: what its examples say when they are read back."""
    masked = F.when(F.col("loss_start").isNotNull(), F.substring(F.col("formatted"), F.col("loss_start").cast("int") + 1, F.col("loss_length").cast("int")))
    per = examples.select("conv_id", "example", "n_turns", "formatted", unescape(F.coalesce(masked, F.lit(""))).alias("loss"))
    one = per.groupBy("conv_id").agg(
        F.max_by("formatted", "n_turns").alias("whole"),
        F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.count("*").alias("n_examples"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
    turns = F.transform(read_back(F.col("whole")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    one = one.select("conv_id", turns.alias("turns"), F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"), "n_examples", "formatted_chars")
    return one.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
    )
