"""Small corpora with the awkward cases: nulls, empty and long texts, ties, repeats, odd columns."""

from __future__ import annotations

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, bands string, toxic string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(rng, n):
    syllables = ["ba", "ce", "di", "fo", "gu", "ha", "je", "ki", "lo", "mu", "né", "or"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


def edited(rng, text, share):
    return " ".join("xx" + prose(rng, 1) if rng.random() < share else w for w in text.split())


def rows(seed=0):
    rng = random.Random(seed)
    texts = [None, "", " \n ", "one", "One  one", prose(rng, 6000)]
    base = [prose(rng, rng.randint(30, 200)) for _ in range(12)]
    passage = prose(rng, 70)
    for b in base:
        texts += [b, b, b.upper() if rng.random() < 0.3 else b, edited(rng, b, 0.01), edited(rng, b, 0.03), edited(rng, b, 0.2)]
        texts.append(prose(rng, 40) + " " + passage + "\n" + prose(rng, 10))
    texts += [base[0] + " " + base[1], passage + " " + passage, "日本語 " * 60, "a" * 5000]
    out = [(k, t, "en", "s", len(t or ""), "clash", "clash") for k, t in enumerate(texts)]
    rng.shuffle(out)
    return [*out, (None, base[2], None, None, None, None, None), out[3]]


def frame(spark, seed=0):
    return spark.createDataFrame(rows(seed), DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
