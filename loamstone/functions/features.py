"""Document features as column expressions: shape, repetition, junk, code and script signals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamstone.functions import text as T
from loamstone.functions.peers import clip

#: Patterns counted by the features; Java and RE2 read them alike.
URL = r"https?://\S+|www\.\S+"
YEAR = r"\b(?:1[5-9]|20)\d\d\b"
CITATION = r"\[\d{1,3}\]|\([A-Z][a-z]+,? (?:19|20)\d\d\)"
BULLET = r"^(?:[-*+]|\d+[.)]) "
COPULA = r"(?i)\b(?:is|are|was|were|means|refers to)\b"
STEP = r"(?i)\b(?:step|first|second|third|then|next|finally)\b"
COOKIE = r"(?i)\b(?:cookies?|privacy policy|terms of (?:use|service)|all rights reserved|sign in|log in|subscribe|newsletter)\b"
PRICE = r"[$€£]\s?\d|\d\s?(?:usd|eur|gbp)\b"
BUY = r"(?i)\b(?:buy|order|cart|checkout|shipping|discount|free trial|best price|offers?)\b"
DISCOURSE = r"(?i)^(?:moreover|furthermore|in conclusion|additionally|overall|in short|in summary|to be fair|as a rule|in practice)\b"
HEDGE = r"(?i)\b(?:perhaps|maybe|arguably|it is important to note|generally|roughly|often|rarely)\b"
CODE_LINE = r"^(?:def |class |import |from \S+ import|#include|public |private |return\b|for .*:$|if .*:$|assert |\}|\{)|[;{}]$"
NAV_LINE = r"^[^.!?]{1,80}$"
TAG = r"</?[a-zA-Z][^<>]{0,200}>"


def count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("double")


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def raw_features(c: Column) -> dict[str, Column]:
    """Counts and ratios of a text with its lines: the raw features of a document."""
    ls, ws = T.lines(c), T.words(c)
    n, lines_n, words_n = F.length(c).cast("double"), F.size(ls).cast("double"), F.size(ws).cast("double")
    of_lines = lambda p: ratio(F.size(F.filter(ls, lambda x: x.rlike(p))).cast("double"), lines_n)
    return {
        "chars": n, "lines": lines_n, "words": words_n,
        "digit_ratio": ratio(count(c, r"[0-9]"), n),
        "upper_ratio": ratio(count(c, r"\p{Lu}"), n),
        "alpha_ratio": ratio(count(c, r"\p{L}"), n),
        "space_ratio": ratio(count(c, r"[ \t\n\r]"), n),
        "urls": count(c, URL), "years": count(c, YEAR), "citations": count(c, CITATION),
        "copulas": count(c, COPULA), "steps": count(c, STEP),
        "questions": count(c, r"\?"), "sentences": count(c, r"[.!?](?:\s|$)"),
        "fences": count(c, "```"), "bullet_ratio": of_lines(BULLET), "table_ratio": of_lines(r"\|.*\|"),
        "code_ratio": of_lines(CODE_LINE), "mean_line": ratio(n, lines_n), "mean_word": ratio(F.aggregate(ws, F.lit(0.0), lambda s, x: s + F.length(x)), words_n),
    }


def line_repetition(c: Column) -> Column:
    """Share of non-blank lines that repeat an earlier one."""
    ls = T.lines(c)
    n = F.size(ls)
    return F.when(n > 0, (n - F.size(F.array_distinct(ls))) / n).otherwise(0.0)


def word_diversity(c: Column) -> Column:
    """Distinct words over words."""
    ws = T.words(F.lower(c))
    return F.when(F.size(ws) > 0, F.size(F.array_distinct(ws)) / F.size(ws)).otherwise(0.0)


def filters(c: Column) -> dict[str, Column]:
    """Junk scores in [0, 1]: boilerplate, transaction, templates, verbosity, enthusiasm, low information, shouting."""
    ws = F.size(T.words(c)).cast("double")
    ls = T.lines(c)
    n = F.size(ls).cast("double")
    sent = F.filter(F.split(c, r"(?:[.!?]\s+)|\n"), lambda x: x != "")
    openers = F.size(F.filter(sent, lambda s: s.rlike(DISCOURSE))).cast("double")
    return {
        "boilerplate": clip(ratio(count(c, COOKIE), n)),
        "transaction": clip(ratio(2 * count(c, PRICE) + count(c, BUY), ws) * 10),
        "templates": clip(ratio(openers, F.size(sent).cast("double"))),
        "hedging": clip(ratio(count(c, HEDGE), ws) * 20),
        "enthusiasm": clip(ratio(count(c, r"!"), F.size(sent).cast("double"))),
        "shouting": clip(ratio(F.size(F.filter(ls, lambda x: (x == F.upper(x)) & x.rlike(r"\p{Lu}{3}"))).cast("double"), n)),
        "low_information": clip(1 - word_diversity(c)),
        "markup": clip(ratio(count(c, TAG), n)),
    }


SCRIPTS = {"latin": r"\p{IsLatin}", "cyrillic": r"\p{IsCyrillic}", "devanagari": r"\p{IsDevanagari}", "arabic": r"\p{IsArabic}", "han": r"\p{IsHan}", "kana": r"[\p{IsHiragana}\p{IsKatakana}]"}


def script_profile(c: Column) -> dict[str, Column]:
    """Signs by script and the number of scripts with at least a twentieth of them."""
    n = {k: F.regexp_count(c, F.lit(p)).cast("double") for k, p in SCRIPTS.items()}
    total = sum(n.values(), F.lit(0.0))
    active = sum((F.when(ratio(v, total) >= 0.05, 1).otherwise(0) for v in n.values()), F.lit(0))
    return n | {"active": active, "mixed": F.when(active > 1, 0.28 * (active - 1)).otherwise(0.0)}


def entropy(c: Column) -> Column:
    """Shannon entropy of a text's signs in bits, from its map of counts: one pass, in the row."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")

    def of(v: Column) -> Column:
        t, n = v["t"], v["n"]
        # counts by length difference: removing a sign shortens the text by its count
        p = F.transform(v["d"], lambda ch: (n - F.length(F.replace(t, ch))) / n)
        return F.aggregate(p, F.lit(0.0), lambda s, x: s - x * F.log2(x))

    return T.let(F.struct(c.alias("t"), F.length(c).cast("double").alias("n"), F.array_distinct(chars).alias("d")), of)
