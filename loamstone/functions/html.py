"""Markup removal by rules, inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Named entities of HTML that texts carry most.
ENTITIES = (("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("#39", "'"), ("mdash", "—"), ("ndash", "–"), ("hellip", "…"), ("copy", "©"), ("amp", "&"))


def strip_markup(c: Column) -> Column:
    """Scripts and styles dropped, breaks and block ends as line feeds, other tags as blanks, entities decoded."""
    t = F.regexp_replace(c, r"(?is)<(script|style|noscript)\b.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</(?:p|div|li|tr|h[1-6])\s*>", "\n")
    t = F.regexp_replace(t, r"<!--[\s\S]*?-->|</?[a-zA-Z][^<>]*>", " ")
    for name, sign in ENTITIES:
        t = F.replace(t, F.lit(f"&{name};"), F.lit(sign))
    t = F.regexp_replace(F.regexp_replace(t, r"[ \t]+", " "), r" ?\n ?", "\n")
    return F.trim(F.regexp_replace(t, r"\n{3,}", "\n\n"))
