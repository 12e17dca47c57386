"""Column functions over text: normalisation, hashing, lines and words. All stay inside the JVM but NFC."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

def let(value: Column, body) -> Column:
    """body(v) with v bound to the value once.

    Inside the lambdas of array functions a plain column expression is
    evaluated for every element; a bound variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


SPACE = r"[\s\p{Z}\x{85}]+"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def nfc(c: Column) -> Column:
    """Unicode form C. Only texts with combining marks or conjoining signs travel to Python; the rest are sent as nulls."""
    need = c.rlike(r"[\p{M}\x{1100}-\x{11FF}\x{212A}\x{212B}\x{2126}\x{F900}-\x{FAFF}]")
    return F.coalesce(_nfc(F.when(need, c)), c)


def collapse_space(c: Column) -> Column:
    """Runs of Unicode white space become one blank; ends are trimmed."""
    return F.trim(F.regexp_replace(c, SPACE, " "))


def minimal_normalize(c: Column) -> Column:
    """Control characters dropped, white space collapsed: the flat text of the merge path."""
    return collapse_space(F.regexp_replace(c, CONTROL, ""))


def meaningful_chars(c: Column) -> Column:
    """Number of letters and numbers."""
    return F.length(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))


def dedup_normalize(c: Column) -> Column:
    """NFC, no control characters, white space collapsed, lower case."""
    return F.lower(minimal_normalize(nfc(c)))


def content_hash(c: Column) -> Column:
    """SHA-256 of the text as normalised for deduplication."""
    return F.sha2(dedup_normalize(c), 256)


def token_hash(c: Column) -> Column:
    """First eight bytes of the SHA-256 as a signed number; the bits are those of the unsigned value."""
    high, low = (F.conv(F.substring(F.sha2(c, 256), at, 8), 16, 10).cast("bigint") for at in (1, 9))
    return F.shiftleft(high, 32).bitwiseOR(low)


def fragment_normalize(c: Column) -> Column:
    """Fuzzy form of a line: lower case, digits as #, other signs dropped."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(c), SPACE, " "), r"\d", "#"), r"[^\p{L}\p{N}# ]", ""))


def lines(c: Column) -> Column:
    """Non-blank lines, trimmed."""
    return F.filter(F.transform(F.split(c, r"\r\n|\r|\n"), lambda x: F.trim(x)), lambda x: x != "")


def words(c: Column) -> Column:
    """White-space tokens of the flat text."""
    return F.filter(F.split(c, SPACE), lambda x: x != "")


def paragraphs(c: Column) -> Column:
    """Blocks between blank lines, trimmed."""
    return F.filter(F.transform(F.split(F.regexp_replace(c, r"\r\n?", "\n"), r"\n[ \t]*\n+"), lambda x: F.trim(x)), lambda x: x != "")


def collapse_repeated_lines(c: Column) -> Column:
    """Drops a line equal to the line before it."""
    return let(F.split(c, "\n"), lambda ls: F.array_join(F.filter(ls, lambda x, i: (i == 0) | (x != F.element_at(ls, F.greatest(i, F.lit(1)))) | (F.trim(x) == "")), "\n"))


def sample_ends(c: Column, limit: int) -> Column:
    """Head and tail of a text over the limit; the tail is the lesser of 2048 and a quarter of the limit."""
    tail = min(2048, limit // 4)
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(F.substring(c, 1, limit - tail), F.right(c, F.lit(tail))))


def ascii_punctuation(c: Column) -> Column:
    """Typographic quotes, dashes and blanks in ASCII; invisible signs dropped."""
    return F.regexp_replace(F.translate(c, "‘’‚‛“”„‟–—―\u00a0\u2009\u202f", "''''\"\"\"\"---   "), "[\u200b\u200c\u200d\u2060\ufeff\u00ad]", "")


def full_normalize(c: Column) -> Column:
    """NFC, ASCII quotes, line ends as LF, no trailing blanks, single blanks, at most one blank line, repeated marks as one."""
    t = F.regexp_replace(ascii_punctuation(nfc(c)), r"\r\n?", "\n")
    t = F.regexp_replace(F.regexp_replace(t, r"[ \t]+\n", "\n"), r"[ \t]{2,}", " ")
    t = F.regexp_replace(t, r"([!?,;:])\1+", "$1")
    return F.trim(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def repair_formatting(c: Column) -> Column:
    """Escaped markdown signs unescaped, empty links and empty list items dropped, split punctuation joined."""
    t = F.regexp_replace(c, r"\\([*_#\[\]()~`>+.!-])", "$1")
    t = F.regexp_replace(t, r"\[\s*\]\([^)]*\)", "")
    t = F.regexp_replace(t, r"(?m)^[ \t]*[-*+][ \t]*$\n?", "")
    return F.regexp_replace(t, r"[ \t]+([,.;:!?])(?=\s|$)", "$1")
