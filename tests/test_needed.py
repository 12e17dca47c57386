"""Strings looked for before a pattern: a text in which it finds something holds one, and counts stay what they were."""

import random
import re

from loamstone.functions import needed, sheet
from loamstone.functions.sheet import SPARK


def test_needed_strings():
    assert needed.needed(r"(?i)\b(?:Buy|add\s+to\s+cart)\b") == {"buy", "cart"}
    assert needed.needed(r"colou?r|x{0}ab|(?:le)?ft") == {"colo", "ab", "ft"}
    assert needed.needed(r"(?:[^\n|]{1,30} \| ){3,}") == {" | "}
    for p in (r"\p{L}+", r"(?:abc)?\d", r"abc|\d+", r"(?x)a b", r"[a-z]+", "é", r"(?:ab)*"):
        assert needed.needed(p) is None, p


def test_counts_and_tests_stay(spark):
    rng = random.Random(2)
    pieces = ["Buy", "BUY now", "add  to\ncart", "Cart", "https://x.org", "WWW.", "it's essential", "…", "...", "©", "É", "İ", "K", "12", "😀", "Straße", "|", " | a", "<b>", "\r\n", "\t", "[1]", "(2001a)", "DOI: x"]
    texts = ["", None] + ["".join(rng.choice(pieces) + rng.choice(["", " ", "\n"]) for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    patterns = [
        r"(?i)\b(?:buy|add\s+to\s+cart)\b", r"(?i)https?://|www\.|utm_", r"(?i)\bit\x27s essential", r"(?:\.\.\.|…)$", r"©", r"(?i)(?:doi:\s*\S+|\[\d+\]|\(\d{4}[a-z]?\))", r"<[^>]+>|&[a-z]+;", r"(?:[^\n|]{1,30} \| ){1,}",
        r"\p{Lu}", r"[^0-9]", r"[\p{L}\p{N}]", r"[^\n\r\t ]", r"\p{L}",
    ]
    for p in patterns:
        bad = df.selectExpr(f"{SPARK.n('text', p)} AS a", f"CAST(regexp_count(text, r'{p}') AS DOUBLE) AS b", f"{SPARK.has('text', p)} AS c", f"regexp_like(text, r'{p}') AS d").where("NOT (a <=> b) OR NOT (c <=> d)")
        assert bad.count() == 0, p
    assert df.selectExpr(f"{SPARK.n('text', patterns[0])} AS a").where("a > 0").count() > 0


def test_patterns_wait_for_their_strings():
    assert re.match(r"\(CASE WHEN NOT \(contains\(lower\(text\), 'buy'\)", SPARK.n("text", r"(?i)\bbuy\b"))
    assert "regexp_count" not in SPARK.n("text", r"[\p{L}\p{N}]") and "contains" not in sheet.DUCK.n("text", r"(?i)\bbuy\b")
