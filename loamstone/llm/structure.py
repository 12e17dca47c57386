"""Problem 10: per-document text statistics and the verdict whether it is natural prose.

Each line (long ones cut at sentence ends) gets a distribution over function
words of any known language, other words, numbers, mixed and symbol tokens and
long unbroken strings. It is set against structural profiles by Jensen-Shannon
divergence, and takes the nearest. The verdict of a document weighs its
lines by their letters and signs, its source's repeated lines left out.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstone.functions.arrow import flat_map
from loamstone.llm.language import FUNCTION_WORDS, fold
from loamstone.llm.lines import LEAST_SHARE, has_words, keys_by_source, line_hash, repeated_lines
from loamstone.sources.tables import spread, table

#: Function words of languages beside those of the language operator.
MORE_FUNCTION_WORDS = (
    "и в во не на но за по к ко с со от из у о об же как то так что это этот эта эти того был была было были его её их он она они мы вы я ты бы ли уже только тоже также"
    " впервые даже несмотря без через между двумя при для до после или если когда где году более больше"
    " को के का की में है हैं और भी ही से पर यह वह नहीं तक एक था थी थे ने कर सकता सकती केवल लिए बाद पहली बार सन जो कि दोनों"
    " في من على إلى الى عن أن ان هذا هذه التي الذي كان كانت لا ما مع بعد قبل بين أو او ثم لم لن قد كل غير عام خلال دون فقط بل أيضا"
)
COMMON = frozenset({form for text in FUNCTION_WORDS.values() for w in text.split() for form in (w, fold(w)) if len(w) > 1 or w in ("a", "y", "e", "à", "é", "o")} | set(MORE_FUNCTION_WORDS.split()))
#: Structural profiles over (function words, other words, numbers, mixed tokens, symbols, long strings).
PROFILES = {
    "prose": (0.42, 0.53, 0.03, 0.01, 0.005, 0.005),
    "prose_plain": (0.27, 0.68, 0.03, 0.01, 0.005, 0.005),
    "list": (0.02, 0.83, 0.05, 0.02, 0.08, 0.0),
    "table": (0.01, 0.28, 0.40, 0.04, 0.27, 0.0),
    "schedule": (0.02, 0.48, 0.30, 0.18, 0.02, 0.0),
    "code": (0.05, 0.22, 0.03, 0.50, 0.20, 0.0),
    "log": (0.06, 0.24, 0.20, 0.48, 0.02, 0.0),
    "links": (0.01, 0.10, 0.01, 0.38, 0.10, 0.40),
    "encoded": (0.0, 0.05, 0.02, 0.13, 0.0, 0.80),
    "garbled": (0.01, 0.04, 0.08, 0.57, 0.30, 0.0),
}
PROSE = ("prose", "prose_plain")
PUNCT = ".,;:!?\"'()[]{}<>«»“”„‘’*_-–—…·|/\\`~#>。，、；：？！「」『』（）।؟،"
LONG = 24
CUT = re.compile(r"(?<=[.!?])[\"'”»)]*\s+(?=[^\W\d_a-z]|[\"'“«(¿¡])|(?<=[。！？।؟])\s*")
#: A running number before a list entry; its word is no function word.
LABEL = re.compile(r"^(?:No|Nr|N|Nº|№)[.º°]?\s*\d+[.):]?\s+")
CJK = re.compile(r"[぀-ヿ㐀-鿿]")
LATIN_LOWER = re.compile(r"[a-zß-ÿ]")
_PROFILE_LOGS = {k: [(p, math.log2(p) if p else 0.0) for p in v] for k, v in PROFILES.items()}


def token_class(tok: str) -> int:
    """0 function word, 1 other word, 2 number, 3 mixed, 4 symbols, 5 long unbroken string."""
    bare = tok.strip(PUNCT)
    if not bare:
        return 4
    low = bare.lower()
    if low in COMMON:
        return 0
    if len(bare) >= LONG and not ("-" in bare and bare.replace("-", "").isalpha()):
        return 5
    if bare.isalpha():
        return 1 if bare[1:].islower() or bare.isupper() or not bare.isascii() else 3
    if bare.replace(".", "").replace(",", "").replace(":", "").isdigit() and len(bare) > 0:
        return 2 if ":" not in bare else 3
    inner = bare.replace("'", "").replace("’", "").replace("-", "")
    if inner.isalpha() and inner[1:].islower():
        if ("'" in bare or "’" in bare) and re.split(r"['’]", low)[0] in COMMON | {"l", "d", "s", "n", "c", "j", "m", "t", "qu", "dell", "nell", "all", "un"}:
            return 0
        return 1
    return 1 if not bare.isascii() and all(c.isalpha() or not c.isprintable() or ord(c) > 0x300 for c in bare) and "�" not in bare else 3


def jsd(dist: list[float], name: str) -> float:
    """Jensen-Shannon divergence in bits to a profile."""
    total = 0.0
    for p, (q, lq) in zip(dist, _PROFILE_LOGS[name]):
        m = (p + q) / 2
        if m:
            lm = math.log2(m)
            if p:
                total += p * (math.log2(p) - lm)
            if q:
                total += q * (lq - lm)
    return total / 2


class Profiler:
    """Statistics of texts; keeps the classes of the tokens and the nearest profiles of the distributions seen."""

    def __init__(self) -> None:
        self.tokens: dict[str, int] = {}
        self.nearest: dict[tuple[int, ...], tuple[str, float]] = {}

    def classes(self, toks: list[str]) -> list[int]:
        known = self.tokens
        if len(known) > 300_000:
            known.clear()  # memory only; classes are found anew
        out = []
        for t in toks:
            k = known.get(t)
            if k is None:
                k = known[t] = token_class(t)
            out.append(k)
        return out

    def profile(self, counts: tuple[int, ...]) -> tuple[str, float]:
        """Nearest profile of a distribution, short lines drawn towards none by half a token of each class."""
        got = self.nearest.get(counts)
        if got is None:
            n = sum(counts)
            dist = [c / n for c in counts]
            got = min(((name, jsd(dist, name)) for name in PROFILES), key=lambda x: (x[1], x[0]))
            if len(self.nearest) > 300_000:
                self.nearest.clear()
            self.nearest[counts] = got
        return got

    def unit(self, s: str) -> tuple[str, float, tuple[int, ...]]:
        """(profile, divergence, token counts) of a line or a piece of one."""
        if not s.isascii() and len(CJK.findall(s)) > 0.3 * len(s):
            # signs without spaces: sentences end in their stop, particles are signs
            grammar = sum(s.count(c) for c in "的了在是不也这和都而并はがをにでとのもいるた")
            n = max(1, len(s))
            prose = grammar / n > 0.06 and (s.rstrip("\"'”」』）) ")[-1:] in "。！？.!?" or len(s) > 30)
            return ("prose" if prose else "list"), 0.0, (grammar, n - grammar, 0, 0, 0, 0)
        if s[:1] in "N№" and (m := LABEL.match(s)):
            s = s[m.end() :]
        ks = self.classes(s.split())
        if not ks:
            return "list", 0.0, (0, 0, 1, 0, 0, 0)
        counts = tuple(map(ks.count, range(6)))
        name, d = self.profile(counts)
        n = len(ks)
        if name in PROSE and (counts[0] < 2 and n >= 6 or n < 4 and counts[0] == 0):
            name = "list"
        return name, d, counts

    def pieces(self, line: str) -> list[str]:
        if len(line) <= 200:
            return [line]
        out = []
        for s in CUT.split(line):
            s = s.strip()
            if len(s) > 400:
                toks = s.split()
                out += [" ".join(toks[k : k + 24]) for k in range(0, len(toks), 24)]
            elif s:
                out.append(s)
        return out

    def document(self, text: str | None, drop: frozenset[int] | set[int] | None = None) -> tuple | None:
        """Statistics of a text without the lines whose key is in drop; None for a null text."""
        if text is None:
            return None
        total = [0] * 6
        chars = {}
        lines = ended = 0
        weighted = weight = 0.0
        words = letters = symbols = 0
        fence = False
        units: list[tuple[str, int, str, bool]] = []
        for line in text.split("\n"):
            s = line.strip()
            if not s or drop and has_words(s) and line_hash(s) in drop:
                continue
            lines += 1
            last = s.rstrip("\"'”»)」』 ")[-1:]
            ended += last in ".!?。！？।؟…:" and last != ""
            if s.startswith("```"):
                fence = not fence
                units.append(("code", len(s), s, False))
                continue
            for p in self.pieces(s):
                name, d, counts = self.unit(p)
                if fence:
                    name = "code"
                for k in range(6):
                    total[k] += counts[k]
                units.append((name, len(p), p, last in ".!?。！？।؟…:"))
                weighted += d * len(p)
                weight += len(p)
        # a wrapped line without function words of its own, between lines of a sentence, belongs to it
        for k, (name, n, s, end) in enumerate(units):
            if name == "list" and k and units[k - 1][0] in PROSE and not units[k - 1][3] and s[:1].islower() and (end or k + 1 < len(units) and units[k + 1][0] in PROSE):
                name = "prose"
                units[k] = (name, n, s, end)
            chars[name] = chars.get(name, 0) + n
        size = sum(chars.values())
        prose = sum(chars.get(p, 0) for p in PROSE)
        words = sum(total[:2]) + total[3]
        tokens = sum(total)
        nearest = max(chars, key=lambda k: (chars[k], k)) if chars else None
        return (
            tokens,
            words,
            size / tokens if tokens else 0.0,
            (total[3] + total[4]) / tokens if tokens else 0.0,
            ended / lines if lines else 0.0,
            total[0] / tokens if tokens else 0.0,
            weighted / weight if weight else 0.0,
            "prose" if nearest in PROSE else nearest,
            prose / size if size else None,
        )


STATS = "tokens int, words int, mean_token_length double, symbol_ratio double, ended_lines double, common_ratio double, divergence double, profile string, prose_share double"


def text_statistics(docs: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """(doc_id, blank, tokens, ..., prose_share, natural_prose) of every row of docs (doc_id, source, text).

    A null text has null statistics; a blank one zeros and no verdict, as has
    one that consists of its source's repeated lines only. Equal texts give equal rows.
    """
    per_source = keys_by_source(repeated_lines(docs, least_share=LEAST_SHARE) if repeated is None else repeated)
    j = docs.select("doc_id", "source", "text").join(per_source, F.col("source").eqNullSafe(F.col("r_source")), "left").select("doc_id", "drop_keys", "text")

    def make():
        p = Profiler()
        sets: dict[int, tuple[list, frozenset]] = {}

        def one(i, keys, t):
            drop = None
            if keys:
                at = hash((len(keys), keys[0], keys[-1]))
                if at not in sets or sets[at][0] != keys:
                    if len(sets) > 1000:
                        sets.clear()
                    sets[at] = (keys, frozenset(keys))
                drop = sets[at][1]
            got = p.document(t, drop)
            blank = t is None or not t.strip()
            if got is None:
                return [(i, blank, *[None] * 9, None)]
            share = got[-1]
            return [(i, blank, *got, None if share is None else share >= 0.5)]

        return one

    return flat_map(j, make, f"doc_id long, blank boolean, {STATS}, natural_prose boolean")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return text_statistics(docs).where("not blank and natural_prose = false").select("doc_id")


def p10_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_statistics(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
