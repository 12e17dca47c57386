"""Problem 7: repetition inside a single document.

Each document becomes a stream of hashed n-grams marked with whether they
already occurred in it. Two multinomials over the hashed marks are counted by
grouped aggregation: that of trusted documents, whose measured repetition is
nil, and that of the raw corpus. The log-likelihood ratio of a document,
divided by its letters in n-grams, falls with its share of repeats; every
document below a fixed threshold, and none else, is read again for the exact
share of letters in repeated runs. No document is sampled or cut.
"""

from __future__ import annotations

import math
import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstone.functions.arrow import flat_map
from loamstone.sources.tables import spread, table, written

RUN = 5  # words of a run that counts as a repeat
BUCKETS = 512  # buckets of the hashed n-grams, for each mark
SHARE = 0.4  # share of letters in repeated runs from which a record is found
#: n-grams weigh as many as their letters have. Repeated n-grams hold every letter of a repeated run at least once and all
#: n-grams hold no letter more than RUN times, so a record with a share of SHARE has at least this share of repeated weight.
LEAST_REPEATS = SHARE / RUN
WORD = re.compile(r"[^\W\d_]+(?:[̀-ͯऀ-ःऺ-ॏً-ْ]+[^\W\d_]*)*")


def words(text: str) -> list[str]:
    """Words without case, punctuation and digits."""
    return WORD.findall(text.lower())


def repeated(text: str | None) -> tuple[int, int, int, int]:
    """(letters in repeated runs, all letters, repeated n-grams, n-grams) of a text; zeros for null and blank texts."""
    if not text:
        return 0, 0, 0, 0
    w = words(text)
    total = sum(map(len, w))
    n = len(w) - RUN + 1
    if n <= 0:
        return 0, total, 0, 0
    seen: set[tuple] = set()
    marked = bytearray(len(w))
    again = 0
    for k, g in enumerate(zip(*(w[j:] for j in range(RUN)))):
        if g in seen:
            again += 1
            marked[k : k + RUN] = b"\1" * RUN
        else:
            seen.add(g)
    return sum(len(x) for x, m in zip(w, marked) if m), total, again, n


def marks(text: str | None) -> dict[int, int]:
    """Letters of hashed n-grams: bucket of the n-gram's hash, plus BUCKETS where it already occurred in the text."""
    if not text:
        return {}
    w = words(text)
    seen: set[tuple] = set()
    counts: dict[int, int] = {}
    for g in zip(*(w[j:] for j in range(RUN))):
        b = zlib.crc32(" ".join(g).encode()) % BUCKETS
        if g in seen:
            b += BUCKETS
        else:
            seen.add(g)
        counts[b] = counts.get(b, 0) + sum(map(len, g))
    return counts


def counted(text: str | None) -> tuple[int, list[int], list[int]]:
    """(letters of n-grams met for the first time, buckets of repeated n-grams, their letters) of a text: all that fit and score need of it."""
    m = marks(text)
    again = [(b - BUCKETS, n) for b, n in m.items() if b >= BUCKETS]
    return sum(n for b, n in m.items() if b < BUCKETS), [b for b, _ in again], [n for _, n in again]


def fit(summaries: DataFrame, trusted: DataFrame) -> tuple[float, list[float]]:
    """Log ratio of the trusted to the raw multinomial: of a new n-gram, and of a repeated one by bucket.

    summaries: (id, fresh, buckets, weights) as of `counted`; trusted: (id).
    The counts are summed over all documents; what comes to the driver has
    BUCKETS + 1 rows at most. A repeat is never evidence of a trusted text, a
    new n-gram never of the opposite: that keeps the score monotone in the repeats.
    """
    t = trusted.select(F.col("id").alias("trusted_id")).distinct()
    j = summaries.join(t, summaries["id"] == t["trusted_id"], "left").withColumn("good", F.col("trusted_id").isNotNull())
    each = F.explode(F.concat(F.array(F.struct(F.lit(-1).alias("mark"), F.col("fresh").alias("n"))), F.arrays_zip(F.col("buckets").alias("mark"), F.col("weights").alias("n"))))
    rows = j.select("good", each.alias("x")).groupBy("x.mark").agg(F.sum("x.n").alias("raw"), F.sum(F.when(F.col("good"), F.col("x.n")).otherwise(0)).alias("good")).collect()
    raw, good = dict.fromkeys(range(-1, BUCKETS), 1.0), dict.fromkeys(range(-1, BUCKETS), 1.0)
    for r in rows:
        raw[r["mark"]] += r["raw"] or 0
        good[r["mark"]] += r["good"] or 0
    a, b = sum(good.values()), sum(raw.values())
    again = [min(-1.0, math.log((good[k] / a) / (raw[k] / b))) for k in range(BUCKETS)]
    return max(0.0, math.log((good[-1] / a) / (raw[-1] / b))), again


def score(text: str | None, new: float, again: list[float]) -> float:
    """Length-normalised log-likelihood ratio; 0 for texts without a run of words."""
    fresh, buckets, weights = counted(text)
    n = fresh + sum(weights)
    return (new * fresh + sum(again[b] * w for b, w in zip(buckets, weights))) / n if n else 0.0


def threshold(new: float, again: list[float]) -> float:
    """Greatest score that a text with a share of SHARE can have."""
    return (1 - LEAST_REPEATS) * new + LEAST_REPEATS * max(again)


def trusted_ids(signals: DataFrame) -> DataFrame:
    """Records measured as free of repeated lines and characters in every measurement at hand."""
    s = signals.where("id is not null").groupBy("id").agg(F.max("line_repetition").alias("l"), F.max("char_repetition").alias("c"), F.max("word_diversity").alias("d"))
    return s.where("coalesce(l, 0) = 0 and coalesce(c, 0) < 0.15 and d > 0.5").select("id")


def repetition_shares(docs: DataFrame, trusted: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, score, suspect, share) of every record.

    suspect: the score lies at or under that of a text with LEAST_REPEATS
    repeats; only then can the share reach SHARE, and it is counted exactly.
    Others get a share of null. Repeats of an id count once, by the largest share.
    """
    d = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).withColumn("key", F.xxhash64("text"))
    # the one pass over all texts; what it leaves of a text is a few numbers
    found = flat_map(d, lambda: lambda i, t, k: [(i, k, *counted(t))], "id string, key long, fresh long, buckets array<int>, weights array<long>")
    found = written(found, "repetition").dropDuplicates(["id", "key"])
    new, again = fit(found, trusted)
    n = F.col("fresh") + F.aggregate("weights", F.lit(0).cast("long"), lambda s, x: s + x)
    ratios = F.array(*map(F.lit, again))
    total = F.aggregate(F.zip_with("buckets", "weights", lambda b, w: F.get(ratios, b) * w), new * F.col("fresh"), lambda s, x: s + x)
    scored = found.select("id", "key", n.alias("n"), F.when(n > 0, total / n).otherwise(0.0).alias("score"))
    scored = scored.withColumn("suspect", F.col("n").isNotNull() & (F.col("n") > 0) & (F.col("score") <= threshold(new, again) + 1e-9))
    suspects = scored.where("suspect").select("id", "key").distinct()
    # texts of suspects alone are read again; a null id meets no text and keeps a share of null
    texts = d.join(suspects, ["id", "key"], "left_semi").select("id", "text")

    def share(i, t):
        rep, total, _, _ = repeated(t)
        return [(i, rep / total if total else 0.0)]

    exact = flat_map(texts, lambda: share, "id string, share double").groupBy("id").agg(F.max("share").alias("share"))
    return scored.groupBy("id").agg(F.min("score").alias("score"), F.max("suspect").alias("suspect")).join(exact, "id", "left")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, signals = spread(table(spark, sf_dir, "redteam_adversarial").select("id", "text")), table(spark, sf_dir, "quality_signals")
    return repetition_shares(docs, trusted_ids(signals)).where(F.col("share") >= SHARE).where("id is not null").select("id")


def p7_against_line_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of repeated content beside the latest line_repetition measured, which sees whole lines only."""
    signals = table(spark, sf_dir, "quality_signals")
    latest = signals.groupBy("id").agg(F.max_by("line_repetition", "measured_at").alias("line_repetition"))
    return repetition_shares(table(spark, sf_dir, "redteam_adversarial"), trusted_ids(signals)).join(latest, "id", "left").select("id", "score", "share", "line_repetition")
