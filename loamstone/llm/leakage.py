"""Problem 9: passages of evaluation items leaking into training text.

Pigeonhole matching with an error budget: a window of WINDOW passage words
with at most `budget` word edits leaves at least one of any budget + 1
disjoint pieces inside it untouched. Passages are cut into pieces so short that every
window holds budget + 1 whole ones; an automaton finds exact piece hits in
each document, and Myers' bit-parallel distance over words verifies the
windows around a hit. Only the items travel to the tasks, in blocks of a
checked size; documents are read once for each block and never shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstone.functions.arrow import flat_map
from loamstone.sources.tables import spread, table, written

WINDOW = 13
BLOCK_CHARS = 16_000_000  # characters of passages that one pass carries to the tasks
WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Words without case, punctuation and marks around them."""
    return WORD.findall(text.lower())


def piece_length(budget: int, window: int = WINDOW) -> int:
    """Longest piece of which every window holds budget + 1 whole ones, wherever it starts."""
    p = 1
    while (window - p) // (p + 1) + 0 >= 0 and (window - p) // (p + 1) >= budget + 1:
        p += 1
    return p


def myers(pattern: list[str], text: list[str]) -> int:
    """Least number of word edits between the pattern and any stretch of the text (Myers 1999, over words)."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for k, w in enumerate(pattern):
        peq[w] = peq.get(w, 0) | 1 << k
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best = m
    for w in text:
        eq = peq.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best = score
    return best


class Matcher:
    """The pieces of all items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], budget: int, window: int = WINDOW):
        import ahocorasick

        self.budget, self.window = budget, window
        self.passages = {i: words(p) for i, p in items}
        self.length = piece_length(budget, window)
        where: dict[str, list[tuple[int, int]]] = {}
        for i, w in self.passages.items():
            if len(w) < window:
                continue
            for at in range(0, len(w) - self.length + 1, self.length):
                where.setdefault(" " + " ".join(w[at : at + self.length]) + " ", []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def match(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item, longest exact run of words, least edits of a window) of every item with a window within the budget."""
        if self.empty or not text:
            return []
        w = words(text)
        if len(w) < self.window - self.budget:
            return []
        joined = " " + " ".join(w) + " "
        hits = [(end - size + 1, places) for end, (size, places) in self.automaton.iter(joined)]
        if not hits:
            return []
        found: dict[int, tuple[int, int]] = {}
        done: set[tuple[int, int]] = set()
        counted, last = 0, 0
        for start, places in hits:
            # overlapping pieces end in order but may start out of it
            if start >= last:
                counted += joined.count(" ", last, start)
                at = counted
                last = start
            else:
                at = joined.count(" ", 0, start)
            for item, p in places:
                run, edits, diagonal = self.verify(w, at, item, p, done)
                if diagonal is None:
                    continue
                old = found.get(item, (0, self.window))
                found[item] = (max(old[0], run), min(old[1], edits))
        return [(i, run, e) for i, (run, e) in found.items() if e <= self.budget]

    def verify(self, w: list[str], at: int, item: int, p: int, done: set[tuple[int, int]]) -> tuple[int, int, int | None]:
        """Exact run through a piece hit and the least edits of a window of the passage around it."""
        q = self.passages[item]
        if (item, at) in done:
            return 0, self.window, None
        a, b = at, p
        while a > 0 and b > 0 and w[a - 1] == q[b - 1]:
            a, b = a - 1, b - 1
        x, y = at + self.length, p + self.length
        while x < len(w) and y < len(q) and w[x] == q[y]:
            x, y = x + 1, y + 1
        # other pieces of the passage inside this run lie on it as well
        done.update((item, k) for k in range(a, x) if (k - a + b) % self.length == 0)
        run = y - b
        # window - budget words match in budget + 1 runs, so one of them has at least this many
        if run * (self.budget + 1) < self.window - self.budget:
            return run, self.window, at - p
        segment = w[max(0, at - self.window - self.budget) : at + self.length + self.window + self.budget]
        if run >= self.window:
            return run, myers(q[b : b + self.window], segment), at - p
        least = self.window
        inside = set(segment)
        known = [x in inside for x in q]
        for s in range(max(0, p + self.length - self.window), min(p, len(q) - self.window) + 1):
            # each word of the window that is nowhere near costs an edit
            if sum(known[s : s + self.window]) >= self.window - self.budget:
                least = min(least, myers(q[s : s + self.window], segment))
        return run, least, at - p


def leaks(docs: DataFrame, items: DataFrame, budget: int = 1) -> DataFrame:
    """(doc_id, item_id, run_words, edits) of every document holding a window of an item's passage within the budget.

    Null and blank texts or passages and passages shorter than a window give
    nothing. Items are carried in blocks of BLOCK_CHARS characters; a set of
    items beyond one block takes several passes, none is left out.
    """
    size = items.agg(F.coalesce(F.sum(F.length("passage")), F.lit(0)).alias("n")).first()["n"]
    blocks = int(size // BLOCK_CHARS) + 1
    parts = []
    for k in range(blocks):
        rows = items.where(F.col("passage").isNotNull() & F.col("item_id").isNotNull()).where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).select("item_id", "passage").distinct().collect()
        block = [(r["item_id"], r["passage"]) for r in rows]

        def make(block=block):
            m = Matcher(block, budget)
            return lambda i, t: [(i, *x) for x in m.match(t)]

        part = flat_map(docs.select("doc_id", "text"), make, "doc_id long, item_id long, run_words int, edits int")
        # one block of items at a time is held by the driver and the tasks: its rows are written before the next comes
        parts.append(written(part, "leaks") if blocks > 1 else part)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with at least 13 consecutive words of an item's passage; the budget of one edit finds, the exact run decides."""
    return leaks(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), table(spark, sf_dir, "eval_items")).where(F.col("run_words") >= WINDOW).select("doc_id", "item_id").distinct()


def p9_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage not letter by letter: a window within the edit budget where no exact run is long enough, with its edits."""
    x = leaks(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), table(spark, sf_dir, "eval_items"))
    return x.where(F.col("run_words") < WINDOW).groupBy("doc_id", "item_id").agg(F.max("run_words").alias("run_words"), F.min("edits").alias("edits"))


def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per leaked item, exact and with an edit."""
    x = leaks(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), table(spark, sf_dir, "eval_items"))
    return x.groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"), F.sum(F.when(F.col("run_words") >= WINDOW, 1).otherwise(0)).alias("exact"), F.max("run_words").alias("longest_run"))
