"""Problem 2: lines repeated across one source's documents.

Documents are cut into lines in one narrow pass; a line's key is the hash of its
letters, so case, spacing, punctuation, symbols and digits do not count. For
every source and key the share of the source's documents is set against the
share outside the source by a one-sided log-likelihood ratio; significant
excess under Benjamini-Hochberg control is what a source repeats. Those lines
are taken out by an anti-join on (source, key), the rest is put together by position.

Shuffles: one, of 16 bytes for each distinct (document, line) pair with
partial sums on the map side, so a hot source or a hot line is added up
before it moves. Texts are never shuffled to find the lines; the lines that
stay are shuffled once by document to put them together.
"""

from __future__ import annotations

import unicodedata

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstone.functions.arrow import flat_map
from loamstone.sources.tables import spread, table, written

LEAST_WORDS = 3
LEAST_DOCS = 3
LEAST_SHARE = 0.1
FDR = 0.01


class _Letters(dict):
    """Translation table that drops all but letters and marks; entries are made as signs occur."""

    def __missing__(self, c: int) -> int | None:
        ch = chr(c)
        self[c] = value = c if ch.isalpha() or unicodedata.category(ch)[0] in "LM" else None
        return value


_ASCII = {c: (c if chr(c).isalpha() else None) for c in range(128)}
_LETTERS = _Letters()


def line_hash(line: str) -> int:
    """64-bit key of a line: its letters and marks, in lower case, hashed."""
    low = line.lower()
    h = xxhash.xxh64_intdigest(low.translate(_ASCII if low.isascii() else _LETTERS).encode("utf-8", "surrogatepass"), 42)
    return h - (1 << 64) if h >> 63 else h


def has_words(line: str, least: int = LEAST_WORDS) -> bool:
    """Whether at least three of the pieces between white space have a letter."""
    head = line.split(None, 8)
    n = 0
    for tok in head[:8]:
        if tok[0].isalpha() or any(map(str.isalpha, tok)):
            n += 1
            if n >= least:
                return True
    return len(head) > 8 and sum(any(map(str.isalpha, tok)) for tok in line.split()) >= least


def keyed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, source, line_no, key) of every line of three and more words, of docs (doc_id, source, text).

    One narrow pass; string translation in batches costs a fifth of the
    regular expressions that the same key takes inside the JVM.
    """

    def one(i, source, text):
        if not text:
            return []
        return [(i, source, no, line_hash(line)) for no, line in enumerate(text.split("\n"), 1) if line and has_words(line)]

    return flat_map(docs.select("doc_id", "source", "text"), lambda: one, "doc_id long, source string, line_no int, key long")


def repeated_lines(docs: DataFrame, lines: DataFrame | None = None, fdr: float = FDR, least_docs: int = LEAST_DOCS, least_share: float = 0.0) -> DataFrame:
    """(source, key, docs_with, docs_of_source, llr): lines a source repeats in significant excess.

    docs: (doc_id, source, text); lines: its keyed_lines, if at hand. Null sources form one source of their own;
    null and blank texts have no lines but count as documents. Repeated texts
    under different ids count as documents each.

    The outside share is taken over the sources that do not repeat the line
    themselves, so a line that several sources repeat is excess in each. A
    line in every document of a table with one source has no outside; its
    expected share is then that of an average line.
    """
    sources = docs.groupBy("source").agg(F.count("*").alias("docs_of_source")).where("docs_of_source > 0")
    lines = written(keyed_lines(docs), "keyed_lines") if lines is None else lines
    # a line twice in a document counts once: distinct (source, key, doc_id) first, partial sums on the map side of both steps
    counted = lines.select("source", "key", "doc_id").distinct().groupBy("source", "key").agg(F.count("*").alias("docs_with"))
    # lines of a single document in a source cannot be excess; they only enter as outside counts, where they are under the least
    several = counted.where(F.col("docs_with") >= least_docs)
    # the number of sources is the number of sites: one row each, far below the broadcast threshold, and AQE falls back to a shuffle beyond it
    with_n = several.join(sources, several["source"].eqNullSafe(sources["source"]), "inner").select(several["source"], "key", "docs_with", "docs_of_source")
    share = F.col("docs_with") / F.col("docs_of_source")
    total = docs.agg(F.count("*").alias("all_docs"))
    hot = with_n.withColumn("hot", share >= LEAST_SHARE)
    by_key = hot.groupBy("key").agg(
        F.sum(F.when(~F.col("hot"), F.col("docs_with")).otherwise(0)).alias("cold_with"),
        F.sum(F.when(F.col("hot"), F.col("docs_of_source")).otherwise(0)).alias("hot_docs"),
    )
    x = hot.join(by_key, "key").crossJoin(F.broadcast(total))  # total is one row
    k1, n1 = F.col("docs_with").cast("double"), F.col("docs_of_source").cast("double")
    k2 = F.greatest(F.col("cold_with") - F.when(~F.col("hot"), F.col("docs_with")).otherwise(0), F.lit(0)).cast("double")
    n2 = F.greatest(F.col("all_docs") - F.col("hot_docs") - F.when(~F.col("hot"), F.col("docs_of_source")).otherwise(0), F.lit(0)).cast("double")
    # an average line stands in one document: as many documents of that share as the source has keep the outside from being nil or empty
    k2s, n2s = k2 + n1 / F.col("all_docs"), n2 + n1
    p1, p2, p = k1 / n1, k2s / n2s, (k1 + k2s) / (n1 + n2s)

    def ll(k: Column, n: Column, q: Column) -> Column:
        q = F.least(F.greatest(q, F.lit(1e-12)), F.lit(1 - 1e-12))
        return k * F.log(q) + (n - k) * F.log(1 - q)

    llr = F.when(p1 > p2, 2 * (ll(k1, n1, p1) + ll(k2s, n2s, p2) - ll(k1, n1, p) - ll(k2s, n2s, p))).otherwise(0.0)
    tested = x.select("source", "key", "docs_with", "docs_of_source", llr.alias("llr"))
    # Benjamini-Hochberg over a histogram of the ratio: the tail count at a bin gives the rank without a global sort
    tests = counted.agg(F.count("*").alias("tests"))
    binned = tested.withColumn("bin", F.least(F.floor(F.col("llr") * 4), F.lit(4000)).cast("int"))
    tail = binned.groupBy("bin").agg(F.count("*").alias("n"))  # at most 4001 rows
    rank = tail.alias("a").join(F.broadcast(tail.alias("b")), F.col("b.bin") >= F.col("a.bin")).groupBy(F.col("a.bin").alias("bin")).agg(F.sum("b.n").alias("rank"))
    # tail of chi-square with one degree, halved for one side: at most exp(-x/2) / sqrt(2 pi x) for x > 0
    edge = F.greatest(F.col("bin") / 4, F.lit(0.01))
    p_bound = F.least(F.exp(-edge / 2) / F.sqrt(2 * F.lit(3.141592653589793) * edge), F.lit(1.0))
    passing = rank.crossJoin(F.broadcast(tests)).where(p_bound <= F.col("rank") / F.col("tests") * fdr).agg(F.min("bin").alias("cut"))
    return binned.crossJoin(F.broadcast(passing)).where((F.col("bin") >= F.col("cut")) & (share >= least_share)).select("source", "key", "docs_with", "docs_of_source", "llr")


def marked_lines(lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """(doc_id, line_no) of the keyed lines whose (source, key) is in repeated.

    A source repeats at most 1/LEAST_SHARE times its mean number of lines per
    document above that share; the join is left to AQE, which broadcasts the
    small side only under its threshold and splits hot sources otherwise.
    """
    r = repeated.select(F.col("source").alias("r_source"), F.col("key").alias("r_key"))
    return lines.join(r, (lines["key"] == r["r_key"]) & lines["source"].eqNullSafe(r["r_source"])).select("doc_id", "line_no")


def keys_by_source(repeated: DataFrame) -> DataFrame:
    """(r_source, drop_keys): the repeated keys of each source in one array, bounded as in marked_lines; written, so that its size is known."""
    return written(repeated.groupBy(F.col("source").alias("r_source")).agg(F.collect_set("key").alias("drop_keys")), "repeated_by_source")


def all_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, source, line_no, key, line) of every line of docs (doc_id, source, text); key is null for lines of fewer than three words."""

    def one(i, source, text):
        return [(i, source, no, line_hash(line) if has_words(line) else None, line) for no, line in enumerate(text.split("\n"), 1)] if text is not None else []

    return flat_map(docs.select("doc_id", "source", "text"), lambda: one, "doc_id long, source string, line_no int, key long, line string")


def without_repeated_lines(docs: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """(doc_id, text) with the source's repeated lines taken out and the rest in its order.

    An anti-join on (source, key), which is broadcast only under the session's
    threshold and split by AQE where a source is hot; what is left is put
    together by position within its document. A document of nothing but
    repeated lines becomes empty, a null text stays null.
    """
    r = repeated_lines(docs, least_share=LEAST_SHARE) if repeated is None else repeated
    r = r.select(F.col("source").alias("r_source"), F.col("key").alias("r_key"))
    lines = all_lines(docs)
    left = lines.join(r, (lines["key"] == r["r_key"]) & lines["source"].eqNullSafe(r["r_source"]), "left_anti")
    texts = left.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("kept")).select("doc_id", F.array_join("kept.line", "\n").alias("rest"))
    whole = docs.select("doc_id", F.col("text").isNotNull().alias("has"))
    return whole.join(texts, "doc_id", "left").select("doc_id", F.when(F.col("has"), F.coalesce("rest", F.lit(""))).alias("text"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    lines = written(keyed_lines(spread(docs)), "keyed_lines")
    return marked_lines(lines, written(repeated_lines(docs, lines, least_share=LEAST_SHARE), "repeated_lines"))


def p2_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_lines(spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text")))
