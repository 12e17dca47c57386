"""Queries over further document signals: rhythm, noise, code, grades, headers, tokenizer efficiency, quota moves, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamstone.functions import peers as P
from loamstone.functions import text as T
from loamstone.functions.tokens import encoded
from loamstone.sources.tables import spread, table

#: Patterns that Java and RE2 read alike.
ANCHOR = r"\b\d{4}\b|\b\d+(?:\.\d+)? ?(?:%|km|kg|hours|minutes|records)"
CLAIM = r"(?i)\b(?:always|never|everyone|nobody|proves?|guarantee[sd]?)\b"
PIRACY = r"(?i)\b(?:torrent|cracked|keygen|warez|free download)\b"
FILLER = r"(?i)\b(?:in order to|at the end of the day|it is worth noting|needless to say|more often than not|as a matter of fact)\b"
GENERATED = r"(?i)\b(?:auto-?generated|do not edit|generated by)\b"
SDK = r"(?i)\b(?:HAL_|GPIO|STM32|esp_|nrf_)\w*"
META_LINE = r"(?i)^(?:posted|published|updated|author|by|tags|category|source|date)\b ?:?"


def _docs(spark, d):
    return spread(table(spark, d, "documents").where("text is not null and length(text) > 0").select("doc_id", "source", "domain", "lang", "text"))


def sentence_rhythm(spark, d):
    """O-060: variation of sentence lengths, scaled by 1.2, of documents of three and more sentences."""
    n = F.transform(F.filter(F.split("text", r"[.!?]+(?:[ \n\t]+|$)"), lambda x: F.trim(x) != ""), lambda x: F.length(x).cast("double"))
    t = _docs(spark, d).select("doc_id", n.alias("n")).where(F.size("n") >= 3)
    m = P.mean(F.col("n"))
    var = F.aggregate(F.transform("n", lambda x: x * x), F.lit(0.0), lambda s, x: s + x) / F.size("n") - m * m
    return t.select("doc_id", F.size("n").alias("sentences"), F.round(P.clip(F.sqrt(F.greatest(var, F.lit(0.0))) / m / 1.2), 5).alias("burstiness"))


def heading_repeats(spark, d):
    """O-042, O-236: headings of a document and those that repeat an earlier one."""
    h = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"^(?:#{1,6} |== )"))
    t = _docs(spark, d).select("doc_id", h.alias("h")).where(F.size("h") > 0)
    return t.select("doc_id", F.size("h").alias("headings"), (F.size("h") - F.size(F.array_distinct("h"))).alias("repeated"))


def metadata_only(spark, d):
    """O-125, O-135, O-136: share of lines that hold metadata, and pages that hold little else."""
    t = table(spark, d, "cleaning_golden").select("id", "text").dropDuplicates(["id", "text"]).where("text is not null").select("id", T.lines(F.col("text")).alias("ls")).where(F.size("ls") > 0)
    share = F.size(F.filter("ls", lambda x: x.rlike(META_LINE))) / F.size("ls")
    return t.select("id", F.round(share, 6).alias("share"), ((share >= 0.5) & (F.size("ls") >= 2)).alias("metadata_only"))


def tokenizer_efficiency(spark, d):
    """O-086, O-087, O-148 to O-150: characters and tokens of a public tokenizer by label of language."""
    docs = _docs(spark, d)
    t = encoded(docs.select("doc_id", "text")).select("doc_id", (F.octet_length("ids") / 4 - 1).cast("bigint").alias("tokens"))
    return docs.select("doc_id", "lang", F.length("text").alias("n")).join(t, "doc_id").groupBy("lang").agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"), F.round(F.sum("n") / F.sum("tokens"), 4).alias("chars_per_token"))


def quota_moves(spark, d):
    """O-146, O-147, O-314: bounded moves of language shares towards equal targets, and their boosts."""
    t = table(spark, d, "documents").where("lang is not null").groupBy("lang").agg(F.count("*").alias("n"))
    s = t.agg(F.sum("n").alias("total"), F.count("*").alias("k"))
    x = t.crossJoin(F.broadcast(s))  # one row
    obs, target = F.col("n") / F.col("total"), 1 / F.col("k")
    ratio = F.greatest(F.lit(1.0), F.least(F.lit(50.0), target / obs))
    return x.select("lang", F.round(obs, 6).alias("observed"), F.round(F.greatest(F.lit(0.01), target * ratio), 6).alias("weight"), F.round(1 + F.greatest(F.lit(0.0), target - obs) * 2, 6).alias("boost"))


def chunk_validation(spark, d):
    """O-137, O-138, O-219: what is wrong with each document as an output row, as a list of issues."""
    c = F.col("text")
    t = table(spark, d, "documents")
    issues = F.filter(
        F.array(
            F.when(c.isNull() | (F.trim(F.coalesce(c, F.lit(""))) == ""), "empty"), F.when(c.contains("�"), "replacement"), F.when(c.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f]"), "control"),
            F.when(F.length(c) > 12000 * 1.12 * 1.15, "too_many_tokens"), F.when(F.col("lang").isNull(), "no_language"), F.when(F.col("n_chars") != F.length(c), "length_differs"),
        ),
        lambda x: x.isNotNull(),
    )
    return t.groupBy(F.array_join(issues, ",").alias("issues")).agg(F.count("*").alias("documents"))


def page_metadata(spark, d):
    """O-050, O-187: bylines, dates and editions that lines of documents state."""
    t = _docs(spark, d)
    by = F.regexp_extract("text", r"(?:^|\n)(?:By|Text by) ([^\n,]{3,60})", 1)
    year = F.regexp_extract("text", r"(?:^|\n)Last checked [0-9./]*(20[0-9][0-9])", 1)
    return t.where((by != "") | (year != "")).groupBy(by.alias("byline"), year.alias("year")).agg(F.count("*").alias("documents"))


QUERIES = {f.__name__: f for f in (sentence_rhythm, heading_repeats, metadata_only, tokenizer_efficiency, quota_moves, chunk_validation, page_metadata)}

from loamstone.plans.features import LINES, WORDS  # noqa: E402

_B = "documents WHERE text IS NOT NULL AND length(text) > 0"
_W = WORDS.format(c="text")
_C = lambda e: f"greatest(0, least(1, {e}))"
ORACLE = {
    "sentence_rhythm": rf"SELECT doc_id, CAST(len(n) AS INTEGER) AS sentences, round({_C('sqrt(greatest(list_avg(list_transform(n, lambda x: x * x)) - list_avg(n) * list_avg(n), 0)) / list_avg(n) / 1.2')}, 5) AS burstiness FROM (SELECT doc_id, list_transform(list_filter(regexp_split_to_array(text, '[.!?]+(?:[ \n\t]+|$)'), lambda x: trim(x) <> ''), lambda x: CAST(length(x) AS DOUBLE)) AS n FROM {_B}) WHERE len(n) >= 3",
    "heading_repeats": f"SELECT doc_id, CAST(len(h) AS INTEGER) AS headings, CAST(len(h) - len(list_distinct(h)) AS INTEGER) AS repeated FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^(?:#{{1,6}} |== )')) AS h FROM {_B}) WHERE len(h) > 0",
    "metadata_only": f"SELECT id, round(s, 6) AS share, s >= 0.5 AND len(ls) >= 2 AS metadata_only FROM (SELECT id, ls, len(list_filter(ls, lambda x: regexp_matches(x, '{META_LINE}'))) / len(ls) AS s FROM (SELECT id, {LINES} AS ls FROM (SELECT DISTINCT id, text FROM cleaning_golden WHERE text IS NOT NULL)) WHERE len(ls) > 0)",
    "quota_moves": "WITH t AS (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1), x AS (SELECT lang, n / (SELECT sum(n) FROM t) AS o, 1 / (SELECT count(*) FROM t) AS g FROM t) SELECT lang, round(o, 6) AS observed, round(greatest(0.01, g * greatest(1, least(50, g / o))), 6) AS weight, round(1 + greatest(0, g - o) * 2, 6) AS boost FROM x",
    "chunk_validation": r"SELECT array_to_string(list_filter([CASE WHEN text IS NULL OR trim(text) = '' THEN 'empty' END, CASE WHEN contains(text, chr(65533)) THEN 'replacement' END, CASE WHEN regexp_matches(text, '[\x00-\x08\x0b\x0c\x0e-\x1f]') THEN 'control' END, CASE WHEN length(text) > 12000 * 1.12 * 1.15 THEN 'too_many_tokens' END, CASE WHEN lang IS NULL THEN 'no_language' END, CASE WHEN n_chars <> length(text) THEN 'length_differs' END], lambda x: x IS NOT NULL), ',') AS issues, count(*) AS documents FROM documents GROUP BY 1",
    "page_metadata": rf"SELECT byline, year, count(*) AS documents FROM (SELECT regexp_extract(text, '(?:^|\n)(?:By|Text by) ([^\n,]{{3,60}})', 1) AS byline, regexp_extract(text, '(?:^|\n)Last checked [0-9./]*(20[0-9][0-9])', 1) AS year FROM {_B}) WHERE byline <> '' OR year <> '' GROUP BY 1, 2",
}
