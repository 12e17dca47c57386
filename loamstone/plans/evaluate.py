"""Queries over corpus evaluation: histograms, snapshots, diversity, drift, intervals, percentiles, acceptance."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamstone.functions import text as T
from loamstone.sources.tables import spread, table

Z = 1.96


def length_histogram(spark, d):
    """O-334, O-305: documents by length bucket with shares."""
    t = table(spark, d, "documents").where("text is not null")
    n = F.length("text")
    b = F.when(n < 800, "<800").when(n < 2400, "<2400").when(n < 6000, "<6000").otherwise(">=6000")
    c = t.groupBy(b.alias("bucket")).agg(F.count("*").alias("documents"))
    total = c.agg(F.sum("documents").alias("total"))
    return c.crossJoin(F.broadcast(total)).select("bucket", "documents", F.round(F.col("documents") / F.col("total"), 4).alias("share"))


def corpus_snapshot(spark, d):
    """O-333, O-335, O-340, O-346, O-352: one row of corpus figures."""
    t = table(spark, d, "documents").select("doc_id", "lang", "source", "text", T.content_hash(F.col("text")).alias("h"))
    return t.agg(
        F.count("*").alias("documents"), F.countDistinct("h").alias("distinct_texts"), F.countDistinct("source").alias("sources"), F.sum(F.when(F.col("lang").isNull(), 1).otherwise(0)).alias("unlabelled"),
        F.sum(F.when(F.trim(F.coalesce("text", F.lit(""))) == "", 1).otherwise(0)).alias("blank"), F.sum(F.length("text")).alias("chars"), F.round(F.avg(F.length("text")), 4).alias("mean_chars"),
    )


def diversity_index(spark, d):
    """O-345: normalised entropies of language, source and domain and their weighted index."""
    t = table(spark, d, "documents")
    parts = []
    for name in ("lang", "source", "domain"):
        c = t.groupBy(F.coalesce(name, F.lit("none")).alias("k")).agg(F.count("*").alias("n"))
        s = c.agg(F.sum("n").alias("s"))
        p = F.col("n") / F.col("s")
        parts.append(c.crossJoin(F.broadcast(s)).agg(F.round(F.sum(-p * F.log2(p)) / F.greatest(F.log2(F.count("*").cast("double")), F.lit(1e-9)), 6).alias("entropy")).withColumn("axis", F.lit(name)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("axis", "entropy")


def distribution_drift(spark, d):
    """O-336, O-337, O-338, O-348: L1 distance of source shares between documents and each batch."""
    a = table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"))
    at = a.agg(F.sum("n").alias("total"))
    a = a.crossJoin(F.broadcast(at)).select("source", (F.col("n") / F.col("total")).alias("p"))
    b = table(spark, d, "batch_docs").groupBy("batch_no", "source").agg(F.count("*").alias("n"))
    bt = b.groupBy("batch_no").agg(F.sum("n").alias("total"))
    b = b.join(bt, "batch_no").select("batch_no", "source", (F.col("n") / F.col("total")).alias("q"))
    grid = bt.select("batch_no").crossJoin(F.broadcast(a))  # batches by sources: both are names, not rows
    x = grid.join(b, ["batch_no", "source"], "full").groupBy("batch_no").agg(F.round(F.sum(F.abs(F.coalesce("p", F.lit(0.0)) - F.coalesce("q", F.lit(0.0)))), 6).alias("l1"))
    return x.select("batch_no", "l1", F.when(F.col("l1") > 0.5, "high").when(F.col("l1") > 0.25, "medium").otherwise("low").alias("severity"))


def wilson_rates(spark, d):
    """O-353, O-354: share of records labelled as needing cleaning with its Wilson interval, by length class."""
    t = table(spark, d, "cleaning_golden").groupBy("id").agg(F.max("expect_clean").alias("label"), F.max(F.length("text")).alias("n")).where("label is not null and n is not null")
    c = t.groupBy(F.when(F.col("n") < 400, "short").otherwise("long").alias("class")).agg(F.count("*").cast("double").alias("n"), F.sum(F.col("label").cast("int")).cast("double").alias("k"))
    p, n = F.col("k") / F.col("n"), F.col("n")
    denom = 1 + Z * Z / n
    mid = (p + Z * Z / (2 * n)) / denom
    half = Z * F.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n)) / denom
    return c.select("class", n.cast("bigint").alias("records"), F.round(p, 6).alias("rate"), F.round(F.greatest(F.lit(0.0), mid - half), 6).alias("low"), F.round(F.least(F.lit(1.0), mid + half), 6).alias("high"))


def percentile_summary(spark, d):
    """O-211: linear percentiles, mean and deviation of quality signals of the latest measurement."""
    t = table(spark, d, "quality_signals").where("id is not null").groupBy("id").agg(F.max_by("char_entropy", F.coalesce("measured_at", F.lit("1970-01-01").cast("timestamp_ntz"))).alias("e"), F.max_by("alpha_ratio", F.coalesce("measured_at", F.lit("1970-01-01").cast("timestamp_ntz"))).alias("a"))
    return t.agg(*[F.round(F.percentile("e", F.lit(q / 100)), 6).alias(f"entropy_p{q}") for q in (10, 50, 90)], F.round(F.avg("a"), 6).alias("alpha_mean"), F.round(F.stddev_samp("a"), 6).alias("alpha_sd"))


def midrank_percentile(spark, d):
    """O-207, O-208: mid-rank percentile of every text length; counts of distinct values in groups, no global sort of rows."""
    t = table(spark, d, "documents").where("text is not null").select(F.length("text").alias("n"))
    c = t.groupBy("n").agg(F.count("*").alias("equal")).withColumn("grp", F.floor(F.col("n") / 256))
    g = c.groupBy("grp").agg(F.sum("equal").alias("s"))
    before = g.withColumn("before", F.coalesce(F.sum("s").over(Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("s")
    total = c.agg(F.sum("equal").alias("total"))
    below = F.col("before") + F.coalesce(F.sum("equal").over(Window.partitionBy("grp").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return c.join(before, "grp").withColumn("below", below).crossJoin(F.broadcast(total)).select("n", "equal", F.round((F.col("below") + 0.5 * F.col("equal")) / F.col("total"), 6).alias("percentile"))


def signal_drift(spark, d):
    """O-210, O-339: mean entropy of each day of measurement against the whole and whether it drifts by over two standard errors."""
    t = table(spark, d, "quality_signals").where("char_entropy is not null and measured_at is not null").select(F.date_trunc("hour", "measured_at").cast("string").alias("hour"), "char_entropy")
    s = t.agg(F.avg("char_entropy").alias("m"), F.stddev_samp("char_entropy").alias("sd"))
    x = t.groupBy("hour").agg(F.count("*").alias("n"), F.avg("char_entropy").alias("mean"))
    return x.crossJoin(F.broadcast(s)).select("hour", "n", F.round("mean", 6).alias("mean"), (F.abs(F.col("mean") - F.col("m")) > 2 * F.col("sd") / F.sqrt("n")).alias("drifts"))


def corpus_score(spark, d):
    """O-347, O-349, O-350: weighted score of each source from diversity, repetition and size, and the decision."""
    from loamstone.functions.features import word_diversity

    t = spread(table(spark, d, "documents").where("text is not null").select("source", "text")).select("source", F.length("text").alias("n"), word_diversity(F.col("text")).alias("w"), T.content_hash(F.col("text")).alias("h"))
    x = t.groupBy("source").agg(F.count("*").alias("documents"), F.avg("w").alias("w"), (F.countDistinct("h") / F.count("*")).alias("u"), F.avg(F.least(F.lit(1.0), F.col("n") / 2000)).alias("s"))
    score = 100 * (0.4 * F.col("w") + 0.4 * F.col("u") + 0.2 * F.col("s"))
    return x.select("source", "documents", F.round(score, 4).alias("score"), F.when(score >= 75, "ACCEPT").when(score >= 60, "REVIEW").otherwise("REJECT").alias("decision"))


def sorted_output_hash(spark, d):
    """O-343, O-344: an order-free hash of each source's texts: the sum of 60-bit digests, so nothing is gathered."""
    h = F.conv(F.substring(F.sha2("text", 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return table(spark, d, "documents").where("text is not null").groupBy("source").agg(F.count("*").alias("documents"), F.sum(h).cast("string").alias("digest"))


def run_accounting(spark, d):
    """O-343, O-356: scanned = kept + rejected for runs of the detector, with those that do not add up."""
    t = table(spark, d, "pii_run_stats").where("run_id is not null")
    ok = F.col("accepted") + F.col("redacted") + F.col("rejected") + F.col("hard_rejected") == F.col("documents_scanned")
    return t.groupBy(F.coalesce(ok, F.lit(False)).alias("adds_up")).agg(F.count("*").alias("rows"), F.sum("documents_scanned").alias("scanned"))


def transform_audit(spark, d):
    """O-355, O-223: recall and kept noise of an old run by category and language."""
    t = table(spark, d, "redteam_qa").dropDuplicates(["id"])
    return t.groupBy("category", "lang").agg(F.count("*").alias("records"), F.count("actual_output").alias("outputs"), F.round(F.avg("recall"), 6).alias("recall"), F.round(F.avg("noise_retention"), 6).alias("noise"))


QUERIES = {f.__name__: f for f in (length_histogram, corpus_snapshot, diversity_index, distribution_drift, wilson_rates, percentile_summary, midrank_percentile, signal_drift, corpus_score, sorted_output_hash, run_accounting, transform_audit)}

from loamstone.plans.features import WORDS as _W  # noqa: E402
from loamstone.plans.texts import DEDUP as _D  # noqa: E402

_AXIS = "SELECT '{a}' AS axis, round(sum(-p * log2(p)) / greatest(log2(count(*)), 1e-9), 6) AS entropy FROM (SELECT n / sum(n) OVER () AS p FROM (SELECT count(*) AS n FROM documents GROUP BY coalesce({a}, 'none')))"
_LAST = "(SELECT id, char_entropy AS e FROM quality_signals WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY coalesce(measured_at, TIMESTAMP '1970-01-01') DESC) = 1)"
ORACLE = {
    "percentile_summary": f"SELECT {', '.join(f'(SELECT round(quantile_cont(e, {q / 100}), 6) FROM {_LAST}) AS entropy_p{q}' for q in (10, 50, 90))}, round(avg(a), 6) AS alpha_mean, round(stddev_samp(a), 6) AS alpha_sd FROM {_LAST.replace('char_entropy AS e', 'alpha_ratio AS a')}",
    "transform_audit": "SELECT category, lang, count(*) AS records, count(actual_output) AS outputs, round(avg(recall), 6) AS recall, round(avg(noise_retention), 6) AS noise FROM (SELECT DISTINCT ON (id) * FROM redteam_qa) GROUP BY 1, 2",
    "length_histogram": "SELECT bucket, documents, round(documents / sum(documents) OVER (), 4) AS share FROM (SELECT CASE WHEN length(text) < 800 THEN '<800' WHEN length(text) < 2400 THEN '<2400' WHEN length(text) < 6000 THEN '<6000' ELSE '>=6000' END AS bucket, count(*) AS documents FROM documents WHERE text IS NOT NULL GROUP BY 1)",
    "corpus_snapshot": f"SELECT count(*) AS documents, count(DISTINCT sha256({_D})) AS distinct_texts, count(DISTINCT source) AS sources, CAST(sum(CASE WHEN lang IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unlabelled, CAST(sum(CASE WHEN trim(coalesce(text,'')) = '' THEN 1 ELSE 0 END) AS BIGINT) AS blank, CAST(sum(length(text)) AS BIGINT) AS chars, round(avg(length(text)), 4) AS mean_chars FROM documents",
    "diversity_index": " UNION ALL ".join(_AXIS.format(a=a) for a in ("lang", "source", "domain")),
    "distribution_drift": "WITH a AS (SELECT source, count(*) / (SELECT count(*) FROM documents) AS p FROM documents GROUP BY 1), b AS (SELECT batch_no, source, count(*) / sum(count(*)) OVER (PARTITION BY batch_no) AS q FROM batch_docs GROUP BY 1, 2), g AS (SELECT batch_no, source, p FROM (SELECT DISTINCT batch_no FROM batch_docs), a), l AS (SELECT batch_no, round(sum(abs(coalesce(p, 0) - coalesce(q, 0))), 6) AS l1 FROM g FULL JOIN b USING (batch_no, source) GROUP BY 1) SELECT batch_no, l1, CASE WHEN l1 > 0.5 THEN 'high' WHEN l1 > 0.25 THEN 'medium' ELSE 'low' END AS severity FROM l",
    "wilson_rates": "WITH t AS (SELECT id, bool_or(expect_clean) AS label, max(length(text)) AS n FROM cleaning_golden GROUP BY 1), c AS (SELECT CASE WHEN n < 400 THEN 'short' ELSE 'long' END AS class, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CASE WHEN label THEN 1 ELSE 0 END) AS DOUBLE) AS k FROM t WHERE label IS NOT NULL AND n IS NOT NULL GROUP BY 1), d AS (SELECT *, k / n AS p, 1 + 3.8416 / n AS dn FROM c) SELECT class, CAST(n AS BIGINT) AS records, round(p, 6) AS rate, round(greatest(0, (p + 3.8416 / (2 * n)) / dn - 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n)) / dn), 6) AS low, round(least(1, (p + 3.8416 / (2 * n)) / dn + 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n)) / dn), 6) AS high FROM d",
    "midrank_percentile": "SELECT DISTINCT length(text) AS n, count(*) OVER (PARTITION BY length(text)) AS equal, round((rank() OVER (ORDER BY length(text)) - 1 + 0.5 * count(*) OVER (PARTITION BY length(text))) / count(*) OVER (), 6) AS percentile FROM documents WHERE text IS NOT NULL",
    "signal_drift": "WITH t AS (SELECT CAST(date_trunc('hour', measured_at) AS VARCHAR) AS hour, char_entropy FROM quality_signals WHERE char_entropy IS NOT NULL AND measured_at IS NOT NULL), s AS (SELECT avg(char_entropy) AS m, stddev_samp(char_entropy) AS sd FROM t) SELECT hour, n, round(mean, 6) AS mean, abs(mean - m) > 2 * sd / sqrt(n) AS drifts FROM (SELECT hour, count(*) AS n, avg(char_entropy) AS mean FROM t GROUP BY 1), s",
    "corpus_score": f"SELECT source, documents, round(score, 4) AS score, CASE WHEN score >= 75 THEN 'ACCEPT' WHEN score >= 60 THEN 'REVIEW' ELSE 'REJECT' END AS decision FROM (SELECT source, count(*) AS documents, 100 * (0.4 * avg(CASE WHEN len(lw) > 0 THEN len(list_distinct(lw)) / len(lw) ELSE 0 END) + 0.4 * count(DISTINCT h) / count(*) + 0.2 * avg(least(1, length(text) / 2000))) AS score FROM (SELECT source, text, sha256({_D}) AS h, {_W.format(c='lower(text)')} AS lw FROM documents WHERE text IS NOT NULL) GROUP BY 1)",
    "sorted_output_hash": "SELECT source, count(*) AS documents, CAST(sum(CAST(CAST('0x' || substr(sha256(text), 1, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS digest FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "run_accounting": "SELECT coalesce(accepted + redacted + rejected + hard_rejected = documents_scanned, false) AS adds_up, count(*) AS rows, CAST(sum(documents_scanned) AS BIGINT) AS scanned FROM pii_run_stats WHERE run_id IS NOT NULL GROUP BY 1",
}
