"""Queries over quotas, mixtures, splits, sampling order and curriculum."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamstone.operators.order import running
from loamstone.plans.evidence import MEASURED
from loamstone.sources.tables import spread, table

def mixture_weights(spark, d):
    """O-306, O-307, O-314: inverse-gap weights of domains towards equal shares."""
    t = table(spark, d, "documents").groupBy(F.coalesce("domain", F.lit("none")).alias("domain")).agg(F.count("*").alias("n"))
    all_ = t.agg(F.sum("n").alias("total"), F.count("*").alias("k"))
    x = t.crossJoin(F.broadcast(all_))  # one row
    gap = F.greatest(F.lit(0.0), 1 / F.col("k") - F.col("n") / F.col("total"))
    x = x.withColumn("raw", 0.05 + 2 * gap + 1 / F.col("k"))
    s = x.agg(F.sum("raw").alias("s"))
    return x.crossJoin(F.broadcast(s)).select("domain", "n", F.round(F.col("raw") / F.col("s"), 6).alias("weight"))


def hash_split(spark, d):
    """O-316: train, validation and test by a 53-bit digest of the key."""
    f = F.conv(F.substring(F.sha2(F.concat(F.lit("7:"), F.col("doc_id").cast("string")), 256), 1, 13), 16, 10).cast("double") / float(1 << 52)
    s = F.when(f < 0.05, "test").when(f < 0.15, "val").otherwise("train")
    return table(spark, d, "documents").select("doc_id", s.alias("split"))


def domain_quota_batch(spark, d):
    """O-301, O-302, O-304: documents within a domain's quota of a third and a soft overflow, by hash order within the domain.

    Each group of a domain is ranked on its own; the exact place follows from counts of groups and not from one sorted domain.
    """
    h = F.substring(F.sha2(F.col("doc_id").cast("string"), 256), 1, 8)
    t = table(spark, d, "documents").select("doc_id", F.coalesce("domain", F.lit("none")).alias("domain"), h.alias("h"))
    total = t.agg(F.count("*").alias("total"))
    n = t.groupBy("domain").agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).withColumn("cap", F.floor(F.col("total") * 0.15 * 1.15))
    # a cap as a share of hashes: ranks are needed only in the group where the cap falls
    t = t.withColumn("grp", F.conv(F.substring("h", 1, 3), 16, 10).cast("int"))
    sums = t.groupBy("domain", "grp").agg(F.count("*").alias("k"))
    before = sums.withColumn("before", F.coalesce(F.sum("k").over(Window.partitionBy("domain").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("k")
    r = t.join(before, ["domain", "grp"]).withColumn("r", F.col("before") + F.row_number().over(Window.partitionBy("domain", "grp").orderBy("h", "doc_id")))
    return r.join(n.select("domain", "cap"), "domain").where(F.col("r") <= F.col("cap")).select("doc_id", "domain", F.col("r").cast("bigint").alias("place"))


def sampling_weights(spark, d):
    """O-308, O-309: sampling weight of a document from language, length and diversity, with its floor."""
    t = table(spark, d, "documents").where("text is not null")
    n = F.length("text")
    lang = F.when(F.col("lang") == "en", 1.0).when(F.col("lang").isNull(), 0.5).otherwise(1.3)
    size = F.when(n > 16000, 0.6).when(n > 8000, 0.8).when(n < 200, 0.5).otherwise(1.0)
    w = F.greatest(F.lit(1e-6), lang * size)
    return t.groupBy("lang").agg(F.count("*").alias("documents"), F.round(F.sum(w), 4).alias("weight"))


#: Cut-offs of the policy: a document beyond one has no weight at all.
POLICY = {"min_quality": 0.3, "synthetic_cap": 0.72, "max_spam": 0.55, "min_education": 0.0, "languages": ("en", "de", "fr", "es")}


def policy_weights(spark, d):
    """O-308, O-309: sampling weight of every document from its quality, its language and its size, nil beyond a cut-off of the policy."""
    x = MEASURED.spark(spread(table(spark, d, "documents").where("text is not null and length(text) > 0").select("doc_id", "lang", "source", "domain", "text")))
    return x.selectExpr("doc_id", f"round({_POLICY} + 1e-9, 5) AS weight")


_QUALITY = "1.0 - greatest(boilerplate, commercial, seo, low_info)"
_POLICY = (
    f"CASE WHEN {_QUALITY} < {POLICY['min_quality']} OR synthetic > {POLICY['synthetic_cap']} OR token_spam > {POLICY['max_spam']} OR education < {POLICY['min_education']} OR coalesce(lang, 'en') NOT IN {POLICY['languages']!r} THEN 0.0"
    f" ELSE greatest(1e-6, ({_QUALITY}) * (1.0 + 0.5 * education + 0.5 * factual + 0.3 * reasoning) * (1.0 - 0.5 * synthetic) * (CASE WHEN coalesce(lang, 'en') = 'en' THEN 1.0 ELSE 1.3 END) * (CASE WHEN n > 16000 THEN 0.6 WHEN n > 8000 THEN 0.8 WHEN n < 200 THEN 0.5 ELSE 1.0 END)) END"
)


def weighted_sample_order(spark, d):
    """O-311: the 200 documents first in a deterministic weighted order (a top-k report of `weighted_order`)."""
    f = F.conv(F.substring(F.sha2(F.concat(F.lit("s1:"), F.col("doc_id").cast("string")), 256), 1, 13), 16, 10).cast("double") / float(1 << 52)
    w = F.when(F.col("lang") == "en", 1.0).otherwise(2.0)
    return table(spark, d, "documents").select("doc_id", F.round(f / w, 9).alias("score")).orderBy(F.desc("score"), "doc_id").limit(200)


def _rank_groups(t, key, groups=4096):
    """(grp, before) of every row: even ranges of a key in [0, 1), the greatest first, with the rows in earlier groups."""
    g = t.withColumn("grp", F.least(F.lit(groups - 1), F.floor((1 - F.col(key)) * groups)).cast("int"))
    sums = g.groupBy("grp").agg(F.count("*").alias("k"))
    # the only global step: one row a group
    before = sums.withColumn("before", F.coalesce(F.sum("k").over(Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("k")
    return g.join(before, "grp")


def weighted_order(spark, d, quotas=None):
    """O-310, O-317: every document with its rank in the deterministic weighted order and its stage from the tokens before it in id order.

    quotas: documents of a language taken at most, first come by id; a language
    that it does not name is left out, and without quotas all are taken. Places
    and ranks come from counts of groups and the order within a group, so no
    sort holds all documents.
    """
    f = F.conv(F.substring(F.sha2(F.concat(F.lit("s1:"), F.col("doc_id").cast("string")), 256), 1, 13), 16, 10).cast("double") / float(1 << 52)
    w = F.when(F.col("lang") == "en", 1.0).otherwise(2.0)
    t = table(spark, d, "documents").select("doc_id", "lang", F.round(f / w, 9).alias("score"), F.greatest(F.lit(1), F.floor(F.coalesce(F.length("text"), F.lit(0)) / 4)).cast("bigint").alias("tokens"))
    if quotas:
        cap = F.lit(0)
        for lang, n in quotas.items():
            cap = F.when(F.col("lang") == lang, n).otherwise(cap)
        g = t.withColumn("cap", cap).where("cap > 0").withColumn("one", F.lit(1))
        t = running(g, "one", "place", by=("lang",)).where("place < cap").select("doc_id", "lang", "score", "tokens")
    x = running(t, "tokens", "cursor")
    stage = F.when(F.col("cursor") < 50_000, "foundation").when(F.col("cursor") < 150_000, "expansion").when(F.col("cursor") < 300_000, "depth").otherwise("anneal")
    rank = F.col("before") + F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("score"), "doc_id"))
    return _rank_groups(x, "score").select(rank.alias("rank"), "doc_id", "lang", "score", stage.alias("stage"))


def curriculum_stage_ranges(spark, d):
    """O-303, O-313: stage of every document from the running token cursor in id order."""
    t = table(spark, d, "documents").where("text is not null").select("doc_id", F.greatest(F.lit(1), F.floor(F.length("text") / 4)).cast("bigint").alias("tokens"))
    x = running(t, "tokens", "cursor")
    stage = F.when(F.col("cursor") < 50_000, "foundation").when(F.col("cursor") < 150_000, "expansion").when(F.col("cursor") < 300_000, "depth").otherwise("anneal")
    return x.groupBy(stage.alias("stage")).agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"), F.min("cursor").alias("first_cursor"))


def replay_injection(spark, d):
    """O-311, O-312: a fixed share of positions replays an earlier document, chosen by hash."""
    u = F.conv(F.substring(F.sha2(F.concat(F.lit("r:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("bigint")
    t = table(spark, d, "documents").select("doc_id", "source", u.alias("u"))
    return t.where("u % 100 < 5").select("doc_id", "source", F.pmod(F.floor(F.col("u") / 100), F.greatest(F.col("doc_id") - 1, F.lit(1))).alias("replay_rank"))


def shard_plan(spark, d):
    """O-325, O-326, O-330: shard of every document from the running count of its white-space tokens."""
    from loamstone.functions import text as T

    t = table(spark, d, "documents").where("text is not null").select("doc_id", (F.size(T.words(F.col("text"))) + 1).cast("bigint").alias("tokens"))
    x = running(t, "tokens", "cursor").withColumn("shard", F.floor(F.col("cursor") / 20_000))
    return x.groupBy("shard").agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"), F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last_doc_id"))


def sequence_windows(spark, d):
    """O-327, O-328: windows of 257 tokens over the concatenated stream: each document's first and last window and fill."""
    from loamstone.functions import text as T

    t = table(spark, d, "documents").where("text is not null").select("doc_id", (F.size(T.words(F.col("text"))) + 1).cast("bigint").alias("tokens"))
    x = running(t, "tokens", "cursor")
    return x.select("doc_id", F.floor(F.col("cursor") / 257).alias("first_window"), F.floor((F.col("cursor") + F.col("tokens") - 1) / 257).alias("last_window"), (F.col("cursor") % 257).alias("offset"))


def top_sources(spark, d):
    """O-319, O-320: five sources of the most text (a top-k report)."""
    return table(spark, d, "documents").groupBy("source").agg(F.sum(F.length("text")).alias("chars"), F.count("*").alias("documents")).orderBy(F.desc("chars"), "source").limit(5)


QUERIES = {f.__name__: f for f in (mixture_weights, hash_split, domain_quota_batch, sampling_weights, policy_weights, weighted_sample_order, weighted_order, curriculum_stage_ranges, replay_injection, shard_plan, sequence_windows, top_sources)}

_F52 = "CAST(CAST('0x' || substr(sha256('{p}' || doc_id), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496"
_TOK = r"len(list_filter(regexp_split_to_array(text, '[\s\x0b\p{Z}\x{85}]+'), lambda x: x <> '')) + 1"
_CUR = f"(SELECT doc_id, tokens, coalesce(sum(tokens) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cursor FROM (SELECT doc_id, {_TOK} AS tokens FROM documents WHERE text IS NOT NULL))"
ORACLE = {
    "policy_weights": f"SELECT doc_id, round({_POLICY} + 1e-9, 5) AS weight FROM {MEASURED.duck('(SELECT doc_id, lang, source, domain, text FROM documents WHERE text IS NOT NULL AND length(text) > 0)')}",
    "mixture_weights": "WITH t AS (SELECT coalesce(domain,'none') AS domain, count(*) AS n FROM documents GROUP BY 1), r AS (SELECT domain, n, 0.05 + 2 * greatest(0, 1 / (SELECT count(*) FROM t) - n / (SELECT sum(n) FROM t)) + 1 / (SELECT count(*) FROM t) AS raw FROM t) SELECT domain, n, round(raw / (SELECT sum(raw) FROM r), 6) AS weight FROM r",
    "hash_split": f"SELECT doc_id, CASE WHEN f < 0.05 THEN 'test' WHEN f < 0.15 THEN 'val' ELSE 'train' END AS split FROM (SELECT doc_id, {_F52.format(p='7:')} AS f FROM documents)",
    "domain_quota_batch": "WITH t AS (SELECT doc_id, coalesce(domain,'none') AS domain, row_number() OVER (PARTITION BY coalesce(domain,'none') ORDER BY substr(sha256(CAST(doc_id AS VARCHAR)),1,8), doc_id) AS place FROM documents) SELECT doc_id, domain, place FROM t WHERE place <= floor((SELECT count(*) FROM documents) * 0.15 * 1.15)",
    "sampling_weights": "SELECT lang, count(*) AS documents, round(sum(greatest(1e-6, l * s)), 4) AS weight FROM (SELECT lang, CAST(CASE WHEN lang = 'en' THEN 1.0 WHEN lang IS NULL THEN 0.5 ELSE 1.3 END AS DOUBLE) AS l, CAST(CASE WHEN length(text) > 16000 THEN 0.6 WHEN length(text) > 8000 THEN 0.8 WHEN length(text) < 200 THEN 0.5 ELSE 1.0 END AS DOUBLE) AS s FROM documents WHERE text IS NOT NULL) GROUP BY lang",
    "weighted_sample_order": f"SELECT doc_id, round(({_F52.format(p='s1:')}) / CASE WHEN lang = 'en' THEN 1.0 ELSE 2.0 END, 9) AS score FROM documents ORDER BY score DESC, doc_id LIMIT 200",
    "weighted_order": f"SELECT row_number() OVER (ORDER BY score DESC, doc_id) AS rank, doc_id, lang, score, CASE WHEN cursor < 50000 THEN 'foundation' WHEN cursor < 150000 THEN 'expansion' WHEN cursor < 300000 THEN 'depth' ELSE 'anneal' END AS stage FROM (SELECT doc_id, lang, round(({_F52.format(p='s1:')}) / CASE WHEN lang = 'en' THEN 1.0 ELSE 2.0 END, 9) AS score, coalesce(sum(greatest(1, coalesce(length(text), 0) // 4)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cursor FROM documents)",
    "curriculum_stage_ranges": "SELECT CASE WHEN cursor < 50000 THEN 'foundation' WHEN cursor < 150000 THEN 'expansion' WHEN cursor < 300000 THEN 'depth' ELSE 'anneal' END AS stage, count(*) AS documents, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(min(cursor) AS BIGINT) AS first_cursor FROM (SELECT tokens, coalesce(sum(tokens) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cursor FROM (SELECT doc_id, greatest(1, length(text) // 4) AS tokens FROM documents WHERE text IS NOT NULL)) GROUP BY 1",
    "replay_injection": "SELECT doc_id, source, (u // 100) % greatest(doc_id - 1, 1) AS replay_rank FROM (SELECT doc_id, source, CAST('0x' || substr(sha256('r:' || doc_id), 1, 8) AS BIGINT) AS u FROM documents) WHERE u % 100 < 5",
    "shard_plan": f"SELECT CAST(cursor // 20000 AS BIGINT) AS shard, count(*) AS documents, CAST(sum(tokens) AS BIGINT) AS tokens, min(doc_id) AS first_doc_id, max(doc_id) AS last_doc_id FROM {_CUR} GROUP BY 1",
    "sequence_windows": f"SELECT doc_id, CAST(cursor // 257 AS BIGINT) AS first_window, CAST((cursor + tokens - 1) // 257 AS BIGINT) AS last_window, CAST(cursor % 257 AS BIGINT) AS \"offset\" FROM {_CUR}",
    "top_sources": "SELECT source, CAST(sum(length(text)) AS BIGINT) AS chars, count(*) AS documents FROM documents GROUP BY source ORDER BY chars DESC, source LIMIT 5",
}
