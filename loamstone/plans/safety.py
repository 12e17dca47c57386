"""Queries over personal data, toxicity, licences and provenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamstone.functions import safety as S
from loamstone.functions.features import count
from loamstone.sources.tables import table


def _qa(spark, d):
    return table(spark, d, "redteam_qa").select("id", "lang", "text").dropDuplicates(["id", "text"]).where("text is not null")


def _counted(spark, d):
    c = F.col("text")
    return _qa(spark, d).select("id", "lang", (count(c, S.EMAIL) - F.least(count(c, S.EMAIL), count(c, S.TEMPLATE_EMAIL))).alias("emails"), count(c, S.PHONE).alias("phones"), count(c, S.CARD).alias("cards"), count(c, S.SECRET).alias("secrets"), c.rlike(S.EDUCATION).alias("benign"))


def pii_entity_counts(spark, d):
    """O-152 to O-155: mailboxes, phone numbers, cards and credentials by rule in every record."""
    return _counted(spark, d)


def pii_bands(spark, d):
    """O-156, O-157, O-159, O-160, O-163: risk bands by language."""
    x = _counted(spark, d).withColumn("risk", S.pii_risk(*[F.col(k) for k in ("emails", "phones", "cards", "secrets", "benign")]))
    return x.groupBy("lang", S.band(F.col("risk")).alias("band")).agg(F.count("*").alias("records"), F.round(F.avg("risk"), 6).alias("mean_risk"))


def pii_redact(spark, d):
    """O-161, O-162: redacted texts by their digest."""
    return _qa(spark, d).select("id", F.sha2(S.redact(F.col("text")), 256).alias("digest"), F.length(S.redact(F.col("text"))).alias("chars"))


def pii_run_totals(spark, d):
    """O-163: the latest row of every run and its totals."""
    t = table(spark, d, "pii_run_stats").where("run_id is not null")
    last = t.groupBy("run_id").agg(F.max(F.struct(F.coalesce("started_at", F.lit("1970-01-01").cast("timestamp_ntz")).alias("at"), "documents_scanned", "entities_detected", "redactions_applied", "accepted", "redacted")).alias("r"))
    return last.select("run_id", "r.documents_scanned", "r.entities_detected", "r.redactions_applied", "r.accepted", "r.redacted")


def toxicity_scores(spark, d):
    """O-164 to O-173: rule hits of three families, combined and damped in a context of teaching; bands."""
    c = F.col("text")
    t = table(spark, d, "redteam_adversarial").select("id", "text").dropDuplicates(["id"]).where("text is not null")
    hits = [count(c, p) for p in (S.INSULT, S.THREAT, S.PROFANITY)]
    raw = F.greatest(*[F.when(h > 0, w + 0.04 * (h - 1)).otherwise(0.0) for h, w in zip(hits, (0.5, 0.9, 0.3))])
    score = F.least(F.lit(1.0), F.when(c.rlike(S.EDUCATION), raw * 0.5).otherwise(raw))
    b = F.when(score < 0.25, "accept").when(score < 0.45, "review").when(score < 0.8, "reject").otherwise("hard_reject")
    return t.groupBy(b.alias("band")).agg(F.count("*").alias("records"), F.round(F.sum(score), 6).alias("score"))


def spam_repeats(spark, d):
    """O-165, O-166: records whose most frequent word of three letters and more takes over a quarter of the words."""
    t = table(spark, d, "redteam_adversarial").select("id", "text").dropDuplicates(["id"]).where("text is not null")
    w = t.select("id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}"), F.lit(0))).alias("w"))
    n = w.groupBy("id", "w").agg(F.count("*").alias("n")).groupBy("id").agg(F.max("n").alias("top"), F.sum("n").alias("words"))
    return n.where("top >= 5 and top * 4 > words").select("id", "top", "words")


def url_hosts(spark, d):
    """O-176 to O-179, O-182: hosts that texts link to, with suffix and kind, and the documents that do."""
    u = table(spark, d, "documents").where("text is not null").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"https?://([A-Za-z0-9.-]+)"), F.lit(1))).alias("h"))
    h = u.select("doc_id", F.regexp_replace(F.lower("h"), r"^www\.", "").alias("host")).where("host <> ''").distinct()
    kind = F.when(F.col("host").rlike(r"\.gov(?:\.|$)"), "government").when(F.col("host").rlike(r"^(?:github|gitlab)\."), "repository").otherwise("web")
    return h.groupBy(F.regexp_extract("host", r"\.([a-z]+)$", 1).alias("suffix"), kind.alias("kind")).agg(F.countDistinct("host").alias("hosts"), F.countDistinct("doc_id").alias("documents"))


def provenance_records(spark, d):
    """O-187, O-188, O-189: provenance of every document: source, day, licence class and whether the index and registry know it."""
    docs = table(spark, d, "documents").select("doc_id", "source", "content_hash", F.to_date("ingested_at").cast("string").alias("day"))
    seen = table(spark, d, "content_hashes").select(F.col("hash").alias("content_hash")).where("content_hash is not null").distinct().withColumn("indexed", F.lit(True))
    reg = table(spark, d, "corpus_doc_registry").where("content_hash <> ''").groupBy("content_hash").agg(F.sum("observation_count").alias("observations"))
    x = docs.join(seen, "content_hash", "left").join(reg, "content_hash", "left")
    return x.select("doc_id", "source", "day", F.coalesce("indexed", F.lit(False)).alias("indexed"), F.coalesce("observations", F.lit(0)).alias("observations"))


QUERIES = {f.__name__: f for f in (pii_entity_counts, pii_bands, pii_redact, pii_run_totals, toxicity_scores, spam_repeats, url_hosts, provenance_records)}

_E = lambda p, c="text": f"CAST(len(regexp_extract_all({c}, '{p}')) AS DOUBLE)"
_CNT = f"(SELECT id, lang, {_E(S.EMAIL)} - least({_E(S.EMAIL)}, {_E(S.TEMPLATE_EMAIL)}) AS emails, {_E(S.PHONE)} AS phones, {_E(S.CARD)} AS cards, {_E(S.SECRET)} AS secrets, regexp_matches(text, '{S.EDUCATION}') AS benign FROM (SELECT DISTINCT ON (id, text) id, lang, text FROM redteam_qa WHERE text IS NOT NULL))"
_RED = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '{}', '<SECRET>', 'g'), '{}', '<CARD>', 'g'), '{}', '<EMAIL>', 'g'), '{}', '<PHONE>', 'g')".format(S.SECRET, S.CARD, S.EMAIL, S.PHONE)
_LIC = "CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in S.LICENCES) + " ELSE 'unknown' END"
ORACLE = {
    "pii_run_totals": "SELECT run_id, documents_scanned, entities_detected, redactions_applied, accepted, redacted FROM pii_run_stats WHERE run_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY coalesce(started_at, TIMESTAMP '1970-01-01') DESC, documents_scanned DESC NULLS LAST, entities_detected DESC NULLS LAST, redactions_applied DESC NULLS LAST, accepted DESC NULLS LAST, redacted DESC NULLS LAST) = 1",
    "pii_entity_counts": f"SELECT * FROM {_CNT}",
    "pii_bands": f"SELECT lang, CASE WHEN risk <= 0.20 THEN 'accept' WHEN risk < 0.60 THEN 'redact' WHEN risk < 0.95 THEN 'reject' ELSE 'hard_reject' END AS band, count(*) AS records, round(avg(risk), 6) AS mean_risk FROM (SELECT lang, CASE WHEN benign THEN 0.5 ELSE 1.0 END * CASE WHEN n > 0 THEN least(1, best * 0.85 + 0.05 * least(n, 8)) ELSE 0 END AS risk FROM (SELECT *, emails + phones + cards + secrets AS n, CAST(greatest(CASE WHEN emails > 0 THEN 0.6 ELSE 0 END, CASE WHEN phones > 0 THEN 0.55 ELSE 0 END, CASE WHEN cards > 0 THEN 0.9 ELSE 0 END, CASE WHEN secrets > 0 THEN 0.95 ELSE 0 END) AS DOUBLE) AS best FROM {_CNT})) GROUP BY 1, 2",
    "pii_redact": f"SELECT id, sha256({_RED}) AS digest, length({_RED}) AS chars FROM (SELECT DISTINCT id, text FROM redteam_qa WHERE text IS NOT NULL)",
    "toxicity_scores": f"SELECT band, count(*) AS records, round(sum(score), 6) AS score FROM (SELECT score, CASE WHEN score < 0.25 THEN 'accept' WHEN score < 0.45 THEN 'review' WHEN score < 0.8 THEN 'reject' ELSE 'hard_reject' END AS band FROM (SELECT least(1, CASE WHEN regexp_matches(text, '{S.EDUCATION}') THEN 0.5 ELSE 1.0 END * greatest(CASE WHEN a > 0 THEN 0.5 + 0.04 * (a - 1) ELSE 0 END, CASE WHEN b > 0 THEN 0.9 + 0.04 * (b - 1) ELSE 0 END, CASE WHEN c > 0 THEN 0.3 + 0.04 * (c - 1) ELSE 0 END)) AS score FROM (SELECT text, {_E(S.INSULT)} AS a, {_E(S.THREAT)} AS b, {_E(S.PROFANITY)} AS c FROM (SELECT DISTINCT id, text FROM redteam_adversarial WHERE text IS NOT NULL)))) GROUP BY 1",
    "spam_repeats": r"SELECT id, top, CAST(words AS BIGINT) AS words FROM (SELECT id, max(n) AS top, sum(n) AS words FROM (SELECT id, w, count(*) AS n FROM (SELECT id, unnest(regexp_extract_all(lower(text), '\p{L}{3,}')) AS w FROM (SELECT DISTINCT id, text FROM redteam_adversarial WHERE text IS NOT NULL)) GROUP BY 1, 2) GROUP BY 1) WHERE top >= 5 AND top * 4 > words",
    "url_hosts": r"SELECT regexp_extract(host, '\.([a-z]+)$', 1) AS suffix, CASE WHEN regexp_matches(host, '\.gov(?:\.|$)') THEN 'government' WHEN regexp_matches(host, '^(?:github|gitlab)\.') THEN 'repository' ELSE 'web' END AS kind, count(DISTINCT host) AS hosts, count(DISTINCT doc_id) AS documents FROM (SELECT doc_id, regexp_replace(lower(h), '^www\.', '') AS host FROM (SELECT doc_id, unnest(regexp_extract_all(text, 'https?://([A-Za-z0-9.-]+)', 1)) AS h FROM documents WHERE text IS NOT NULL)) WHERE host <> '' GROUP BY 1, 2",
    "provenance_records": "SELECT d.doc_id, d.source, CAST(CAST(ingested_at AS DATE) AS VARCHAR) AS day, h.hash IS NOT NULL AS indexed, coalesce(r.observations, 0) AS observations FROM documents d LEFT JOIN (SELECT DISTINCT hash FROM content_hashes) h ON d.content_hash = h.hash LEFT JOIN (SELECT content_hash, CAST(sum(observation_count) AS BIGINT) AS observations FROM corpus_doc_registry WHERE content_hash <> '' GROUP BY 1) r ON d.content_hash = r.content_hash",
}
