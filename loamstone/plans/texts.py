"""Queries over normalisation, hashing, exact deduplication, admission and sources."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamstone.config import Settings
from loamstone.functions import text as T
from loamstone.operators.order import running
from loamstone.sources.tables import spread, table

FLAT = r"trim(regexp_replace(regexp_replace(text,'[\x00-\x08\x0b\x0c\x0e-\x1f]','','g'),'[\s\p{Z}\x{85}]+',' ','g'))"
DEDUP = r"lower(trim(regexp_replace(regexp_replace(nfc_normalize(text),'[\x00-\x08\x0b\x0c\x0e-\x1f]','','g'),'[\s\p{Z}\x{85}]+',' ','g')))"


def normalize_minimal(spark, d):
    """O-030, O-031, O-040: flat text and its letters and numbers."""
    t = spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", T.minimal_normalize(F.col("text")).alias("flat"))
    return t.select("doc_id", F.length("flat").alias("chars"), T.meaningful_chars(F.col("flat")).alias("meaningful"), F.sha2("flat", 256).alias("digest"))


def content_hash_groups(spark, d):
    """O-034, O-035, O-117: groups of documents equal after normalisation."""
    t = spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", T.content_hash(F.col("text")).alias("hash"))
    return t.groupBy("hash").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last_doc_id"))


def exact_dedup_first_wins(spark, d):
    """O-277: the first document of each content hash, by aggregation instead of a window, so copies are joined on the map side."""
    t = table(spark, d, "documents").select("doc_id", "lang", T.content_hash(F.col("text")).alias("hash"))
    return t.groupBy("hash").agg(F.min(F.struct("doc_id", "lang")).alias("first")).select("hash", "first.doc_id", "first.lang")


def hash_index_summary(spark, d):
    """O-278, O-279, O-281: entries, hashes and first sights of the index by source and shard."""
    t = table(spark, d, "content_hashes").where("hash is not null")
    shard = F.pmod(F.conv(F.substring("hash", 1, 2), 16, 10).cast("int"), F.lit(4)).alias("shard")
    return t.groupBy("source", shard).agg(F.count("*").alias("entries"), F.countDistinct("hash").alias("hashes"))


def new_against_index(spark, d):
    """O-280, O-297: documents whose hash the index lacks (anti-join; the index is read in two columns)."""
    docs = table(spark, d, "documents").select("doc_id", "source", T.content_hash(F.col("text")).alias("hash"))
    known = table(spark, d, "content_hashes").select("hash").where("hash is not null")
    return docs.join(known, "hash", "left_anti").select("doc_id", "source", "hash")


def size_alpha_gate(spark, d, cfg: Settings = Settings()):
    """O-014, O-114, O-115: size and alphabet gates with one reason per document."""
    t = table(spark, d, "documents").select("doc_id", "domain", T.minimal_normalize(F.col("text")).alias("flat"))
    m, n = T.meaningful_chars(F.col("flat")), F.length("flat")
    code = F.coalesce(F.col("domain") == "code", F.lit(False))
    letters = F.length(F.regexp_replace("flat", r"[^\p{L}]", ""))
    reason = F.when(n == 0, "empty_text").when((m < cfg.min_chars) & ~code, "too_short").when((n > cfg.max_chars) & ~code, "document_too_large").when(letters / n < cfg.min_alpha, "low_alpha").otherwise("ok")
    return t.select("doc_id", m.alias("meaningful"), n.alias("chars"), reason.alias("reason"))


def admission_tiers(spark, d):
    """O-126, O-127: cost tier and lane by length."""
    t = table(spark, d, "documents").select("doc_id", F.length("text").alias("n"))
    tier = F.when(F.col("n") < 8000, "small").when(F.col("n") < 30000, "medium").when(F.col("n") < 80000, "large").otherwise("huge")
    base = F.when(F.col("n") < 8000, 1.0).when(F.col("n") < 30000, 2.0).when(F.col("n") < 80000, 4.0).otherwise(8.0)
    cost = base * (1 + F.least(F.col("n"), F.lit(200_000)) / 120_000.0)
    x = t.where("n is not null").select(tier.alias("tier"), cost.alias("cost"), F.when(tier == "huge", "huge").when(tier == "large", "large").otherwise("normal").alias("lane"))
    return x.groupBy("tier", "lane").agg(F.count("*").alias("documents"), F.sum("cost").alias("cost"))


def byte_budget_per_source(spark, d):
    """O-011, O-012, O-013: documents that fit a source's byte cap in order, the cap a share of the budget.

    The running sum is taken in two steps, over groups of ids and then within
    a group, so that one hot source is not one task's sort.
    """
    t = table(spark, d, "documents").select("source", "doc_id", F.octet_length("text").cast("bigint").alias("bytes"))
    run = running(t, "bytes", "before", by=("source",))
    return run.where(F.col("before") + F.coalesce("bytes", F.lit(0)) <= 60_000).groupBy("source").agg(F.count("*").alias("documents"), F.sum("bytes").alias("bytes"))


def weighted_interleave(spark, d):
    """O-006, O-007: weighted round robin over sources; the place of every document in the merged stream.

    A round holds at most the sum of the weights, so the order within it is a
    window over a few rows; rows of the rounds before come from counts of
    rounds, summed over groups of rounds first. No global sort, no cross join.
    """
    w = F.when(F.col("source").startswith("open-web"), 2).otherwise(1)
    step = 4096
    t = table(spark, d, "documents").where("source is not null").select("source", "doc_id", w.cast("bigint").alias("w"), F.lit(1).alias("one"))
    k = F.col("k")
    ranked = running(t, "one", "k", by=("source",)).select("source", "doc_id", F.floor(k / F.col("w")).alias("round"), (k % F.col("w")).alias("slot"))
    rounds = ranked.groupBy("round").agg(F.count("*").alias("n")).withColumn("block", F.floor(F.col("round") / step))
    blocks = rounds.groupBy("block").agg(F.sum("n").alias("s"))
    ahead = blocks.withColumn("ahead", F.coalesce(F.sum("s").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("s")
    inner = F.coalesce(F.sum("n").over(Window.partitionBy("block").orderBy("round").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = rounds.join(ahead, "block").select("round", (F.col("ahead") + inner).alias("start"))
    within = F.row_number().over(Window.partitionBy("round").orderBy("source", "slot")) - 1
    return ranked.withColumn("within", within).join(starts, "round").select("source", "doc_id", (F.col("start") + F.col("within")).cast("bigint").alias("seq"))


def ingest_metadata(spark, d):
    """O-010: length, hash and source of every row."""
    return table(spark, d, "documents").select("doc_id", "source", F.length("text").alias("chars"), F.octet_length("text").alias("bytes"), F.sha2("text", 256).alias("sha256"), F.to_date("ingested_at").cast("string").alias("day"))


def multilingual_sources(spark, d):
    """O-009: sources whose name carries a language tag."""
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("documents")).select("source", "documents", F.col("source").rlike(r"-(?:ar|de|es|fr|hi|it|ja|nl|pt|ru|zh)(?:-|$)").alias("multilingual"))


def stratified_sample(spark, d):
    """O-018, O-209: bottom-k by hash within each source, a reservoir that any order of rows yields.

    Groups of a source keep their own bottom k before the final one: no group is gathered whole.
    """
    k = 25
    h = F.sha2(F.concat(F.lit("17|"), F.col("doc_id").cast("string")), 256)
    t = table(spark, d, "documents").select("source", "doc_id", h.alias("h"), F.pmod("doc_id", F.lit(64)).alias("grp"))
    first = t.withColumn("r", F.row_number().over(Window.partitionBy("source", "grp").orderBy("h", "doc_id"))).where(F.col("r") <= k)
    return first.withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy("h", "doc_id"))).where(F.col("r") <= k).select("source", "doc_id", F.col("r").cast("bigint").alias("place"))


def full_normalize_digest(spark, d):
    """O-032, O-033: full normalisation and repair; lengths and digest."""
    t = spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", T.repair_formatting(T.full_normalize(F.col("text"))).alias("t"))
    return t.select("doc_id", F.length("t").alias("chars"), F.sha2("t", 256).alias("digest"))


def paragraph_dedup(spark, d):
    """O-231: within a document the first of equal paragraphs of 24 and more characters stays; share of repeats.

    Arrays stay in their row: no shuffle. Positions come from array_position of the first equal key.
    """
    key = lambda x: F.trim(F.lower(F.regexp_replace(x, T.SPACE, " ")))
    t = table(spark, d, "documents").select("doc_id", T.paragraphs(F.col("text")).alias("p"))
    t = t.withColumn("k", F.transform("p", key))
    dup = F.size(F.filter(F.transform("k", lambda x, i: (F.length(x) >= 24) & (F.array_position("k", x) < i + 1)), lambda b: b))
    return t.where("p is not null").select("doc_id", F.size("p").alias("paragraphs"), dup.alias("duplicates"))


def collapsed_lines(spark, d):
    """O-041: consecutive equal lines collapsed, lines before and after."""
    t = table(spark, d, "redteam_adversarial").select("id", "text").dropDuplicates(["id"]).where("text is not null")
    c = T.collapse_repeated_lines(F.col("text"))
    return t.select("id", F.size(F.split("text", "\n")).alias("lines"), F.size(F.split(c, "\n")).alias("kept"))


def sampled_ends(spark, d):
    """O-043: head and tail sample of long texts."""
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.length(T.sample_ends(F.col("text"), 4000)).alias("chars"), F.sha2(T.sample_ends(F.col("text"), 4000), 256).alias("digest"))


def token_hashes(spark, d):
    """O-036, O-037, O-039: stable hashes of source names and a digest over parts."""
    t = table(spark, d, "documents").select("source").distinct().where("source is not null")
    return t.select("source", T.token_hash(F.col("source")).alias("h"), F.substring(F.sha2(F.concat_ws("\x1f", F.lit("v1"), "source"), 256), 1, 24).alias("fingerprint"))


QUERIES = {f.__name__: f for f in (normalize_minimal, content_hash_groups, exact_dedup_first_wins, hash_index_summary, new_against_index, size_alpha_gate, admission_tiers, byte_budget_per_source, weighted_interleave, ingest_metadata, multilingual_sources, stratified_sample, full_normalize_digest, paragraph_dedup, collapsed_lines, sampled_ends, token_hashes)}

_FULL = "regexp_replace(translate(nfc_normalize(text), '‘’‚‛“”„‟–—―' || chr(160) || chr(8201) || chr(8239), '\'\'\'\'\'\'\'\'\"\"\"\"---   '), '[\\x{200B}\\x{200C}\\x{200D}\\x{2060}\\x{FEFF}\\x{AD}]', '', 'g')"
for _p, _by in ((r"\r\n?", "\n"), (r"[ \t]+\n", "\n"), (r"[ \t]{2,}", " "), ("!{2,}", "!"), (r"\?{2,}", "?"), (",{2,}", ","), (";{2,}", ";"), (":{2,}", ":"), (r"\n{3,}", "\n\n")):
    _FULL = f"regexp_replace({_FULL}, '{_p}', '{_by}', 'g')"
_REPAIR = f"trim({_FULL})"
for _p, _by in ((r"\\([*_#\[\]()~`>+.!-])", r"\1"), (r"\[\s*\]\([^)]*\)", ""), (r"(?m)^[ \t]*[-*+][ \t]*$\n?", ""), (r"[ \t]+([,.;:!?])(\s|$)", r"\1\2")):
    _REPAIR = f"regexp_replace({_REPAIR}, '{_p}', '{_by}', 'g')"
_U64 = "CAST('0x' || substr(sha256(source), 1, 16) AS UBIGINT)"
ORACLE = {
    "full_normalize_digest": f"SELECT doc_id, length(t) AS chars, sha256(t) AS digest FROM (SELECT doc_id, {_REPAIR} AS t FROM documents)",
    "token_hashes": f"SELECT source, CAST(CASE WHEN {_U64} >= 9223372036854775808 THEN CAST({_U64} AS HUGEINT) - 18446744073709551616 ELSE CAST({_U64} AS HUGEINT) END AS BIGINT) AS h, substr(sha256('v1' || chr(31) || source), 1, 24) AS fingerprint FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)",
    "normalize_minimal": rf"SELECT doc_id, length(flat) AS chars, length(regexp_replace(flat,'[^\p{{L}}\p{{N}}]','','g')) AS meaningful, sha256(flat) AS digest FROM (SELECT doc_id, {FLAT} AS flat FROM documents)",
    "content_hash_groups": f"SELECT sha256({DEDUP}) AS hash, count(*) AS copies, min(doc_id) AS first_doc_id, max(doc_id) AS last_doc_id FROM documents GROUP BY 1",
    "exact_dedup_first_wins": f"SELECT hash, doc_id, lang FROM (SELECT doc_id, lang, sha256({DEDUP}) AS hash FROM documents) QUALIFY row_number() OVER (PARTITION BY hash ORDER BY doc_id) = 1",
    "hash_index_summary": "SELECT source, CAST(CAST('0x' || substr(hash,1,2) AS INTEGER) % 4 AS INTEGER) AS shard, count(*) AS entries, count(DISTINCT hash) AS hashes FROM content_hashes WHERE hash IS NOT NULL GROUP BY 1, 2",
    "new_against_index": f"SELECT doc_id, source, hash FROM (SELECT doc_id, source, sha256({DEDUP}) AS hash FROM documents) WHERE hash NOT IN (SELECT hash FROM content_hashes WHERE hash IS NOT NULL)",
    "size_alpha_gate": rf"""SELECT doc_id, m AS meaningful, n AS chars, CASE WHEN n = 0 THEN 'empty_text' WHEN m < 100 AND coalesce(domain <> 'code', true) THEN 'too_short' WHEN n > 100000 AND coalesce(domain <> 'code', true) THEN 'document_too_large' WHEN l / n < 0.5 THEN 'low_alpha' ELSE 'ok' END AS reason
FROM (SELECT doc_id, domain, length(flat) AS n, length(regexp_replace(flat,'[^\p{{L}}\p{{N}}]','','g')) AS m, CAST(length(regexp_replace(flat,'[^\p{{L}}]','','g')) AS DOUBLE) AS l FROM (SELECT doc_id, domain, {FLAT} AS flat FROM documents))""",
    "admission_tiers": "SELECT tier, CASE WHEN tier IN ('huge','large') THEN tier ELSE 'normal' END AS lane, count(*) AS documents, sum(base * (1 + least(n, 200000) / 120000.0)) AS cost FROM (SELECT length(text) AS n, CASE WHEN length(text) < 8000 THEN 'small' WHEN length(text) < 30000 THEN 'medium' WHEN length(text) < 80000 THEN 'large' ELSE 'huge' END AS tier, CAST(CASE WHEN length(text) < 8000 THEN 1 WHEN length(text) < 30000 THEN 2 WHEN length(text) < 80000 THEN 4 ELSE 8 END AS DOUBLE) AS base FROM documents WHERE text IS NOT NULL) GROUP BY 1, 2",
    "byte_budget_per_source": "SELECT source, count(*) AS documents, CAST(sum(bytes) AS BIGINT) AS bytes FROM (SELECT source, bytes, sum(bytes) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS running FROM (SELECT source, doc_id, strlen(text) AS bytes FROM documents)) WHERE running <= 60000 GROUP BY source",
    "weighted_interleave": "WITH r AS (SELECT source, doc_id, CASE WHEN starts_with(source,'open-web') THEN 2 ELSE 1 END AS w, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS k FROM documents WHERE source IS NOT NULL) SELECT source, doc_id, row_number() OVER (ORDER BY k // w, source, k % w) - 1 AS seq FROM r",
    "ingest_metadata": "SELECT doc_id, source, length(text) AS chars, strlen(text) AS bytes, sha256(text) AS sha256, CAST(CAST(ingested_at AS DATE) AS VARCHAR) AS day FROM documents",
    "multilingual_sources": "SELECT source, count(*) AS documents, regexp_matches(source, '-(?:ar|de|es|fr|hi|it|ja|nl|pt|ru|zh)(?:-|$)') AS multilingual FROM documents GROUP BY source",
    "stratified_sample": "SELECT source, doc_id, place FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY sha256('17|' || doc_id), doc_id) AS place FROM documents) WHERE place <= 25",
    "paragraph_dedup": r"""WITH p AS (SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '\r\n?', chr(10), 'g'), '\n[ \t]*\n+'), lambda x: trim(x)), lambda x: x <> '') AS ps FROM documents WHERE text IS NOT NULL)),
k AS (SELECT doc_id, i, trim(lower(regexp_replace(p, '[\s\x0b\p{Z}\x{85}]+', ' ', 'g'))) AS k FROM p), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, k ORDER BY i) AS n FROM k)
SELECT d.doc_id, CAST(count(r.k) AS INTEGER) AS paragraphs, CAST(coalesce(sum(CASE WHEN length(r.k) >= 24 AND n > 1 THEN 1 ELSE 0 END), 0) AS INTEGER) AS duplicates FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id WHERE d.text IS NOT NULL GROUP BY d.doc_id""",
    "collapsed_lines": "WITH t AS (SELECT DISTINCT id, text FROM redteam_adversarial WHERE text IS NOT NULL), l AS (SELECT id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM t), p AS (SELECT *, lag(x) OVER (PARTITION BY id ORDER BY i) AS y FROM l) SELECT id, CAST(count(*) AS INTEGER) AS lines, CAST(sum(CASE WHEN i = 1 OR x <> y OR trim(x) = '' THEN 1 ELSE 0 END) AS INTEGER) AS kept FROM p GROUP BY id",
    "sampled_ends": "SELECT doc_id, length(s) AS chars, sha256(s) AS digest FROM (SELECT doc_id, CASE WHEN length(text) <= 4000 THEN text ELSE substr(text, 1, 3000) || right(text, 1000) END AS s FROM documents WHERE text IS NOT NULL)",
}
