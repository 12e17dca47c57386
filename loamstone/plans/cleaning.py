"""Queries over row formats, line cleaning, sections and fragments of the earlier pass."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamstone.functions import text as T
from loamstone.operators import formatters as R
from loamstone.functions.sheet import Sheet
from loamstone.operators.chunks import chunked
from loamstone.sources.tables import spread, table

#: Lines that clean-up drops, as Java and RE2 read alike.
UI_LINE = r"(?i)^(?:[-*] )?(?:home|search|log in|register|my account|share|print this page|back to top.*|skip to main content|load more.*|advertisement)$"
COPY_LINE = r"(?i)(?:all rights reserved|terms \| privacy|registered name of)"
PROMO = r"(?i)^(?:subscribe|download our app|sponsored:|follow .* on:|enter your e-mail)"
#: Characters that the index keeps of a fragment.
SAMPLE = 200


def formatted_items(spark, d):
    """O-019, O-026, O-027, O-028, O-029: evaluation items as question and answer text."""
    t = table(spark, d, "eval_items")
    return t.select("item_id", R.instruction_answer(F.col("instruction"), F.col("passage"), F.col("question")).alias("text"))


def formatted_rows(spark, d):
    """O-020 to O-025: digests of the conversation, turn, message, code and tagged formats of the same rows."""
    t = table(spark, d, "eval_items")
    msgs = F.array(F.struct(F.lit("system").alias("role"), F.col("instruction").alias("content")), F.struct(F.lit("user").alias("role"), F.col("passage").alias("content")))
    tc = F.array("passage", "question")
    f = lambda c: F.substring(F.sha2(c, 256), 1, 16)
    return t.select("item_id", f(R.conversation(msgs)).alias("conversation"), f(R.turns(tc)).alias("turns"), f(R.single_message(F.col("task"), F.col("passage"))).alias("message"), f(R.code(F.col("task"), F.col("passage"))).alias("code"), f(R.tagged_chat(tc, F.col("instruction"))).alias("tagged"))


def qa_pairs(spark, d):
    """O-232, O-233, O-234: labelled question and answer of a record."""
    t = table(spark, d, "redteam_qa").select("id", "text").dropDuplicates(["id", "text"]).where("text is not null")
    q, a = F.regexp_extract("text", r"(?:^|\n)(?:Question|Q): ([^\n]*)", 1), F.regexp_extract("text", r"(?:^|\n)(?:Answer|A): ([^\n]*)", 1)
    return t.where((q != "") & (a != "")).select("id", q.alias("question"), F.length(a).alias("answer_chars"))


def cleaned_lines(spark, d):
    """O-225 to O-228, O-241, O-251: menu, rights and promotion lines dropped; lines and characters left."""
    t = table(spark, d, "cleaning_golden").select("id", "text").dropDuplicates(["id", "text"]).where("text is not null")
    ls = F.split("text", "\n")
    keep = F.filter(ls, lambda x: ~F.trim(x).rlike(UI_LINE) & ~x.rlike(COPY_LINE) & ~F.trim(x).rlike(PROMO))
    return t.select("id", F.size(ls).alias("lines"), F.size(keep).alias("kept"), F.sha2(F.array_join(keep, "\n"), 256).alias("digest"))


def segments(spark, d):
    """O-259, O-260: blocks of documents with place, size and kind."""
    t = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(T.paragraphs(F.col("text"))).alias("k", "p"))
    kind = F.when(F.col("p").startswith("```"), "code").when(F.col("p").rlike(r"^#{1,6} |^== "), "header").when(F.col("p").rlike(r"^\|"), "table").when(F.col("p").rlike(r"^(?:[-*+]|\d+[.)]) "), "list").otherwise("paragraph")
    return t.groupBy(kind.alias("kind")).agg(F.count("*").alias("blocks"), F.sum(F.length("p")).alias("chars"), F.countDistinct("doc_id").alias("documents"))


def chunk_plan(spark, d):
    """O-088: number of chunks of 3000 estimated tokens of four characters per document; no text is cut."""
    n = F.length("text")
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.ceil(n / 4.0 / 3000).cast("bigint").alias("chunks"), F.ceil(n / 4.0).cast("bigint").alias("tokens")).where("chunks > 1")


def text_chunks(spark, d):
    """O-237: chunks of at most 600 estimated tokens of every document, cut at blocks and sentences with an overlap of sentences."""
    c = chunked(spread(table(spark, d, "documents").select("doc_id", "text")), 600)
    return c.select("doc_id", "chunk", "chunks", F.length("text").alias("chars"), F.sha2("text", 256).alias("digest"))


def fragment_statistics(spark, d):
    """O-038, O-359, O-360: document and line frequency of every fuzzy line, its mean place, those in two documents and more."""
    t = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line"))
    f = t.select("doc_id", "k", T.fragment_normalize(F.col("line")).alias("f")).where("length(f) >= 8")
    per = f.groupBy("f", "doc_id").agg(F.count("*").alias("n"), F.min("k").alias("k"))
    x = per.groupBy("f").agg(F.count("*").alias("doc_frequency"), F.sum("n").alias("line_frequency"), F.round(F.avg("k"), 4).alias("mean_first_line")).where("doc_frequency >= 2")
    return x.select(F.substring(F.sha2("f", 256), 1, 24).alias("key"), "doc_frequency", "line_frequency", "mean_first_line")


_Z = 1.96
#: Frequency by its Wilson bound, place by the entropy of the histogram, shape by the layouts that share it, novelty by information.
PROMOTED = Sheet([
    {"p": "doc_frequency / n", "parts": lambda d: d.map(d.all("coalesce(position_histogram, '')", "[0-9]+(?:[.][0-9]+)?"), "CAST(x AS DOUBLE)"), "bits": lambda d: d.entropy("coalesce(text_sample, '')"), "per_doc": "greatest(CAST(coalesce(line_frequency, doc_frequency) AS DOUBLE) / greatest(doc_frequency, 1), 1.0)"},
    {"mass": lambda d: d.sum("parts", "x"), "low": f"(p + {_Z * _Z} / (2 * n) - {_Z} * sqrt(greatest(p * (1 - p) / n + {_Z * _Z} / (4.0 * n * n), 0.0))) / (1 + {_Z * _Z} / n)", "structure": "bucket_n / (bucket_n + bucket_mean)"},
    {"h": lambda d: f"CASE WHEN mass > 0 THEN {d.sum('parts', 'CASE WHEN x > 0 THEN -(x / mass) * log2(x / mass) ELSE 0.0 END')} / log2(5.0) ELSE 1.0 END", "novelty": "least(1.0, least(1.0, bits / greatest(doc_frequency, 1) / 8.0) * 0.6 + 0.4 / per_doc)"},
    {"place": "least(1.0, (1.0 - least(1.0, h)) * 0.65 + low * 0.35)"},
    {"confidence0": "(0.30 * low + 0.25 * place + 0.25 * structure + 0.20 * (1.0 - novelty)) * coalesce(weight, 1.0)"},
    {"confidence": "CASE WHEN doc_frequency < 2 THEN confidence0 * 0.15 ELSE confidence0 END"},
])
_PROMOTED = ["key", "doc_frequency", *[f"round({c} + 1e-9, 6) AS {c}" for c in ("low", "place", "structure", "novelty", "confidence")], "doc_frequency >= 3 AND confidence >= 0.3 AS promoted"]


def fragment_promotion(spark, d):
    """O-361 to O-365: fragments of the index with their bound, place, shape and novelty, and those that these promote."""
    t = table(spark, d, "fragments").where("key is not null and doc_frequency is not null")
    total = t.agg(F.greatest(F.max("doc_frequency"), F.lit(1)).cast("double").alias("n"))  # one row
    buckets = t.groupBy(F.coalesce("layout_bucket", F.lit("")).alias("bucket")).agg(F.count("*").cast("double").alias("bucket_n"))
    mean = buckets.agg(F.avg("bucket_n").alias("bucket_mean"))  # one row
    x = t.withColumn("bucket", F.coalesce("layout_bucket", F.lit(""))).join(buckets, "bucket").crossJoin(F.broadcast(total)).crossJoin(F.broadcast(mean))
    return PROMOTED.spark(x).selectExpr(*_PROMOTED)


def _trimmed(t, hit):
    """Documents that lose lines, with what they lose, and whether it is at most 40 percent of the text."""
    x = t.groupBy("doc_id").agg(F.sum(F.length("line")).alias("chars"), F.sum(F.when(hit, F.length("line")).otherwise(0)).alias("cut"), F.sum(F.when(hit, 1).otherwise(0)).alias("cut_lines"))
    return x.where("cut > 0").select("doc_id", "cut_lines", "cut", "chars", (F.col("cut") <= 0.4 * F.col("chars")).alias("trimmed"))


def safe_trim(spark, d):
    """O-366 to O-368 for fragments that the index holds whole: lines it promotes taken from documents, unless over 40 percent of a text would go.

    Samples cut at 200 characters are left to `safe_trim_all`. The index side is
    what has been promoted, a small part of the fragments; AQE broadcasts it only under the session's threshold.
    """
    bad = table(spark, d, "fragments").where("doc_frequency >= 3 and text_sample is not null and length(text_sample) < 200").select(T.fragment_normalize(F.col("text_sample")).alias("f")).where("length(f) >= 8").distinct()
    t = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line")).withColumn("f", T.fragment_normalize(F.col("line")))
    return _trimmed(t.join(bad.withColumn("hit", F.lit(True)), "f", "left"), F.col("hit"))


def safe_trim_all(spark, d):
    """O-366 to O-368: as `safe_trim` over all promoted fragments; one whose sample is cut takes the lines that begin with it.

    A line of 200 characters and more is matched by its first 200 beside the whole line, both by equi-joins.
    """
    bad = table(spark, d, "fragments").where("doc_frequency >= 3 and text_sample is not null").select(T.fragment_normalize(F.col("text_sample")).alias("f"), (F.length("text_sample") >= SAMPLE).alias("cut")).where("length(f) >= 8")
    whole, begin = (bad.where(c).select("f").distinct() for c in (~F.col("cut"), F.col("cut")))
    t = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line"))
    t = t.withColumn("f", T.fragment_normalize(F.col("line"))).withColumn("p", F.when(F.length("line") >= SAMPLE, T.fragment_normalize(F.substring("line", 1, SAMPLE))))
    # most lines are short: those without a prefix never meet the second join as one null key
    short = t.where("p is null").withColumn("long_hit", F.lit(False))
    long = t.where("p is not null").join(begin.withColumnRenamed("f", "p").withColumn("long_hit", F.lit(True)), "p", "left").select(*short.columns)
    x = short.unionByName(long).join(whole.withColumn("hit", F.lit(True)), "f", "left")
    return _trimmed(x, F.coalesce("hit", "long_hit", F.lit(False)))


def family_overview(spark, d):
    """O-369, O-370, O-373, O-377: families of the registry: members, observations, last sight."""
    t = table(spark, d, "corpus_doc_registry").where("coalesce(family_key, '') <> ''")
    return t.groupBy("family_key").agg(F.count("*").alias("members"), F.sum("observation_count").alias("observations"), F.max("last_seen").alias("last_seen")).where("members >= 2")


def gene_aging(spark, d):
    """O-372, O-374, O-375: confidence of genome keys by verification count and age."""
    t = table(spark, d, "corpus_doc_registry").where("genome_key is not null").groupBy("genome_key").agg(F.sum("observation_count").alias("v"), F.max("last_seen").alias("seen"))
    now = t.agg(F.max("seen").alias("now"))
    age = (F.col("now") - F.col("seen")) / 86400.0
    c = F.when(F.col("v") <= 1, 0.45).otherwise((0.35 + 0.65 * F.least(F.lit(1.0), F.log(1 + F.col("v")) / F.log(F.lit(25.0)))) * (0.4 + 0.6 * F.pow(F.lit(0.5), age / 90)))
    return t.where("seen > 0").crossJoin(F.broadcast(now)).select("genome_key", "v", F.round(c, 6).alias("confidence"))


def overlap_router(spark, d):
    """O-299, O-376, O-378: each batch row routed by whether its source and hash are known: FAST, VERIFY or FULL."""
    b = table(spark, d, "batch_docs").select("doc_id", "source", T.content_hash(F.col("text")).alias("hash"))
    seen = table(spark, d, "content_hashes").where("hash is not null").select("hash").distinct().withColumn("known_hash", F.lit(True))
    src = table(spark, d, "content_hashes").where("source is not null").select("source").distinct().withColumn("known_source", F.lit(True))
    x = b.join(seen, "hash", "left").join(src, "source", "left")
    return x.groupBy(F.when(F.col("known_hash"), "FAST").when(F.col("known_source"), "VERIFY").otherwise("FULL").alias("route")).agg(F.count("*").alias("rows"))


def role_sections(spark, d):
    """O-246, O-263, O-272, O-275: lines of pages by role and place, with their share of the characters."""
    t = table(spark, d, "cleaning_golden").select("id", "text").dropDuplicates(["id", "text"]).where("text is not null").select("id", F.posexplode(F.split("text", "\n")).alias("k", "line"), F.size(F.split("text", "\n")).alias("n")).where("trim(line) <> ''")
    x = F.trim("line")
    role = F.when(x.rlike(UI_LINE), "navigation").when(x.rlike(COPY_LINE), "rights").when(x.rlike(PROMO), "promotion").when(x.rlike(r"^#{1,6} "), "heading").when(x.rlike(r"^(?:[-*+]|\d+[.)]) "), "list").when(x.rlike(r"[.!?]$"), "body").otherwise("other")
    place = F.when(F.col("k") * 10 < F.col("n"), "head").when(F.col("k") * 10 >= F.col("n") * 9, "tail").otherwise("middle")
    return t.groupBy(role.alias("role"), place.alias("place")).agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


def best_outputs(spark, d):
    """O-270, O-320: of each category the five records of the best recall (a top-k report)."""
    t = table(spark, d, "redteam_qa").where("recall is not null").select(F.coalesce("category", F.lit("none")).alias("category"), "id", "recall").distinct()
    # groups of ids keep their own five first
    part = t.withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(32))).withColumn("r", F.row_number().over(Window.partitionBy("category", "grp").orderBy(F.desc("recall"), "id"))).where("r <= 5")
    return part.withColumn("r", F.row_number().over(Window.partitionBy("category").orderBy(F.desc("recall"), "id"))).where("r <= 5").select("category", "id", "recall", "r")


QUERIES = {f.__name__: f for f in (formatted_items, formatted_rows, qa_pairs, cleaned_lines, segments, chunk_plan, text_chunks, fragment_statistics, fragment_promotion, safe_trim, safe_trim_all, family_overview, gene_aging, overlap_router, role_sections, best_outputs)}

from loamstone.plans.texts import DEDUP as _D  # noqa: E402

_Q = "trim(coalesce(instruction,'')) || CASE WHEN trim(coalesce(instruction,'')) <> '' AND trim(coalesce(passage,'')) <> '' THEN chr(10) ELSE '' END || trim(coalesce(passage,''))"
_F = r"trim(regexp_replace(regexp_replace(regexp_replace(lower({c}), '[\s\x0b\p{{Z}}\x{{85}}]+', ' ', 'g'), '[0-9]', '#', 'g'), '[^\p{{L}}\p{{N}}# ]', '', 'g'))"
_PAR = r"list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '\r\n?', chr(10), 'g'), '\n[ \t]*\n+'), lambda x: trim(x)), lambda x: x <> '')"
_H = lambda e: f"substr(sha256({e}), 1, 16)"
_FT = "(SELECT *, coalesce(layout_bucket, '') AS bucket FROM fragments WHERE key IS NOT NULL AND doc_frequency IS NOT NULL)"
_FX = f"(SELECT f.*, b.bucket_n, m.bucket_mean, t.n FROM {_FT} f JOIN (SELECT bucket, CAST(count(*) AS DOUBLE) AS bucket_n FROM {_FT} GROUP BY 1) b ON b.bucket = f.bucket CROSS JOIN (SELECT avg(k) AS bucket_mean FROM (SELECT count(*) AS k FROM {_FT} GROUP BY bucket)) m CROSS JOIN (SELECT CAST(greatest(max(doc_frequency), 1) AS DOUBLE) AS n FROM {_FT}) t)"
_TURN = "list_filter([trim(passage), trim(question)], lambda x: x <> '')"
_CHAT = "CASE WHEN passage IS NOT NULL THEN '<|user|>' || trim(passage) || '<|/user|>' END, CASE WHEN question IS NOT NULL THEN '<|assistant|>' || trim(question) || '<|/assistant|>' END"
ORACLE = {
    "fragment_promotion": f"SELECT {', '.join(_PROMOTED)} FROM {PROMOTED.duck(_FX)}",
    "formatted_rows": f"""SELECT item_id, {_H("array_to_string(list_filter([CASE WHEN trim(coalesce(instruction, '')) <> '' THEN 'system: ' || trim(instruction) END, CASE WHEN trim(coalesce(passage, '')) <> '' THEN 'user: ' || trim(passage) END], lambda x: x IS NOT NULL), chr(10))")} AS conversation,
{_H(f"array_to_string({_TURN}, chr(10))")} AS turns, {_H("coalesce(task, 'user') || ': ' || trim(coalesce(passage, ''))")} AS message, {_H("CASE WHEN coalesce(task, '') <> '' THEN '# language: ' || task || chr(10) || trim(coalesce(passage, '')) ELSE trim(coalesce(passage, '')) END")} AS code,
{_H(f"CASE WHEN coalesce(instruction, '') <> '' THEN '<|system|>' || trim(instruction) || '<|/system|>' || chr(10) ELSE '' END || array_to_string([{_CHAT}], chr(10)) || chr(10) || '<|end|>'")} AS tagged FROM eval_items""",
    "formatted_items": f"SELECT item_id, CASE WHEN q <> '' AND trim(question) <> '' THEN 'Question: ' || q || chr(10) || chr(10) || 'Answer: ' || trim(question) WHEN q <> '' THEN q ELSE trim(coalesce(question,'')) END AS text FROM (SELECT *, {_Q} AS q FROM eval_items)",
    "qa_pairs": r"SELECT id, question, length(a) AS answer_chars FROM (SELECT id, regexp_extract(text, '(?:^|\n)(?:Question|Q): ([^\n]*)', 1) AS question, regexp_extract(text, '(?:^|\n)(?:Answer|A): ([^\n]*)', 1) AS a FROM (SELECT DISTINCT id, text FROM redteam_qa WHERE text IS NOT NULL)) WHERE question <> '' AND a <> ''",
    "cleaned_lines": f"SELECT id, len(ls) AS lines, len(k) AS kept, sha256(array_to_string(k, chr(10))) AS digest FROM (SELECT id, ls, list_filter(ls, lambda x: NOT regexp_matches(trim(x), '{UI_LINE}') AND NOT regexp_matches(x, '{COPY_LINE}') AND NOT regexp_matches(trim(x), '{PROMO}')) AS k FROM (SELECT id, string_split(text, chr(10)) AS ls FROM (SELECT DISTINCT id, text FROM cleaning_golden WHERE text IS NOT NULL)))",
    "segments": rf"SELECT CASE WHEN starts_with(p, '```') THEN 'code' WHEN regexp_matches(p, '^#{{1,6}} |^== ') THEN 'header' WHEN regexp_matches(p, '^\|') THEN 'table' WHEN regexp_matches(p, '^(?:[-*+]|\d+[.)]) ') THEN 'list' ELSE 'paragraph' END AS kind, count(*) AS blocks, CAST(sum(length(p)) AS BIGINT) AS chars, count(DISTINCT doc_id) AS documents FROM (SELECT doc_id, unnest({_PAR}) AS p FROM documents WHERE text IS NOT NULL) GROUP BY 1",
    "chunk_plan": "SELECT doc_id, CAST(ceil(length(text) / 4.0 / 3000) AS BIGINT) AS chunks, CAST(ceil(length(text) / 4.0) AS BIGINT) AS tokens FROM documents WHERE text IS NOT NULL AND ceil(length(text) / 4.0 / 3000) > 1",
    "fragment_statistics": f"WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k FROM documents WHERE text IS NOT NULL), f AS (SELECT doc_id, k, {_F.format(c='line')} AS f FROM l), p AS (SELECT f, doc_id, count(*) AS n, min(k) AS k FROM f WHERE length(f) >= 8 GROUP BY 1, 2) SELECT substr(sha256(f), 1, 24) AS key, count(*) AS doc_frequency, CAST(sum(n) AS BIGINT) AS line_frequency, round(avg(k), 4) AS mean_first_line FROM p GROUP BY f HAVING count(*) >= 2",
    "family_overview": "SELECT family_key, count(*) AS members, CAST(sum(observation_count) AS BIGINT) AS observations, max(last_seen) AS last_seen FROM corpus_doc_registry WHERE coalesce(family_key, '') <> '' GROUP BY 1 HAVING count(*) >= 2",
    "gene_aging": "WITH t AS (SELECT genome_key, CAST(sum(observation_count) AS BIGINT) AS v, max(last_seen) AS seen FROM corpus_doc_registry WHERE genome_key IS NOT NULL GROUP BY 1) SELECT genome_key, v, round(CASE WHEN v <= 1 THEN 0.45 ELSE (0.35 + 0.65 * least(1, ln(1 + v) / ln(25))) * (0.4 + 0.6 * pow(0.5, ((SELECT max(seen) FROM t) - seen) / 86400.0 / 90)) END, 6) AS confidence FROM t WHERE seen > 0",
    "overlap_router": f"SELECT CASE WHEN h IS NOT NULL THEN 'FAST' WHEN s IS NOT NULL THEN 'VERIFY' ELSE 'FULL' END AS route, count(*) AS rows FROM (SELECT b.doc_id, x.hash AS h, y.source AS s FROM (SELECT doc_id, source, sha256({_D}) AS hash FROM batch_docs) b LEFT JOIN (SELECT DISTINCT hash FROM content_hashes) x ON b.hash = x.hash LEFT JOIN (SELECT DISTINCT source FROM content_hashes WHERE source IS NOT NULL) y ON b.source = y.source) GROUP BY 1",
    "role_sections": rf"WITH t AS (SELECT id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k, len(string_split(text, chr(10))) AS n FROM (SELECT DISTINCT id, text FROM cleaning_golden WHERE text IS NOT NULL)) SELECT CASE WHEN regexp_matches(trim(line), '{UI_LINE}') THEN 'navigation' WHEN regexp_matches(trim(line), '{COPY_LINE}') THEN 'rights' WHEN regexp_matches(trim(line), '{PROMO}') THEN 'promotion' WHEN regexp_matches(trim(line), '^#{{1,6}} ') THEN 'heading' WHEN regexp_matches(trim(line), '^(?:[-*+]|\d+[.)]) ') THEN 'list' WHEN regexp_matches(trim(line), '[.!?]$') THEN 'body' ELSE 'other' END AS role, CASE WHEN k * 10 < n THEN 'head' WHEN k * 10 >= n * 9 THEN 'tail' ELSE 'middle' END AS place, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM t WHERE trim(line) <> '' GROUP BY 1, 2",
    "best_outputs": "SELECT category, id, recall, CAST(r AS INTEGER) AS r FROM (SELECT category, id, recall, row_number() OVER (PARTITION BY category ORDER BY recall DESC, id) AS r FROM (SELECT DISTINCT coalesce(category, 'none') AS category, id, recall FROM redteam_qa WHERE recall IS NOT NULL)) WHERE r <= 5",
    "safe_trim": f"WITH b AS (SELECT DISTINCT {_F.format(c='text_sample')} AS f FROM fragments WHERE doc_frequency >= 3 AND text_sample IS NOT NULL AND length(text_sample) < 200), l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL), x AS (SELECT doc_id, line, (SELECT count(*) FROM b WHERE b.f = {_F.format(c='line')} AND length(b.f) >= 8) > 0 AS hit FROM l) SELECT doc_id, CAST(sum(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT) AS cut_lines, CAST(sum(CASE WHEN hit THEN length(line) ELSE 0 END) AS BIGINT) AS cut, CAST(sum(length(line)) AS BIGINT) AS chars, sum(CASE WHEN hit THEN length(line) ELSE 0 END) <= 0.4 * sum(length(line)) AS trimmed FROM x GROUP BY 1 HAVING sum(CASE WHEN hit THEN length(line) ELSE 0 END) > 0",
    "safe_trim_all": f"WITH b AS (SELECT DISTINCT {_F.format(c='text_sample')} AS f, length(text_sample) >= 200 AS cut FROM fragments WHERE doc_frequency >= 3 AND text_sample IS NOT NULL), l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL), x AS (SELECT doc_id, line, {_F.format(c='line')} IN (SELECT f FROM b WHERE NOT cut AND length(f) >= 8) OR (length(line) >= 200 AND {_F.format(c='substr(line, 1, 200)')} IN (SELECT f FROM b WHERE cut AND length(f) >= 8)) AS hit FROM l) SELECT doc_id, CAST(sum(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT) AS cut_lines, CAST(sum(CASE WHEN hit THEN length(line) ELSE 0 END) AS BIGINT) AS cut, CAST(sum(length(line)) AS BIGINT) AS chars, sum(CASE WHEN hit THEN length(line) ELSE 0 END) <= 0.4 * sum(length(line)) AS trimmed FROM x GROUP BY 1 HAVING sum(CASE WHEN hit THEN length(line) ELSE 0 END) > 0",
}
