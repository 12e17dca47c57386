"""Queries over repair, stripping, statistical boilerplate, thresholds, boundaries and secrets."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamstone.functions import features as X
from loamstone.functions import peers as P
from loamstone.functions import text as T
from loamstone.sources.tables import spread, table

#: Patterns that Java and RE2 read alike.
REFERENCES = r"(?is)\n(?:#+ )?(?:references|external links|see also|bibliography)\n.*$"
WRAPPER = r"(?i)^(?:instruction|response|question|answer|step \d+|thought|q|a) ?:"
ABBREVIATION = r"(?:Dr|Prof|Mr|Mrs|Ms|St|No|vs|etc)\.$"
SECRET_TOKEN = r"\b[A-Za-z0-9+/_-]{24,}\b"


def _docs(spark, d):
    return spread(table(spark, d, "documents").where("text is not null and length(text) > 0").select("doc_id", "source", "text"))


def truncation_repair(spark, d):
    """O-217, O-230, O-262, O-265: texts that end within a sentence, trimmed to the last sentence end if 45 percent remain."""
    t = _docs(spark, d).select("doc_id", T.collapse_space(F.col("text")).alias("t")).where("t <> ''")
    cut = F.regexp_extract("t", r"(?s)^(.*[.!?])[^.!?]*$", 1)
    open_end = ~F.col("t").rlike(r"[.!?\"')\]]$")
    fit = open_end & (F.length(cut) >= 0.45 * F.length("t")) & ~cut.rlike(ABBREVIATION)
    return t.where(open_end).select("doc_id", F.length("t").alias("chars"), F.when(fit, F.length(cut)).otherwise(F.length("t")).alias("kept"), fit.alias("repaired"))


def code_stripped(spark, d):
    """O-229, O-235, O-257: fenced code and reference tails taken out; what is left of each document that had any."""
    c = F.regexp_replace(F.regexp_replace("text", r"(?s)```.*?```", " "), REFERENCES, "")
    t = _docs(spark, d)
    return t.where(F.length(c) < F.length("text")).select("doc_id", F.length("text").alias("chars"), F.length(c).alias("kept"), (F.length(c) < 0.5 * F.length("text")).alias("mostly_code"))


def instruction_density(spark, d):
    """O-242, O-243: share of lines that wrap instructions, by category of the records."""
    t = table(spark, d, "redteam_qa").select("id", "category", "text").dropDuplicates(["id", "text"]).where("text is not null").select("category", T.lines(F.col("text")).alias("ls")).where(F.size("ls") > 0)
    share = F.size(F.filter("ls", lambda x: x.rlike(WRAPPER))) / F.size("ls")
    return t.groupBy("category").agg(F.count("*").alias("records"), F.round(F.avg(0.65 * share), 6).alias("density"))


def statistical_boilerplate(spark, d):
    """O-239, O-252: weighted boilerplate score of pages from repeats, links, separators and line lengths."""
    t = table(spark, d, "cleaning_golden").select("id", "text").dropDuplicates(["id", "text"]).where("text is not null").select("id", "text", T.lines(F.col("text")).alias("ls")).where(F.size("ls") > 0)
    n = F.size("ls").cast("double")
    dup = (n - F.size(F.array_distinct("ls"))) / n
    of = lambda p: F.size(F.filter("ls", lambda x: x.rlike(p))) / n
    s = 0.3 * dup + 0.25 * of(r"[|»›>/·•]") + 0.25 * of(r"^[^.!?]{1,40}$") + 0.1 * of(X.URL) + 0.1 * of(r"(?i)cookie|rights reserved|subscribe")
    return t.select("id", F.round(s, 6).alias("score"))


def section_thresholds(spark, d):
    """O-247, O-249: the 22nd and 38th percentile of utility and the 72nd of noise over all blocks, and the blocks beyond them."""
    b = _docs(spark, d).select("doc_id", F.explode(T.paragraphs(F.col("text"))).alias("p")).where("length(p) > 0")
    u = F.round(0.5 * X.word_diversity(F.col("p")) + 0.5 * P.clip(F.length("p") / 800.0), 6)
    z = F.round(X.count(F.col("p"), r"[^\p{L}\p{N}\s]") / F.length("p"), 6)
    x = b.select(u.alias("u"), z.alias("z"))
    q = x.agg(F.percentile("u", F.lit(0.22)).alias("low"), F.percentile("u", F.lit(0.38)).alias("mid"), F.percentile("z", F.lit(0.72)).alias("noise"))
    c = x.crossJoin(F.broadcast(q))  # one row
    route = F.when((F.col("u") < F.col("low")) & (F.col("z") > F.col("noise")), "REMOVE").when(F.col("u") < F.col("low"), "DOWNWEIGHT").when(F.col("u") < F.col("mid"), "KEEP_AFTER_CLEANING").otherwise("KEEP")
    return c.groupBy(route.alias("route")).agg(F.count("*").alias("blocks"), F.round(F.avg("u"), 5).alias("utility"))


def topic_boundaries(spark, d):
    """O-261, O-267: neighbouring blocks of a document that share few words: possible changes of topic."""
    b = _docs(spark, d).select("doc_id", F.posexplode(T.paragraphs(F.col("text"))).alias("k", "p")).select("doc_id", "k", F.array_distinct(F.regexp_extract_all(F.lower("p"), F.lit(r"\p{L}{4,}"), F.lit(0))).alias("w")).where(F.size("w") >= 8)
    x = b.withColumn("prev", F.lag("w").over(Window.partitionBy("doc_id").orderBy("k"))).where("prev is not null")
    both = F.size(F.array_intersect("w", "prev"))
    j = both / (F.size("w") + F.size("prev") - both)
    return x.groupBy("doc_id").agg(F.count("*").alias("joints"), F.sum(F.when(j < 0.1, 1).otherwise(0)).alias("boundaries"), F.round(F.min(j), 6).alias("least"))


def secret_tokens(spark, d):
    """O-158: long tokens of high entropy that may be secrets, by source; placeholders of one sign left out."""
    w = _docs(spark, d).select("source", "doc_id", F.explode(F.regexp_extract_all("text", F.lit(SECRET_TOKEN), F.lit(0))).alias("tok"))
    x = w.select("source", "doc_id", "tok", X.entropy(F.col("tok")).alias("h")).where("h >= 3.2").where(F.col("tok").rlike("[0-9]") & F.col("tok").rlike("[A-Za-z]"))
    return x.groupBy("source").agg(F.count("*").alias("tokens"), F.countDistinct("doc_id").alias("documents"), F.round(F.avg("h"), 5).alias("entropy"))


def licence_candidates(spark, d):
    """O-181, O-186: for each source the licence named in most documents, an explicit one before rights reserved."""
    from loamstone.functions.safety import licence

    t = _docs(spark, d).select("source", licence(F.col("text")).alias("licence")).where("licence <> 'unknown'").groupBy("source", "licence").agg(F.count("*").alias("n"))
    pick = F.max(F.struct((F.col("licence") != "proprietary").alias("explicit"), "n", "licence"))
    return t.groupBy("source").agg(pick.alias("p")).select("source", "p.licence", F.col("p.n").alias("documents"))


QUERIES = {f.__name__: f for f in (truncation_repair, code_stripped, instruction_density, statistical_boilerplate, section_thresholds, topic_boundaries, secret_tokens, licence_candidates)}

from loamstone.plans.features import LINES, WORDS, _n  # noqa: E402
from loamstone.plans.safety import _LIC  # noqa: E402

_B = "documents WHERE text IS NOT NULL AND length(text) > 0"
_T = r"trim(regexp_replace(text, '[\s\x0b\p{Z}\x{85}]+', ' ', 'g'))"
_PAR = r"list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '\r\n?', chr(10), 'g'), '\n[ \t]*\n+'), lambda x: trim(x)), lambda x: x <> '')"
_CUT = r"regexp_extract(t, '(?s)^(.*[.!?])[^.!?]*$', 1)"
_CODE = f"regexp_replace(regexp_replace(text, '(?s)```.*?```', ' ', 'g'), '{REFERENCES}', '', 'g')"
ORACLE = {
    "secret_tokens": f"SELECT source, count(*) AS tokens, count(DISTINCT doc_id) AS documents, round(avg(h), 5) AS entropy FROM (SELECT source, doc_id, tok, -list_sum(list_transform(map_values(list_aggregate(string_split(tok, ''), 'histogram')), lambda k: k / length(tok) * log2(k / length(tok)))) AS h FROM (SELECT source, doc_id, unnest(regexp_extract_all(text, '{SECRET_TOKEN}')) AS tok FROM {_B})) WHERE h >= 3.2 AND regexp_matches(tok, '[0-9]') AND regexp_matches(tok, '[A-Za-z]') GROUP BY 1",
    "truncation_repair": f"SELECT doc_id, length(t) AS chars, CASE WHEN fit THEN length(c) ELSE length(t) END AS kept, fit AS repaired FROM (SELECT *, length(c) >= 0.45 * length(t) AND NOT regexp_matches(c, '{ABBREVIATION}') AS fit FROM (SELECT doc_id, t, {_CUT} AS c FROM (SELECT doc_id, {_T} AS t FROM {_B}) WHERE t <> '' AND NOT regexp_matches(t, '[.!?\"'')\\]]$')))",
    "code_stripped": f"SELECT doc_id, length(text) AS chars, length(c) AS kept, length(c) < 0.5 * length(text) AS mostly_code FROM (SELECT doc_id, text, {_CODE} AS c FROM {_B}) WHERE length(c) < length(text)",
    "instruction_density": f"SELECT category, count(*) AS records, round(avg(0.65 * len(list_filter(ls, lambda x: regexp_matches(x, '{WRAPPER}'))) / len(ls)), 6) AS density FROM (SELECT category, {LINES} AS ls FROM (SELECT DISTINCT ON (id, text) id, category, text FROM redteam_qa WHERE text IS NOT NULL)) WHERE len(ls) > 0 GROUP BY 1",
    "statistical_boilerplate": "SELECT id, round(0.3 * (len(ls) - len(list_distinct(ls))) / len(ls) + " + " + ".join(f"{w} * len(list_filter(ls, lambda x: regexp_matches(x, '{p}'))) / len(ls)" for w, p in ((0.25, r"[|»›>/·•]"), (0.25, r"^[^.!?]{1,40}$"), (0.1, X.URL), (0.1, "(?i)cookie|rights reserved|subscribe"))) + f", 6) AS score FROM (SELECT id, {LINES} AS ls FROM (SELECT DISTINCT id, text FROM cleaning_golden WHERE text IS NOT NULL)) WHERE len(ls) > 0",
    "section_thresholds": rf"WITH b AS (SELECT unnest({_PAR}) AS p FROM {_B}), w AS (SELECT p, {WORDS.format(c='lower(p)')} AS w FROM b WHERE length(p) > 0), x AS (SELECT round(0.5 * CASE WHEN len(w) > 0 THEN len(list_distinct(w)) / len(w) ELSE 0 END + 0.5 * least(1, length(p) / 800.0), 6) AS u, round({_n('[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}' + chr(92) + 's' + chr(92) + 'x0b]', 'p')} / length(p), 6) AS z FROM w), q AS (SELECT quantile_cont(u, 0.22) AS low, quantile_cont(u, 0.38) AS mid, quantile_cont(z, 0.72) AS noise FROM x) SELECT CASE WHEN u < low AND z > noise THEN 'REMOVE' WHEN u < low THEN 'DOWNWEIGHT' WHEN u < mid THEN 'KEEP_AFTER_CLEANING' ELSE 'KEEP' END AS route, count(*) AS blocks, round(avg(u), 5) AS utility FROM x, q GROUP BY 1",
    "topic_boundaries": rf"WITH b AS (SELECT doc_id, unnest({_PAR}) AS p, generate_subscripts({_PAR}, 1) AS k FROM {_B}), w AS (SELECT doc_id, k, list_distinct(regexp_extract_all(lower(p), '\p{{L}}{{4,}}')) AS w FROM b), f AS (SELECT * FROM w WHERE len(w) >= 8), x AS (SELECT doc_id, w, lag(w) OVER (PARTITION BY doc_id ORDER BY k) AS pr FROM f), j AS (SELECT doc_id, len(list_intersect(w, pr)) / (len(w) + len(pr) - len(list_intersect(w, pr))) AS j FROM x WHERE pr IS NOT NULL) SELECT doc_id, count(*) AS joints, CAST(sum(CASE WHEN j < 0.1 THEN 1 ELSE 0 END) AS BIGINT) AS boundaries, round(min(j), 6) AS least FROM j GROUP BY 1",
    "licence_candidates": f"SELECT source, licence, n AS documents FROM (SELECT source, licence, count(*) AS n FROM (SELECT source, {_LIC} AS licence FROM {_B}) WHERE licence <> 'unknown' GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY source ORDER BY (licence <> 'proprietary') DESC, n DESC, licence DESC) = 1",
}
