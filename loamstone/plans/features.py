"""Queries over document features, filters, gates and evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamstone.functions import features as X
from loamstone.functions.html import ENTITIES, strip_markup
from loamstone.functions import text as T
from loamstone.sources.tables import spread, table

R = 6


def _doc(spark, d):
    return spread(table(spark, d, "documents").where("text is not null").select("doc_id", "lang", "source", "domain", "text"))


def raw_line_features(spark, d):
    """O-053, O-051, O-095: raw counts and ratios of every document."""
    x = X.raw_features(F.col("text"))
    return _doc(spark, d).select("doc_id", *[F.round(v, R).alias(k) for k, v in x.items()])


def keyword_stuffing(spark, d):
    """O-066: share of the most frequent word of texts of 40 and more words; counted per document by a partial aggregation."""
    w = _doc(spark, d).select("doc_id", F.explode(T.words(F.lower(F.col("text")))).alias("w"))
    c = w.groupBy("doc_id", "w").agg(F.count("*").alias("n")).groupBy("doc_id").agg(F.max("n").alias("top"), F.sum("n").alias("words"))
    return c.where("words >= 40").select("doc_id", "top", "words", (F.col("top") / F.col("words") > 0.08).alias("stuffed"))


def script_profile(spark, d):
    """O-084, O-085: signs by script and mixture of every record of several languages."""
    t = table(spark, d, "redteam_multilingual").select("id", "text").dropDuplicates(["id"]).where("text is not null")
    return t.select("id", *[v.cast("double").alias(k) for k, v in X.script_profile(F.col("text")).items()])


def domain_assignment(spark, d):
    """O-091, O-092, O-093: domain from the source's prefix, else from the text's shape; content type."""
    t = _doc(spark, d)
    code = F.size(F.filter(T.lines(F.col("text")), lambda x: x.rlike(X.CODE_LINE)))
    hinted = F.when(F.col("source").startswith("open-web"), "web").when(F.col("source").endswith("-wiki") | F.col("source").contains("-wiki-"), "wiki").when(F.col("source").contains("code"), "code").when(F.col("source").contains("news"), "news").when(F.col("source").contains("forum") | F.col("source").contains("answers"), "qa").when(F.col("source").contains("docs") | F.col("source").contains("handbook"), "docs")
    shape = F.when((code >= 3) | F.col("text").contains("```"), "code").when(X.count(F.col("text"), r"\?") >= 3, "qa").when(F.col("text").rlike(r"(?m)^#{1,6} \S"), "docs").otherwise("web")
    return t.groupBy(F.coalesce(hinted, shape).alias("assigned"), F.when(code >= 10, "code").when(code >= 3, "mixed").otherwise("text").alias("content_type")).agg(F.count("*").alias("documents"))


def stage0_reject_reasons(spark, d):
    """O-118 to O-125: the first structural reason to reject each record, in ladder order."""
    t = table(spark, d, "cleaning_golden").select("id", "text").dropDuplicates(["id"])
    c = F.col("text")
    ls = T.lines(c)
    n = F.size(ls)
    short = F.size(F.filter(ls, lambda x: (F.length(x) < 40) & ~x.rlike(r"[.!?]$")))
    ctrl = F.try_divide(X.count(c, r"[\x{FFFD}]"), F.length(c))
    reason = (
        F.when(c.isNull() | (F.trim(F.coalesce(c, F.lit(""))) == ""), "empty_text")
        .when(ctrl > 0.02, "corruption")
        .when(X.count(c, X.TAG) >= 20, "html_dump")
        .when((n >= 5) & (F.try_divide(short, n) >= 0.7), "navigation_boilerplate")
        .when(c.rlike(r"(?i)may refer to") & (F.size(F.filter(ls, lambda x: x.rlike(X.BULLET))) >= 4), "disambiguation")
        .when(c.rlike(r"(?i)^\s*(?:404|500) |not found|access denied|internal error"), "error_page")
        .when(c.rlike(r"(?i)lorem ipsum|\{\{[^}]*\}\}"), "template_page")
        .when(c.rlike(r"(?i)sign in again|log in to continue"), "login_page")
        .otherwise("ok")
    )
    return t.groupBy(reason.alias("reason")).agg(F.count("*").alias("records"))


def truncation_signals(spark, d):
    """O-062, O-063: marks of a cut text and their severity."""
    t = _doc(spark, d)
    # only the end counts: 200 signs after trailing white space is gone
    t = t.withColumn("tail", T.collapse_space(F.right(F.regexp_replace("text", T.SPACE + "$", ""), F.lit(200))))
    tail = F.col("tail")
    base = F.when(tail.rlike(r"(?:\.\.\.|…)$"), 0.5).when(tail.rlike(r"[,;:(\-]$"), 0.6).when(tail.rlike(r"[.!?\"')\]]$"), 0.0).otherwise(0.3)
    explicit = tail.rlike(r"(?i)\[(?:truncated|cut|continued)\]$|read more$")
    p = F.when(explicit, 0.92).otherwise(0.55 * F.greatest(base, F.lit(0.1)) + 0.45 * base)
    sev = F.when(p < 0.30, "none").when(p < 0.72, "slight").otherwise("heavy")
    return t.select("doc_id", F.round(p, R).alias("truncation"), sev.alias("severity"))


def html_fallback_clean(spark, d):
    """O-046, O-048, O-051, O-052: markup of pages removed by rules; what remains."""
    t = table(spark, d, "cleaning_golden").select("id", "text").dropDuplicates(["id"]).where("text is not null")
    c = F.col("text")
    return t.select("id", c.rlike(r"<[a-zA-Z!/]").alias("looks_like_html"), X.count(c, X.TAG).cast("bigint").alias("tags"), F.sha2(strip_markup(c), 256).alias("digest"), F.length(strip_markup(c)).alias("chars"))


QUERIES = {f.__name__: f for f in (raw_line_features, keyword_stuffing, script_profile, domain_assignment, stage0_reject_reasons, truncation_signals, html_fallback_clean)}

# --- SQL --------------------------------------------------------------------
LINES = r"list_filter(list_transform(regexp_split_to_array(text, '\r\n|\r|\n'), lambda x: trim(x)), lambda x: x <> '')"
WORDS = r"list_filter(regexp_split_to_array({c}, '[\s\x0b\p{{Z}}\x{{85}}]+'), lambda x: x <> '')"


def _n(pattern: str, c: str = "text") -> str:
    return f"CAST(len(regexp_extract_all({c}, '{pattern}')) AS DOUBLE)"


def _lines(pattern: str) -> str:
    return f"CASE WHEN lines > 0 THEN len(list_filter(ls, lambda x: regexp_matches(x, '{pattern}'))) / lines ELSE 0 END"


_RAW = f"""(SELECT *, CAST(len(ls) AS DOUBLE) AS lines, CAST(len(ws) AS DOUBLE) AS words, CAST(length(text) AS DOUBLE) AS n FROM (SELECT doc_id, source, domain, text, {LINES} AS ls, {WORDS.format(c='text')} AS ws FROM documents WHERE text IS NOT NULL))"""
_SENT = r"list_filter(regexp_split_to_array(text, '(?:[.!?][\s\x0b]+)|\n'), lambda x: x <> '')"


def _q(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) > 0 THEN ({a}) / ({b}) ELSE 0 END"


def _clip(e: str) -> str:
    return f"greatest(0, least(1, {e}))"


_FILTERS = {
    "boilerplate": _clip(_q(_n(X.COOKIE), "lines")),
    "transaction": _clip("(" + _q(f"2 * {_n(X.PRICE)} + {_n(X.BUY)}", "words") + ") * 10"),
    "templates": _clip(_q(f"CAST(len(list_filter(sent, lambda s: regexp_matches(s, '{X.DISCOURSE}'))) AS DOUBLE)", "CAST(len(sent) AS DOUBLE)")),
    "hedging": _clip("(" + _q(_n(X.HEDGE), "words") + ") * 20"),
    "enthusiasm": _clip(_q(_n("!"), "CAST(len(sent) AS DOUBLE)")),
    "shouting": _clip(_q(r"CAST(len(list_filter(ls, lambda x: x = upper(x) AND regexp_matches(x, '\p{Lu}{3}'))) AS DOUBLE)", "lines")),
    "low_information": _clip("1 - (" + _q("CAST(len(list_distinct(lw)) AS DOUBLE)", "CAST(len(lw) AS DOUBLE)") + ")"),
    "markup": _clip(_q(_n(X.TAG), "lines")),
}
_RAWS = {
    "chars": "n", "lines": "lines", "words": "words", "digit_ratio": _q(_n("[0-9]"), "n"), "upper_ratio": _q(_n(r"\p{Lu}"), "n"), "alpha_ratio": _q(_n(r"\p{L}"), "n"), "space_ratio": _q(_n(r"[ \t\n\r]"), "n"),
    "urls": _n(X.URL), "years": _n(X.YEAR), "citations": _n(X.CITATION), "copulas": _n(X.COPULA), "steps": _n(X.STEP), "questions": _n(r"\?"), "sentences": _n(r"[.!?](?:[\s\x0b]|$)"), "fences": _n("```"),
    "bullet_ratio": _lines(X.BULLET), "table_ratio": _lines(r"\|.*\|"), "code_ratio": _lines(X.CODE_LINE), "mean_line": _q("n", "lines"), "mean_word": _q("list_sum(list_transform(ws, lambda x: CAST(length(x) AS DOUBLE)))", "words"),
}
_FROM = f"(SELECT *, {_SENT} AS sent, {WORDS.format(c='lower(text)')} AS lw FROM {_RAW})"


def _sat(v: str, a: str) -> str:
    return f"CASE WHEN {v} <= 0 THEN 0 ELSE greatest(0, least(1, {v} / ({v} + greatest(list_avg({a}), {v} * 0.25)))) END"


def _base(a: str) -> str:
    pos = f"list_filter({a}, lambda x: x > 0)"
    return f"CASE WHEN len({pos}) = 0 THEN 0 WHEN len({pos}) = 1 THEN least(1, {pos}[1] * 0.85) ELSE list_max(list_transform({pos}, lambda v: v / (v + greatest(list_avg({a}), v * 0.25)))) END"


_CODE = f"len(list_filter({LINES}, lambda x: regexp_matches(x, '{X.CODE_LINE}')))"
_STRIP = "regexp_replace(regexp_replace(regexp_replace(text, '(?is)<script\\b.*?</script\\s*>', ' ', 'g'), '(?is)<style\\b.*?</style\\s*>', ' ', 'g'), '(?is)<noscript\\b.*?</noscript\\s*>', ' ', 'g')"
_STRIP = f"regexp_replace(regexp_replace({_STRIP}, '(?i)<br\\s*/?>|</(?:p|div|li|tr|h[1-6])\\s*>', chr(10), 'g'), '(?s)<!--.*?-->|</?[a-zA-Z][^<>]*>', ' ', 'g')"
for _name, _sign in ENTITIES:
    _STRIP = f"replace({_STRIP}, '&{_name};', '{_sign.replace(chr(39), chr(39) * 2)}')"
_STRIP = f"trim(regexp_replace(regexp_replace(regexp_replace({_STRIP}, '[ \\t]+', ' ', 'g'), ' ?\\n ?', chr(10), 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'))"
ORACLE = {
    "html_fallback_clean": f"SELECT id, regexp_matches(text, '<[a-zA-Z!/]') AS looks_like_html, CAST({_n(X.TAG)} AS BIGINT) AS tags, sha256({_STRIP}) AS digest, length({_STRIP}) AS chars FROM (SELECT DISTINCT id, text FROM cleaning_golden WHERE text IS NOT NULL)",
    "raw_line_features": f"SELECT doc_id, {', '.join(f'round({v}, 6) AS {k}' for k, v in _RAWS.items())} FROM {_RAW}",
    "keyword_stuffing": f"SELECT doc_id, top, CAST(words AS BIGINT) AS words, top / words > 0.08 AS stuffed FROM (SELECT doc_id, max(n) AS top, sum(n) AS words FROM (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest({WORDS.format(c='lower(text)')}) AS w FROM documents WHERE text IS NOT NULL) GROUP BY 1, 2) GROUP BY 1) WHERE words >= 40",
    "script_profile": "WITH t AS (SELECT DISTINCT id, text FROM redteam_multilingual WHERE text IS NOT NULL), n AS (SELECT id, " + ", ".join(f"CAST(len(regexp_extract_all(text, '{p}')) AS DOUBLE) AS {k}" for k, p in {"latin": r"\p{Latin}", "cyrillic": r"\p{Cyrillic}", "devanagari": r"\p{Devanagari}", "arabic": r"\p{Arabic}", "han": r"\p{Han}", "kana": r"[\p{Hiragana}\p{Katakana}]"}.items()) + " FROM t), a AS (SELECT *, latin+cyrillic+devanagari+arabic+han+kana AS s FROM n), b AS (SELECT *, " + " + ".join(f"CASE WHEN s > 0 AND {k} / s >= 0.05 THEN 1 ELSE 0 END" for k in ("latin", "cyrillic", "devanagari", "arabic", "han", "kana")) + " AS k FROM a) SELECT id, latin, cyrillic, devanagari, arabic, han, kana, CAST(k AS DOUBLE) AS active, CASE WHEN k > 1 THEN CAST(0.28 * (k - 1) AS DOUBLE) ELSE 0.0 END AS mixed FROM b",
    "domain_assignment": f"SELECT coalesce(CASE WHEN starts_with(source,'open-web') THEN 'web' WHEN source LIKE '%-wiki' OR source LIKE '%-wiki-%' THEN 'wiki' WHEN source LIKE '%code%' THEN 'code' WHEN source LIKE '%news%' THEN 'news' WHEN source LIKE '%forum%' OR source LIKE '%answers%' THEN 'qa' WHEN source LIKE '%docs%' OR source LIKE '%handbook%' THEN 'docs' END, CASE WHEN code >= 3 OR contains(text, '```') THEN 'code' WHEN {_n(chr(92) + '?')} >= 3 THEN 'qa' WHEN regexp_matches(text, '(?m)^#{{1,6}} \\S') THEN 'docs' ELSE 'web' END) AS assigned, CASE WHEN code >= 10 THEN 'code' WHEN code >= 3 THEN 'mixed' ELSE 'text' END AS content_type, count(*) AS documents FROM (SELECT source, text, {_CODE} AS code FROM documents WHERE text IS NOT NULL) GROUP BY 1, 2",
    "stage0_reject_reasons": rf"""SELECT reason, count(*) AS records FROM (SELECT CASE WHEN text IS NULL OR trim(text) = '' THEN 'empty_text' WHEN {_n('[' + chr(92) + 'x{FFFD}]')} / length(text) > 0.02 THEN 'corruption' WHEN {_n(X.TAG)} >= 20 THEN 'html_dump'
WHEN len(ls) >= 5 AND len(list_filter(ls, lambda x: length(x) < 40 AND NOT regexp_matches(x, '[.!?]$'))) / len(ls) >= 0.7 THEN 'navigation_boilerplate' WHEN regexp_matches(text, '(?i)may refer to') AND len(list_filter(ls, lambda x: regexp_matches(x, '{X.BULLET}'))) >= 4 THEN 'disambiguation'
WHEN regexp_matches(text, '(?i)^[\s\x0b]*(?:404|500) |not found|access denied|internal error') THEN 'error_page' WHEN regexp_matches(text, '(?i)lorem ipsum|\{{\{{[^}}]*\}}\}}') THEN 'template_page' WHEN regexp_matches(text, '(?i)sign in again|log in to continue') THEN 'login_page' ELSE 'ok' END AS reason
FROM (SELECT id, text, {LINES} AS ls FROM (SELECT DISTINCT id, text FROM cleaning_golden))) GROUP BY 1""",
    "truncation_signals": r"""SELECT doc_id, round(p, 6) AS truncation, CASE WHEN p < 0.30 THEN 'none' WHEN p < 0.72 THEN 'slight' ELSE 'heavy' END AS severity FROM (SELECT doc_id, CASE WHEN regexp_matches(tail, '(?i)\[(?:truncated|cut|continued)\]$|read more$') THEN 0.92 ELSE 0.55 * greatest(base, 0.1) + 0.45 * base END AS p FROM (SELECT *, CAST(CASE WHEN regexp_matches(tail, '(?:\.\.\.|…)$') THEN 0.5 WHEN regexp_matches(tail, '[,;:(\-]$') THEN 0.6 WHEN regexp_matches(tail, '[.!?"'')\]]$') THEN 0.0 ELSE 0.3 END AS DOUBLE) AS base FROM (SELECT doc_id, trim(regexp_replace(text, '[\s\x0b\p{Z}\x{85}]+', ' ', 'g')) AS tail FROM documents WHERE text IS NOT NULL)))""",
}
