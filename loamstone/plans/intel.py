"""Structure of documents: fingerprints, typed spans (genes), their graph and promotion; discovery of lines that pages share."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamstone.functions import text as T
from loamstone.functions.sheet import TOKEN, WS, Sheet
from loamstone.plans.evidence import _SOURCE, PARTS, _documents, _picked
from loamstone.sources.tables import spread, table, written

# Patterns of the kinds of spans, in the order in which they are tried.
KINDS = (
    ("code", r"(?m)```|^\s*(?:def |class |import |from |function )"), ("forum_question", r"(?im)^\s*(?:Q:|Question:|\?)"), ("forum_answer", r"(?im)^\s*(?:A:|Answer:)"), ("mathematical", r"\$[^$]+\$|\\begin\{|\\frac\{|∑|∫|∀|∃"),
    ("html_layout", r"(?i)<(?:html|div|table|nav|header|footer)\b"), ("publication_scaffold", r"(?i)(?:published|copyright|all rights reserved|subscribe|newsletter|by\s+\w+\s+\w+)"), ("navigation", r"(?i)(?:home\s*\||\bmenu\b|breadcrumb|table of contents)"),
    ("legal", r"(?i)(?:whereas|hereby|pursuant to|section\s+\d+\.\d+)"), ("news", r"(?i)(?:breaking:|associated press|reuters|for immediate release)"), ("scientific", r"(?i)(?:abstract|introduction|methodology|references|doi:)"),
    ("educational", r"(?i)(?:learning objective|exercise|homework|chapter\s+\d+)"), ("documentation", r"(?i)(?:api reference|parameters:|returns:|usage:)"),
)
MARKERS = r"def |class |import |```|function |const "
PROTECTED = (
    r"(?i)\b10\.\d{4,9}/\S+|\b\d{4}-\d{3}[\dx]\b|\barxiv:\d+\.\d+|\$\$.+?\$\$|\\begin\{|\\frac\{|\\sum_|\\int_|```|^\s*(?:date|score|grade|rating|violation|inspector|facility)\s*:"
    r"|\b(?:mg/dl|mmhg|bpm|diagnosis|patient|symptom|pathology)\b|\b(?:def |class |import |function |theorem|proof|lemma)|^\s*\|.+\|.+\|\s*$"
)

#: O-371: a span of a document as a typed gene; `text` is the span.
GENES = Sheet([
    {"ls": lambda d: d.filter(d.map(d.split("text", r"[\r\n]+"), d.replace("x", f"^{WS}+|{WS}+$", "")), "x <> ''"), "words": lambda d: f"CAST({d.n('text', TOKEN)} AS BIGINT)", "stops": lambda d: d.n("text", r"\.")},
    {
        "kind": lambda d: "CASE " + " ".join(f"WHEN {d.has('text', p)} THEN '{k}'" for k, p in KINDS) + " WHEN words >= 12 AND stops >= 2 THEN 'prose' ELSE 'unknown' END",
        "shape": lambda d: d.sha(d.text_of(d.map("ls", f"concat(CAST(CAST({d.n('x', TOKEN)} AS BIGINT) AS VARCHAR(20)), ':', substring(x, 1, 1))"), "|")), "span_lines": lambda d: f"CAST({d.size('ls')} AS BIGINT)",
    },
    {"gene_key": lambda d: f"substring({d.sha('concat(kind, ' + chr(39) + '|' + chr(39) + ', shape, ' + chr(39) + '|' + chr(39) + ', CAST(words AS VARCHAR(20)))')}, 1, 24)"},
])
#: O-369, O-370, O-372: hashes of shape and the complexity of a document.
PRINTS = Sheet([*PARTS.layers, {
    "upper_n": lambda d: d.n("text", "[A-Z]"), "alpha_n": lambda d: d.n("text", "[A-Za-z]"), "digit_n": lambda d: d.n("text", "[0-9]"), "punct_n": lambda d: d.n("text", r"[!-/:-@\[-`{-~]"), "ws_n": lambda d: d.n("text", TOKEN), "marker_n": lambda d: d.size(d.filter("ls", d.has("x", MARKERS))),
    "sections": lambda d: d.filter(d.split("text", r"\n\n"), d.has("x", "[^ \\t\\n\\r]")), "head": lambda d: f"lower(substring({d.text_of(d.first('ls', 1), '')}, 1, 90))", "rear": lambda d: f"lower(substring({d.last('ls')}, 1, 90))",
    "hint": lambda d: f"CASE WHEN {d.has('text', '(?i)<html')} THEN 'html' WHEN {d.has('text', '@')} THEN 'forum' ELSE 'plain' END",
}, {
    "section_lens": lambda d: d.map("sections", f"CAST(CAST({d.n('x', TOKEN)} AS BIGINT) AS VARCHAR(20))"), "line_shapes": lambda d: d.map("ls", f"concat(CAST(CAST({d.n('x', TOKEN)} AS BIGINT) AS VARCHAR(20)), CASE WHEN {d.has('x', MARKERS)} THEN ':c:' ELSE ':p:' END, CASE WHEN {d.has('x', '[0-9]')} THEN '1' ELSE '0' END)"),
}, {
    "structural": lambda d: f"substring({d.sha(_packed('ws_n', 'lc', '(upper_n / greatest(alpha_n, 1.0)) * 10000', 'digit_n / n1 * 10000', 'punct_n / n1 * 10000'))}, 1, 24)", "wrapper": lambda d: f"substring({d.sha('concat(hint, ' + chr(39) + '|' + chr(39) + ', substring(head, 1, 40), ' + chr(39) + '|' + chr(39) + ', substring(rear, 1, 40))')}, 1, 24)",
    "section_shape": lambda d: f"substring({d.sha(d.text_of('section_lens', ','))}, 1, 24)", "line_shape": lambda d: f"substring({d.sha(d.text_of('line_shapes', ','))}, 1, 24)",
    "complexity": lambda d: f"least(1.0, least(1.0, {d.size('sections')} / 24.0) * 0.28 + least(1.0, marker_n / lc) * 0.32 + least(1.0, lc / 240.0) * 0.18 + least(1.0, {d.size(d.distinct('section_lens'))} / 18.0) * 0.12 + least(1.0, n / 48000.0) * 0.10)",
}])


def _packed(*parts: str) -> str:
    """Numbers as one text, each rounded to a whole."""
    return "concat(" + ", '|', ".join(f"CAST(CAST(floor({p} + 0.5) AS BIGINT) AS VARCHAR(20))" for p in parts) + ")"


def _spans(spark, d):
    return spread(table(spark, d, "documents").where("text is not null").select("doc_id", "domain", "text")).select("doc_id", "domain", F.posexplode(F.split("text", r"\n{2,}")).alias("k", "text")).where(f"regexp_like(text, r'[^ \\t\\n\\r\\f]')")


_SPANS = r"(SELECT doc_id, domain, k, p[k] AS text FROM (SELECT doc_id, domain, p, unnest(range(1, len(p) + 1)) AS k FROM (SELECT doc_id, domain, regexp_split_to_array(text, '\n{2,}') AS p FROM documents WHERE text IS NOT NULL)) WHERE regexp_matches(p[k], '[^ \t\n\r\f]'))"


def document_fingerprints(spark, d):
    """O-369, O-370, O-372: structural, wrapper, section and line hashes of every document, and its complexity."""
    return PRINTS.spark(_documents(spark, d)).selectExpr("doc_id", "structural", "wrapper", "section_shape", "line_shape", *_picked(["complexity"]))


def genome_profiles(spark, d):
    """O-371: genes of every document over all its spans, the number of kinds, and the key of their order."""
    g = GENES.spark(_spans(spark, d)).groupBy("doc_id").agg(F.count("*").alias("genes"), F.countDistinct("kind").alias("kinds"), F.array_sort(F.collect_list(F.struct("k", "gene_key"))).alias("a"))
    return g.select("doc_id", "genes", "kinds", F.sha2(F.array_join("a.gene_key", ","), 256).alias("genome_key"))


def gene_graph(spark, d):
    """O-372 to O-374: genes with documents, domains, novelty and confidence; promoted from five documents and a confidence of a half.

    Counts are partial sums per document first, so that a gene of many spans or documents is added up before it moves.
    """
    per = GENES.spark(_spans(spark, d)).groupBy("gene_key", "kind", "doc_id", "domain").agg(F.count("*").alias("n"))
    x = per.groupBy("gene_key", "kind").agg(F.count("*").alias("documents"), F.sum("n").alias("observations"), F.countDistinct("domain").alias("domains")).where("documents >= 2")
    conf = F.when(F.col("observations") < 3, 0.0).otherwise(F.least(F.lit(1.0), F.col("documents") / F.col("observations") * 0.55 + F.least(F.lit(1.0), F.log1p("observations") / F.log1p(F.lit(48.0))) * 0.45))
    return x.select("gene_key", "kind", "documents", "observations", "domains", F.round(1 / (1 + F.log1p("observations")) + 1e-9, 5).alias("novelty"), F.round(conf + 1e-9, 5).alias("confidence"), ((F.col("documents") >= 5) & (conf >= 0.5)).alias("promoted"))


def discovery_report(spark, d):
    """O-364, O-365, O-367, O-368: documents with the lines that other documents share: those to trim, those protected, and their characters.

    Two passes over the lines of all documents: frequency, place and novelty of
    every fuzzy line by grouped aggregation, then a join back by the line's
    hash. Lines protected by what they hold (identifiers, formulas, code,
    tables, forms, measures) are never trimmed.
    """
    t = spread(table(spark, d, "documents").where("text is not null").select("doc_id", "text"))
    total = t.agg(F.count("*").alias("docs"))  # one row
    lines = t.select("doc_id", F.size(F.split("text", "\n")).alias("n"), F.posexplode(F.split("text", "\n")).alias("k", "line"))
    lines = lines.select("doc_id", F.length("line").alias("chars"), T.fragment_normalize(F.col("line")).alias("f"), (F.col("k") / F.col("n")).alias("at"), F.col("line").rlike(PROTECTED).alias("kept")).where("length(f) >= 8")
    bins = [(F.col("at") < 0.10), (F.col("at") >= 0.10) & (F.col("at") < 0.25), (F.col("at") >= 0.25) & (F.col("at") < 0.75), (F.col("at") >= 0.75) & (F.col("at") < 0.90), (F.col("at") >= 0.90)]
    per = lines.groupBy("f", "doc_id").agg(F.count("*").alias("c"), F.sum("chars").alias("chars"), F.max(F.col("kept").cast("int")).alias("kept"), *[F.sum(b.cast("int")).alias(f"b{k}") for k, b in enumerate(bins)])
    per = written(per, "line_units")
    stats = per.groupBy("f").agg(F.count("*").alias("df"), F.sum("c").alias("lf"), *[F.sum(f"b{k}").alias(f"b{k}") for k in range(5)]).where("df >= 2").crossJoin(F.broadcast(total))
    scored = _LINES.spark(stats).select("f", "lf", "low", "place", "novelty", "artifact")
    x = per.join(scored, "f")
    fused = F.least(F.lit(1.0), F.col("artifact") * 0.75 + (1 - 1 / F.col("c")) * 0.15 + F.col("low") * 0.10)
    trim = (fused >= 0.40) & (F.col("novelty") < 0.45) & (F.col("kept") == 0)
    return x.groupBy("doc_id").agg(F.count("*").alias("shared_lines"), F.sum(trim.cast("int")).alias("trimmable"), F.sum(F.when(trim, F.col("chars")).otherwise(0)).alias("trim_chars"), F.sum("kept").cast("bigint").alias("protected"))


_Z = 1.96
_H = " + ".join(f"(CASE WHEN b{k} > 0 THEN -(b{k} / CAST(lf AS DOUBLE)) * log2(b{k} / CAST(lf AS DOUBLE)) ELSE 0.0 END)" for k in range(5))
#: Wilson bound, place by the entropy of the histogram, novelty by information, and what they say together.
_LINES = Sheet([
    {"p": "df / CAST(docs AS DOUBLE)", "h": f"({_H}) / log2(5.0)", "bits": lambda d: d.entropy("f")},
    {"low": f"(p + {_Z * _Z} / (2 * docs) - {_Z} * sqrt(p * (1 - p) / docs + {_Z * _Z} / (4.0 * docs * docs))) / (1 + {_Z * _Z} / docs)", "novelty": "least(1.0, least(1.0, bits / df / 8.0) * 0.6 + 0.4 * df / lf)"},
    {"place": "least(1.0, (1.0 - least(1.0, h)) * 0.65 + low * 0.35)"},
    {"artifact": "least(1.0, 0.40 * low + 0.35 * place + 0.25 * (1.0 - novelty))"},
])
_FRAG = r"trim(regexp_replace(regexp_replace(regexp_replace(lower(line), '[\s\x0b\p{Z}\x{85}]+', ' ', 'g'), '[0-9]', '#', 'g'), '[^\p{L}\p{N}# ]', '', 'g'))"
_BIN = ("spot < 0.10", "spot >= 0.10 AND spot < 0.25", "spot >= 0.25 AND spot < 0.75", "spot >= 0.75 AND spot < 0.90", "spot >= 0.90")
_STATS = f"(SELECT f, count(*) AS df, CAST(sum(c) AS BIGINT) AS lf, {', '.join(f'CAST(sum(b{k}) AS BIGINT) AS b{k}' for k in range(5))}, (SELECT count(*) FROM documents WHERE text IS NOT NULL) AS docs FROM per GROUP BY 1 HAVING count(*) >= 2)"
_FUSED = "least(1.0, artifact * 0.75 + (1 - 1 / c) * 0.15 + low * 0.10) >= 0.40 AND novelty < 0.45 AND kept = 0"
QUERIES = {f.__name__: f for f in (document_fingerprints, genome_profiles, gene_graph, discovery_report)}
ORACLE = {
    "document_fingerprints": f"SELECT doc_id, structural, wrapper, section_shape, line_shape, {_picked(['complexity'])[0]} FROM {PRINTS.duck(_SOURCE)}",
    "genome_profiles": f"SELECT doc_id, count(*) AS genes, count(DISTINCT kind) AS kinds, sha256(string_agg(gene_key, ',' ORDER BY k)) AS genome_key FROM {GENES.duck(_SPANS)} GROUP BY 1",
    "gene_graph": f"SELECT gene_key, kind, documents, observations, domains, round(1 / (1 + ln(1 + observations)) + 1e-9, 5) AS novelty, round(conf + 1e-9, 5) AS confidence, documents >= 5 AND conf >= 0.5 AS promoted FROM (SELECT *, CASE WHEN observations < 3 THEN 0.0 ELSE least(1.0, documents / observations * 0.55 + least(1.0, ln(1 + observations) / ln(49.0)) * 0.45) END AS conf FROM (SELECT gene_key, kind, count(DISTINCT doc_id) AS documents, count(*) AS observations, count(DISTINCT domain) AS domains FROM {GENES.duck(_SPANS)} GROUP BY 1, 2) WHERE documents >= 2)",
    "discovery_report": f"""WITH cut AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL), l AS (SELECT doc_id, len(p) AS n, unnest(p) AS line, generate_subscripts(p, 1) - 1 AS k FROM cut), u AS (SELECT doc_id, length(line) AS chars, {_FRAG} AS f, k / n AS spot, regexp_matches(line, '{PROTECTED}') AS kept FROM l),
per AS (SELECT f, doc_id, count(*) AS c, sum(chars) AS chars, max(CAST(kept AS INTEGER)) AS kept, {', '.join(f'sum(CASE WHEN {b} THEN 1 ELSE 0 END) AS b{k}' for k, b in enumerate(_BIN))} FROM u WHERE length(f) >= 8 GROUP BY 1, 2), s AS (SELECT f, low, novelty, artifact FROM {_LINES.duck(_STATS)})
SELECT doc_id, count(*) AS shared_lines, CAST(sum(CASE WHEN {_FUSED} THEN 1 ELSE 0 END) AS BIGINT) AS trimmable, CAST(sum(CASE WHEN {_FUSED} THEN chars ELSE 0 END) AS BIGINT) AS trim_chars, CAST(sum(kept) AS BIGINT) AS protected FROM per JOIN s ON per.f = s.f GROUP BY 1""",
}
