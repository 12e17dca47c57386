"""Knowledge units: blocks of documents with their roles, class, completeness and retention; what documents are made of.

Stated once for both engines over one row a block. A block's evidence is that of the block alone. The survey's 25
classes and their weights are stated in the common form below: role scores from patterns, shape and place.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loamstone.functions.sheet import TOKEN, WS, Sheet, base
from loamstone.plans.curation import CITES, INLINE_NAV, WRAP_HEAD
from loamstone.plans.decisions import DANGLING
from loamstone.plans.evidence import EVIDENCE, _picked
from loamstone.plans.gates import META, SCAFFOLD, UI
from loamstone.sources.tables import spread, table

# Patterns of the roles.
MASTHEAD = r"(?i)\b(?:vol(?:ume|\.)? ?\d+|issue (?:no\.? ?)?\d+|issn|isbn|editor(?:s|ial board)?|published (?:by|in)|publisher|copyright|all rights reserved|printed in|imprint|subscribe|newsletter|masthead)\b"
PAGING = r"(?i)\bpage \d+ (?:of|/) \d+\b|^\s*\d+ ?\| ?page\b|\b(?:previous|next) page\b"
QUESTION, ANSWER = r"(?im)^\s*(?:q:|question:|\?)|\?\s*$", r"(?im)^\s*(?:a:|answer:|accepted answer|solution:)"
COMMENT = r"(?im)^\s*(?:comment:|re:|reply:|@\w+|\w+ (?:wrote|said|commented):)|\b\d+ (?:points?|upvotes?|likes?|replies)\b"
INSTRUCTS = r"(?i)\b(?:exercise|learning objectives?|homework|worksheet|quiz|fill in|choose the correct|write down|answer the following|discuss with)\b"
EXPLAINS = r"(?i)\b(?:is defined as|means that|refers to|therefore|because|for example|consists of|is called|in other words|as a result|depends on)\b"
REFERENCE = r"(?im)^\s*(?:\[\d+\]|\d+\.) .*(?:19|20)\d\d|doi:|et al\.|\bpp?\. \d+"
LEGAL = r"(?i)\b(?:hereby|pursuant|terms of (?:use|service)|privacy policy|warranty|liable|liability|disclaimer)\b"
LIST_LINE, TABLE_LINE, HEAD_LINE = r"^(?:[-*+•]|\d+[.)]) ", r"\|.*\|", r"^(?:#{1,6} |={2,}.*={2,}$)"
DISCARD = ("navigation", "publication", "legal", "exercise", "empty", "reference")


def _of(p: str):
    return lambda d: d.size(d.filter("ls", d.has("x", p))) + " / lc"


#: O-262 to O-264, O-266, O-268, O-269, O-271 to O-273: roles, class, completeness, retention and the cleaned unit.
UNITS = EVIDENCE + Sheet([
    {
        "mast_hits": lambda d: d.n("text", MASTHEAD) + " + " + d.n("text", PAGING), "q_hits": lambda d: d.n("text", QUESTION), "a_hits": lambda d: d.n("text", ANSWER), "c_hits": lambda d: d.n("text", COMMENT), "ex_hits": lambda d: d.n("text", INSTRUCTS), "why_hits": lambda d: d.n("text", EXPLAINS),
        "ref_hits": lambda d: d.n("text", REFERENCE), "law_hits": lambda d: d.n("text", LEGAL), "scaffold_hits": lambda d: d.n("text", SCAFFOLD), "list_share": _of(LIST_LINE), "table_share": _of(TABLE_LINE), "ui_share": lambda d: _of(UI)(d), "meta_share": lambda d: _of(META)(d),
        "headed": lambda d: d.has("t", HEAD_LINE), "fenced": lambda d: d.has("text", "```"), "tokens_n": lambda d: d.n("text", TOKEN), "end_clean": lambda d: d.has("t", r"[.!?)\x22\x27\]};>”。！？]$"), "end_open": lambda d: d.has("t", r"[({\[<]$"), "end_joined": lambda d: d.has("t", r"[,\-–—:]$"),
        "final_word": lambda d: d.replace(f"lower({d.last(d.all('t', TOKEN))})", r"[^a-z]", ""), "lower_start": lambda d: d.has("t", r"^\p{Ll}"), "cleaned": lambda d: d.replace(d.replace(d.replace(d.replace("text", WRAP_HEAD, ""), INLINE_NAV, " "), CITES, ""), f"^{WS}+|{WS}+$", ""),
    },
    {
        "dangling": lambda d: d.has("final_word", DANGLING), "s_publication": "least(1.0, (mast_hits) / lc * 0.5 + CASE WHEN (spot < 0.1 OR spot >= 0.9) AND mast_hits > 0 THEN 0.2 ELSE 0.0 END)",
        "s_question": "least(1.0, q_hits / lc * 0.7 + CASE WHEN q_hits > 0 AND spot < 0.3 THEN 0.15 ELSE 0.0 END)", "s_answer": "least(1.0, a_hits / lc * 0.8 + CASE WHEN why_hits > 0 AND spot >= 0.3 THEN 0.1 ELSE 0.0 END)", "s_comment": "least(1.0, c_hits / lc * 0.7)",
        "s_exercise": "least(1.0, ex_hits / greatest(wc / 25, 1.0) * 0.6)", "s_knowledge": "least(1.0, why_hits / greatest(wc / 40, 1.0) * 0.5 + r_factual * 0.3 + r_educational * 0.2)",
        "s_navigation": f"least(1.0, greatest({base(['nav_ratio', 'ui_share', 'r_navigational'])} * 0.6, ui_share, CASE WHEN wc < 12 THEN nav_ratio ELSE 0.0 END))", "s_legal": "least(1.0, law_hits / greatest(wc / 30, 1.0) * 0.5)",
    },
    {"incomplete": "CASE WHEN headed OR fenced OR list_share > 0.5 OR table_share > 0.5 THEN 0.0 WHEN end_clean THEN CASE WHEN lower_start THEN 0.2 ELSE 0.0 END WHEN dangling THEN 0.78 WHEN end_open THEN 0.88 WHEN end_joined THEN 0.62 ELSE 0.5 END"},
    {
        "class": "CASE WHEN wc = 0 THEN 'empty' WHEN fenced OR code_density > 0.6 THEN 'code' WHEN table_share > 0.5 AND ui_share < 0.5 THEN 'table' WHEN s_navigation >= 0.5 THEN 'navigation' WHEN s_publication >= 0.5 THEN 'publication' WHEN s_legal >= 0.5 THEN 'legal' WHEN headed AND lc <= 1 THEN 'heading'"
        " WHEN ref_hits / lc >= 0.6 THEN 'reference' WHEN s_exercise >= 0.5 AND s_exercise > s_knowledge THEN 'exercise' WHEN s_answer >= 0.5 THEN 'answer' WHEN s_question >= 0.5 THEN 'question' WHEN s_comment >= 0.5 THEN 'comment' WHEN list_share > 0.5 THEN 'list' WHEN s_knowledge >= 0.35 THEN 'explanation' WHEN r_factual > r_narrative THEN 'facts' ELSE 'prose' END",
        "retention": "greatest(0.0, least(1.0, utility * 0.5 + strength * q_coherence * 0.3 + (1.0 - incomplete) * 0.2 - s_navigation * 0.4 - s_publication * 0.3 - scaffold_hits / greatest(wc / 30, 1.0) * 0.2))",
    },
    {"kept": f"class NOT IN ({', '.join(repr(x) for x in DISCARD)}) AND (retention >= 0.25 OR (preserve AND class IN ('code', 'table', 'explanation', 'facts')))"},
    {"dropped_for": "CASE WHEN kept THEN '' WHEN class IN (" + ", ".join(repr(x) for x in DISCARD) + ") THEN concat('class_', class) WHEN incomplete >= 0.6 THEN 'incomplete' ELSE 'low_retention' END", "leaks": "CASE WHEN kept THEN ui_share + meta_share ELSE 0.0 END"},
])
_VALUES = ["retention", "incomplete", "s_publication", "s_question", "s_answer", "s_comment", "s_exercise", "s_knowledge", "s_navigation"]
_PLAIN = ["class", "kept", "dropped_for", "CAST(length(cleaned) AS INT) AS chars"]


def _blocks(spark, d):
    t = spread(table(spark, d, "documents").where("text is not null").select("doc_id", "source", "domain", "text")).select("doc_id", "source", "domain", F.split("text", r"\n[ \t]*\n+").alias("p"))
    return t.select("doc_id", "source", "domain", F.size("p").alias("blocks"), F.posexplode("p").alias("block", "text")).withColumn("spot", F.col("block") / F.col("blocks")).where(r"regexp_like(text, r'[^ \t\n\f\r\x0b\p{Z}\x{85}]')")


_SRC = r"(SELECT doc_id, source, domain, len(p) AS blocks, CAST(k - 1 AS INTEGER) AS block, p[k] AS text, (k - 1) / len(p) AS spot FROM (SELECT doc_id, source, domain, p, unnest(range(1, len(p) + 1)) AS k FROM (SELECT doc_id, source, domain, regexp_split_to_array(text, '\n[ \t]*\n+') AS p FROM documents WHERE text IS NOT NULL)) WHERE regexp_matches(p[k], '[^ \t\n\f\r\x0b\p{Z}\x{85}]'))"


def knowledge_units(spark, d):
    """O-258, O-263, O-264, O-266, O-268 to O-273: every block with its roles, class, completeness, retention and whether it is kept."""
    return UNITS.spark(_blocks(spark, d)).selectExpr("doc_id", "block", *_picked(_VALUES), *_PLAIN)


def document_understanding(spark, d):
    """O-258, O-274, O-275: units kept and dropped of every document, the share of its words in kept ones, and what it is mostly made of."""
    x = UNITS.spark(_blocks(spark, d)).groupBy("doc_id", "class").agg(F.count("*").alias("n"), F.sum("tokens_n").alias("w"), F.sum(F.col("kept").cast("int")).alias("k"), F.sum(F.when(F.col("kept"), F.col("tokens_n")).otherwise(0)).alias("kw"))
    y = x.groupBy("doc_id").agg(F.sum("n").alias("units"), F.sum("k").alias("kept"), F.round(F.sum("kw") / F.greatest(F.sum("w"), F.lit(1.0)) + 1e-9, 5).alias("kept_share"), F.max(F.struct("w", "class")).alias("m"))
    return y.select("doc_id", "units", "kept", "kept_share", F.col("m.class").alias("mostly"), F.when(F.col("kept") == 0, "no_knowledge_units").otherwise("").alias("reason"))


def class_feedback(spark, d):
    """O-276: leakage of page signs into kept units by class, and the weight that the next run gives the class."""
    x = UNITS.spark(_blocks(spark, d)).groupBy("class").agg(F.count("*").alias("units"), F.sum(F.col("kept").cast("int")).alias("kept"), F.sum("leaks").alias("leaks"))
    return x.select("class", "units", "kept", F.round(F.col("leaks") / F.greatest(F.col("kept"), F.lit(1)) + 1e-9, 5).alias("leakage"), F.round(F.greatest(F.lit(0.5), 1 - F.col("leaks") / F.greatest(F.col("kept"), F.lit(1))) + 1e-9, 5).alias("weight"))


QUERIES = {f.__name__: f for f in (knowledge_units, document_understanding, class_feedback)}
_U = UNITS.duck(_SRC)
ORACLE = {
    "knowledge_units": f"SELECT doc_id, block, {', '.join([*_picked(_VALUES), *_PLAIN])} FROM {_U}",
    "document_understanding": f"SELECT doc_id, units, kept, kept_share, mostly, CASE WHEN kept = 0 THEN 'no_knowledge_units' ELSE '' END AS reason FROM (SELECT doc_id, CAST(sum(n) AS BIGINT) AS units, CAST(sum(k) AS BIGINT) AS kept, round(sum(kw) / greatest(sum(w), 1.0) + 1e-9, 5) AS kept_share, max(struct_pack(w := w, class := class)).class AS mostly FROM (SELECT doc_id, class, count(*) AS n, sum(tokens_n) AS w, sum(CASE WHEN kept THEN 1 ELSE 0 END) AS k, sum(CASE WHEN kept THEN tokens_n ELSE 0 END) AS kw FROM {_U} GROUP BY 1, 2) GROUP BY 1)",
    "class_feedback": f"SELECT class, units, kept, round(leaks / greatest(kept, 1) + 1e-9, 5) AS leakage, round(greatest(0.5, 1 - leaks / greatest(kept, 1)) + 1e-9, 5) AS weight FROM (SELECT class, count(*) AS units, CAST(sum(CASE WHEN kept THEN 1 ELSE 0 END) AS BIGINT) AS kept, sum(leaks) AS leaks FROM {_U} GROUP BY 1)",
}
