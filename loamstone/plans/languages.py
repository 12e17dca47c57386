"""Languages of texts by function words and scripts, stated once for both engines: distribution, confidence, fragmentation, mixing, gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamstone.functions.sheet import Sheet
from loamstone.plans.evidence import _picked
from loamstone.sources.tables import spread, table

# Frequent function words by language, and the signs of scripts that name one.
WORDS = {
    "en": "the of and to in is that it was for are with as at by this have from or had not but were which their been has its would there",
    "de": "der die das und ist in den von zu mit sich des auf für nicht ein eine dem als auch es an werden aus er hat dass sie nach wird bei",
    "nl": "de het een en van is dat op te zijn met voor niet aan er om ook als bij maar uit door over ze naar nog wordt deze die",
    "fr": "le la les de des du un une et est en que qui dans pour pas sur au aux par plus ne se ce elle avec son sont cette",
    "es": "el la los las de del un una y es en que se por con para no su al lo como más pero sus este esta porque cuando muy",
    "pt": "o a os as de do da dos das um uma e é em que se por com para não sua seu ao na nos como mais mas foi são",
    "it": "il lo la i gli le di del della dei un una e è in nel nella che si per con non su al alla da come più ma anche sono",
}
SCRIPTS = {"ru": r"[\x{400}-\x{4FF}]", "hi": r"[\x{900}-\x{97F}]", "ar": r"[\x{600}-\x{6FF}]", "ja": r"[\x{3040}-\x{30FF}]", "zh": r"[\x{4E00}-\x{9FFF}]"}
LANGS = (*WORDS, *SCRIPTS)
SHARPNESS = 40.0  # how steeply a greater share of function words tells

_LATIN = r"[A-Za-z\x{C0}-\x{24F}]"
_ENTROPY = " + ".join(f"(CASE WHEN d_{k} >= 0.08 THEN -(d_{k} / act_sum) * log2(d_{k} / act_sum) ELSE 0.0 END)" for k in LANGS)
#: O-139 to O-145. Segments of one script are read together, weighted by their letters.
IDENTIFIED = Sheet([
    {
        "tw": lambda d: d.all("lower(text)", r"\p{L}+"), "n": "CAST(length(text) AS DOUBLE)", "letter_n": lambda d: d.n("text", r"\p{L}"), "symbol_n": lambda d: d.n("text", r"[^\p{L}\p{N}\s]"), "k_latin": lambda d: d.n("text", _LATIN),
        **{f"k_{k}": (lambda p: lambda d: d.n("text", p))(p) for k, p in SCRIPTS.items()},
    },
    {"tw_n": lambda d: f"greatest({d.size('tw')}, 1.0)", **{f"e_{k}": (lambda ws: lambda d: d.size(d.filter("tw", "x IN (" + ", ".join(f"'{w}'" for w in ws.split()) + ")")))(ws) for k, ws in WORDS.items()}},
    {f"z_{k}": f"exp({SHARPNESS} * (e_{k} - greatest({', '.join(f'e_{x}' for x in WORDS)})) / tw_n)" for k in WORDS} | {"told": f"greatest({', '.join(f'e_{x}' for x in WORDS)}) > 0", "han_ja": "CASE WHEN k_ja > 0 THEN k_zh ELSE 0.0 END", "script_sum": f"greatest(k_latin + {' + '.join(f'k_{k}' for k in SCRIPTS)}, 1.0)"},
    {f"p_{k}": f"CASE WHEN told THEN z_{k} / ({' + '.join(f'z_{x}' for x in WORDS)}) ELSE 0.0 END" for k in WORDS} | {"symbol_heavy": "n >= 4 AND letter_n < greatest(8.0, n * 0.12) AND symbol_n >= greatest(6.0, floor(n * 0.55))"},
    {f"d_{k}": f"CASE WHEN symbol_heavy THEN 0.0 ELSE p_{k} * k_latin / script_sum END" for k in WORDS}
    | {f"d_{k}": f"CASE WHEN symbol_heavy THEN 0.0 ELSE k_{k} / script_sum END" for k in ("ru", "hi", "ar")}
    | {"d_ja": "CASE WHEN symbol_heavy THEN 0.0 ELSE (k_ja + han_ja) / script_sum END", "d_zh": "CASE WHEN symbol_heavy THEN 0.0 ELSE (k_zh - han_ja) / script_sum END"},
    {
        "first_p": f"greatest({', '.join(f'd_{k}' for k in LANGS)})", "act_n": " + ".join(f"(CASE WHEN d_{k} >= 0.08 THEN 1 ELSE 0 END)" for k in LANGS), "act_sum": "greatest(" + " + ".join(f"(CASE WHEN d_{k} >= 0.08 THEN d_{k} ELSE 0.0 END)" for k in LANGS) + ", 1e-9)",
        "best": lambda d: d.max_of({k: f"d_{k}" for k in LANGS}), "many": " + ".join(f"(CASE WHEN d_{k} >= 0.28 THEN 1 ELSE 0 END)" for k in LANGS),
        "buckets": "(CASE WHEN k_latin >= 2 THEN 1 ELSE 0 END) + (CASE WHEN k_ru >= 2 THEN 1 ELSE 0 END) + (CASE WHEN k_hi >= 2 THEN 1 ELSE 0 END) + (CASE WHEN k_ar >= 2 THEN 1 ELSE 0 END) + (CASE WHEN k_ja + k_zh >= 2 THEN 1 ELSE 0 END)",
    },
    {"second_p": "greatest(" + ", ".join(f"CASE WHEN best = '{k}' THEN 0.0 ELSE d_{k} END" for k in LANGS) + ")", "fragmentation": f"CASE WHEN first_p <= 0 THEN 1.0 WHEN act_n <= 1 THEN 0.0 ELSE least(1.0, ({_ENTROPY}) / log2(CAST(act_n AS DOUBLE))) END"},
    {"confidence": "least(1.0, greatest(0.0, first_p * (0.5 + 0.5 * least(1.0, (first_p - second_p) / 0.4))))", "mixed": "buckets >= 2 OR many >= 2"},
    {"lang_found": "CASE WHEN first_p <= 0 OR (first_p < 0.25 AND confidence < 0.20 AND fragmentation >= 0.85) THEN 'und' ELSE best END"},
    {"gate": "CASE WHEN lang_found = 'und' THEN 'unknown_language' WHEN confidence < 0.55 THEN 'low_language_confidence' WHEN first_p < 0.35 THEN 'low_primary' WHEN fragmentation > 0.72 THEN 'language_fragmentation' ELSE 'ok' END", "english": "lang_found = 'en' AND confidence >= 0.55"},
])
_OUT = ["confidence", "first_p", "second_p", "fragmentation"]
_PLAIN = ["lang_found", "mixed", "gate", "english"]


def language_assessments(spark, d):
    """O-139 to O-145: language, confidence, fragmentation, mixing and gate of every record of several languages."""
    t = table(spark, d, "redteam_multilingual").where("text is not null and length(text) > 0").select("id", "text").distinct()
    return IDENTIFIED.spark(t).selectExpr("id", *_picked(_OUT), *_PLAIN)


def document_languages(spark, d):
    """O-116, O-139, O-144, O-151: documents by label, language found and gate."""
    t = spread(table(spark, d, "documents").where("text is not null and length(text) > 0").select("doc_id", "lang", "text"))
    x = IDENTIFIED.spark(t).groupBy("lang", "lang_found", "gate")
    return x.agg(F.count("*").alias("documents"), F.round(F.avg("confidence") + 1e-9, 4).alias("confidence"), F.sum(F.col("mixed").cast("int")).alias("mixed"))


QUERIES = {f.__name__: f for f in (language_assessments, document_languages)}
ORACLE = {
    "language_assessments": f"SELECT id, {', '.join([*_picked(_OUT), *_PLAIN])} FROM {IDENTIFIED.duck('(SELECT DISTINCT id, text FROM redteam_multilingual WHERE text IS NOT NULL AND length(text) > 0)')}",
    "document_languages": f"SELECT lang, lang_found, gate, count(*) AS documents, round(avg(confidence) + 1e-9, 4) AS confidence, CAST(sum(CASE WHEN mixed THEN 1 ELSE 0 END) AS BIGINT) AS mixed FROM {IDENTIFIED.duck('(SELECT doc_id, lang, text FROM documents WHERE text IS NOT NULL AND length(text) > 0)')} GROUP BY 1, 2, 3",
}
