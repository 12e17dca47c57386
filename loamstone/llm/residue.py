"""Problem 1: template residue, error pages and filler in place of content.

A multi-pattern automaton (Aho-Corasick) finds error, script-required and
filler phrases of several languages in every text; a sentence is matched when
its phrases make up enough of it, and a text is excluded when matched
sentences cover at least half of it. Filler in no language is told by the
printers' words it is mixed from and the lack of any function word. Slots of templates that
were left unfilled are found by their delimiters, outside code and quotes.

Null and blank texts are never cases. A repeated id is one record.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstone.functions.arrow import flat_map
from loamstone.llm.language import FUNCTION_WORDS
from loamstone.sources.tables import spread, table

#: Phrases of error and access messages, notices that scripts must run, and filler, lower case.
ERROR_PHRASES = """
not found|403 forbidden|500 internal server|502 bad gateway|503 service|page not found|not found on this server
does not exist on this server|withdrawn or never existed|document you asked for|no longer exists|has been removed or
could not find that page|it may have moved or been removed|cannot be found|the page you requested|page does not exist
too many requests|slow down and retry|request blocked|contact the site owner|access denied|do not have permission to view
permission denied|you are not authorized|you are not authorised|rate limit exceeded|temporarily unavailable
while we carry out maintenance|down for maintenance|bad gateway|upstream host closed|gateway timeout|timed out after
connection timed out|connection reset|connection refused|something went wrong|an unexpected error|internal error
please try again later|session has expired|please sign in again|sign in to continue|could not connect to database
warning: could not connect|fatal error|uncaught exception|traceback|in render(|in handle(|error code|no results. the article
the article has been deleted|has been deleted by its author|content is not available in your|not available in your region
checking your browser|this may take a few seconds|prove that you are human|are you a robot|tick the box below|verify you are human
loading...|please wait|ein interner fehler|seite nicht gefunden|bitte prüfen sie die adresse|zugriff verweigert|zu viele anfragen
dienst vorübergehend nicht|erreur 4|erreur 5|cette page est introuvable|page introuvable|accès refusé|une erreur est survenue
erreur interne|la página solicitada no existe|página no encontrada|ha cambiado de lugar|acceso denegado|error interno
demasiadas solicitudes|pagina non trovata|accesso negato|errore interno|página não encontrada|acesso negado|erro interno
pagina niet gevonden|toegang geweigerd|interne fout|страница не найдена|доступ запрещен|внутренняя ошибка|页面不存在|访问被拒绝
服务器错误|ページが見つかりません|アクセスが拒否|الصفحة غير موجودة|पृष्ठ नहीं मिला
"""
SCRIPT_PHRASES = """
enable javascript|javascript is required|javascript is disabled|javascript disabled|requires javascript|turn on javascript
js disabled|redirecting to the basic version|needs scripting switched on|turn on scripts|scripts are required|allow scripts
noscript|browser is out of date|browser is not supported|update it to read|browser has scripts turned off|scripting is disabled
javascript aktivieren|aktivieren sie javascript|activer javascript|activar javascript|active javascript|habilite o javascript
ativar o javascript|ativar javascript|abilita javascript|attivare javascript|attiva javascript|schakel javascript|javascript in te schakelen
включите javascript|启用 javascript|启用javascript|javascriptを有効|javascript सक्षम|تفعيل javascript|تمكين javascript
"""
FILLER_PHRASES = """
your text goes here|text goes here|lorem ipsum|body copy|heading one|heading two|heading three|todo write|tbd - copy|copy to follow
coming soon: content|content for this section|add a short description|in this space|placeholder article|nothing to see yet
sample paragraph|replace this wording|before going live|insert text here|click to edit|default description|sample text|dummy text
hier steht ihr text|blindtext|texte à remplacer|votre texte ici|su texto aquí|texto de ejemplo|il tuo testo qui|seu texto aqui
"""
#: Single words that fill a layout, and the scrambled Latin that printers use for it.
FILLER_WORDS = frozenset(
    "foo bar baz qux asdf jkl qwerty blah test xxx xxxx xxxxx lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor"
    " incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo"
    " consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non"
    " proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
#: Lines that go along with an error message.
AUX_PHRASES = ("go back", "try our search", "return to the start page", "return to the home page", "reference:", "zurück", "retour", "volver")
#: The delimiters of slots for values in common template languages and mail-merge tools.
SLOT = re.compile(
    r"\{\{[^{}\n]*\}?\}|\$\{[^{}\n]*\}|#\{[^{}\n]*\}|\{%[^%\n]*%\}|<%=?[^%\n]*%>|%%\w+%%|\*\|\w+\|\*|\[\[\w[\w .]*\]\]"
    r"|<<\w+>>|@@\w+@@|\$\(\w[\w.]*\)|(?<!\w)~\w{2,}~(?!\w)|&lt;\w[\w .]*&gt;|<\w+_GOES_HERE>|\[(?:INSERT|insert|Insert)\s[^\]\n]+\]"
    r"|\[(?:YOUR|Your|your)\s[^\]\n]+\]|\[(?:NAME|Name|DATE|TITLE|CITY|COMPANY|ADDRESS|EMAIL|PHONE|FIRST_NAME|FIRST NAME|LAST NAME)\]|(?<!\w)__[A-Z]+(?:_[A-Z]+)*__(?!\w)"
    r"|(?<![\w{])\{\w+(?:\.\w+)?\}(?!\w)|(?<!\w)%[sd](?!\w)|\[object Object\]"
    r"|(?-i:<(?!(?:HTML|HEAD|BODY|DIV|SPAN|TABLE|TBODY|THEAD|TITLE|SECTION|ARTICLE|STRONG|IMG|PRE|CODE|NAV|FOOTER|HEADER|MAIN)>)[A-Z]{3,}(?:_[A-Z]+)*>)",
    re.IGNORECASE,
)
#: Words printed for a missing value; they count as a slot only where a value belongs.
EMPTY_VALUE = re.compile(r"(?:^|\b(?:to|on|in|by|about|about|costs|since|hello|dear|at|with|user|and|question:|answer:|\|\s*published))\s*[#>*-]*\s*(?:undefined|nan|null|none)\b(?=\s*(?:$|[.,!?|]|in\b|per\b|and\b|your\b|to\b|on\b|by\b|since\b|answer))", re.IGNORECASE | re.MULTILINE)
#: Words by which a text speaks of slots instead of leaving one unfilled.
META = re.compile(r"\b(?:template engine|templates?|placeholders?|braces|format call|merge tags?)\b", re.IGNORECASE)
CODE = re.compile(r"```.*?(?:```|\Z)|`[^`\n]*`", re.DOTALL)
QUOTED = re.compile(r"\"[^\"\n]+\"|“[^”\n]+”|«[^»\n]+»")
#: Letters of a sentence for each letter of a phrase in it, beyond which the sentence only mentions it.
REACH = 16
TAG = re.compile(r"</?(?:p|div|span|br|b|i|em|strong|h[1-6]|a|ul|ol|li|section|article|body|html|head|title|main|noscript)\b[^<>\n]*>", re.IGNORECASE)
UNIT = re.compile(r"(?<=[.!?。！？।])\s+|\n+")
WORD = re.compile(r"[^\W_]+")


def _phrases(text: str) -> list[str]:
    return [p.strip() for line in text.strip().splitlines() for p in line.split("|") if p.strip()]


@lru_cache(1)
def living_words() -> frozenset[str]:
    """Function words of living languages that scrambled Latin does not use as well."""
    return frozenset(w for text in FUNCTION_WORDS.values() for w in text.split()) - FILLER_WORDS


def is_filler_text(words: list[str]) -> bool:
    """A text in no language that draws on the printers' words: whatever stands between them was made up to fill."""
    known = [w for w in words if w in FILLER_WORDS]
    return len(known) >= 0.1 * len(words) and len(set(known)) >= 2


@lru_cache(1)
def automaton():
    """The phrases of all kinds in one automaton; each hit gives its kind and length."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, phrases in (("error", _phrases(ERROR_PHRASES)), ("script", _phrases(SCRIPT_PHRASES)), ("filler", _phrases(FILLER_PHRASES))):
        for p in phrases:
            a.add_word(p, (kind, len(p)))
    for p in AUX_PHRASES:
        a.add_word(p, ("aux", len(p)))
    a.make_automaton()
    return a


#: Signs without which there is no slot, and words printed for a missing value.
SLOT_SIGN = re.compile(r"[{%<\[*@~$&_]|undefined|nan|null|none", re.IGNORECASE)


@lru_cache(1)
def printers_words() -> frozenset[str]:
    """Filler words that no living language uses as a function word."""
    return FILLER_WORDS - frozenset(w for text in FUNCTION_WORDS.values() for w in text.split())


def may_be_residue(text: str) -> bool:
    """Whether a text holds anything of residue at all: a phrase, the sign of a slot, a printers' word. Most texts hold none."""
    low = " ".join(text.lower().split())
    return next((True for _, v in automaton().iter(low) if v[0] != "aux"), False) or SLOT_SIGN.search(text) is not None or not printers_words().isdisjoint(WORD.findall(low))


def measure(text: str | None) -> tuple[float, int, str | None]:
    """Coverage of matched sentences, number of unfilled slots, and kind of the most covered class (None: no case)."""
    if text is None or not text.strip() or not may_be_residue(text):
        return 0.0, 0, None
    plain = TAG.sub(" ", CODE.sub(" ", text))
    scan = QUOTED.sub(" ", plain)
    slots = 0
    for unit in UNIT.split(scan):
        n = len(SLOT.findall(unit)) + len(EMPTY_VALUE.findall(unit))
        if n and not META.search(unit):
            slots += n
    covered = {"error": 0, "script": 0, "filler": 0}
    content = 0
    a = automaton()
    units = [(unit, " ".join(QUOTED.sub(" ", unit).lower().split())) for unit in UNIT.split(plain)]
    units = [(unit, low, words) for unit, low in units if (words := WORD.findall(low))]
    made_up = is_filler_text([w for _, _, words in units for w in words])
    for unit, low, words in units:
        size = len("".join(words))
        hits = [v for _, v in a.iter(low)]
        kinds = [k for k, _ in hits]
        filler = sum(w in FILLER_WORDS for w in words)
        main = [k for k in kinds if k != "aux"]
        if main and size <= REACH * sum(n for k, n in hits if k != "aux"):
            covered[main[0]] += size
        elif filler >= 0.6 * len(words) and (filler >= 2 or len(words) == 1 and len(low) > 3):
            covered["filler"] += size
        elif made_up and len(words) >= 3 and living_words().isdisjoint(words):
            covered["filler"] += size
        elif "aux" in kinds and len(words) <= 8:
            continue
        elif len(words) >= 6 or (unit.rstrip()[-1:] in ".!?。！？।" and len(words) >= 3) or size > 40:
            content += size
    hit = sum(covered.values())
    coverage = hit / (hit + content) if hit else 0.0
    kind = max(covered, key=covered.get) if coverage >= 0.5 else None
    if kind is None and slots:
        kind = "slot"
    return coverage, slots, kind


def residue_scores(df: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, coverage, slots, kind) of every record; kind is null where the record is to be kept.

    One narrow pass, no shuffle but the one that joins repeats of an id.
    """
    out = flat_map(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), lambda: lambda i, t: [(i, *measure(t))], "id string, coverage double, slots int, kind string")
    return out.groupBy("id").agg(F.max("coverage").alias("coverage"), F.max("slots").alias("slots"), F.max("kind").alias("kind"))


def drop_residue(df: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """The records of df without those that hold residue; columns as given, records without an id are kept."""
    bad = residue_scores(df, id_col, text_col).where("kind is not null").select(F.col("id").alias("_residue_id"))
    return df.join(bad, df[id_col] == bad["_residue_id"], "left_anti")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue_scores(spread(table(spark, sf_dir, "cleaning_golden").select("id", "text"))).where("kind is not null and id is not null").select("id")


def p1_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by kind of residue, against the partial labels of the table."""
    t = table(spark, sf_dir, "cleaning_golden")
    labels = t.groupBy("id").agg(F.max("expect_clean").alias("expect_clean"))
    return residue_scores(t).join(labels, "id").groupBy("kind", "expect_clean").agg(F.count("*").alias("records"), F.sum("slots").alias("slots"))
