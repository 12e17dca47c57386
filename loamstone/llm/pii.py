"""Problem 4: personal information inside free text, replaced by typed placeholders.

Regular expressions propose spans; checksum validators (Luhn, mod 97, mod 23
letters, mod 11,10) confirm numbers; words near a span raise or lower its
score, and spans of 0.5 and more are taken. Names need the lexicon, which is
widened from the corpus by grouped aggregation: a word that stands beside
known given or family names in the manner of one becomes known itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstone.functions.arrow import flat_map
from loamstone.sources.tables import spread, table, written

#: Digits and signs of other scripts, one for one, so that positions stay.
ASCII_SIGNS = {**{ord(c): str(k % 10) for k, c in enumerate("٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹०१२३४५६७८९０１２３４５６７８９")}, ord("＋"): "+", ord("＠"): "@", ord("．"): ".", ord("－"): "-", ord("‐"): "-", ord("‑"): "-", ord("–"): "-", ord(" "): " ", ord(" "): " ", ord("（"): "(", ord("）"): ")"}

EMAIL = re.compile(
    r"(?<![\w.+@-])(?P<local>\w(?:[\w.+'-]{0,62}\w)?)(?:\s?@\s?|\s?[\[(]\s?at\s?[\])]\s?)(?P<domain>[\w-]+(?:(?:\.|\s?[\[(]\s?dot\s?[\])]\s?)[\w-]+)+)(?![\w@])",
    re.IGNORECASE,
)
AT = re.compile(r"[\[(]\s?at\s?[\])]", re.IGNORECASE)
PLACEHOLDER_LOCAL = {"user", "username", "name", "your", "you", "yourname", "someone", "email", "address", "foo", "xxx", "local"}
PLACEHOLDER_DOMAIN = re.compile(r"^(?:domain|your-?\w*|host|example|sample|test|site|company|server)\.(?:tld|com|org|net|ext|example|xxx)$", re.IGNORECASE)
PHONE = re.compile(
    r"(?<![\w.+/-])(?:"
    r"(?:\+|00)\d{1,3}[ .\-/]?(?:\(0?\d{0,4}\)[ .\-]?)?\d{1,5}(?:[ .\-/]?\d{2,8}){1,6}"  # with a country code
    r"|(?:1[ .\-])?\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}"  # (area) exchange-number
    r"|(?:1[ .\-])?\d{3}[.\-]\d{3}[.\-]\d{4}"  # area-exchange-number
    r"|\(?0\d{1,5}\)?[ /\-]\d{2,8}(?:[ \-]\d{2,5}){0,4}"  # national, leading 0
    r"|0\d(?:[ .]\d{2}){4}"
    r")(?![\w]|[-./]\d)"
)
PHONE_NEAR = re.compile(r"\b(?:call|text|cell|office|phone|tel|telephone|mobile|fax|ring|reach|contact|gave|line|on|at|llama|llame|al|appelez|le|telefonisch|unter|telefon|handy|ou|or|o|oder|teléfono|téléphone)\b[\s:.]*(?:\w+\s)?$", re.IGNORECASE)
NOT_NUMBER = re.compile(r"\b(?:part number|part no|order code|order|build|release|version|section|ratios?|host|isbn|issn|article|invoice|serial|model|figure|table|item|sku|port|code)\s*(?:no\.?|number|is|of|:|#)?\s*(?:\d[\d.:-]*\s(?:and|to)\s)?$", re.IGNORECASE)
ID_WORDS = (
    r"identity (?:card|number|no\.?)|national (?:id|identity|insurance)(?: number| no\.?)?|passport(?: number| no\.?)?|insurance (?:number|no\.?)|tax (?:number|id|no\.?)|social (?:security )?(?:number|no\.?)"
    r"|(?:my )?ssn|nino|driving licen[cs]e(?: number| no\.?)?|id (?:card|number|no\.?)|personalausweis\w*|ausweisnummer|reisepass\w*|steuer(?:nummer|-?id)|sozialversicherungsnummer|dni|nie|nif|pasaporte|numéro de sécurité sociale|carte d'identité|passeport|codice fiscale|iban|credit card|card number|account number"
)
ID_NUMBER = re.compile(
    r"(?<![\w.+])(?:[A-Z]{2}\s?\d{2}\s?\d{2}\s?\d{2}\s?[A-Z]|[A-Z]{2}\d{2}(?:\s?[A-Z0-9]{4}){2,7}(?:\s?[A-Z0-9]{1,3})?|[A-Z]\s?-?\d{6,9}\s?-?[A-Z]|\d{7,9}\s?-?[A-Z]|[A-Z]{1,2}\d{6,9}"
    r"|\d{3}[- ]\d{2}[- ]\d{4}|\d{2,3}/\d{3,5}/\d{3,5}|\d{2}(?: \d{3}){3}|\d{4}(?:[ -]\d{4}){3}|\d(?:[ /.-]?\d){6,18})(?![\w]|[-/]\d)",
    re.IGNORECASE,
)
ID_BEFORE = re.compile(r"\b(?:" + ID_WORDS + r")\s*(?:is|ist|es|est|:|#|no\.?|number|nummer)?\s*[:#(]?\s*$", re.IGNORECASE)
CITY_AFTER = re.compile(r"^(?:,? (?:Apt|Flat|Unit|Suite|Appt|Apartment)\.? ?\d+[a-z]?)?,? ?(?:\d{4,5} )?[A-ZÀ-Þ]\w+")
ADDRESS_NEAR = re.compile(r"\b(?:lives? at|ship to:?|moved to|back to|signed,.{0,60}|wohnhaft|habite|está en|address:?|adresse:?|deliver to|send to|resid\w+ (?:at|in)|at|to|en|in)\s*$", re.IGNORECASE | re.DOTALL)
UNIT = r"(?:(?:Flat|Apt|Apartment|Unit|Suite|Room|Wohnung|Appt|Piso)\.? ?\d{1,4}[a-z]?, ?)?"
STREET = "Street|Lane|Way|Road|Avenue|Drive|Court|Terrace|Close|Square|Place|Crescent|Row|Hill|Boulevard|Grove|Gardens|Mews|Parade|Alley|Walk|St|Rd|Ave|Ln|Dr|Ct|Blvd"
ADDRESS = re.compile(
    r"(?<![\w/.,-])(?:"
    + UNIT + r"\d{1,4}[a-z]?,? (?:[A-ZÀ-Þ][\w'’-]* ){1,4}(?:" + STREET + r")\b"
    r"|" + UNIT + r"\d{1,4}[a-z]?(?: (?:bis|ter))?,? (?:rue|avenue|chemin|boulevard|place|allée|impasse|quai|route|cours|sentier|square)(?: (?:du|de|des|la|le|les|l'|d'))*[ ]?(?:de |du |des |la |l'|d')?[A-ZÀ-Þ][\w'’-]+(?: [A-ZÀ-Þ][\w'’-]+)?"
    r"|(?:Calle|Avenida|Plaza|Paseo|Camino|Carrera|Ronda|Travesía|Rua|Via|Viale|Piazza|Corso|Largo)(?: (?:del|de|della|dei|do|da|dos|la|las|los|el))* [A-ZÀ-Þ][\w'’-]+(?: [A-ZÀ-Þ][\w'’-]+)?,? \d{1,4}[a-z]?\b"
    r"|[A-ZÄÖÜ][a-zäöüß]*(?:straße|strasse|weg|gasse|allee|platz|ring|ufer|damm|steig|straat|laan|gracht|plein)\.? \d{1,4} ?[a-z]?\b"
    r"|(?:Am|An der|An den|Im|Zum|Zur|Auf dem|Auf der|Unter den|Hinter dem|Bei der) [A-ZÄÖÜ][\wäöüß-]+ \d{1,4}[a-z]?\b"
    r")"
)
PARTICLE = r"(?:(?:van der|van den|van de|von der|de la|del|della|de|von|van|da|di|du|le|la|ter|ten|bin|al)\s)?"
TOKEN = r"[A-ZÀ-ÞŠŽČŚŁŃ][\w'’]*(?:-[A-ZÀ-Þ][\w'’]*)*"
PAIR = re.compile(rf"(?<![\w'’.-])(?=({TOKEN}) (?:[A-ZÀ-Þ]\. )?({PARTICLE}{TOKEN}))")
CAPITAL = re.compile(rf"(?<![\w'’-]){TOKEN}")
ANY = r"[^\W\d_][\w'’-]*"
#: given [initial] family; family, given; initial family: proposals, of any case.
FULL = re.compile(rf"(?<![\w'’@.+-])(?=(?P<a>{ANY}) (?:(?P<m>[A-ZÀ-Þ])\. )?(?P<b>{PARTICLE}{ANY})(?![\w@]))", re.IGNORECASE)
TURNED = re.compile(rf"(?<![\w'’@.+-])(?=(?P<b>{PARTICLE}{ANY}), (?P<a>{ANY})(?![\w@]))", re.IGNORECASE)
INITIAL = re.compile(rf"(?<![\w'’@.+-])(?=(?P<i>[A-ZÀ-Þ]\.(?: ?[A-ZÀ-Þ]\.)?) ?(?P<b>{PARTICLE}{ANY})(?![\w@]))", re.IGNORECASE)
NAME_WORD = re.compile(ANY)
DIGIT = re.compile(r"\d")
#: Words that a name can hold before its known one: an initial or two and a particle of two words.
AHEAD = 4
PARTICLES = frozenset("van der den de von la del della da di du le ter ten bin al".split())
TITLE = frozenset("mr mrs ms miss dr prof sir madam herr frau monsieur madame señor señora sr sra contact signed account holder as by for and the".split())
NAME_BEFORE = re.compile(r"(?:\b(?:contact|signed,|opened by|export for|account holder|as|by|for|hat|(?:el )?(?:lunes|martes|miércoles|jueves|viernes)|aparato es de|appartient à|gehört|dear|from|ask for|regards,|sincerely,|mr\.?|mrs\.?|ms\.?|dr\.?|prof\.?|herr|frau|m\.|mme\.?))\s*(?:(?:dr|prof|ms|mr|mrs)\.?\s)*$", re.IGNORECASE)
NAME_AFTER = re.compile(r"^(?:,? (?:pointed out|fixed|wrote|said|lists|on [+(\d]|lives|wohnhaft|qui habite|y está|den |revisó|asked|reported|replied|opened|noticed)|,? ?\(|, (?:\d|Flat|Apt|Calle|Avenida|ID|national|tax|my |insurance|passport|identity|social))", re.IGNORECASE)
THING_AFTER = re.compile(r"^(?:'s)? (?:scheduler|dataset|bridge|street|library|algorithm|method|award|institute|hall|museum|river|station|theorem|test|protocol|model|valley|school|prize|foundation|index|engine|framework|server|cluster|project|release|district|park|road|lane|square)\b", re.IGNORECASE)
#: Names that are handed to every task (about 1 MB); beyond, they are joined by word.
HELD = 50_000
KINDS = ("email", "phone", "id_number", "address", "name")


def luhn(digits: str) -> bool:
    """Checksum of payment cards."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (2 if k % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Checksum of bank account numbers with a country code."""
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def letter23(code: str) -> bool:
    """Check letter of eight digits (or X, Y, Z and seven) modulo 23."""
    digits = code[:-1].translate(str.maketrans("XYZ", "012"))
    return digits.isdigit() and "TRWAGMYFPDXBNJZSQVHLCKE"[int(digits) % 23] == code[-1]


def mod11_10(digits: str) -> bool:
    """Recursive check digit of eleven-digit tax numbers."""
    p = 10
    for c in digits[:-1]:
        s = (int(c) + p) % 10 or 10
        p = s * 2 % 11
    return (11 - p) % 10 == int(digits[-1])


def number_score(raw: str) -> float:
    """How far the form and checksum of a number speak for an identity number."""
    code = re.sub(r"[\s/.\-]", "", raw).upper()
    digits = re.sub(r"\D", "", code)
    if re.fullmatch(r"[A-Z]{2}\d{6}[A-D]", code):
        return 0.6
    if re.fullmatch(r"[XYZ]?\d{7,8}[A-Z]", code) and len(code) == 9:
        return 0.6 if letter23(code) else 0.2
    if re.fullmatch(r"[A-Z]{2}\d{2}[A-Z0-9]{11,30}", code):
        return 0.7 if mod97(code) else 0.0
    if re.fullmatch(r"\d{13,19}", code):
        return 0.7 if luhn(code) else 0.0
    if re.fullmatch(r"\d{11}", code) and re.fullmatch(r"\d{2}(?: \d{3}){3}", raw):
        return 0.6 if mod11_10(code) else 0.25
    if re.fullmatch(r"\d{3}-\d{2}-\d{4}", raw):
        return 0.5
    if re.fullmatch(r"\d{2}/\d{4}/\d{3}", raw):
        return 0.3
    return 0.2 if 6 <= len(digits) <= 18 else 0.0


@lru_cache(4)
def known_words(given: frozenset[str], family: frozenset[str]) -> frozenset[str]:
    """Words by which a name can be known: given names and the last words of family names."""
    return given | {w.rpartition(" ")[2] for w in family}


def name_starts(t: str, given: frozenset[str], family: frozenset[str]) -> list[int]:
    """Where a name with a known word can begin: at most AHEAD words before it. Names are tried there and nowhere else."""
    known = known_words(given, family)
    if known.isdisjoint(NAME_WORD.findall(t.lower())):
        return []
    words = [(m.start(), m[0].lower()) for m in NAME_WORD.finditer(t)]
    at: set[int] = set()
    for k, (_, w) in enumerate(words):
        if w in known:
            at.update(range(max(0, k - AHEAD), k + 1))
    return [words[k][0] for k in sorted(at)]


def spans(text: str | None, given: frozenset[str], family: frozenset[str]) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of every confirmed item, in order and without overlap; none for null or blank texts."""
    if text is None or not text.strip():
        return []
    t = text if text.isascii() else text.translate(ASCII_SIGNS)
    found: list[tuple[str, int, int, float]] = []

    for m in EMAIL.finditer(t) if "@" in t or AT.search(t) else ():
        local, domain = m["local"].lower(), re.sub(r"\s?[\[(]\s?dot\s?[\])]\s?", ".", m["domain"].lower())
        score = 0.8
        if local in PLACEHOLDER_LOCAL and (PLACEHOLDER_DOMAIN.match(domain) or not re.search(r"\.(?:test|example|[a-z]{2,})$", domain)):
            score = 0.1
        if re.search(r"\b(?:of the form|such as|format|sample|placeholder|never a true)\b", t[max(0, m.start() - 30) : m.start()], re.IGNORECASE):
            score -= 0.5
        found.append(("email", m.start(), m.end(), score))
    figures = bool(DIGIT.search(t))
    for m in ADDRESS.finditer(t) if figures else ():
        score = 0.35 + (0.3 if CITY_AFTER.match(t[m.end() : m.end() + 60]) else 0) + (0.2 if ADDRESS_NEAR.search(t[max(0, m.start() - 80) : m.start()]) else 0)
        found.append(("address", m.start(), m.end(), score))
    for m in ID_NUMBER.finditer(t) if figures else ():
        before = t[max(0, m.start() - 60) : m.start()]
        score = number_score(m[0]) + (0.5 if ID_BEFORE.search(before) else 0) - (0.5 if NOT_NUMBER.search(before) else 0)
        if not ID_BEFORE.search(before):
            score -= 0.1
            if re.search(r"[a-z]", m[0]):
                score = 0.0
        found.append(("id_number", m.start(), m.end(), score))
    for m in PHONE.finditer(t) if figures else ():
        digits = re.sub(r"\D", "", m[0])
        before = t[max(0, m.start() - 40) : m.start()]
        score = (0.5 if 9 <= len(digits) <= 15 else 0.0) + (0.2 if PHONE_NEAR.search(before) else 0) - (0.5 if NOT_NUMBER.search(before) or ID_BEFORE.search(before) else 0)
        found.append(("phone", m.start(), m.end(), score))
    starts = name_starts(t, given, family)
    for m in filter(None, (FULL.match(t, k) for k in starts)):
        a, b = m["a"], m["b"]
        ka, kb = a.lower() in given, b.lower() in family
        if not (ka or kb) or a.lower() in TITLE:
            continue
        start, end = m.start("a"), m.end("b")
        near = bool(NAME_BEFORE.search(t[max(0, start - 40) : start])) + bool(NAME_AFTER.match(t[end : end + 40]))
        capital = a[:1].isupper() and b.split()[-1][:1].isupper()
        score = 0.4 * (ka + kb) + 0.15 * near + (0.0 if capital or (ka and kb) else -0.5)
        if THING_AFTER.match(t[end : end + 24]) or re.search(r"\b[Tt]he\s$", t[max(0, start - 4) : start]):
            score -= 0.6
        found.append(("name", start, end, score))
    for m in filter(None, (TURNED.match(t, k) for k in starts)):
        a, b = m["a"], m["b"]
        ka, kb = a.lower() in given, b.lower() in family
        if not (ka and kb):
            near = NAME_BEFORE.search(t[max(0, m.start() - 40) : m.start()]) and a[:1].isupper() and b.split()[-1][:1].isupper()
            if not (near and (ka or kb)):
                continue
        found.append(("name", m.start(), m.end("a"), 0.75))
    for m in filter(None, (INITIAL.match(t, k) for k in starts)):
        if m["b"].lower() in family and m["i"][0].isupper():
            found.append(("name", m.start(), m.end("b"), 0.7))
    rank = {k: n for n, k in enumerate(("email", "id_number", "phone", "address", "name"))}
    out: list[tuple[str, int, int, float]] = []
    for x in sorted((x for x in found if x[3] >= 0.5), key=lambda x: (rank[x[0]], -x[3], x[1] - x[2], x[1])):
        if all(x[2] <= y[1] or x[1] >= y[2] for y in out):
            out.append(x)
    return sorted(out, key=lambda x: x[1])


def redact(text: str | None, items: list[tuple[str, int, int, float]]) -> str | None:
    """The text with every item replaced by its placeholder, as [EMAIL]."""
    if text is None:
        return None
    out, at = [], 0
    for kind, a, b, _ in items:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def counted_once(docs: DataFrame) -> DataFrame:
    """docs (id, text) with the number of rows that are the same record, so that counts can be divided by it.

    Only hashes are shuffled, and only those of repeated rows are joined back.
    """
    d = docs.select("id", "text").withColumn("key", F.xxhash64("id", "text"))
    again = written(d.groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1"), "copies")
    return d.join(again, "key", "left").select("id", "text", F.coalesce("copies", F.lit(1)).alias("copies"))


def widen_lexicon(docs: DataFrame, lexicon: DataFrame, rounds: int = 3, least: int = 2) -> DataFrame:
    """(kind, w): given (g) and family (f) names, of the lexicon and of what the corpus shows beside its names; all of them.

    A capitalised word is taken when it stands at least `least` times beside a
    known name as its other half and at least a third of its uses are such.
    The names of every round are written, so their number is not bounded.
    """

    def pairs(t, copies):
        got: dict[tuple[str, str], int] = {}
        for m in PAIR.finditer(t or ""):
            key = (m[1].lower(), m[2].lower())
            got[key] = got.get(key, 0) + 1
        for m in CAPITAL.finditer(t or ""):
            key = (m[0].lower(), "")
            got[key] = got.get(key, 0) + 1
        return [(a, b, n / copies) for (a, b), n in got.items()]

    kind = F.when(F.col("kind") == "given", "g").when(F.col("kind") == "family", "f")
    known = written(lexicon.where("name is not null").select(kind.alias("kind"), F.lower("name").alias("w")).where("kind is not null").distinct(), "names")
    size = known.count()
    counts = flat_map(counted_once(docs).select("text", "copies"), lambda: pairs, "a string, b string, n double").groupBy("a", "b").agg(F.round(F.sum("n")).cast("bigint").alias("n"))
    counts = written(counts, "name_pairs")
    single = counts.where("b = ''").select(F.col("a").alias("key"), F.col("n").alias("uses"))
    two = counts.where("b <> ''")
    for _ in range(rounds):
        g, f = known.where("kind = 'g'").select(F.col("w").alias("a")), known.where("kind = 'f'").select(F.col("w").alias("b"))
        new_f = two.join(g, "a").groupBy(F.col("b").alias("w")).agg(F.sum("n").alias("n")).withColumn("kind", F.lit("f"))
        new_g = two.join(f, "b").groupBy(F.col("a").alias("w")).agg(F.sum("n").alias("n")).withColumn("kind", F.lit("g"))
        cand = new_f.unionByName(new_g).where(F.col("n") >= least).where("length(w) > 1").where(~F.col("w").isin(*TITLE, *PARTICLES))
        # a name of several words has its own count; else that of the single word
        last = cand.withColumn("key", F.element_at(F.split("w", " "), -1))
        kept = last.join(single, "key", "left").where("3 * n >= coalesce(uses, n)").select("kind", "w")
        known = written(known.unionByName(kept).distinct(), "names")
        before, size = size, known.count()
        if size == before:
            break
    return known


def candidates(text: str | None) -> set[str]:
    """Every word of a text that may be looked up as a name."""
    t = text or ""
    return {m[k].lower() for p, ks in ((FULL, "ab"), (TURNED, "ab"), (INITIAL, "b")) for m in p.finditer(t) for k in ks}


def with_names(docs: DataFrame, names: DataFrame, f: Callable[..., list[tuple]], schema: str) -> DataFrame:
    """f(id, text, given, family) over docs (id, text); the way the names reach a text changes no result.

    Up to HELD names go to every task. More of them are joined to the words of
    each distinct text, and a text gets those that stand in it.
    """
    if names.count() <= HELD:
        rows = names.collect()
        given, family = (frozenset(r["w"] for r in rows if r["kind"] == k) for k in "gf")
        return flat_map(docs, lambda: lambda i, t: f(i, t, given, family), schema)
    d = docs.withColumn("key", F.sha2("text", 256))
    words = flat_map(d.select("key", "text").dropDuplicates(["key"]), lambda: lambda k, t: [(k, w) for w in candidates(t)], "key string, w string")
    own = words.join(names, "w").groupBy("key").agg(F.collect_list(F.when(F.col("kind") == "g", F.col("w"))).alias("given"), F.collect_list(F.when(F.col("kind") == "f", F.col("w"))).alias("family"))
    d = d.join(own, "key", "left").select("id", "text", "given", "family")
    return flat_map(d, lambda: lambda i, t, g, n: f(i, t, frozenset(g or ()), frozenset(n or ())), schema)


def find_pii(docs: DataFrame, lexicon: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, kind, start_pos, end_pos, score) of every item; repeated rows of an id count once."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = lambda i, t, given, family: [(i, *x) for x in spans(t, given, family)]
    return with_names(d, widen_lexicon(d, lexicon), found, "id string, kind string, start_pos int, end_pos int, score double").distinct()


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(spread(table(spark, sf_dir, "redteam_qa").select("id", "text")), table(spark, sf_dir, "name_lexicon")).where("id is not null").select("id", "kind", "start_pos").distinct()


def p4_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with placeholders in place of its items."""
    d = spread(table(spark, sf_dir, "redteam_qa").select("id", "text"))

    def one(i, t, given, family):
        items = spans(t, given, family)
        return [(i, redact(t, items), len(items))]

    return with_names(d, widen_lexicon(d, table(spark, sf_dir, "name_lexicon")), one, "id string, redacted string, redactions int").distinct()


def p4_per_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items per run of 25 records beside redactions_applied of the latest row of that run."""
    runs = table(spark, sf_dir, "pii_run_stats").where("run_id is not null").groupBy("run_id").agg(F.max("first_id").alias("first_id"), F.max("last_id").alias("last_id"), F.max_by("redactions_applied", "started_at").alias("redactions_applied"))
    found = find_pii(spread(table(spark, sf_dir, "redteam_qa").select("id", "text")), table(spark, sf_dir, "name_lexicon")).groupBy("id").agg(F.count("*").alias("n"))
    # runs are ranges of 25 ids: a hash join on the run's number of the id instead of a range join
    number = lambda c: F.floor((F.regexp_extract(c, r"(\d+)$", 1).cast("bigint") - 1) / 25)
    prefix = lambda c: F.regexp_extract(c, r"^(.*?)\d+$", 1)
    left = runs.select("run_id", "redactions_applied", number("first_id").alias("k"), prefix("first_id").alias("series"))
    right = found.select(number("id").alias("k"), prefix("id").alias("series"), "n").groupBy("k", "series").agg(F.sum("n").alias("found"))
    return left.join(right, ["k", "series"], "left").select("run_id", F.coalesce("found", F.lit(0)).alias("found"), "redactions_applied")
