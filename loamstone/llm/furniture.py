"""Problem 6: page furniture around and within the body of a page.

Every text becomes a small tree: the page, its blocks (runs of lines between
blank lines) and the lines. For each node the link-adjusted characters per tag
are computed, where link characters are those of menu words, link phrases,
control phrases and of lines that are rows of short items, and tags are the
lines themselves, markup tags, bullets and separators. The densities of the
lines of a block are summed; the block of the greatest sum holds the body, and
the path from the page down to it gives the threshold. The phrases only adjust
the link characters: whether a line is furniture is decided by its density
against that threshold.

Lines are much shorter than the nodes of a page's markup, so a density is
taken relative to that of the same node without links, with the line scaled to
the longest line of the body: a short heading is then as dense as a paragraph,
and a menu of one word as thin as one of ten. What holds body text as well (four
words and more beside the links) stays, as does everything without links.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstone.functions.arrow import flat_map
from loamstone.llm.residue import measure as residue
from loamstone.sources.tables import spread, table

#: Menu words of page headers and footers by language.
MENU_WORDS = """
home|about|about us|archive|archives|contact|contact us|culture|help|jobs|careers|latest|log in|login|sign in|sign up|my account|account|opinion|podcasts|press|register
science|search|shop|sitemap|site map|subscribe|topics|travel|video|videos|weather|news|sport|sports|business|politics|health|technology|world|menu|faq|terms|privacy
accessibility|imprint|cookies|advertise|newsletter|rss|feed|mail|chat|settings|legal|blog|forum|gallery|events|store|cart|checkout|more|next|previous|share|save|report|follow|print
startseite|kontakt|datenschutz|impressum|agb|reisen|suche|stellen|kultur|anmelden|wissen|hilfe|über uns|aktuell|archiv|themen|meinung|wetter|wirtschaft|politik|registrieren|warenkorb
merken|teilen|drucken|mein konto|presse|nachrichten|karriere|barrierefreiheit
accueil|mentions légales|recherche|qui sommes-nous|aide|sujets|à la une|connexion|emploi|sciences|voyages|météo|boutique|plan du site|confidentialité|accessibilité|partager|enregistrer|imprimer|mon compte|actualités|s'inscrire
inicio|temas|última hora|entrar|ciencia|cultura|ayuda|viajes|aviso legal|privacidad|accesibilidad|empleo|contacto|archivo|buscar|quiénes somos|opinión|tienda|mapa del sitio|compartir|guardar|imprimir|mi cuenta|noticias|registrarse
início|contato|ajuda|notícias|ciência|viagens|pesquisa|sobre nós|inizio|contatti|cerca|notizie|chi siamo|viaggi|scienza|lavoro|nieuws|zoeken|over ons|reizen|wetenschap|vacatures|главная|контакты|поиск|новости|首页|联系我们|ホーム|お問い合わせ
"""
#: Furniture phrases as patterns over one line, case ignored; they take the whole phrase as link text.
FURNITURE = [
    r"skip to (?:main |the )?content|skip navigation|zum inhalt springen|saltar al contenido|ir al contenido|aller au contenu|passer au contenu|vai al contenuto|ir para o conteúdo|naar inhoud",
    r"back to (?:the )?top|nach oben|haut de page|volver arriba|torna su|voltar ao topo|terug naar boven|retour en haut",
    r"we use cookies[^.]*\.?|wir verwenden cookies[^.]*\.?|nous utilisons des cookies[^.]*\.?|usamos cookies[^.]*\.?|utilizamos cookies[^.]*\.?|this (?:web)?site uses cookies[^.]*\.?",
    r"accept all(?: cookies)?|only required|accept|decline|reject(?: all)?|alle annehmen|alle akzeptieren|nur notwendige|ablehnen|tout accepter|tout refuser|refuser|aceptar todo|solo necesarias|rechazar",
    r"cookie settings|cookie preferences|cookie-einstellungen(?: verwalten)?|gérer mes cookies|configurar las cookies|manage (?:your )?consent(?: preferences)?|your privacy matters to us:?",
    r"(?:we and )?(?:our )?\d* ?partners would like to process your data\.?|learn more|mehr erfahren|en savoir plus|más información",
    r"this site stores small files on your device\.?|by (?:staying|continuing) you agree\.?|\[ok\]|\[settings\]",
    r"subscribe to (?:our|the) [^.|]{0,30}newsletter|sign up (?:for|to) (?:our|the) [^.|]{0,40}|enter your e-?mail(?: address)?(?: to subscribe)?|newsletter (?:bestellen|abonnieren)|s'abonner à la (?:lettre|newsletter)|suscríbete al boletín|iscriviti alla newsletter|assine a newsletter",
    r"download our app(?: for [\w ]{0,40})?|get the app|available on the app store|unsere app laden|téléchargez notre application|descarga nuestra app",
    r"(?:©|\(c\)|copyright) ?(?:\(c\)|©)? ?\d{4}[^|]{0,60}?(?:all rights reserved|alle rechte vorbehalten|tous droits réservés|todos los derechos reservados|tutti i diritti riservati|todos os direitos reservados)\.?",
    r"(?:©|\(c\)|copyright) ?(?:\(c\)|©)? ?\d{4}(?: [^\s|.]+){0,5}(?= ?\||$)|all rights reserved\.?|alle rechte vorbehalten\.?|tous droits réservés\.?|todos los derechos reservados\.?",
    r"[^|.]{2,40} is a registered (?:name|trademark|mark) of its (?:publisher|owner)\.?(?: imprint)?",
    r"powered by \S+(?: v?\d[\w.]*)?",
    r"page \d+ (?:of|sur|/) \d+|seite \d+ (?:von|of) \d+|página \d+ de \d+|pagina \d+ (?:di|van) \d+",
    r"\d+ comments?(?: ?·? ?sort by \w+)?|sort by \w+|\d+ kommentare|\d+ commentaires?|\d+ comentarios|leave a comment|add a comment|log in to comment|load more(?: \w+)?(?:\.{3}|…)?|show more|mehr laden|voir plus|ver más",
    r"(?:up vote|upvote) ?\d* ?(?:down ?vote)?|down ?vote|\d+ (?:likes?|votes?|shares?|upvotes?)",
    r"share ?\| ?improve this ?\| ?follow|improve this(?: answer| question)?|edited \d+ \w+ ago|asked \d+ \w+ ago|answered \d+ \w+ ago",
    r"add to (?:favou?rites|bookmarks|reading list|wishlist)|bookmark this(?: page)?|zu favoriten hinzufügen|ajouter aux favoris|añadir a favoritos",
    r"print this page|email this page|seite drucken|imprimer cette page|imprimir esta página",
    r"most read(?: this week)?|most popular|meistgelesen|les plus lus|lo más leído|i più letti|mais lidas|editor's picks|you may also like|you might also like|recommended for you|das könnte sie (?:auch )?interessieren|vous aimerez aussi|también te puede interesar|read next",
    r"(?:related stories|related articles|related posts|trending now|trending|sponsored|promoted|advertisement|ähnliche beiträge|verwandte artikel|à lire aussi|noticias relacionadas|leggi anche|leia também|lees ook|tags|filed under|schlagwörter|mots-clés|etiquetas) ?:[^.]{0,200}",
    r"advertisement|anzeige|publicité|publicidad|pubblicità|advertentie|sponsored(?: content)?|реклама|广告|広告",
    r"follow [^|.]{2,40} on:?(?: (?:feed|mail|chat|social|video|rss)(?: ?[·|,/] ?)?)*|follow us(?: on [^.|]{0,40})?|folgen sie uns[^.|]{0,40}|suivez-nous[^.|]{0,40}|síguenos[^.|]{0,40}",
    r"your browser (?:has scripts turned off;? ?some features will not work\.?|is out of date[^.]*\.|does not support[^.]*\.)",
    r"(?:←|«|<) ?(?:previous|zurück|précédent|anterior)|(?:next|weiter|suivant|siguiente) ?(?:→|»|>)|[←→↑↓☆★]+",
]
#: The signs of the pattern that has no literal.
ARROWS = "←→↑↓☆★"
SEPARATORS = re.compile(r"[|»›>/·•←→↑↓\\‹«]|\s{3,}|^\s*[-*•–]\s")
MARKUP = re.compile(r"<[^<>\n]{1,300}>")
BULLET = re.compile(r"^\s*(?:[-*•–+]|\d+[.)])\s+")
LETTER = re.compile(r"[^\W_]")
#: What parts the items of a row: spaced separators, wide gaps, running numbers.
ITEMS = re.compile(r"\s+[|»›>/·•]\s+|\s{2,}|(?:^|\s+)\d{1,2}[.)]\s+")
#: Words beside the links from which a thin line holds body text as well.
BODY_WORDS = 4
CODE = re.compile(r"[={}()`$;<]")
VERBLIKE_END = re.compile(r"[.!?。！？।؟]['\")\]]*\s*$")


def literals(parsed) -> frozenset[str]:
    """Strings of which every match of a parsed pattern holds at least one; empty where there is no such set."""
    runs: list[frozenset[str]] = []
    run = ""
    for op, arg in [*parsed, (None, None)]:
        if str(op) == "LITERAL":
            run += chr(arg).lower()
            continue
        if run:
            runs.append(frozenset([run]))
            run = ""
        if str(op) == "BRANCH":
            parts = [literals(x) for x in arg[1]]
            runs.append(frozenset().union(*parts) if all(parts) else frozenset())
        elif str(op) == "SUBPATTERN":
            runs.append(literals(arg[3]))
        elif str(op) in ("MAX_REPEAT", "MIN_REPEAT") and arg[0]:
            runs.append(literals(arg[2]))
    # the set whose shortest string is longest lets the fewest lines through
    return max((r for r in runs if r), key=lambda r: (min(map(len, r)), -len(r)), default=frozenset())


@lru_cache(1)
def anchors():
    """Automaton over the strings that the furniture phrases cannot do without, each with the phrases it may stand in."""
    import ahocorasick
    from re import _parser

    where: dict[str, list[int]] = {}
    for k, p in enumerate(phrases()[0]):
        for lit in literals(_parser.parse(p)) or ARROWS:
            where.setdefault(lit, []).append(k)
    a = ahocorasick.Automaton()
    for lit, ks in where.items():
        a.add_word(lit, ks)
    a.make_automaton()
    return a


@lru_cache(1)
def phrases() -> tuple[list[str], list[re.Pattern]]:
    """The single phrases of all furniture, as stated and compiled."""
    parts = [part for p in FURNITURE for part in _branches(p)]
    return parts, [re.compile(f"(?<!\\w)(?:{p})(?!\\w)", re.IGNORECASE) for p in parts]


def _branches(pattern: str) -> list[str]:
    """The alternatives of a pattern at its outermost level."""
    out, depth, start, inside, k = [], 0, 0, False, 0
    while k < len(pattern):
        ch = pattern[k]
        if ch == "\\":
            k += 2
            continue
        if inside:
            inside = ch != "]"
        elif ch == "[":
            inside = True
        elif ch in "()":
            depth += 1 if ch == "(" else -1
        elif ch == "|" and not depth:
            out.append(pattern[start:k])
            start = k + 1
        k += 1
    return [*out, pattern[start:]]


@lru_cache(1)
def patterns() -> tuple[re.Pattern, frozenset[str]]:
    """Menu words as separate tokens, and the set of them."""
    words = sorted({w.strip() for line in MENU_WORDS.strip().splitlines() for w in line.split("|") if w.strip()}, key=lambda w: (-len(w), w))
    return (
        re.compile(r"(?<![\w'’-])(?:" + "|".join(map(re.escape, words)) + r")(?![\w'’-])", re.IGNORECASE),
        frozenset(words),
    )


class _Signs(dict):
    """Translation table that keeps letters and numbers; entries are made as signs occur."""

    def __missing__(self, c: int) -> int | None:
        self[c] = value = c if LETTER.match(chr(c)) else None
        return value


_SIGNS = _Signs()


def letters(s: str) -> int:
    return len(s.translate(_SIGNS))


def row_items(line: str) -> int:
    """Number of items of a line that is a row of three and more short items with letters, else 0; code and sentences are none."""
    plain = line.strip()
    if CODE.search(plain) or VERBLIKE_END.search(plain) or plain.startswith("|"):
        return 0
    parts = [p for p in (x.strip() for x in ITEMS.split(plain)) if p]
    ok = len(parts) >= 3 and all(len(p.split()) <= 6 and any(ch.isalpha() for ch in p) and not VERBLIKE_END.search(p) for p in parts)
    return len(parts) if ok else 0


def line_counts(line: str) -> tuple[int, int, int, int]:
    """(letters, link letters, tags, link tags) of one line; the line itself is a tag."""
    menu, words = patterns()
    tags, plain = 0, line.strip()
    if "<" in line:
        tags = len(MARKUP.findall(line))
        plain = MARKUP.sub(" ", line).strip()
    total = letters(plain)
    if not total:
        return 0, 0, tags + 1, 1 if plain else 0
    rest, link = plain, 0
    # the automaton goes first: the phrases are tried only where one of their own strings stands
    tried = {k for _, ks in anchors().iter(plain.lower()) for k in ks}
    if tried:
        for k in sorted(tried):
            rest = phrases()[1][k].sub(" ", rest)
        link = total - letters(rest)
    seps = len(SEPARATORS.findall(plain)) + len(BULLET.findall(plain))
    core = BULLET.sub("", rest).strip(" \t|»›>/·•-–*:[]")
    if core and not VERBLIKE_END.search(core):
        left = menu.sub(" ", core)
        got = letters(core) - letters(left)
        if got and letters(left) == 0:
            link += got  # nothing but menu words
        elif got and seps and re.search(r"[»›>/|·•]", core):
            parts = [p.strip(" *-–") for p in re.split(r"[»›>/|·•]", core) if p.strip(" *-–")]
            known = sum(p.lower() in words for p in parts)
            # a breadcrumb: menu words that lead to the title of the page
            if known >= 1 and len(parts) - known <= 1 and all(len(p.split()) <= 8 for p in parts):
                link += letters(core)
            else:
                link += got
        elif got and link:
            link += got
    return total, link, tags + seps + 1, (seps + tags + 1 if link else 0)


def density(c: int, lc: int, t: int, lt: int, body_c: int, body_lc: int) -> float:
    """Link-adjusted characters per tag of a node."""
    if not c:
        return 0.0
    t, lc1, lt1 = max(t, 1), max(lc, 1), max(lt, 1)
    base = math.log(c / max(c - lc, 1) * lc + body_lc / max(body_c, 1) * c + math.e)
    return c / t * math.log(c / lc1 * t / lt1 + 1) / base


Counts = tuple[float, float, float, float]


def is_link(x: Counts) -> bool:
    return x[0] > 0 and x[1] >= 0.85 * x[0]


def summed(xs: list[Counts]) -> Counts:
    return tuple(sum(x[k] for x in xs) for k in range(4))


def thinness(x: Counts, c: float, lc: float) -> float:
    """Density of a node relative to that of the same node without links: 1 without links, near 0 for nothing but links."""
    plain = density(x[0], 0, x[2], 0, c, lc)
    return density(*x, c, lc) / plain if plain else 1.0


def body_threshold(blocks: list[list[Counts]]) -> tuple[float, float]:
    """(threshold, letters of the longest body line): of the block of the greatest density sum and its path from the page.

    A page whose densest block is links has no body: everything below a node without links is thin there.
    """
    page = summed([x for b in blocks for x in b])
    c, lc = page[:2]
    best = max((b for b in blocks if b), key=lambda b: sum(density(*x, c, lc) for x in b))
    body = summed(best)
    if is_link(body):
        return 1.0, max(x[0] for x in best)
    return max(thinness(page, c, lc), thinness(body, c, lc)), max(x[0] for x in best)


def furniture_lines(text: str | None) -> list[tuple[int, float, bool]]:
    """(line number, relative density, is furniture) of every non-blank line of a text; null and blank texts have none."""
    if text is None or not text.strip():
        return []
    blocks: list[list[Counts]] = [[]]
    where: list[tuple[int, int, Counts]] = []
    lines = text.split("\n")
    for no, line in enumerate(lines, 1):
        if not line.strip():
            if blocks[-1]:
                blocks.append([])
            continue
        x = line_counts(line)
        if x[0] and not is_link(x) and (n := row_items(line)):
            # lines of as many bars above or below are a table and no menu
            bars = line.count("|")
            if not bars or bars not in (lines[k].count("|") for k in (no - 2, no) if 0 <= k < len(lines)):
                x = (x[0], x[0], max(x[2], n), max(x[2], n))
        blocks[-1].append(x)
        where.append((no, len(line.split()), x))
    c, lc = summed([x for _, _, x in where])[:2]
    if not c:
        return [(no, 0.0, False) for no, _, _ in where]
    threshold, size = body_threshold(blocks)
    out = []
    for no, words, (n, link, tags, link_tags) in where:
        d = 1.0 if not link else thinness((size, link * size / n, tags, link_tags), c, lc)
        body_words = words * (1 - link / n) if n else 0.0
        out.append((no, d, d < threshold and body_words < BODY_WORDS))
    return out


def page_lines(df: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, line_no, density, furniture) of every non-blank line; repeated rows of an id give their lines once."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return flat_map(rows, lambda: lambda i, t: [(i, *x) for x in furniture_lines(t)], "id string, line_no int, density double, furniture boolean").dropDuplicates(["id", "line_no"])


def main_text(df: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, text) with the furniture lines taken out; a null text stays null."""

    def keep(i, t):
        if t is None:
            return [(i, None)]
        drop = {no for no, _, f in furniture_lines(t) if f}
        return [(i, "\n".join(x for no, x in enumerate(t.split("\n"), 1) if no not in drop).strip("\n"))]

    return flat_map(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), lambda: keep, "id string, text string")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Furniture lines of pages and answers; records that problem 1 excludes give none."""

    def found(i, t):
        return [(i, no) for no, _, f in furniture_lines(t) if f] if residue(t)[2] is None else []

    golden, qa = (spread(table(spark, sf_dir, n).select("id", "text")) for n in ("cleaning_golden", "redteam_qa"))
    a = flat_map(golden, lambda: found, "id string, line_no int")
    b = flat_map(qa, lambda: lambda i, t: [(i, no) for no, _, f in furniture_lines(t) if f], "id string, line_no int")
    return a.unionByName(b).distinct()


def p6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Body text of every page, with its length before and after."""
    t = table(spark, sf_dir, "cleaning_golden").select("id", "text").unionByName(table(spark, sf_dir, "redteam_qa").select("id", "text")).dropDuplicates(["id", "text"])
    m = main_text(t).withColumnRenamed("text", "body")
    return m.groupBy("id").agg(F.max("body").alias("body")).withColumn("body_chars", F.length("body"))
