"""Document evidence, stated once for both engines: raw features, junk filters, quality signals, latent channels, selection.

Input is the raw text with its lines, as in the refining path; the merge path
would see one line. Every document is one row throughout: nothing is shuffled.
"""

from __future__ import annotations

from loamstone.functions.sheet import TOKEN, WORD, WS, Sheet, base, clip, mean, rate, sat, spread
from loamstone.sources.tables import spread as spread_scan
from loamstone.sources.tables import table

# Patterns of the features; Java and RE2 read them alike.
CITATION = r"(?i)(?:doi:\s*\S+|arxiv:\s*\S+|\[\d+\]|\(\d{4}[a-z]?\))"
YEAR = r"\b(?:1[0-9]{3}|20[0-2][0-9])\b"
URL = r"https?://\S+|www\.\S+"
FENCE = r"(?s)```.*?```"
STRUCTURED = r"(?m)^(?:#{1,6}\s+|={2,}.+={2,})"
COPULA = r"(?i)\b\w+(?:\s+\w+){0,6}\s+(?:is|are|was|were)\s+(?:a|an|the|defined)\b"
STEP = r"(?im)^\s*(?:step\s*)?\d+[.):]\s+\S"
QA = r"(?im)^\s*(?:question|answer|reply|comment)\s*:"
RELATION = r"(?i)\b(?:equals?|converts?|produces?|fixes?|defines?|means?)\b"
EXCLAIM = r"^[^.!?]{4,}[!?]$"
MARKER = r"(?i)\[(?:truncated|continued|cut|excerpt|…+)\]|(?:\.\.\.|…)$|<\s*/?\s*(?:page|div|article)\s*>"
BOILERPLATE = (
    r"(?i)\b(?:cookies?\s+(?:policy|consent|banner)|accept\s+(?:all\s+)?cookies|privacy\s+policy|terms\s+(?:of\s+)?(?:service|use)|all\s+rights\s+reserved|skip\s+to\s+(?:main\s+)?content"
    r"|sign\s+up\s+for\s+(?:our\s+)?newsletter|subscribe\s+to\s+(?:our\s+)?(?:newsletter|channel)|follow\s+us\s+on|share\s+(?:this|on)\s+\w+|enable\s+javascript|javascript\s+is\s+(?:disabled|required)"
    r"|home\s*[|›>»/]\s*(?:about|contact|products|services|blog))\b"
)
PRICE = r"[$€£¥]\s?\d[\d,]*(?:\.\d{2})?|\b\d{1,3}\s*%\s+off\b"
TRADE = r"(?i)\b(?:subscri|regist|enroll|donat|book|reserv|order|checkout|purchas|membership)\w*\b"
CATALOG = r"(?i)\b(?:sku|isbn|item\s*#|qty|quantity|in\s+stock|publisher\s*:|ages\s*:\s*\d)\b"
CHECKOUT = r"(?i)(?:checkout|/cart|payment|billing|/buy/|/order/|utm_)"
BLURB = r"(?i)(?:author\s*:|illustrated\s+by\s*:|publisher\s*:|workbook\s+ages\s*:|how\s+to\s+draw\s+book)"
LINK = r"(?i)https?://|www\.|utm_"
ANCHOR = (
    r"(?i)(?:\[\d+\]|\(\d{4}[a-z]?\)|doi:\s*\S+|arxiv:\s*\S+|https?://[^\s]+|(?:see|cf\.)\s+(?:section|chapter|table|figure)\s+\d+|(?:figure|table|section|chapter|appendix)\s+\d+"
    r"|(?:published|journal|proceedings|conference)\s+(?:in|by)|(?:et al\.|ibid\.|op\. cit\.))"
)
BARE_CLAIM = (
    r"(?i)\b(?:studies (?:show|prove|confirm|suggest)|research (?:proves|shows|confirms)|scientists (?:agree|believe|say)|experts (?:agree|say|believe)"
    r"|it (?:is|has been) (?:proven|widely known|well established)|everyone knows|common knowledge|undeniably|according to (?:studies|research|experts))\b"
)
#: A claim that names its place is none; counted apart, as RE2 knows no look-ahead.
PLACED_CLAIM = r"(?i)\baccording to (?:studies|research|experts)\s+(?:from|at|by|in|published)"
SPECIFIC = r"\b(?:\d{1,3}(?:\.\d+)?%|\d{4}\b|\$[\d,]+(?:\.\d{2})?|\d+(?:\.\d+)?\s*(?:million|billion|thousand|km|kg|mhz|gb|tb)|[A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3})\b"
OTHER_LETTER = r"[\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{2FF}\x{370}-\x{1FFF}\x{3040}-\x{D7FF}]"
HEDGE = r"(?i)\b(?:important to note|worth noting|crucial to|it\x27s essential|delve into|holistic approach)\b"
OPENER = r"(?i)^(?:furthermore|moreover|additionally|however|therefore|thus|hence|consequently|overall|finally|firstly|secondly|lastly|indeed|nonetheless|meanwhile)[,:]*(?:[ \t\n\f\r]|$)"
OPENER_PHRASE = r"(?i)(?:^|[,;]\s*)(?:in conclusion|to summarize|to sum up|in summary|in addition)\b"
OPENER_NEAR = r"(?i)\b(?:furthermore|moreover|additionally|however|therefore)\b"
PIRACY = (
    r"(?i)\b(?:keygen|key[\s-]?gen(?:erator)?|warez|nulled|crack(?:ed)?\s+(?:software|version|game|app|program)|(?:software|program|game|app)\s+crack|download\s+(?:the\s+)?crack|crack\s+download|crack\s+only"
    r"|serial\s+(?:key|number)\s+crack|license\s+key\s+generator|(?:kms|windows)\s+activator|kmspico|repack\s+crack|pirated\s+software|(?:bypass|circumvent)\s+(?:license|licensing|activation|drm)"
    r"|activate\s+without\s+(?:a\s+)?(?:license|paying|purchase)|torrent\s+(?:download|file|link).{0,40}(?:software|game|app|program|windows|office)|(?:software|game|app|program|windows|office).{0,40}torrent\s+(?:download|file|link))\b"
)
COPYRIGHT = (
    r"(?i)\b(?:(?:remove|strip|break|circumvent)\s+(?:drm|copy\s*protection|copyright\s+protection)|drm\s+remov(?:al|er|e)|illegal(?:ly)?\s+download(?:ing)?\s+(?:of\s+)?(?:movies?|films?|ebooks?|books?|albums?|music|songs?|shows?)"
    r"|download\s+(?:the\s+)?(?:full|entire)\s+(?:movie|film|ebook|book|album|show)(?:\s+for\s+free)?|pirated\s+(?:copy|ebook|movie|film|album|book|pdf|epub)|(?:movie|film|ebook|book|album|show|song)\s+torrent"
    r"|torrent.{0,40}(?:movie|film|ebook|book|album|show|song)|watch\s+(?:the\s+)?(?:full\s+)?(?:movie|film|show).{0,35}online\s+free|leaked\s+(?:copy|pdf|ebook|epub|album)"
    r"|copyrighted\s+(?:material|content|work).{0,40}(?:download|torrent|free)|(?:download|torrent|stream).{0,40}copyrighted\s+(?:material|content|work))\b"
)
HOW_TO_PIRACY = (
    r"(?i)\b(?:how\s+to\s+(?:crack|activate|bypass|patch)\s+|(?:crack|keygen|patch|activator)\s+(?:for|to\s+activate)|download\s+(?:and\s+)?install\s+(?:the\s+)?(?:crack|keygen|patch|activator)|use\s+(?:a\s+)?keygen\s+to"
    r"|apply\s+the\s+(?:crack|patch)\s+to|get\s+(?:the\s+)?full\s+version\s+for\s+free)\b"
)
FREE_TRIAL = r"(?i)\bget\s+(?:the\s+)?full\s+version\s+for\s+free\s+trial"
HOW_TO_COPY = (
    r"(?i)\b(?:how\s+to\s+(?:download|rip|copy)\s+(?:copyrighted|protected)\s+|how\s+to\s+(?:remove|strip|bypass)\s+(?:drm|copy\s*protection|copyright)|how\s+to\s+(?:rip|copy)\s+(?:dvd|blu-?ray|cd)s?"
    r"|bypass\s+dmca|evade\s+copyright|download\s+(?:copyrighted|protected)\s+(?:movies?|films?|ebooks?|books?|albums?|music))\b"
)
LAWFUL = (
    r"(?i)\b(?:illegal|copyright\s+infringement|intellectual\s+property|legal\s+consequences|law\s+enforcement|anti[- ]piracy|official\s+(?:purchase|subscription|license)|free\s+trial|open[- ]source\s+alternative"
    r"|legitimate\s+alternative|fair\s+use|rights\s+holder|licensed\s+under|public\s+domain|creative\s+commons|dmca\s+takedown|copyright\s+(?:law|act|holder))\b"
)
HTML = r"<[^>]+>|&[a-z]+;|&#\d+;"
INJECTION = r"(?i)(ignore (all )?previous|system prompt|jailbreak|do anything now|you are now|act as (?:a )?dan)"
REASONING = r"(?i)\b(?:therefore|because|step \d|first,|second,|thus,|hence,|let\x27s think|reasoning:|analysis:)\b"
CODE = r"```|<code>|def |class |import |function\s*\("
DELIMITER = r"[\[\](){}<>|`~:;,.\-_=+/\\*!?]"
FACTUAL = r"(?i)\b(?:according to|study|evidence|dataset|experiment|theorem|proof|measured|benchmark|reported)\b"
EDUCATION = r"(?i)\b(?:explain|example|intuition|derive|step-by-step|why|how|trade-off|design)\b"


def _strip(c: str):
    return lambda d: d.replace(c, f"^{WS}+|{WS}+$", "")


#: Parts of a text that later layers count over.
PARTS = Sheet([
    {"t": _strip("text"), "n": "CAST(length(text) AS DOUBLE)"},
    {
        "ls": lambda d: d.filter(d.split("t", rf"{WS}*[\r\n]{WS}*"), "x <> ''"),
        "w": lambda d: d.all("text", WORD),
        "lw": lambda d: d.all("lower(text)", WORD),
        "sents": lambda d: d.filter(d.map(d.split("text", "[.!?]+"), d.replace("x", f"^{WS}+|{WS}+$", "")), "x <> ''"),
        "spoken": lambda d: d.filter(d.map(d.split("text", rf"[.!?]+[ \t\n\f\r\x0b]+"), d.replace("x", f"^{WS}+|{WS}+$", "")), "x <> ''"),
    },
    {"wc": lambda d: d.size("w"), "lc": lambda d: f"greatest({d.size('ls')}, 1.0)", "ll": lambda d: d.map("ls", "CAST(length(x) AS DOUBLE)")},
    {"avg_ll": lambda d: f"{d.sum('ll', 'x')} / lc"},
    {"var_ll": lambda d: f"{d.sum('ll', '(x - avg_ll) * (x - avg_ll)')} / lc"},
    {"cv": "CASE WHEN avg_ll > 0 THEN sqrt(var_ll) / avg_ll ELSE 0.0 END", "wc1": "greatest(wc, 1.0)", "n1": "greatest(n, 1.0)"},
])


def _of_lines(p: str):
    return lambda d: d.size(d.filter("ls", d.has("x", p)))


#: O-053: the raw features.
RAW = PARTS.then(
    numeric_ratio=lambda d: d.size(d.filter("w", d.has("x", r"\p{Nd}"))) + " / wc1",
    upper_ratio=lambda d: d.size(d.filter("w", d.has("x", r"^\p{Lu}") + " AND length(x) > 1")) + " / wc1",
    url_ratio=lambda d: d.sum(d.all("text", URL), "length(x)") + " / n1",
    fence_ratio=lambda d: d.sum(d.all("text", FENCE), "length(x)") + " / n1",
    table_ratio=lambda d: _of_lines(r"^\|.+\|$")(d) + " / lc",
    structured_ratio=lambda d: d.n("text", STRUCTURED) + " / lc",
    citations=lambda d: d.n("text", CITATION),
    years=lambda d: d.size(d.distinct(d.all("text", YEAR))),
    copulas=lambda d: d.n("text", COPULA),
    steps=lambda d: d.n("text", STEP),
    questions=lambda d: d.n("text", QA),
    exclaim_ratio=lambda d: _of_lines(EXCLAIM)(d) + " / lc",
    sentences=lambda d: f"greatest({d.size('sents')}, 1.0)",
    contact_ratio=lambda d: d.size(d.filter("w", f"length({d.replace('x', '[^0-9]', '')}) >= greatest(7, floor(length(x) / 2))")) + " / wc1",
    nav_ratio=lambda d: d.size(d.filter("ls", f"avg_ll > 0 AND {d.n('x', TOKEN)} <= greatest(3.0, floor(avg_ll / greatest({d.n('x', WORD)}, 1.0))) AND {d.has('x', chr(91) + '|>»/' + chr(92) * 2 + chr(92) + '-:' + chr(93))} AND length(x) <= avg_ll * (1.0 + cv)")) + " / lc",
    # a word holds no colon, so no word is a time of a schedule
    schedule_ratio="CAST(0 AS DOUBLE)",
    uniform_ratio=lambda d: d.size(d.filter("ll", "avg_ll > 0 AND abs(x - avg_ll) <= avg_ll * greatest(cv, 1e-9)")) + " / lc",
    first_person_ratio=lambda d: d.size(d.filter("w", "length(x) <= 2 AND " + d.has("x", r"^[\p{Ll}\p{Lo}\p{Lm}]+$"))) + " / wc1",
    relations=lambda d: d.n("text", RELATION),
    tokens="CASE WHEN wc > 0 THEN greatest(1.0, floor(n / (n / wc))) ELSE 1.0 END",
).then(anchor_density="(citations + years) / wc1")
RAW_COLUMNS = ("wc", "lc", "n", "tokens", "numeric_ratio", "upper_ratio", "url_ratio", "fence_ratio", "table_ratio", "structured_ratio", "citations", "years", "copulas", "steps", "questions", "exclaim_ratio", "avg_ll", "cv", "sentences", "contact_ratio", "nav_ratio", "schedule_ratio", "anchor_density", "first_person_ratio", "uniform_ratio", "relations")

#: O-061, O-062, O-064 to O-073: junk scores. Words are taken in lower case, so that no word is in capitals.
FILTERS = Sheet([
    {
        "uniq": lambda d: f"{d.size(d.distinct('lw'))} / wc1",
        "top_word": lambda d: d.top("lw"), "top_pair": lambda d: d.top(d.pairs("lw")),
        "anchors": lambda d: d.n("text", ANCHOR), "bare_years": lambda d: d.n("text", r"\b\d{4}\b"),
        "links": lambda d: d.n("text", LINK),
        "shouts": lambda d: d.size(d.filter("ls", f"length(x) > 10 AND length(x) < 80 AND {d.has('x', chr(92) + 'p{Lu}')} AND x = upper(x)")),
        "prices": lambda d: d.n("text", PRICE), "trades": lambda d: d.n("text", TRADE), "catalogs": lambda d: d.n("text", CATALOG), "checkouts": lambda d: d.n("text", CHECKOUT),
        "price_lines": _of_lines(PRICE),
        "buy_lines": lambda d: d.size(d.filter("ls", f"length(x) < 90 AND ({d.has('x', PRICE)} OR {d.has('x', CHECKOUT)}) AND {d.has('x', TRADE)}")),
        "link_lines": lambda d: d.size(d.filter("ls", f"length(x) < 100 AND {d.has('x', LINK)} AND {d.has('x', TRADE)}")),
        "lists": lambda d: d.size(d.filter("ls", f"length(x) < 90 AND {d.has('x', chr(94) + chr(92) + 'd+[.)]' + chr(92) + 's+' + chr(92) + 'S')}")),
        "bars": lambda d: d.size(d.filter("ls", f"length(x) < 120 AND {d.n('x', '[|]')} >= 2")),
        "plain_lines": lambda d: d.size(d.filter("ls", f"length(x) BETWEEN 20 AND 120 AND NOT {d.has('x', '[0-9]')}")),
        "greets": lambda d: d.size(d.filter(d.first("ls", 3), d.has("x", r"(?i)^(?:welcome|hello|hi)\b"))),
        "hype_lines": lambda d: d.size(d.filter("ls", f"length(x) < 100 AND {d.has('x', '!')} AND NOT {d.has('x', '[0-9]{4}')}")),
        "bangs": lambda d: d.n("text", "!"),
        "hedges": lambda d: d.n("text", HEDGE),
        "openers": lambda d: d.size(d.filter("spoken", f"{d.has('substring(x, 1, 60)', OPENER_PHRASE)} OR ({d.has('x', OPENER)} AND NOT {d.has('substring(x, 1, 40)', '[0-9]')}) OR {d.has('substring(x, 1, 50)', OPENER_NEAR)}")),
        "spoken_n": lambda d: d.size("spoken"),
        "bare": lambda d: f"{d.n('text', BARE_CLAIM)} - {d.n('text', PLACED_CLAIM)}",
        # letters beyond ASCII as a word sign that no part of the pattern takes: one engine sees the end of a word before them
        "specifics": lambda d: d.n(d.replace("text", OTHER_LETTER, "_"), SPECIFIC),
        "strong": lambda d: f"{d.n('text', PIRACY)} + {d.n('text', COPYRIGHT)}",
        "how_to": lambda d: f"{d.n('text', HOW_TO_PIRACY)} - {d.n('text', FREE_TRIAL)} + {d.n('text', HOW_TO_COPY)}",
        "lawful": lambda d: d.has("text", LAWFUL), "blurb": lambda d: d.has("text", BLURB),
        "boiler_hits": lambda d: d.n("text", BOILERPLATE),
        "tn": "CAST(length(t) AS DOUBLE)",
        "tail": "substring(t, greatest(CAST(length(t) AS INT) - 119, 1), 120)",
        "last_word": lambda d: d.replace(d.last(d.all("t", TOKEN)), r"^[\x27\x22,;)]+|[\x27\x22,;)]+$", ""),
        "marked": lambda d: d.has("t", MARKER), "dots": lambda d: d.has("t", r"(?:\.\.\.|…)$"),
        "broken": lambda d: d.n("text", r"\x{FFFD}"),
    },
    {
        "clean_end": lambda d: d.has("tail", r"[.!?)\x22\x27\]};>]$"),
        "cut_word": lambda d: d.has("last_word", r"^\p{L}{1,2}$") + " AND tn > 250",
        "bare_word": lambda d: d.has("last_word", r"^\p{L}{6,}$") + " AND NOT " + d.has("last_word", "[aeiouAEIOU]") + " AND tn > 800",
        "open_end": lambda d: d.has("t", r"[({\[<]$"), "joined_end": lambda d: d.has("t", r"[,\-–—:]$"),
        "stuffing": "greatest(CASE WHEN wc >= 40 AND top_word / wc1 > 0.08 THEN least(1.0, (top_word / wc1 - 0.06) * 8.0) ELSE 0.0 END, CASE WHEN wc >= 40 AND top_pair / greatest(wc - 1, 1) > 0.04 THEN least(1.0, (top_pair / greatest(wc - 1, 1) - 0.03) * 10.0) ELSE 0.0 END)",
        "facts": "(anchors + bare_years) / greatest(wc / 80, 1.0)",
        "talk": "openers / greatest(spoken_n, 1.0)",
        "trade": "least(1.0, prices / greatest(wc1 / 80, 1.0) * 0.35 + trades / greatest(wc1 / 90, 1.0) * 0.30 + catalogs / greatest(wc1 / 100, 1.0) * 0.25 + checkouts / greatest(lc / 5, 1.0) * 0.20)",
        "spec": "specifics / greatest(wc / 80, 1.0)", "cited": "anchors / greatest(wc / 100, 1.0)",
        "txn_hits": "prices + trades + catalogs + checkouts",
    },
    {
        "truncation": "CASE WHEN tn < 80 THEN 0.0 ELSE least(1.0, greatest(CASE WHEN marked THEN 0.95 ELSE 0.0 END, CASE WHEN dots THEN 0.85 ELSE 0.0 END, CASE WHEN clean_end THEN 0.0 WHEN open_end THEN 0.9 WHEN joined_end THEN 0.55 WHEN cut_word THEN 0.82 WHEN bare_word THEN 0.78 ELSE 0.0 END, least(1.0, broken / greatest(tn / 200, 1.0)))) END",
        "boilerplate": "greatest(least(1.0, boiler_hits / lc), CASE WHEN bars >= 2 THEN least(1.0, 0.5 + bars / lc) ELSE 0.0 END)",
        "commercial": "greatest(trade, CASE WHEN price_lines >= 2 AND wc1 < 400 THEN 0.55 ELSE 0.0 END, CASE WHEN buy_lines >= 1 THEN 0.42 ELSE 0.0 END, CASE WHEN blurb AND n < 1200 THEN 0.85 ELSE 0.0 END, CASE WHEN links >= 4 THEN least(1.0, 0.35 + links / lc) ELSE 0.0 END)",
        "seo": "least(1.0, greatest(stuffing * 0.9, least(1.0, links / lc * 0.35), CASE WHEN shouts >= 2 THEN least(1.0, 0.4 + shouts / lc) ELSE 0.0 END, CASE WHEN lists >= 3 THEN least(1.0, 0.3 + lists / lc) ELSE 0.0 END, CASE WHEN link_lines >= 1 THEN 0.45 ELSE 0.0 END))",
        "low_info0": "CASE WHEN wc1 < 45 AND uniq > 0.72 THEN 0.0 ELSE greatest(CASE WHEN uniq < 0.38 AND wc1 > 80 THEN least(1.0, (0.42 - uniq) * 3.5) ELSE 0.0 END, CASE WHEN facts < 0.15 AND wc1 > 120 THEN least(1.0, 0.25 + (0.15 - facts) * 2) ELSE 0.0 END, CASE WHEN plain_lines / lc > 0.55 AND facts < 0.2 THEN 0.4 ELSE 0.0 END, CASE WHEN greets > 0 THEN 0.35 ELSE 0.0 END) END",
        "talk0": "CASE WHEN spoken_n < 2 OR talk < 0.12 THEN 0.0 ELSE least(1.0, talk * 2.2) END",
        "enthusiasm0": "least(1.0, bangs / lc * 0.35 + hype_lines / lc * 0.8)",
        "hallucination": "CASE WHEN wc < 15 OR (bare = 0 AND specifics < 4) THEN 0.0 ELSE least(1.0, greatest(0.0, CASE WHEN bare >= 1 THEN least(1.0, 0.25 + bare * 0.18 - cited * 0.12) ELSE 0.0 END, CASE WHEN spec > 1.2 AND cited < 0.15 THEN least(1.0, 0.20 + (spec - 1.0) * 0.25) ELSE 0.0 END, CASE WHEN bare >= 2 AND anchors = 0 AND spec > 0.6 THEN 0.65 ELSE 0.0 END)) END",
        "piracy0": "CASE WHEN strong = 0 AND how_to = 0 THEN 0.0 ELSE greatest(least(1.0, strong * 0.55 + how_to * 0.65), CASE WHEN strong >= 1 AND how_to >= 1 THEN 0.92 WHEN strong >= 2 OR how_to >= 2 THEN 0.88 WHEN strong >= 1 THEN 0.78 ELSE 0.72 END) END",
    },
    {
        "low_info": "CASE WHEN low_info0 > 0.35 AND wc < 600 THEN least(1.0, low_info0 + 0.15) ELSE low_info0 END",
        "enthusiasm": "CASE WHEN enthusiasm0 > 0.15 THEN enthusiasm0 ELSE 0.0 END",
        "discourse": "CASE WHEN talk0 > 0.25 AND wc1 < 1200 THEN greatest(talk0, least(1.0, 0.30 + talk0 * 0.5)) ELSE talk0 END",
        "piracy": "CASE WHEN how_to = 0 AND lawful THEN CASE WHEN strong <= 1 THEN 0.0 ELSE least(1.0, piracy0 * 0.4) END ELSE least(1.0, piracy0) END",
    },
    {"verbosity0": "least(1.0, greatest(CASE WHEN talk0 > 0.2 THEN talk0 * 0.85 ELSE 0.0 END, CASE WHEN low_info > 0.35 AND uniq < 0.45 THEN low_info * 0.75 ELSE 0.0 END, CASE WHEN wc1 / lc > 25 AND uniq < 0.42 THEN least(1.0, (wc1 / lc - 20) / 40 * greatest(0.0, 0.5 - uniq) * 4) ELSE 0.0 END, CASE WHEN hedges >= 2 THEN least(1.0, 0.3 + hedges / greatest(wc1 / 150, 1.0)) WHEN hedges >= 1 AND talk0 > 0.15 THEN 0.32 ELSE 0.0 END))"},
    {"verbosity": "CASE WHEN verbosity0 > 0.2 AND wc1 < 800 THEN greatest(verbosity0, least(1.0, 0.35 + verbosity0 / lc)) ELSE verbosity0 END"},
])
FILTER_COLUMNS = ("truncation", "boilerplate", "commercial", "seo", "low_info", "stuffing", "piracy", "verbosity", "discourse", "enthusiasm", "hallucination", "txn_hits")

#: O-058 to O-060: the quality signals beside the junk scores.
SIGNALS = Sheet([
    {
        "word_diversity": "uniq",
        "line_rep": lambda d: f"CASE WHEN {d.size('ls')} > 2 THEN {d.top('ls')} / {d.size('ls')} ELSE 0.0 END",
        "g": lambda d: d.grams("text", 5, 3),
        "alpha": lambda d: d.n("text", r"\p{L}") + " / n1",
        "html": lambda d: f"least(1.0, {d.n('text', HTML)} / greatest(n / 200, 1.0))",
        "injection": lambda d: f"least(1.0, {d.n('text', INJECTION)} * 0.25)",
        "reasoning": lambda d: f"least(1.0, {d.n('text', REASONING)} / lc)",
        "code_density": lambda d: f"least(1.0, {d.n('text', CODE)} / greatest({d.size('ls')} / 5, 1.0))",
        "delimiters": lambda d: d.n("text", DELIMITER) + " / n1",
        "factual": lambda d: f"least(1.0, {d.n('text', FACTUAL)} / lc)",
        "education": lambda d: f"least(1.0, {d.n('text', EDUCATION)} / lc)",
        "coherence": clip("1.0 - var_ll / greatest(avg_ll * avg_ll, 1.0)"),
        "formatting": "1.0 - least(1.0, broken / greatest(n / 500, 1.0))",
        "sl": lambda d: d.map(d.filter(d.split("text", "[.!?]+"), d.replace("x", f"^{WS}+|{WS}+$", "") + " <> ''"), d.n("x", WORD)),
    },
    {
        "char_rep": lambda d: f"CASE WHEN n > 20 THEN {d.top('g')} / greatest({d.size(d.distinct('g'))}, 1.0) ELSE 0.0 END",
        "sl_n": lambda d: d.size("sl"), "sl_mean": lambda d: f"{d.sum('sl', 'x')} / greatest({d.size('sl')}, 1.0)",
    },
    {"repeated": "greatest(line_rep, char_rep)", "sl_var": lambda d: f"{d.sum('sl', '(x - sl_mean) * (x - sl_mean)')} / greatest(sl_n, 1.0)"},
    {
        "diversity": clip("uniq * (1.0 - repeated)"),
        "token_spam": clip("repeated * 0.7 + greatest(0.0, delimiters - 0.2) * 1.5"),
        "burstiness": "CASE WHEN sl_n < 3 OR sl_mean <= 0 THEN 0.5 ELSE " + clip("sqrt(sl_var) / sl_mean / 1.2") + " END",
        "reasoning_rep": "least(1.0, repeated * (0.5 + reasoning * 0.5))",
    },
    {
        "structure": clip("formatting * (1.0 - html) * (1.0 - token_spam)"),
        "template": "least(1.0, verbosity * 0.35 + discourse * 0.25 + enthusiasm * 0.15 + greatest(0.0, 0.55 - burstiness) * 0.25)",
    },
])
SIGNAL_COLUMNS = ("char_entropy", "word_diversity", "line_rep", "char_rep", "alpha", "html", "injection", "reasoning", "code_density", "formatting", "delimiters", "token_spam", "coherence", "structure", "factual", "education", "repeated", "diversity", "synthetic", "reasoning_rep", "burstiness", "template")
ENTROPY_LAYERS = Sheet([{"char_entropy": lambda d: d.entropy("text")}])
SYNTHETIC = Sheet([{"synthetic": "least(1.0, greatest(template * 0.55, repeated * 0.30 + (1.0 - diversity) * 0.25 + greatest(0.0, 0.2 - char_entropy / 10.0) * 0.15))"}])
MEASURED = RAW + FILTERS + SIGNALS + ENTROPY_LAYERS + SYNTHETIC

#: O-097: the latent channels, each against the mean of all.
_CHANNELS = {
    "educational": f"education + {rate('copulas', 'lc')} + {rate('steps', 'lc')} + reasoning",
    "technical": "code_density + delimiters + fence_ratio + numeric_ratio",
    "factual": f"factual + {rate('citations', 'lc', 'wc1')} + anchor_density + {rate('relations', 'lc')} + numeric_ratio",
    "reasoning": "reasoning + coherence * cv",
    "structural": "structured_ratio + table_ratio + structure + fence_ratio",
    "procedural": f"{rate('steps', 'lc')} + reasoning",
    "referential": f"{rate('citations', 'lc')} + structured_ratio + {rate('years', 'wc1', 'lc')}",
    "code": "code_density + fence_ratio",
    "transactional": f"commercial + {rate('txn_hits', 'wc1', 'lc')}",
    "navigational": "boilerplate + url_ratio + nav_ratio + seo",
    "narrative": "low_info + exclaim_ratio + enthusiasm + (1.0 - diversity)",
    "promotional": "commercial + enthusiasm + seo",
    "corruption": "truncation + html + injection + hallucination",
    "redundancy": "greatest(line_rep, char_rep, repeated)",
    "coherence": "coherence * diversity",
    "temporal": f"{rate('years', 'wc1', 'lc')} + schedule_ratio",
    "opinion": "first_person_ratio",
}
CHANNELS = Sheet([{f"h_{k}": v for k, v in _CHANNELS.items()}, {"h_mean": mean([f"h_{k}" for k in _CHANNELS])}, {f"r_{k}": f"CASE WHEN h_{k} <= 0 THEN 0.0 ELSE {clip(f'h_{k} / (h_{k} + greatest(h_mean, h_{k} * 0.25))')} END" for k in _CHANNELS}])

#: O-098 to O-100: density, novelty, coherence and the quality channels.
_POS = ["educational", "technical", "reference", "code", "per_token", "novelty", "q_coherence"]
_NEG = ["filler", "entertainment", "commerce", "r_corruption", "r_redundancy"]
QUALITY = Sheet([
    {
        "spans": lambda d: d.size(d.distinct(d.map(d.filter(d.map(d.split("lower(text)", r"[.!?\n]+"), d.replace("x", f"^{WS}+|{WS}+$", "")), "length(x) >= 12"), "substring(x, 1, 48)"))),
        "key_len": "CASE WHEN avg_ll > 0 THEN greatest(12, CAST(floor(avg_ll) AS INT)) ELSE 32 END",
    },
    {"cites": lambda d: d.size(d.distinct(d.map(d.all("lower(text)", CITATION), "substring(x, 1, key_len)")))},
    {"fact_count": "spans + cites + CASE WHEN fence_ratio > 0 THEN 1 ELSE 0 END + CASE WHEN table_ratio > 0 THEN 1 ELSE 0 END + citations + least(years, sentences)", "lexical": "word_diversity * diversity"},
    {
        "info_density": f"fact_count / wc1 * {mean(['lexical', '(r_structural + r_factual)', 'r_educational'])}",
        "per_token": f"fact_count / tokens * {mean(['lexical', 'r_reasoning'])}",
        "novel_red": "greatest(r_redundancy, reasoning_rep)", "novel_syn": "greatest(synthetic, template)",
        "q_coherence": clip("(r_coherence + coherence + (1.0 - r_redundancy)) / 3.0"),
        "commerce": sat("commercial + r_transactional + r_promotional", ["commercial", "r_transactional", "r_promotional"]),
        "tech_code": sat("code_density + fence_ratio", ["code_density", "fence_ratio", "r_code"]),
        "tech_dense": sat("delimiters + factual + r_reasoning", ["delimiters", "factual", "r_reasoning", "r_factual"]),
        "reference": sat("r_referential + r_factual", ["r_referential", "r_factual", "citations / lc"]),
    },
    {
        "novel_damp": sat("r_coherence", ["novel_red", "novel_syn", "r_coherence"]),
        "edu_base": sat("education + r_educational + r_reasoning + reasoning", ["education", "r_educational", "r_reasoning", "reasoning", "per_token"]),
        "edu_anchor": sat("factual + per_token + reasoning", ["factual", "per_token", "reasoning", "r_factual"]),
        "technical": sat("greatest(tech_code, tech_dense * (1.0 - r_narrative))", ["tech_code", "tech_dense", "r_narrative"]),
        "code": "tech_code",
        "short_span": sat("avg_ll", ["avg_ll", "cv"]),
    },
    {
        "novelty": clip("1.0 - novel_red * (1.0 - novel_damp) - novel_syn * novel_damp"),
        "edu_weight": sat("edu_anchor + reasoning + fence_ratio + code_density", ["edu_anchor", "reasoning", "fence_ratio", "code_density"]),
        "short_bound": f"greatest(1.0, {mean(['sentences', 'lc', 'wc / sentences'])} * short_span)",
    },
    {"edu0": sat("edu_base * edu_weight * (1.0 - commerce) + per_token * q_coherence", ["edu_base", "edu_weight", "per_token", "q_coherence", "reasoning", "r_reasoning"])},
    {"ent0": sat("r_narrative + exclaim_ratio + low_info", ["r_narrative", "exclaim_ratio", "low_info", "edu0"]) + " * (1.0 - edu0)"},
    {"storytelling": sat("ent0 + enthusiasm", ["ent0", "enthusiasm", "low_info"])},
    {"fil0": sat("storytelling + ent0 - edu0 - per_token", ["storytelling", "ent0", "edu0", "per_token"]), "brief": "wc < short_bound AND relations >= 1", "short_edu": sat("per_token + factual + r_factual + r_educational", ["per_token", "factual", "r_factual", "r_educational"])},
    {"short_damp": sat("short_edu", ["ent0", "fil0", "short_edu"])},
    {"edu1": "CASE WHEN brief THEN greatest(edu0, short_edu) ELSE edu0 END", "entertainment": "CASE WHEN brief THEN least(ent0, short_edu * short_damp) ELSE ent0 END", "filler": "CASE WHEN brief THEN least(fil0, short_edu * short_damp) ELSE fil0 END"},
    {"pos_mean": mean(["edu1", *_POS[1:]]), "neg_mean": f"({' + '.join(_NEG)}) / 6.0", "substance0": mean(["edu1", "technical", "reference", "code"]), "neg_noise": spread([*_NEG, "0.0"])},
    {"overall0": clip("pos_mean / greatest(pos_mean + neg_mean, 1e-9) * substance0 * (1.0 - " + sat("neg_mean", [*_NEG, "0.0"]) + ")")},
    {"overall1": "CASE WHEN neg_noise > substance0 THEN least(overall0, substance0) ELSE overall0 END"},
    {
        "overall": f"CASE WHEN fence_ratio > 0 OR table_ratio > 0 THEN greatest(overall1, {sat('substance0 + fence_ratio + table_ratio', ['edu1', *_POS[1:]])}) ELSE overall1 END",
        "educational": f"CASE WHEN fence_ratio > 0 AND r_procedural > 0 THEN greatest(edu1, {sat('edu_base + r_procedural + r_code + steps / lc', ['edu_base', 'r_procedural', 'r_code', 'per_token'])}) ELSE edu1 END",
    },
])
QUALITY_COLUMNS = ("educational", "technical", "reference", "code", "entertainment", "commerce", "storytelling", "filler", "overall", "info_density", "per_token", "fact_count", "novelty", "q_coherence")

#: O-101, O-102: intent by channel shares, and the profile of the channels.
_ALL = [f"r_{k}" for k in _CHANNELS]
INTENT = Sheet([
    {"mass": f"CASE WHEN {' + '.join(_ALL)} > 0 THEN {' + '.join(_ALL)} ELSE 1e-9 END"},
    {f"m_{k}": f"r_{k} / mass" for k in ("educational", "factual", "reasoning", "referential", "transactional", "temporal", "promotional", "navigational", "procedural", "narrative")},
    {
        "i_knowledge": base(["m_educational", "m_factual", "m_reasoning", "m_referential", "overall"]),
        "i_transactional": base(["m_transactional", "commerce"]),
        "i_administrative": base(["m_temporal", "contact_ratio", "schedule_ratio", "uniform_ratio"]),
        "i_promotional": base(["m_promotional", "m_transactional"]),
        "i_navigational": base(["m_navigational", "nav_ratio", "url_ratio"]),
        "durable": base(["m_factual", "m_referential", "q_coherence"]),
    },
    {"edu_damp": base(["i_knowledge", "m_procedural", "code"]), "volatile": base(["m_temporal", "m_narrative", "i_administrative"])},
    {"i_entertainment": base(["m_narrative", "entertainment", "storytelling"]) + " * (1.0 - edu_damp)", "half_life": sat("durable * (1.0 - volatile) + novelty * r_coherence", ["durable", "volatile", "novelty"])},
    {
        "transience": "greatest(0.0, 1.0 - half_life)",
        "primary_axis": lambda d: d.max_of({k: f"r_{k}" for k in _CHANNELS} | {"overall": "overall"}),
        "axis_mass": f"{' + '.join(_ALL)} + overall",
    },
    {"profile_entropy": "-(" + " + ".join(f"(CASE WHEN {v} > 0 THEN {v} / axis_mass * ln({v} / axis_mass + 1e-9) ELSE 0.0 END)" for v in [*_ALL, "overall"]) + ")"},
])
INTENT_COLUMNS = ("i_knowledge", "i_transactional", "i_administrative", "i_promotional", "i_navigational", "i_entertainment", "half_life", "transience", "profile_entropy")

#: O-103 to O-107: evidence for and against, what remains certain, and the choice to keep.
_FOR = {"educational": "educational", "technical": "technical", "factual": "r_factual", "reasoning": "r_reasoning", "referential": "reference", "code": "code", "structural": "r_structural", "coherence": "q_coherence", "novelty": "novelty", "density": "per_token"}
_AGAINST = {"redundancy": "r_redundancy", "corruption": "r_corruption", "noise": "n_noise", "synthetic": "r_corruption", "navigational": "r_navigational", "transactional": "r_transactional", "promotional": "r_promotional", "administrative": "n_admin"}
_F, _A = list(_FOR.values()), list(_AGAINST.values())
SELECTION = Sheet([
    {"n_noise": mean(["filler", "entertainment", "commerce"]), "n_admin": f"CASE WHEN contact_ratio > 0 OR schedule_ratio > 0 THEN {base(['contact_ratio', 'schedule_ratio', 'uniform_ratio', 'r_temporal'])} ELSE 0.0 END", "integrity": sat("fence_ratio + table_ratio + structured_ratio", ["fence_ratio", "table_ratio", "structured_ratio"])},
    {"strength": base(_F), "against": base(_A), "spread_all": spread(_F + _A), "spread_for": spread(_F), "substance": base(["educational", "technical", "reference", "code", "per_token", base(_F)]), "noise": base(["filler", "entertainment", "commerce", "r_redundancy", "r_corruption"]), "peak": base(["educational", "reference", "technical", "code"])},
    {
        "utility": f"{sat('strength', _F)} * (1.0 - {sat('against', _A)})",
        "uncertainty": clip("spread_all * (1.0 - q_coherence)"),
        "confidence": clip(f"(1.0 - spread_for) * {sat('wc', ['wc', 'spread_for', 'q_coherence'])} + q_coherence * (1.0 - spread_for)"),
        "threshold": f"strength * (1.0 - against * {sat('against', _F + _A)})",
        "commerce_peak": "greatest(r_transactional, r_promotional)", "compact": rate("wc", "sentences", "lc"),
    },
    {"margin": "utility - threshold * (1.0 - uncertainty)"},
    {
        "preserve": "CASE WHEN integrity > substance OR fence_ratio > 0 OR table_ratio > 0 OR structured_ratio > 0 THEN true"
        " WHEN code > noise AND (educational > noise OR technical > substance) THEN true"
        " WHEN r_narrative > greatest(r_factual, r_referential, r_reasoning) AND reference < substance AND margin < 0 THEN false"
        " WHEN commerce_peak > substance AND margin < 0 THEN false"
        " WHEN n_admin > substance AND margin < 0 AND n_admin > noise THEN false"
        " WHEN peak >= noise AND margin > -threshold * (1.0 - uncertainty) THEN true"
        " WHEN relations >= 1 AND (compact <= peak OR r_factual >= r_narrative) THEN true"
        " WHEN margin >= 0 AND (substance >= noise OR strength > noise) THEN true ELSE false END",
        "top_for": lambda d: d.max_of(_FOR), "top_against": lambda d: d.max_of(_AGAINST),
    },
    {"discard": lambda d: "CASE WHEN preserve THEN '' ELSE concat(top_against, '_over_', top_for) END"},
])
SELECTION_COLUMNS = ("strength", "utility", "uncertainty", "confidence", "threshold", "margin", "integrity")
EVIDENCE = MEASURED + CHANNELS + QUALITY + INTENT + SELECTION


def _documents(spark, d):
    return spread_scan(table(spark, d, "documents").where("text is not null").select("doc_id", "source", "domain", "text")).where(r"regexp_like(text, r'[^ \t\n\f\r\x0b\p{Z}\x{85}]')")


_SOURCE = rf"(SELECT doc_id, source, domain, text FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '[^ \t\n\f\r\x0b\p{{Z}}\x{{85}}]'))"


def _picked(columns) -> list[str]:
    # a little more than nothing, so that both engines round halves alike
    return [f"round(CAST({c} AS DOUBLE) + 1e-9, 5) AS {c}" for c in columns]


def _query(sheet: Sheet, columns, plain=()):
    def run(spark, d):
        return sheet.spark(_documents(spark, d)).selectExpr("doc_id", *_picked(columns), *plain)

    return run, f"SELECT doc_id, {', '.join([*_picked(columns), *plain])} FROM {sheet.duck(_SOURCE)}"


QUERIES, ORACLE = {}, {}
for _name, _sheet, _columns, _plain, _doc in (
    ("raw_document_features", RAW, RAW_COLUMNS, (), "O-053: the 26 raw features of every document."),
    ("junk_filter_scores", RAW + FILTERS, FILTER_COLUMNS, (), "O-061, O-062, O-064 to O-073: the twelve junk scores of every document."),
    ("quality_signal_scores", MEASURED, SIGNAL_COLUMNS, (), "O-058 to O-060: the quality signals of every document; with the junk scores and the length they are all 34."),
    ("latent_channels", MEASURED + CHANNELS, tuple(_ALL), (), "O-054, O-055, O-097: the 17 latent channels of every document."),
    ("dynamic_quality", MEASURED + CHANNELS + QUALITY, QUALITY_COLUMNS, (), "O-098 to O-100: density, novelty, coherence and quality channels."),
    ("intent_profile", MEASURED + CHANNELS + QUALITY + INTENT, INTENT_COLUMNS, ("primary_axis",), "O-101, O-102: intents, half life, and the profile of the channels."),
    ("evidence_selection", EVIDENCE, SELECTION_COLUMNS, ("preserve", "discard", "top_for", "top_against"), "O-103 to O-108: evidence for and against, margin, and whether a document is kept."),
):
    QUERIES[_name], ORACLE[_name] = _query(_sheet, _columns, _plain)
    QUERIES[_name].__name__, QUERIES[_name].__doc__ = _name, _doc
