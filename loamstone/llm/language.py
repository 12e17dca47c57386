"""Problem 3: languages of documents and of segments in another language.

Evidence is fused in log space for every sentence: the likelihood of its text
under each language (function words, word counts learned from the corpus, and
script), the declared label with a reliability measured over the corpus, the
country suffix of addresses in the record, and the prior of the record's host
series, smoothed towards that of its category and of the whole table. The
reliabilities and priors come from grouped aggregation over all records.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstone.functions.arrow import flat_map
from loamstone.functions.text import let
from loamstone.sources.tables import spread, table, written

LANGS = ("en", "de", "nl", "fr", "es", "pt", "it", "ru", "hi", "ar", "zh", "ja")
#: The first of LANGS that its script tells.
WORDED = LANGS.index("ru")
#: Learned words that are handed to every task (about 2 MB); beyond, they are joined by word.
HELD = 20_000
#: Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on are as with his they at be this have from or had by but not what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more two him see could no than been its who now people my made over did down only way find use may long little very after words called just where most know first as yet nor neither because near once since rarely but itself behind",
    "de": "der die das und ist in den von zu mit sich des auf für nicht ein eine einen einem einer als auch es an werden aus er hat dass sie nach wird bei um am sind noch wie einem über so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei im zum ersten mal trotz ohne während sondern seit möglich zwischen beiden",
    "nl": "de het een en van in is dat op te zijn met voor niet aan er om ook als bij maar uit door over ze hij dan naar nog wel geen worden wordt deze dit die kan meer of tot heeft hebben werd was al na zo wat jaar eerst alleen ondanks tussen beide sinds zonder zelfs toont het mogelijk tijdens",
    "fr": "le la les de des du un une et est en que qui dans pour pas sur au aux par plus ne se ce il elle avec son sa ses ou mais comme leur cette ces été sont était nous vous même fait aussi non seulement première fois possible pendant malgré sans depuis après avec peu entre deux l d qu",
    "es": "el la los las de del un una y es en que se por con para no su al lo como más pero sus le ya o este esta sí porque cuando muy sin sobre también me hasta hay donde quien desde todo nos durante solo sino primera vez pesar incluso después hace años entre dos se pensaba",
    "pt": "o a os as de do da dos das um uma e é em que se por com para não sua seu ao no na nos nas como mais mas foi são também já ou pelo pela até isso ela ele entre depois sem mesmo aos ter seus quem só quando muito há nem à às pela primeira vez apesar durante",
    "it": "il lo la i gli le di del della dei delle dello degli un una uno e è in nel nella nei nelle che si per con non su al alla ai alle da dal dalla come più ma anche sono questo questa o se ha suo sua loro dopo senza solo prima volta durante fra tra ed era stato l dell nonostante due",
}
#: Names and codes by which labels call a language.
LABEL_NAMES = {
    "en": "en eng english englisch anglais inglés inglese ingles engels",
    "de": "de deu ger german deutsch allemand alemán tedesco aleman duits alemao",
    "nl": "nl nld dut dutch nederlands flemish vlaams niederländisch",
    "fr": "fr fra fre french français francais französisch francés frans francese",
    "es": "es spa esp spanish español espanol castellano spanisch espagnol spaans",
    "pt": "pt por portuguese português portugues portugiesisch portugais portugués",
    "it": "it ita italian italiano italienisch italien italiaans",
    "ru": "ru rus russian русский russisch russe ruso",
    "hi": "hi hin hindi हिन्दी हिंदी",
    "ar": "ar ara arb arabic العربية arabisch arabe árabe",
    "zh": "zh zho chi cmn chinese mandarin 中文 汉语 zh-hans zh-hant chinesisch chinois chino cn",
    "ja": "ja jpn jp japanese 日本語 japanisch japonais japonés",
}
#: Country suffixes that speak for one language.
SUFFIX = {"de": "de", "at": "de", "nl": "nl", "fr": "fr", "es": "es", "mx": "es", "pt": "pt", "br": "pt", "it": "it", "ru": "ru", "in": "hi", "eg": "ar", "sa": "ar", "cn": "zh", "tw": "zh", "jp": "ja", "uk": "en", "us": "en"}
WORD = re.compile(r"[^\W\d_]+")
SENTENCE_END = re.compile(r"(?<=[.!?])[\"'”»)\]]*\s+|(?<=[。！？।؟])[\"'”»」』）)]*\s*|(?<=[.!?][\"”»])\s+")
ADDRESS = re.compile(r"(?:https?://|www\.)?[\w-]+(?:\.[\w-]+)*\.([a-z]{2})(?=[/\s?:]|$)", re.IGNORECASE)
SCRIPTS = (("ru", re.compile(r"[Ѐ-ӿ]")), ("hi", re.compile(r"[ऀ-ॿ]")), ("ar", re.compile(r"[؀-ۿݐ-ݿ]")), ("ja", re.compile(r"[぀-ヿ]")), ("han", re.compile(r"[一-鿿]")))
OTHER = re.compile("|".join(p.pattern for _, p in SCRIPTS))
LATIN = re.compile(r"[A-Za-zÀ-ɏ]")


@lru_cache(1)
def label_map() -> dict[str, str]:
    return {n: lang for lang, names in LABEL_NAMES.items() for n in names.split()}


def declared(label: str | None) -> str | None:
    """The single language a label names, whatever its spelling; None where it names none or several."""
    if not label:
        return None
    low = label.strip().lower().replace("_", "-")
    if low in label_map():
        return label_map()[low]
    head = re.split(r"-|\s*\(", low)[0].strip()
    return label_map().get(head) if re.fullmatch(r"[^\W\d_]+(?:-[\w-]+|\s*\(.*\))", low) else None


def fold(word: str) -> str:
    """A word without Latin accents."""
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))


@lru_cache(1)
def seeds() -> dict[str, dict[str, float]]:
    """Function word -> language -> log likelihood ratio to a floor; a word without its accents counts as well."""
    by: dict[str, dict[str, float]] = {}
    for lang, text in FUNCTION_WORDS.items():
        for w in set(text.split()):
            for form in {w, fold(w)}:
                by.setdefault(form, {})[lang] = 3.0 if len(w) > 1 else 1.5
    return by


def log_likelihoods(sentence: str) -> dict[str, float]:
    """Log likelihood ratio of a sentence by language, to a language that explains none of it."""
    out = dict.fromkeys(LANGS, 0.0)
    if not sentence.isascii() and OTHER.search(sentence):
        counts = {lang: len(p.findall(sentence)) for lang, p in SCRIPTS}
        latin = len(LATIN.findall(sentence))
        top = max(counts, key=counts.get)
        if counts["ja"] and counts["ja"] + counts["han"] >= latin:
            out["ja"] += 4.0 * min(counts["ja"], 12)
            return out
        if counts["han"] and counts["han"] >= latin / 2:
            out["zh"] += 3.0 * min(counts["han"], 12)
            return out
        if counts[top] > latin:
            out[top] += 3.0 * min(counts[top], 12)
            return out
    table_ = seeds()
    for w in WORD.findall(sentence.lower()):
        if w in table_:
            for lang, v in table_[w].items():
                out[lang] += v
    return out


def sentences(line: str) -> list[str]:
    """The sentences of a line; quoted sentences apart from those around them."""
    parts = []
    for piece in re.split(r"[\"“”«»„]", line):
        parts += [p.strip() for p in SENTENCE_END.split(piece) if p and p.strip()]
    return parts


def is_sentence(s: str) -> bool:
    """A full sentence: it ends as one and has enough words (or signs, in scripts without spaces)."""
    body = s.rstrip("\"'”»)]」』 ")
    if not s.isascii() and sum(len(p.findall(s)) for lang, p in SCRIPTS if lang in ("ja", "han")) >= 6:
        return body[-1:] in "。！？.!?"
    n = len(WORD.findall(s))
    return n >= 4 and body[-1:] in ".!?。！？।؟…"


def pieces(text: str | None) -> list[tuple[int, str]]:
    """(line number, sentence) of every full sentence of a text."""
    if not text:
        return []
    return [(no, s) for no, line in enumerate(text.split("\n"), 1) for s in sentences(line) if is_sentence(s)]


def best(scores: dict[str, float]) -> tuple[str, float]:
    """Most probable language and its posterior under log scores."""
    top = max(scores, key=lambda k: (scores[k], k))
    z = sum(math.exp(v - scores[top]) for v in scores.values())
    return top, 1 / z


CUT = "id string, label string, key long, category string, declared string, suffixes array<string>, line_no array<int>, words array<string>, folded array<string>, seed array<double>, top array<string>, sure array<boolean>"


def cut(docs: DataFrame) -> DataFrame:
    """The sentences of docs (id, category, lang, text) with all that the fusion needs of them; the one pass over the texts, written.

    Arrays run along the sentences. words: the words of a sentence by blanks;
    folded: those without the accents they had; seed: log likelihoods by
    function words and script, LANGS for each sentence; sure: they alone settle
    its language. A record without sentences keeps its row, with empty arrays.
    A repeated row (id, label and text) counts once; only its text is compared
    by a hash.
    """

    def one(i, category, label, t, key):
        found = pieces(t)
        suffixes = sorted({SUFFIX[x.lower()] for x in ADDRESS.findall(t) if x.lower() in SUFFIX}) if t and "." in t else []
        nos, words, folded, seed, tops, sure = [], [], [], [], [], []
        for no, s in found:
            ll = log_likelihoods(s)
            top, p = best(ll)
            ws = WORD.findall(s.lower())
            nos.append(no)
            words.append(" ".join(ws))
            folded.append(" ".join([f for w in ws if not w.isascii() and (f := fold(w)) != w]))
            seed.extend(ll.values())
            tops.append(top)
            sure.append(ll[top] >= 6 and p > 0.95)
        return [(i, label, key, category or "", declared(label), suffixes, nos, words, folded, seed, tops, sure)]

    d = docs.select("id", "category", "lang", "text").withColumn("key", F.xxhash64("id", "lang", "text"))
    return written(flat_map(d, lambda: one, CUT).dropDuplicates(["id", "label", "key"]), "sentences")


def learn_words(records: DataFrame, least: int = 5) -> DataFrame:
    """(w, n, by): uses of every word by language over all confident sentences of `cut`, counted inside the JVM and written."""
    p = records.select(F.explode(F.arrays_zip("words", "folded", "top", "sure")).alias("p")).where("p.sure")
    flat = p.select("p.top", F.explode(F.split(F.concat_ws(" ", "p.words", "p.folded"), " ")).alias("w")).where("w <> ''").groupBy("w", F.col("top").alias("lang")).agg(F.count("*").alias("n"))
    return written(flat.groupBy("w").agg(F.sum("n").alias("n"), F.collect_list(F.struct("lang", "n")).alias("by")).where(F.col("n") >= least), "learned_words")


def likelihoods(total: int, by: list) -> dict[str, float]:
    """Log likelihood ratio of a learned word by language."""
    return {x["lang"]: min(2.5, max(-1.0, math.log((x["n"] + 0.1) / (total + 1.2) * len(LANGS)))) for x in by}


def indexed(rows) -> dict[str, list[tuple[int, float]]]:
    """Learned words with their likelihoods by place in LANGS."""
    return {r["w"]: [(LANGS.index(k), v) for k, v in likelihoods(r["n"], r["by"]).items()] for r in rows}


def with_words(records: DataFrame, words: DataFrame) -> tuple[DataFrame, Callable]:
    """records with a column `own`, and what turns it into likelihoods; the way the words reach a record changes no result.

    Up to HELD words go to every task and the column is null. More of them are
    joined to the words of each record, and a record gets those in it.
    """
    if words.count() <= HELD:
        model = indexed(words.collect())
        return records.withColumn("own", F.lit(None).cast("string")), lambda _: model
    flat = records.select("key", F.explode(F.array_distinct(F.split(F.array_join("words", " "), " "))).alias("w"))
    own = flat.join(words, "w").groupBy("key").agg(F.collect_list(F.struct("w", "n", "by")).alias("own"))
    return records.join(own, "key", "left"), lambda rows: indexed(rows or ())


READ = "id string, host string, category string, declared string, suffixes array<string>, main string, line_no array<int>, ll array<array<double>>"


def read_likelihoods(records: DataFrame, words: DataFrame) -> DataFrame:
    """Records with the log likelihoods of their sentences by seeds and learned words, and their main language where it is clear; written."""
    r, model_of = with_words(records, words)

    size = len(LANGS)

    def one(i, category, d, suffixes, nos, words, seed, own):
        learned, lls = model_of(own), []
        for k, ws in enumerate(words):
            ll = seed[k * size : (k + 1) * size]
            if not any(ll[WORDED:]):  # words speak only where no other script does
                for w in ws.split():
                    for at, v in learned.get(w, ()):
                        ll[at] += v
            lls.append(ll)
        lang, p = best({k: sum(v[n] for v in lls) for n, k in enumerate(LANGS)})
        return [(i, series(i), category, d, suffixes, lang if p >= 0.9 else None, nos, lls)]

    return written(flat_map(r.select("id", "category", "declared", "suffixes", "line_no", "words", "seed", "own"), lambda: one, READ), "likelihoods")


def series(record_id: str | None) -> str:
    """The crawl series of a record, the part of its id before the running number; it stands for the host."""
    return (record_id or "").rpartition("-")[0]


def priors(read: DataFrame, strength: float = 20.0) -> DataFrame:
    """(host, category, prior): log priors in the order of LANGS of every host series and category.

    Dirichlet smoothing from the whole table down to the category and the host
    series, all by grouped aggregation; nothing of it comes to the driver.
    """
    by = read.where("main is not null").groupBy("host", "category", "main").agg(F.count("*").alias("n"))
    counts = F.array(*[F.sum(F.when(F.col("main") == x, F.col("n")).otherwise(0)).cast("double") for x in LANGS])
    whole = by.agg(counts.alias("t"))  # one row
    category = by.groupBy("category").agg(counts.alias("c"))
    host = by.groupBy("host").agg(counts.alias("h"))
    pairs = read.select("host", "category").distinct().join(category, "category", "left").join(host, "host", "left").crossJoin(F.broadcast(whole))
    none = F.array(*[F.lit(0.0) for _ in LANGS])

    def total(c):
        return F.aggregate(c, F.lit(0.0), lambda s, x: s + x)

    def smooth(c, p):
        return let(F.struct(F.coalesce(c, none).alias("c"), total(F.coalesce(c, none)).alias("n"), p.alias("p")), lambda v: F.zip_with(v["c"], v["p"], lambda k, q: (k + strength * q) / (v["n"] + strength)))

    table_level = let(F.struct(F.coalesce("t", none).alias("t"), total(F.coalesce("t", none)).alias("n")), lambda v: F.transform(v["t"], lambda k: (k + 1) / (v["n"] + len(LANGS))))
    x = pairs.withColumn("p", table_level).withColumn("p", smooth(F.col("c"), F.col("p"))).withColumn("p", smooth(F.col("h"), F.col("p")))
    return x.select("host", "category", F.transform("p", lambda v: F.log(v)).alias("prior"))


def evidence(docs: DataFrame) -> DataFrame:
    """(id, declared, suffixes, prior, good, line_no, ll) of every record of docs (id, category, lang, text): all that speaks for a language."""
    records = cut(docs)
    read = read_likelihoods(records, learn_words(records))
    hit = F.sum(F.when(F.col("main") == F.col("declared"), 1).otherwise(0))
    agree = read.where("main is not null and declared is not null").agg(((F.coalesce(hit, F.lit(0)) + 4.0) / (F.count("*") + 5.0)).alias("good"))  # one row
    r = read.join(priors(read), ["host", "category"]).crossJoin(F.broadcast(agree))
    return r.select("id", "declared", "suffixes", "prior", "good", "line_no", "ll")


def fused(r: DataFrame, ll) -> DataFrame:
    """r with top, the language of likelihoods ll with prior, label and suffix, and the confidence in it."""
    langs = F.array(*map(F.lit, LANGS))
    label = lambda x: F.when(F.col("declared").isNull(), 0.0).when(F.col("declared") == x, F.log("good")).otherwise(F.log((1 - F.col("good")) / (len(LANGS) - 1)))
    f = F.zip_with(ll, F.arrays_zip(F.col("prior").alias("p"), langs.alias("x")), lambda v, y: F.struct((v + y["p"] + label(y["x"]) + F.when(F.array_contains("suffixes", y["x"]), 1.0).otherwise(0.0)).alias("v"), y["x"].alias("x")))
    r = r.withColumn("f", f).withColumn("top", F.array_max("f"))
    z = let(F.col("top.v"), lambda m: F.aggregate("f", F.lit(0.0), lambda s, y: s + F.exp(y["v"] - m)))
    return r.withColumn("confidence", 1 / z).withColumn("top", F.col("top.x")).drop("f")


def of_sentences(r: DataFrame) -> DataFrame:
    """(id, line_no, lang, confidence, declared) of every full sentence of `evidence` that some language explains."""
    r = r.withColumn("s", F.explode(F.arrays_zip("line_no", "ll"))).where(F.array_max("s.ll") >= 2.5)
    return fused(r.select("id", "declared", "suffixes", "prior", "good", "s"), F.col("s.ll")).select("id", "s.line_no", F.col("top").alias("lang"), "confidence", "declared")


def identify(docs: DataFrame) -> DataFrame:
    """(id, line_no, lang, confidence, declared) of every full sentence of docs (id, category, lang, text).

    Fuses text likelihood, label, address suffix and prior inside the JVM.
    Null and blank texts have no sentences; a null category or label gives no
    evidence. Repeated rows of an id count once. Sentences that no language
    explains (names, figures, addresses) are left out.
    """
    return of_sentences(evidence(docs))


def main_languages(docs: DataFrame) -> DataFrame:
    """(id, lang, share, confidence) of every id of docs: the main language by its sentences, their share and mean confidence.

    A record without a sentence that some language explains comes out by what
    else speaks for a language: label, suffix, prior and the little its
    sentences say. Its share is null.
    """
    r = evidence(docs)
    whole = F.aggregate("ll", F.array(*[F.lit(0.0) for _ in LANGS]), lambda s, x: F.zip_with(s, x, lambda a, b: a + b))
    s = of_sentences(r).groupBy("id", "lang").agg(F.count("*").alias("n"), F.avg("confidence").alias("confidence"))
    s = s.unionByName(fused(r, whole).select("id", F.col("top").alias("lang"), F.lit(0).cast("long").alias("n"), "confidence"))
    order = F.struct("n", F.when(F.col("n") == 0, F.col("confidence")).otherwise(0.0).alias("c"), "lang")
    return s.groupBy("id").agg(F.max_by("lang", order).alias("lang"), F.try_divide(F.max("n"), F.sum("n")).alias("share"), F.max_by("confidence", order).alias("confidence"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = identify(spread(table(spark, sf_dir, "redteam_multilingual").select("id", "category", "lang", "text")))
    return s.where("id is not null and (declared is null or declared <> lang)").select("id", "line_no", "lang").distinct()


def p3_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main language of every record, its share of the sentences and mean confidence."""
    return main_languages(spread(table(spark, sf_dir, "redteam_multilingual").select("id", "category", "lang", "text")))
