"""What each named method decides: cases that come out otherwise without it."""

import random

from loamstone.llm import furniture, language, leakage, lines, pii, repetition, residue

BODY = "The narrow gate was opened by the keeper in the morning, and nobody noticed that the water had risen. "
WORDS = "stone river morning keeper window harvest lantern copper meadow signal thread cellar orchard bridge hollow canvas marble anchor timber velvet".split()


# 1 residue: wording that is on no list
def test_filler_of_unlisted_words():
    made_up = "Brastum lorem nokuri dolor famentu. Quistal amet brastum ipsum nokuri. Famentu quistal dolor brastum nokuri."
    assert residue.measure(made_up)[2] == "filler"
    assert residue.measure(made_up + " " + BODY * 6)[2] is None
    assert residue.measure("Brastum nokuri famentu quistal. " * 3)[2] is None


def test_a_long_sentence_only_mentions_an_error():
    long = "When the visiting class had asked for the older register, the keeper of the archive answered after a long search that the volume was not found among the shelves of the northern reading room, which had been closed since the flood of that year"
    assert residue.measure(long + ". " + BODY)[2] is None
    assert residue.measure("The page you requested was not found on this server, it may have moved or been removed from the archive of the older pages")[2] == "error"


# 2 lines: the ratio refuses what stands everywhere by the same share
def test_ratio_refuses_common_lines(spark):
    rows = []
    for k in range(120):
        source = "abc"[k % 3]
        text = [f"Own words of text number {WORDS[k % 20]} {WORDS[(k * 7) % 19]} {k}"]
        if k % 30 < 3:
            text.append("A line that every source repeats alike")
        if source == "a" and k % 2 == 0:
            text.append("A line of the first source alone")
        rows.append((k, source, "\n".join(text)))
    df = spark.createDataFrame([*rows, (900, None, None), (901, "a", "")], "doc_id long, source string, text string")
    keys = {(r["source"], r["key"]) for r in lines.repeated_lines(df, least_share=0.05).collect()}
    assert ("a", lines.line_hash("A line of the first source alone")) in keys
    assert not any(k == lines.line_hash("A line that every source repeats alike") for _, k in keys)
    clean = {r["doc_id"]: r["text"] for r in lines.without_repeated_lines(df, lines.repeated_lines(df, least_share=0.05)).collect()}
    assert len(clean) == 122 and clean[900] is None and clean[901] == "" and not any("first source" in (t or "") for t in clean.values())
    assert sum("every source" in (t or "") for t in clean.values()) == sum("every source" in (r[2] or "") for r in rows)


# 3 languages: label, suffix and host prior settle what the words leave open
def test_priors_and_labels_settle(spark):
    open_ = "Casa velha de dona Rosa."
    rows = [(f"pt-site-{k}", "c", None, "Não há nada de novo na cidade, mas ela já foi embora.") for k in range(30)] + [(f"es-site-{k}", "c", None, "No hay nada de nuevo en la ciudad, pero ella ya se fue con los otros.") for k in range(30)]
    rows += [("pt-site-x", "c", None, open_), ("es-site-x", "c", None, open_), ("other-1", "c", "es", open_), ("other-2", "c", "pt", open_), ("other-3", "c", None, open_ + "\nwww.casa.com.br")]
    got = {r["id"]: (r["lang"], r["confidence"]) for r in language.identify(spark.createDataFrame(rows, "id string, category string, lang string, text string")).where("line_no = 1").collect()}
    assert got["pt-site-x"][0] == "pt" and got["es-site-x"][0] == "es" and got["other-1"][0] == "es" and got["other-2"][0] == "pt" and got["other-3"][0] == "pt"
    assert all(0 < c <= 1 for _, c in got.values())


# 4 personal data: numbers that nothing announces stand or fall by their check digits
def test_checksums_decide():
    none = frozenset()
    good, bad = "4539 1488 0343 6467", "4539 1488 0343 6468"
    assert [x[0] for x in pii.spans(f"It was {good} then.", none, none)] == ["id_number"] and pii.spans(f"It was {bad} then.", none, none) == []
    iban, broken = "DE89370400440532013000", "DE88370400440532013000"
    assert [x[0] for x in pii.spans(f"See {iban} there.", none, none)] == ["id_number"] and pii.spans(f"See {broken} there.", none, none) == []


# 6 furniture: the threshold of the body's path decides, not the phrases
def test_density_decides_furniture(monkeypatch):
    page = "\n".join([BODY * 3, "Home | Science | Search", "Accept the gate key", "The old gate", "- Keep it shut"])

    def found():
        return [no for no, _, f in furniture.furniture_lines(page) if f]

    assert found() == [2, 3]
    # headings and lists hold no links: they are as dense as the body, whatever their length
    assert [d for _, d, _ in furniture.furniture_lines(page)[3:]] == [1.0, 1.0]
    real = furniture.body_threshold
    monkeypatch.setattr(furniture, "body_threshold", lambda blocks: (0.08, real(blocks)[1]))
    assert found() == [2]
    monkeypatch.setattr(furniture, "body_threshold", lambda blocks: (0.0, real(blocks)[1]))
    assert found() == []


# 7 repetition: the ratio alone says which texts are read again
def test_ratio_orders_repetition():
    rng = random.Random(2)
    new, again = 0.3, [-2.0 - rng.random() for _ in range(repetition.BUCKETS)]
    fresh = " ".join(f"{rng.choice(WORDS)}{rng.choice('abcdefgh')}{rng.choice('ijklmnop')}" for _ in range(200))
    loop = " ".join(WORDS[:8] * 20)
    half = fresh[:400] + " " + " ".join(WORDS[:8] * 4)
    scores = [repetition.score(t, new, again) for t in (fresh, half, loop)]
    assert scores[0] > scores[1] > scores[2] and scores[0] > repetition.threshold(new, again) >= scores[2]


# 9 leaks: passages with one word changed, dropped or put in
def test_edited_passages_are_found():
    rng = random.Random(9)
    words = [a + b for a in WORDS for b in ("s", "ed", "ing", "er", "ful")]
    items = [(k, " ".join(rng.choice(words) for _ in range(40))) for k in range(20)]
    m = leakage.Matcher(items, 1)
    found = exact = 0
    for k, p in items:
        w = p.split()
        at = 20 + rng.randrange(3)
        cut = w[10:34]
        edit = rng.randrange(3)
        if edit == 0:
            cut[at - 10] = "changed"
        elif edit == 1:
            del cut[at - 10]
        else:
            cut.insert(at - 10, "inserted")
        # runs of fewer than thirteen words on both sides of the edit
        text = " ".join(["before", *cut[at - 20 : at - 10 + 12], "after"])
        hits = {i: (run, e) for i, run, e in m.match(text)}
        found += k in hits and hits[k][1] <= 1
        exact += k in hits and hits[k][0] >= leakage.WINDOW
    assert found == len(items) and exact < len(items)
    assert leakage.Matcher(items, 0).match(" ".join(items[0][1].split()[:12] + ["other"])) == []
