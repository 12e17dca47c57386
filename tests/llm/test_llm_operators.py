"""Small fixtures for every llm operator: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import random

import pytest

from loamstone.llm import batches, furniture, language, leakage, lines, packing, pii, repetition, residue, structure

BODY = "The narrow gate was opened by the keeper in the morning, and nobody noticed that the water had risen. "
LONG = BODY * 3000


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# 1 residue
@pytest.mark.parametrize(
    "text, kind",
    [
        (None, None), ("", None), (" \n\t", None), (BODY, None), (LONG, None),
        ("Access denied. You do not have permission to view /x.", "error"),
        ("Please enable JavaScript to continue.", "script"),
        ("Lorem ipsum dolor sit amet amet dolor.", "filler"),
        ("Dear {{first_name}},\n" + BODY, "slot"),
        ('A page that says "please enable JavaScript" is often empty. ' + BODY, None),
        ("```\nx = render(\"{{ a }}\")\n```\n" + BODY, None),
        (BODY * 4 + "\nYour browser has scripts turned off; some features will not work.", None),
    ],
)
def test_residue(text, kind):
    assert residue.measure(text)[2] == kind


def test_residue_frame(spark):
    rows = [("a", "404 Not Found", 1), ("a", "404 Not Found", 2), ("b", None, 1), (None, "404 Not Found", 1)]
    df = frame(spark, rows, "id string, text string, coverage int")
    got = {r["id"]: r["kind"] for r in residue.residue_scores(df).collect()}
    assert got == {"a": "error", "b": None, None: "error"}
    assert residue.drop_residue(df).count() == 2
    assert residue.residue_scores(df.limit(0)).count() == 0


# 2 repeated lines
def test_repeated_lines(spark):
    rows = []
    for k in range(40):
        text = f"Own words number {'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]} of this text stand here"
        if k % 2 == 0:
            text = "Share this  PAGE, 12 now!\n" + text
        rows.append((k, text, "s1" if k < 20 else None, "x"))
    rows += [(100, None, "s1", "x"), (101, "", "s1", "x"), (102, LONG, "s1", "x"), (103, "share this page now\nshare this page now", "s2", "x")]
    df = frame(spark, rows, "doc_id long, text string, source string, key string")
    r = lines.repeated_lines(df, least_share=0.1)
    got = {(x["source"], x["docs_with"]) for x in r.collect()}
    assert got == {("s1", 10), (None, 10)}
    marked = {tuple(x) for x in lines.marked_lines(lines.keyed_lines(df), r).collect()}
    assert marked == {(k, 1) for k in range(0, 40, 2)}
    clean = {x["doc_id"]: x["text"] for x in lines.without_repeated_lines(df, r).collect()}
    assert len(clean) == len(rows) and clean[100] is None and clean[101] == "" and clean[102] == LONG
    assert clean[0].startswith("Own words") and clean[103] == rows[-1][1]
    assert lines.repeated_lines(df.limit(0)).count() == 0


def test_line_key_rules():
    assert lines.line_hash("Share THIS-page 12!") == lines.line_hash("share  this page")
    assert not lines.has_words("two words 12 .") and lines.has_words("now 3 words here")


# 3 languages
@pytest.mark.parametrize("label, lang", [("en", "en"), (" DE", "de"), ("pt_BR", "pt"), ("Dutch", "nl"), ("es-419", "es"), ("zho", "zh"), ("mul", None), ("", None), (None, None), ("en/de", None), ("?", None)])
def test_labels(label, lang):
    assert language.declared(label) == lang


def test_language_frame(spark):
    rows = [
        ("ml-1", "c", "en", "The keeper has opened the gate in the morning.\nDer Wärter hat das Tor am Morgen nicht geöffnet.", 0),
        ("ml-2", None, None, "La llave de la puerta no está en el cajón.\nMenu · Login\n12 3 4", 0),
        ("ml-3", "c", "zh", "图书馆限制了用水的需求，在寒冷的月份里都是如此。", 0),
        ("ml-4", "c", "en", None, 0), ("ml-5", "c", "en", "", 0),
        ("ml-2", None, None, "La llave de la puerta no está en el cajón.\nMenu · Login\n12 3 4", 0),
    ]
    df = frame(spark, rows, "id string, category string, lang string, text string, confidence int")
    got = {(r["id"], r["line_no"], r["lang"]) for r in language.identify(df).collect()}
    assert got == {("ml-1", 1, "en"), ("ml-1", 2, "de"), ("ml-2", 1, "es"), ("ml-3", 1, "zh")}
    assert language.identify(df.limit(0)).count() == 0


# 4 personal data
def test_checksums():
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB83WEST12345698765432")
    assert pii.letter23("12345678Z") and not pii.letter23("12345678A")


def test_pii_frame(spark):
    text = "Contact Mira Holtby on +44 20 7946 0025 or mira.h [at] post [dot] example. Account holder Mira Holtby, national ID QQ 79 59 90 C, lives at Flat 5, 12b Mill Lane, Oxby 47713."
    rows = [("a", text, "k"), ("a", text, "k"), ("b", None, "k"), ("c", "", "k"), ("d", "The part number 00584-533-7 is printed. Version 4.369.2 and host 192.0.2.31. Any value of the form user@domain.tld.", "k")]
    df = frame(spark, rows, "id string, text string, kind string")
    lex = frame(spark, [("Mira", "given"), ("Holtby", "family"), (None, "given")], "name string, kind string")
    got = sorted((r["id"], r["kind"], r["start_pos"]) for r in pii.find_pii(df, lex).collect())
    want = [("a", "address", text.index("Flat 5")), ("a", "email", text.index("mira.h")), ("a", "id_number", text.index("QQ 79")), ("a", "name", text.index("Mira")), ("a", "name", text.rindex("Mira")), ("a", "phone", text.index("+44"))]
    assert got == sorted(want)
    items = pii.spans(text, frozenset({"mira"}), frozenset({"holtby"}))
    red = pii.redact(text, items)
    assert "[EMAIL]" in red and "Mira" not in red and red.startswith("Contact [NAME] on [PHONE]")
    assert pii.find_pii(df.limit(0), lex).count() == 0 and pii.redact(None, []) is None


# 5 batches
def edit(words, rng, share):
    out = list(words)
    for k in rng.sample(range(len(out)), int(share * len(out))):
        out[k] = "zz" + str(rng.randrange(10**6))
    return out


def test_batches_against_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"w{k}" for k in range(300)]
    base = [[rng.choice(vocab) for _ in range(rng.randrange(5, 120))] for _ in range(60)]
    docs = [(k, " ".join(w)) for k, w in enumerate(base)] + [(60, None), (61, " "), (62, " ".join(base[3])), (62, " ".join(base[3]))]
    batch = [(1000 + k, "<p>" + " ".join(edit(base[k], rng, rng.choice([0, 0.1, 0.14, 0.2, 0.3]))).upper() + "!</p>") for k in range(60)]
    batch += [(1100, " ".join(["new"] * 40)), (1101, "New, " * 40), (1102, None), (1103, "")]
    d = frame(spark, [(*r, "x") for r in docs], "doc_id long, text string, n string")
    b = frame(spark, [(*r, "x") for r in batch], "doc_id long, text string, holder string")
    got = {(r["first_doc_id"], r["doc_id"]) for r in batches.holders(d, b).collect()}
    rows = [(i, batches.words(t)) for i, t in docs + batch]
    want = set()
    for i, w in rows:
        if i >= 1000 and w:
            h = [j for j, v in rows if j < i and v and (v == w or batches.near(w, v))]
            if h:
                want.add((min(h), i))
    assert got == want and len(want) > 30


def test_batches_empty(spark):
    e = frame(spark, [], "doc_id long, text string")
    one = frame(spark, [(5, "a few words of text")], "doc_id long, text string")
    assert batches.holders(e, e).count() == 0
    assert batches.holders(e, one).count() == 0


def test_lcs_brute_force():
    rng = random.Random(3)
    for _ in range(50):
        a = [rng.choice("abc") for _ in range(rng.randrange(0, 12))]
        b = [rng.choice("abc") for _ in range(rng.randrange(0, 12))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert batches.lcs(a, b) == t[-1][-1]


# 6 furniture
@pytest.mark.parametrize(
    "line, found",
    [
        ("Home | Science | Search", True), ("Home > Video / old stone bridge", True), ("© 2019 Mill Post. All rights reserved.", True), ("Related stories: a | b", True),
        ("* Jobs", True), ("3 comments · sort by newest", True), ("Question: Why does the gate fail?", False), ("# The old gate", False),
        ("- Keep the gate shut at night.", False), ("Readers who subscribe to a printed journal rarely read more than 4 pages of it.", False),
        (BODY + "Back to top ↑", False),
    ],
)
def test_furniture(line, found):
    text = BODY + "\n" + line + "\n" + BODY
    assert [f for no, _, f in furniture.furniture_lines(text) if no == 2] == [found]


def test_furniture_frame(spark):
    rows = [("a", BODY + "\nBack to top ↑", 1), ("a", BODY + "\nBack to top ↑", 2), ("b", None, 1), ("c", " ", 1), ("d", LONG, 1)]
    df = frame(spark, rows, "id string, text string, line_no int")
    got = [(r["id"], r["line_no"]) for r in furniture.page_lines(df).where("furniture").collect()]
    assert got == [("a", 2)]
    body = {(r["id"], r["text"]) for r in furniture.main_text(df).collect()}
    assert ("b", None) in body and ("a", BODY) in body
    assert furniture.page_lines(df.limit(0)).count() == 0


# 7 repetition
def brute_share(text):
    w = repetition.words(text or "")
    mark = set()
    for i in range(len(w) - 4):
        if any(w[j : j + 5] == w[i : i + 5] for j in range(i)):
            mark |= set(range(i, i + 5))
    total = sum(map(len, w))
    return sum(len(w[k]) for k in mark) / total if total else 0.0


def test_repetition_frame(spark):
    rng = random.Random(5)
    texts = [None, "", "one two", "go " * 200, LONG]
    for _ in range(40):
        s = [" ".join(rng.choice("abcdefghij") * 3 for _ in range(7)) for _ in range(6)]
        texts.append(". ".join(rng.choice(s) for _ in range(rng.randrange(2, 10))))
    rows = [(str(k), t, 1.0) for k, t in enumerate(texts)] * 2
    df = frame(spark, rows, "id string, text string, share double")
    trusted = frame(spark, [(str(k),) for k in range(5, 12)], "id string")
    rows = repetition.repetition_shares(df, trusted).collect()
    got = {r["id"]: r["share"] for r in rows}
    # the ratio decides which texts are read again: some are not, none above the share is left out
    assert any(not r["suspect"] for r in rows) and all(r["suspect"] == (r["share"] is not None) for r in rows)
    for k, t in enumerate(texts):
        if t == LONG:
            assert got[str(k)] > 0.99
            continue
        want = brute_share(t)
        assert (got[str(k)] or 0) == pytest.approx(want) or (got[str(k)] is None and want < repetition.SHARE)
    assert repetition.repetition_shares(df.limit(0), trusted).count() == 0


# 8 packing
def test_shortest_pack_first():
    rng = random.Random(1)
    for cap in (1, 7, 64):
        h = {k: rng.randrange(0, 30) for k in range(1, cap + 1)}
        h = {k: v for k, v in h.items() if v}
        p = packing.shortest_pack_first(h, cap)
        got = {}
        for n, pattern in p:
            assert sum(a * b for a, b in pattern) <= cap
            for a, b in pattern:
                got[a] = got.get(a, 0) + n * b
        assert got == h
    assert packing.shortest_pack_first({}, 10) == []


def test_pack_frame(spark):
    texts = [None, "", "one two three", "one two three", BODY, BODY * 20]
    df = frame(spark, [(k, t, "p") for k, t in enumerate(texts)], "doc_id long, text string, container_id string")
    caps = frame(spark, [(1, 64, 1), (2, 16, 2), (None, 5, 1), (3, 1, 1)], "capacity_id int, capacity_tokens int, separator_tokens int")
    tokens = {r["doc_id"]: r["tokens"] for r in packing.token_counts(df).collect()}
    rows = packing.pack(df, caps).collect()
    for cap, size, sep in ((1, 64, 1), (2, 16, 2)):
        mine = [r for r in rows if r["capacity_id"] == cap]
        for d, n in tokens.items():
            got = sorted((r["piece_no"], r["tokens"]) for r in mine if r["doc_id"] == d)
            assert sum(t for _, t in got) == (n + sep if n else 0)
            assert [p for p, _ in got] == list(range(len(got))) and (len(got) < 2 or n + sep > size)
        fill = {}
        for r in mine:
            fill.setdefault(r["container_id"], []).append(r)
        for c in fill.values():
            assert sum(r["tokens"] for r in c) == c[0]["fill"] <= size and sorted(r["position"] for r in c) == list(range(len(c)))
    assert {r["capacity_id"] for r in rows} == {1, 2}
    assert packing.pack(df.limit(0), caps).count() == 0


def test_ranks_of_a_hot_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_RANK_GROUP", 10)
    df = frame(spark, [(k, "one two three") for k in range(200)], "doc_id long, text string")
    caps = frame(spark, [(1, 9, 1)], "capacity_id int, capacity_tokens int, separator_tokens int")
    rows = packing.pack(df, caps).collect()
    assert len({(r["container_id"], r["position"]) for r in rows}) == 200


# 9 leakage
def test_leaks_against_brute_force(spark):
    rng = random.Random(11)
    vocab = [f"v{k}" for k in range(12)]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.choice([10, 13, 30])))) for k in range(30)] + [(98, None), (99, "")]
    docs = []
    for k in range(60):
        w = [rng.choice(vocab) for _ in range(30)]
        p = items[k % 30][1].split()
        cut = rng.randrange(5, len(p) + 1)
        w[10:10] = p[:cut] if k % 2 else p[-cut:]
        docs.append((k, ", ".join(w).upper(), "x"))
    docs += [(100, None, "x"), (101, "", "x"), (101, "", "x")]
    d = frame(spark, docs, "doc_id long, text string, edits string")
    i = frame(spark, items, "item_id long, passage string")
    got = {(r["doc_id"], r["item_id"]) for r in leakage.leaks(d, i).where("run_words >= 13").collect()}
    want = set()
    for a, t, _ in docs:
        joined = " " + " ".join(leakage.words(t or "")) + " "
        for b, p in items:
            w = leakage.words(p or "")
            if any(" " + " ".join(w[s : s + 13]) + " " in joined for s in range(len(w) - 12)):
                want.add((a, b))
    assert got == want and want
    assert leakage.leaks(d.limit(0), i).count() == 0 and leakage.leaks(d, i.limit(0)).count() == 0


def test_myers_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        p = [rng.choice("ab") for _ in range(rng.randrange(1, 8))]
        t = [rng.choice("ab") for _ in range(rng.randrange(0, 12))]
        prev = [0] * (len(t) + 1)
        for i, x in enumerate(p, 1):
            cur = [i]
            for j, y in enumerate(t, 1):
                cur.append(min(prev[j - 1] + (x != y), prev[j] + 1, cur[j - 1] + 1))
            prev = cur
        assert leakage.myers(p, t) == min(prev)


def test_pieces_fit_every_window():
    for budget in (0, 1, 2, 3):
        p = leakage.piece_length(budget)
        assert min(sum(k >= s and k + p <= s + 13 for k in range(0, 300, p)) for s in range(100)) >= budget + 1


# 10 structure
def test_structure_frame(spark):
    table_ = "\n".join(f"| {k} | mopel | {k * 3}.{k} |" for k in range(20))
    rows = [
        (1, BODY * 4, "s"), (2, table_, "s"), (3, "- red stone\n- old gate\n- wide river\n" * 5, "s"), (4, None, "s"), (5, " \n", None), (6, LONG, "s"),
        (7, "https://a.example/x/1\nhttps://b.example/y/2\n" * 4, None), (8, "图书馆限制了用水的需求，在寒冷的月份里都是如此。" * 3, "s"), (9, table_ + "\n" + BODY, "s"),
        (10, "\n".join([BODY[:52], BODY[52:]] * 5), "s"), (11, BODY.upper() * 3, "s"),
    ]
    df = frame(spark, rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["blank"], r["natural_prose"]) for r in structure.text_statistics(df).collect()}
    assert got == {1: (False, True), 2: (False, False), 3: (False, False), 4: (True, None), 5: (True, None), 6: (False, True), 7: (False, False), 8: (False, True), 9: (False, False), 10: (False, True), 11: (False, True)}
    assert structure.text_statistics(df.limit(0)).count() == 0


# names
def test_every_problem_has_its_queries():
    from loamstone.llm.queries import queries

    q = queries()
    for n in (1, 2, 3, 4, 5, 6, 7, 9, 10):
        assert f"p{n}_found" in q
    assert "p8_pack" in q


def test_batches_one_after_another(spark):
    """A batch is set against history and the batches before it, by the persisted index alone."""
    rng = random.Random(9)
    base = [[f"w{rng.randrange(200)}" for _ in range(40)] for _ in range(6)]
    row = lambda i, w: (i, " ".join(w))
    schema = "doc_id long, text string"
    docs = frame(spark, [row(k, w) for k, w in enumerate(base[:3])], schema)
    index = batches.CellIndex.build(docs)
    first = frame(spark, [row(100, edit(base[0], rng, 0.1)), row(101, base[4])], schema)
    got = {(r["first_doc_id"], r["doc_id"], r["exact"]) for r in batches.holders(None, first, index).collect()}
    assert got == {(0, 100, False)}
    again = batches.CellIndex.open(spark, index.path)
    second = frame(spark, [row(200, base[4]), row(201, edit(base[4], rng, 0.05)), row(202, base[5]), row(203, base[5])], schema)
    got = {(r["first_doc_id"], r["doc_id"], r["exact"]) for r in batches.holders(None, second, again).collect()}
    assert got == {(101, 200, True), (101, 201, False), (202, 203, True)}
