"""Cases of the llm operators that a cut would lose."""

from pyspark.sql import functions as F

from loamstone.llm import batches, furniture, language, pii

BODY = "The narrow gate was opened by the keeper in the morning, and nobody noticed that the water had risen. "


# 6 furniture: rows of words that are on no list
def test_furniture_beyond_the_lists():
    def found(*lines):
        return [no for no, _, f in furniture.furniture_lines("\n".join(lines)) if f]

    assert found(BODY, "Bakery | Gardens | Ferries | Old town", BODY) == [2]
    assert found(BODY, "Most read", "1. quiet dye recipe  2. stable oven stone  3. uneven city block", BODY) == [2, 3]
    assert found("Home | Science | Search", "Back to top ↑") == [1, 2]
    assert found(BODY, "Stone | Weight | Place", "Basalt | 3 kg | Oxby", "Granite | 4 kg | Quenby", BODY) == []
    assert found(BODY, "- red stone", "# The old gate", "Boil the water, then add the salt.", BODY) == []


# 5 batches: times with fractions, and hashes without a readable time
def test_status_by_membership(spark, tmp_path):
    texts = {1: "words of the first text", 2: "words of quite another kind", 3: "a third and last remark", 4: "nothing like the rest here"}
    h = {k: batches.content_hash(t) for k, t in texts.items()}
    seen = [(h[1], "s", "2024-01-01T00:00:00.123456+00:00"), (h[1], "s", "2024-03-01T00:00:00Z"), (h[2], "s", "2023-05-01T02:00:00.5+02:00"), (h[3], "s", "some day")]
    tables = {
        "batch_docs": ([(100 + k, 1, t) for k, t in texts.items()], "doc_id long, batch_no int, text string"),
        "documents": ([(9, "unrelated")], "doc_id long, text string"),
        "content_hashes": (seen, "hash string, source string, first_seen string"),
        "corpus_doc_registry": ([], "content_hash string, observation_count long"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r["doc_id"]: (r["status"], r["first_seen"] and r["seen"]) for r in batches.p5_status(spark, str(tmp_path)).withColumn("seen", F.col("first_seen").cast("string")).collect()}
    assert got == {101: ("exact", "2024-01-01 00:00:00.123456"), 102: ("exact", "2023-05-01 00:00:00.5"), 103: ("exact", None), 104: ("new", None)}


# 3 and 4: models beyond what a task is handed are joined by word, with the same results
def test_models_of_any_size(spark, monkeypatch):
    rows = [("a", f"Contact Mira Holtby today. Signed, Mira Quen{x}al, and {y}ora Holtby wrote. Signed, {y}ora Brun{x}e.") for x in "abcde" for y in ("D", "F", "L")]
    df = spark.createDataFrame([(f"{i}{k}", t) for k, (i, t) in enumerate(rows)] + [("n", None)], "id string, text string")
    lex = spark.createDataFrame([("Mira", "given"), ("Holtby", "family")], "name string, kind string")
    held = sorted(tuple(r) for r in pii.find_pii(df, lex).where("kind = 'name'").collect())
    names = {(r["kind"], r["w"]) for r in pii.widen_lexicon(df, lex).collect()}
    monkeypatch.setattr(pii, "HELD", 2)
    assert sorted(tuple(r) for r in pii.find_pii(df, lex).where("kind = 'name'").collect()) == held and len(held) > 30
    assert {("g", "dora"), ("f", "quenaal"), ("f", "brunee")} <= names

    ml = [(f"ml-{k}", "c", "en", f"The keeper has opened the zorb{k % 4} gate in the morning.\nDer Wärter hat das Tor am Morgen nicht geöffnet.\nZorb{k % 4} gate keeper morning.") for k in range(40)]
    ml = spark.createDataFrame(ml + [("ml-x", None, None, None)], "id string, category string, lang string, text string")
    want = sorted(tuple(r) for r in language.identify(ml).select("id", "line_no", "lang", F.round("confidence", 9)).collect())
    monkeypatch.setattr(language, "HELD", 2)
    assert sorted(tuple(r) for r in language.identify(ml).select("id", "line_no", "lang", F.round("confidence", 9)).collect()) == want and len(want) >= 80
    assert language.learn_words(language.cut(ml)).count() > 2
