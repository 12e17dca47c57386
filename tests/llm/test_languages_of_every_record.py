"""Every record comes out with a language and a confidence, whatever its text."""

from loamstone.llm import language

SCHEMA = "id string, category string, lang string, text string"
EN = "The keeper has opened the gate in the morning."
DE = "Der Wärter hat das Tor am Morgen nicht geöffnet."


def test_records_without_sentences_come_out(spark, tmp_path):
    rows = [(f"ml-{k}", "c", "en", EN) for k in range(8)] + [(f"xx-{k}", "c", "de", DE) for k in range(8)]
    rows += [("ml-null", "c", "en", None), ("xx-blank", "c", "de", " "), ("xx-sum", "c", "de", "12 / 7 = ?"), ("xx-none", None, None, "Menu · Login"), ("xx-name", "c", "de", "Rosa Brann Quell Tarn.")]
    rows += [("ml-two", "c", "en", None), ("ml-two", "c", "en", f"{DE}\n{EN}\n{EN}"), (None, "c", "de", None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/redteam_multilingual.parquet")
    got = {r["id"]: r for r in language.p3_documents(spark, str(tmp_path)).collect()}
    assert set(got) == {r[0] for r in rows}
    assert {i: got[i]["lang"] for i in ("ml-null", "xx-blank", "xx-sum", "xx-none", "xx-name")} == {"ml-null": "en", "xx-blank": "de", "xx-sum": "de", "xx-none": "de", "xx-name": "de"}
    assert got["ml-null"]["share"] is None and got["ml-two"]["lang"] == "en" and abs(got["ml-two"]["share"] - 2 / 3) < 1e-9
    assert all(0 < r["confidence"] <= 1 for r in got.values())
    assert not {r["id"] for r in language.p3_found(spark, str(tmp_path)).collect()} - {"ml-two"}


def test_a_null_does_not_make_rows_equal(spark):
    """Spark's hash passes over nulls, so id and label must be compared themselves."""
    rows = [(None, "c", "xx", DE), ("xx", "c", None, DE), ("xx", "c", None, DE)]
    got = sorted((r["id"] or "", r["line_no"], r["lang"]) for r in language.identify(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("", 1, "de"), ("xx", 1, "de")]
