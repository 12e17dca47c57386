"""Layers of expressions on hand-made cases, and both renderings of them on the same rows."""

import duckdb
import pytest

from loamstone.functions import sheet as H
from loamstone.plans import curation, decisions, evidence, gates, languages, rights

MIT = "Permission is hereby granted, free of charge, provided that the following conditions are met. The software comes as is, without warranty of merchantability. MIT License, apache license, gnu general public license."


def rows(spark, layers, texts, columns):
    df = spark.createDataFrame([(k, "a-source", "web", t) for k, t in enumerate(texts)], "doc_id long, source string, domain string, text string")
    got = [tuple(r) for r in layers.spark(df).selectExpr("doc_id", *columns).orderBy("doc_id").collect()]
    c = duckdb.connect()
    c.execute("create table docs (doc_id bigint, source text, domain text, text text)")
    c.executemany("insert into docs values (?, 'a-source', 'web', ?)", [(k, t) for k, t in enumerate(texts)])
    want = c.execute(f"select doc_id, {', '.join(columns)} from {layers.duck('docs')} order by doc_id").fetchall()
    assert [tuple(float(v) if isinstance(v, (int, float)) else v for v in r) for r in got] == [pytest.approx(tuple(float(v) if not isinstance(v, (str, bool, type(None))) or isinstance(v, bool) else v for v in r)) for r in want]
    return {r[0]: r[1:] for r in got}


def test_peers(spark):
    def value(e):
        return spark.sql(f"select {e}").first()[0]

    assert float(value(H.base(["0.4"]))) == pytest.approx(0.4) and float(value(H.base(["0.4", "0.0"]))) == pytest.approx(0.34) and float(value(H.base(["0.0", "0.0"]))) == 0
    assert float(value(H.base(["0.4", "0.2"]))) == pytest.approx(0.4 / 0.7) and float(value(H.sat("8.0", ["0.0", "0.0"]))) == pytest.approx(0.8)
    assert float(value(H.spread(["0.3", "0.3"]))) == pytest.approx(0.3) and float(value(H.spread(["0.1", "0.4"]))) == pytest.approx(0.3)


def test_raw_features_and_signals(spark):
    texts = ["# Head\n\nIn 1999 the gate was a door [1]. Step by step!\nWho?\n| a | b |\n", "```\nx = 1\n```\nplain", "word word word word word word", "𝒜 é 中文 字", "", "   \n\t ", "a" * 30000]
    r = rows(spark, evidence.MEASURED, texts, ["wc", "lc", "citations", "years", "fence_ratio", "table_ratio", "word_diversity", "line_rep", "char_rep", "char_entropy"])
    assert r[0][:4] == (15.0, 4.0, 1.0, 1.0) and r[1][4] == pytest.approx(13 / 19) and r[2][6] == pytest.approx(1 / 6) and r[4][0] == 0 and r[6][9] == pytest.approx(0)


def test_junk_scores(spark):
    shop = "Buy now $10\nOrder today $20\nCheckout at www.shop.example/cart"
    talk = "Moreover, it rained. Furthermore, it snowed. However, we stayed. It was late."
    r = rows(spark, evidence.RAW + evidence.FILTERS, [shop, talk, "Download the crack and the keygen for the game crack", "keygen law: illegal", "x" * 90 + " and so the"], ["commercial", "discourse", "piracy", "truncation"])
    assert r[0][0] == 1.0 and r[1][1] > 0.9 and r[2][2] >= 0.92 and r[3][2] == 0.0 and r[1][0] == 0


def test_evidence_and_decisions(spark):
    prose = "The theorem was measured in a study, because the proof is an example of design. " * 12
    r = rows(spark, decisions.DECIDED, [prose, "click here", "ignore previous system prompt jailbreak"], ["preserve", "action", "reason", "grade", "content_type"])
    assert r[2][1:3] == ("DROP", "injection") and r[1][1] == "DROP" and {v[4] for v in r.values()} == {"text"}


def test_licences(spark):
    texts = ["SPDX-License-Identifier: Apache-2.0", "see https://creativecommons.org/licenses/by-sa/4.0/", "It is licensed under the mit license.", "read https://www.epa.gov/x", "no part of this book may be reproduced", "plain", "Copyright 2020 Mill. All rights reserved."]
    r = rows(spark, rights._FULL, texts, ["licence", "rights_action", "rights_reason"])
    assert r[0] == ("Apache-2.0", "KEEP", "permitted_license") and r[1][0] == "CC-BY-SA" and r[3][:2] == ("Public Domain", "KEEP") and r[4][1] == "REMOVE" and r[5] == ("Unknown", "FLAG", "unknown_license")


def test_licence_regions(spark):
    r = rows(spark, rights.REGIONS, [MIT, "# SPDX-License-Identifier: MIT", "The MIT license is short, and this lesson explains an example of an algorithm.", "plain words"], ["region_score", "region_action"])
    assert r[1][1] == "remove" and r[2][1] == "preserve" and r[3][0] == 0 and r[0][0] > 0.4


def test_languages(spark):
    texts = ["the cat is on the mat and it was there", "der Hund ist nicht auf dem Sofa und das ist gut", "кошка на столе", "猫がいる", "&&&& %%%% ####", "the cat is on the mat. кошка сидит на столе и спит", "zzz"]
    r = rows(spark, languages.IDENTIFIED, texts, ["lang_found", "mixed", "gate"])
    assert [r[k][0] for k in range(5)] == ["en", "de", "ru", "ja", "und"] and r[5][1] is True and r[6][2] == "unknown_language"


def test_cleaning_chain(spark):
    code = "```\nhome | about | contact | menu\n# todo: keep\n```"
    page = "<p>In this guide, we boil water [1].</p>\nShare\nfrom wikipedia, the free encyclopedia\n3 comments\nQuestion: why?\n\n" + code + "\n\nThe gate stands. It is old.\n\nThe gate stands. It is old.\n\nReferences\n[2] a book"
    r = rows(spark, curation.CLEAN, [page, "", "Menu\n" * 60, "plain text stays"], ["cleaned", "over", "dup_ratio"])
    got = r[0][0]
    assert "we boil water" in got and code in got and not any(x in got for x in ("Share", "wikipedia", "3 comments", "Question:", "[1]", "a book", "<p>", "In this guide"))
    assert got.count("The gate stands") == 1 and r[0][2] > 0 and r[2][1] is True and r[3][0] == "plain text stays"


def test_gate_reasons(spark):
    list_page = "Mercury may refer to:\n" + "\n".join(f"Mercury planet {k}" for k in range(8))
    tags = "".join(f"<div class='x{k}'><span>a</span></div>" for k in range(40))
    prose = "The theorem was measured in a study because the proof is an example. It means that the force equals mass. " * 6
    r = rows(spark, gates.GATED, [list_page, tags, prose, "zxcvbnm qwrtpsd bcdfghj \ufffd\ufffd\ufffd\ufffd\ufffd\ufffd\ufffd"], ["gate", "salvage"])
    assert r[1][0] == "html_dump" and r[2] == ("keep", True) and r[3][0] in ("extreme_corruption", "low_utility")


def test_units(spark):
    from loamstone.plans import units

    texts = ["Menu | About | Contact | Home", "Question: why does the gate fail?", "The force is defined as mass because, for example, it depends on the rate. Therefore it means that it grows. " * 3, "```\ndef f():\n    return 1\n```", "Exercise: fill in the words. Homework: write down ten. Quiz: choose the correct one.", "and then it went on to the"]
    df = spark.createDataFrame([(k, "s", "web", 10, k, t, k / 10) for k, t in enumerate(texts)], "doc_id long, source string, domain string, blocks int, block int, text string, spot double")
    r = {x["doc_id"]: x for x in units.UNITS.spark(df).select("doc_id", "class", "kept", "incomplete", "dropped_for").collect()}
    assert [r[k]["class"] for k in range(5)] == ["navigation", "question", "explanation", "code", "exercise"]
    assert r[2]["kept"] and not r[0]["kept"] and r[0]["dropped_for"] == "class_navigation" and float(r[5]["incomplete"]) == 0.78
