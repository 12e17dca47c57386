"""Sequences, batches, stages, locks and plug-ins on small fixtures."""

import pytest

from loamstone.operators import runs, sequences


def test_packing_rules():
    out = sequences.pack([(1, 4), (2, 3), (3, 0), (4, None), (5, 25), (6, 2)], 9)
    assert [(u, p, s) for u, p, _, s in out] == [(8, 2, [(1, 0, 4), (2, 0, 3)]), (10, 0, [(5, 0, 10)]), (10, 0, [(5, 10, 10)]), (8, 2, [(5, 20, 5), (6, 0, 2)])]
    assert sequences.pack([], 9) == [] and len(sequences.pack([(k, 1) for k in range(10)], 99, most=4)) == 3


def test_packed_frames(spark):
    rows = [(k, (k * 37) % 90) for k in range(400)] + [(900, None)]
    df = spark.createDataFrame([(i, n, 0) for i, n in rows], "doc_id long, tokens int, shard int")
    w = sequences.packed(df, 127, shard_tokens=2000)
    got = {}
    for r in w.collect():
        assert r["used"] + r["padding"] == 128 and r["used"] == sum(s["tokens"] for s in r["segments"]) + len(r["segments"]) - 1
        for s in r["segments"]:
            got[s["doc_id"]] = got.get(s["doc_id"], 0) + s["tokens"]
    assert got == {i: n for i, n in rows if n}
    stats = sequences.pack_stats(w, 127).first()
    assert stats["used"] + stats["padding"] == stats["sequences"] * 128 and 0.6 < stats["efficiency"] <= 1
    ranks = [{(r["shard"], r["seq"]) for r in sequences.batches(w, 4, rank, 3).collect()} for rank in range(3)]
    assert sum(map(len, ranks)) == len(set().union(*ranks)) == stats["sequences"]
    assert sequences.pack_stats(sequences.packed(df.limit(0)), 127).first()["efficiency"] == 0


def test_stages_and_plug_ins(spark):
    runs.register("stage", "even", lambda df: df.where("id % 2 = 0"))
    runs.register("stage", "small", lambda df: df.where("id < 10"))
    assert runs.chain(spark.range(20), ["even", "small"]).count() == 5
    out, cost = runs.timed(spark.range(20), ["even", "small"])
    assert out.count() == 5 and [(r["rows_in"], r["rows_out"]) for r in cost.orderBy("place").collect()] == [(20, 10), (10, 5)]
    assert runs.resolve("similarity", "math:sqrt")(9) == 3
    with pytest.raises(KeyError):
        runs.resolve("stage", "missing")
    with pytest.raises(ValueError):
        runs.register("other", "x", len)
    lines = runs.metrics_text(spark.createDataFrame([('a"b', 2)], "reason string, n long"), "rejected", "n", ["reason"]).first()["line"]
    assert lines == 'rejected{reason="a\\"b"} 2.0'


def test_run_lock(spark, tmp_path):
    with runs.run_lock(spark, str(tmp_path), "one"):
        with pytest.raises(RuntimeError), runs.run_lock(spark, str(tmp_path), "two"):
            pass
    with runs.run_lock(spark, str(tmp_path), "three"):
        pass


def test_segments_hold_every_word_and_keep_code_whole():
    from loamstone.operators.chunks import segment

    code = "```\n" + "x = 1\n\n" * 60 + "```"
    text = "# Head\n\n" + "The gate stands by the river. It is old and made of stone. " * 30 + "\n\n" + code + "\n\n" + "word " * 900 + "\n\nThe end comes here."
    parts = segment(text, 100)
    assert len(parts) > 5 and sum(code in p for p in parts) == 1 and parts[0].startswith("# Head\n\nThe gate")
    assert all(len(p) <= 400 * 1.4 or "```" in p for p in parts) and segment(None) == segment(" \n ") == [] and segment("short") == ["short"]
    assert " ".join(text.split()).count("word") == sum(p.count("word") for p in segment(text, 100, overlap=0.0))
    assert len(segment("a b c. " * 60 + "\n\nshort tail.", 100)) == 1 and segment("a b c. " * 120 + "\n\nshort tail.", 100)[-1].endswith("short tail.")
    assert parts[1].split("\n\n")[0] in parts[0]
