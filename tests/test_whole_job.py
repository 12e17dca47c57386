"""Cases of the core queries that a cut would lose."""

import random

from loamstone.operators import similarity
from loamstone.plans import cleaning, mixture, pipeline, rights

SCHEMA = "doc_id long, lang string, source string, domain string, text string"


def folder(spark, path, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_curation_pipeline(spark, tmp_path):
    rng = random.Random(4)
    base = [" ".join(rng.choice("stone gate river keeper morning water bridge lamp orchard mill".split()) + rng.choice("abcdefgh") for _ in range(90)) + "." for _ in range(4)]
    near = base[1].replace(".", " now.")
    rows = [
        (1, "en", "s", None, "Menu\n" + base[0] + "\n\n" + base[0] + "\nShare"), (2, "en", "s", None, base[0]), (3, "en", "s", None, base[1]), (4, "en", "s", None, near),
        (5, "en", "s", None, base[2] + "\nno part of this book may be reproduced"), (6, "en", "s", None, base[2]), (7, "en", "s", None, None), (8, "en", "s", "code", "```\n" + base[3] + "\nMenu\n```"), (9, None, None, None, " \n "),
    ]
    d = folder(spark, tmp_path, documents=(rows, SCHEMA))
    got = {r["doc_id"]: (r["reject_reason"], r["chars"]) for r in pipeline.curation_pipeline(spark, d, decide=False).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: None, 2: "exact_dup", 3: None, 4: "near_dup", 5: "redistribution_prohibited", 6: None, 7: "empty_text", 8: None, 9: "empty_text"}
    assert got[1][1] == len(base[0]) and got[8][1] == len(rows[7][4])
    assert pipeline.curation_pipeline(spark, d).count() == len(rows)


def test_simhash_pairs_against_brute_force(spark):
    rng = random.Random(6)
    vocab = [f"w{k}" for k in range(80)]
    rows = []
    for k in range(30):
        w = [rng.choice(vocab) for _ in range(150)]
        rows.append((3 * k, " ".join(w)))
        w[rng.randrange(150)] = "other"
        rows += [(3 * k + 1, " ".join(w)), (3 * k + 2, " ".join(reversed(w)))]
    df = spark.createDataFrame(rows + [(900, None), (901, " ! ")], "doc_id long, text string")
    h = {r["doc_id"]: r["h"] for r in df.select("doc_id", similarity.simhash(df["text"]).alias("h")).collect()}
    sets = {i: set(t.split()) for i, t in rows}
    want = set()
    for a in sets:
        for b in sets:
            bits = ((h[a] ^ h[b]) & (2**64 - 1)).bit_count()
            if a < b and bits <= 4 and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.72:
                want.add((a, b, bits))
    got = [(r["a"], r["b"], r["distance"]) for r in similarity.simhash_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want and {x[2] > 0 for x in want} == {True, False}


def test_weighted_order_ranks_every_document(spark, tmp_path):
    rows = [(k, "en" if k % 3 else ("de" if k % 2 else None), "s", None, "text " * (k % 50)) for k in range(5000)]
    d = folder(spark, tmp_path, documents=(rows, SCHEMA))
    got = sorted((r["rank"], r["score"], r["doc_id"]) for r in mixture.weighted_order(spark, d).collect())
    assert [g[0] for g in got] == list(range(1, 5001)) and [g[1:] for g in got] == sorted((g[1:] for g in got), key=lambda x: (-x[0], x[1]))
    assert [g[2] for g in got[:200]] == [r["doc_id"] for r in mixture.weighted_sample_order(spark, d).collect()]
    part = mixture.weighted_order(spark, d, {"en": 700, "de": 20}).collect()
    assert sorted(r["rank"] for r in part) == list(range(1, 721))
    assert {r["doc_id"] for r in part} == set([k for k, lang, *_ in rows if lang == "en"][:700] + [k for k, lang, *_ in rows if lang == "de"][:20])


def test_safe_trim_of_cut_samples(spark, tmp_path):
    long = "the long line of a source that stands in every text of it " * 5
    docs = [(1, "en", "s", None, long + "one\n" + "own words of this text here " * 40), (2, "en", "s", None, long.upper() + "two\nShort line of the source\nmine"), (3, "en", "s", None, "x" + long)]
    frags = [(long[:200], 4), ("short line of the source", 3), (long[:150], 9), ("own words of this text here", 2)]
    d = folder(spark, tmp_path, documents=(docs, SCHEMA), fragments=(frags, "text_sample string, doc_frequency long"))
    got = {r["doc_id"]: (r["cut_lines"], r["cut"], r["trimmed"]) for r in cleaning.safe_trim_all(spark, d).collect()}
    assert got == {1: (1, len(long) + 3, True), 2: (2, len(long) + 3 + 24, False)}


def test_licence_after_a_long_text(spark, tmp_path):
    rows = [(1, "en", "s", None, "plain words " * 1100 + "licensed under the MIT License"), (2, "en", "s", None, "GPL here"), (3, "en", "s", None, None)]
    d = folder(spark, tmp_path, documents=(rows, SCHEMA))
    got = {(r["doc_id"], r["licence"], r["rights_action"]) for r in rights.licence_decisions(spark, d).collect()}
    assert got == {(1, "MIT", "KEEP"), (2, "Unknown", "FLAG")}
