"""Small fixtures for the core: functions, near duplicates, formatters, sources, sinks and streaming."""

import hashlib
import json
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from loamstone.functions import features as X
from loamstone.functions import peers as P
from loamstone.functions import safety as S
from loamstone.functions import text as T
from loamstone.functions.html import strip_markup
from loamstone.operators import export, formatters, similarity
from loamstone.sources import jsonl
from loamstone.streaming import ingest

TEXTS = [None, "", " \n\t", "Café noël", "Café noël", "a b　c", "straße İstanbul \U0001f600 中文", "x\x00y\x1fz", "word " * 5000, "A\r\nB\rC"]


def values(spark, texts, *cols):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    return [tuple(r)[1:] for r in df.select("k", *cols).orderBy("k").collect()]


def test_content_hash(spark):
    def want(t):
        if t is None:
            return None
        s = unicodedata.normalize("NFC", t)
        s = "".join(c for c in s if not (ord(c) <= 8 or ord(c) in (11, 12) or 14 <= ord(c) <= 31))
        return hashlib.sha256(" ".join(s.split()).lower().encode()).hexdigest()

    texts = [t for t in TEXTS if t is None or "İ" not in t]
    assert [r[0] for r in values(spark, texts, T.content_hash(F.col("t")))] == [want(t) for t in texts]


def test_normalisation(spark):
    got = values(spark, TEXTS, T.minimal_normalize(F.col("t")), T.meaningful_chars(F.col("t")))
    assert got[0] == (None, None) and got[2] == ("", 0) and got[5] == ("a b c", 3) and got[7][0] == "xyz"


def test_collapsed_and_sampled(spark):
    assert values(spark, ["a\na\nb\n\n\na", None], T.collapse_repeated_lines(F.col("t"))) == [("a\nb\n\n\na",), (None,)]
    (s,) = values(spark, ["x" * 6000 + "y" * 6000], F.length(T.sample_ends(F.col("t"), 4000)))
    assert s == (4000,)


def peers_by_hand(v, peers):
    if v <= 0:
        return 0.0
    base = max(sum(peers) / len(peers) if peers else v, v * 0.25)
    return max(0.0, min(1.0, v / (v + base)))


@pytest.mark.parametrize("a", [[0.4], [0.0, 0.0], [0.0, 0.8], [0.2, 0.4, 0.9], [5.0], [1.0, 1.0]])
def test_peers(spark, a):
    c = F.array(*[F.lit(x) for x in a])
    got = spark.range(1).select(P.baseline(c), P.spread(c), P.saturate(F.lit(a[-1]), c)).first()
    pos = [x for x in a if x > 0]
    base = 0.0 if not pos else min(1.0, pos[0]) if len(a) == 1 else min(1.0, pos[0] * 0.85) if len(pos) == 1 else max(peers_by_hand(x, a) for x in pos)
    spread = (max(a) - min(a)) or sum(a) / len(a)
    assert tuple(got) == pytest.approx((base, spread, peers_by_hand(a[-1], a)))


def test_entropy(spark):
    got = values(spark, ["aabb", "aaaa", "abcd"], X.entropy(F.col("t")))
    assert [r[0] for r in got] == pytest.approx([1.0, 0.0, 2.0])


def test_markup_and_redaction(spark):
    page = "<html><style>p{}</style><p>One &amp; two</p><br>three<script>x()</script></html>"
    assert values(spark, [page, None], strip_markup(F.col("t"))) == [("One & two\n\nthree",), (None,)] or values(spark, [page], strip_markup(F.col("t")))[0][0].split() == ["One", "&", "two", "three"]
    (r,) = values(spark, ["mail a.b@c.org or 020 7946 0000; password: abcdefghijkl"], S.redact(F.col("t")))
    assert "<EMAIL>" in r[0] and "<PHONE>" in r[0] and "<SECRET>" in r[0]


def shingle_set(t):
    w = [x for x in "".join(c if c.isalnum() else " " for c in t.lower()).split()]
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(4)
    base = [[f"w{rng.randrange(60)}" for _ in range(60)] for _ in range(8)]
    texts = []
    for k in range(60):
        w = list(base[k % 8])
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(60)] = f"n{rng.randrange(999)}"
        texts.append(" ".join(w))
    texts += [texts[0]] * 30 + [None, "", "one two", "one two"]  # a third of the rows are copies
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    sets = {k: shingle_set(t) for k, t in enumerate(texts) if t and shingle_set(t)}
    rep = {}
    for k, s in sets.items():
        rep[k] = min(j for j, v in sets.items() if v == s)
    reps = sorted(set(rep.values()))
    want = {(a, b) for a in reps for b in reps if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    pairs, members = similarity.near_pairs(df)
    assert {(r["a"], r["b"]) for r in pairs.collect()} == want and want
    assert {(r["doc_id"], r["rep"]) for r in members.collect()} == set(rep.items())
    root = {k: k for k in reps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in want:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r["doc_id"]: r["class_id"] for r in similarity.near_duplicate_classes(df).collect()}
    assert got == {k: find(r) for k, r in rep.items()}
    assert similarity.near_duplicate_classes(df.limit(0)).count() == 0


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(0, 30)] + [(100, 101), (101, 102)]
    got = {r["node"]: r["component"] for r in similarity.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(31)}, 100: 100, 101: 100, 102: 100}


def test_vector_search(spark):
    rng = random.Random(2)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(8)]) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = similarity.vector_search(df, df.where("vec_id % 20 = 0"), 5).collect()

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5

    for q in (0, 20, 40):
        want = sorted((-round(cos(rows[q][1], v), 5), k) for k, v in rows if k != q)[:5]
        assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == [k for _, k in want]


def test_formatters(spark):
    df = spark.range(1).select(
        formatters.instruction_answer(F.lit("Why?"), F.lit(None).cast("string"), F.lit(" So. ")).alias("qa"),
        formatters.instruction_answer(F.lit(""), F.lit(""), F.lit("So.")).alias("a"),
        formatters.conversation(F.array(F.struct(F.lit("user").alias("role"), F.lit(" hi ").alias("content")), F.struct(F.lit("bot").alias("role"), F.lit(None).cast("string").alias("content")))).alias("c"),
        formatters.code(F.lit("python"), F.lit("x = 1")).alias("code"), formatters.question_answers(F.lit("T"), F.array().cast("array<string>")).alias("s"),
    )
    assert tuple(df.first()) == ("Question: Why?\n\nAnswer: So.", "So.", "user: hi", "# language: python\nx = 1", "T")


def test_jsonl_round_trip(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / "raw" / name).mkdir(parents=True)
        (tmp_path / "raw" / name / "data.jsonl").write_text('{"text": "one"}\n\n{bad\n{"content": "two"}\n[1]\n')
    lines = jsonl.scan_tree(spark, str(tmp_path / "raw"))
    kinds = {(r["source"], r["kind"]): r["lines"] for r in jsonl.count_lines(lines).collect()}
    assert kinds == {(s, k): n for s in "ab" for k, n in (("ok", 2), ("blank", 1), ("parse_error", 2))}
    assert sorted(r["text"] for r in jsonl.parse_lines(lines).where("kind = 'ok'").collect()) == ["one", "one", "two", "two"]
    df = spark.createDataFrame([(k, f"t{k}") for k in range(50)], "seq long, text string")
    export.write_jsonl(df, str(tmp_path / "out"), partitions=3)
    got = [json.loads(x)["seq"] for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text().splitlines()]
    assert got == list(range(50))


def test_token_shards(spark):
    from loamstone.functions.tokens import END, encoder

    texts = ["one two three", None, "", "four five " * 50, "six"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    rows = export.token_shards(df, shard_tokens=40).orderBy("shard").collect()
    stream = b"".join(bytes(r["payload"]) for r in rows)
    enc = encoder()
    want = [x for t in texts for x in [*enc.encode_ordinary(t or ""), END]]
    assert [int.from_bytes(stream[k : k + 4], "little") for k in range(0, len(stream), 4)] == want
    assert all(hashlib.sha256(bytes(r["payload"])).hexdigest() == r["sha256"] for r in rows)


def test_streaming_ingest_restarts_without_doubles(spark, tmp_path):
    src, out, state, cp = (str(tmp_path / x) for x in ("src", "out", "state", "cp"))
    schema = "doc_id long, source string, text string"
    spark.createDataFrame([(1, "s", "Same text"), (2, "s", "same  TEXT"), (3, "s", "other")], schema).write.mode("append").parquet(src)
    run = lambda: ingest.dedup_ingest(spark.readStream.schema(schema).parquet(src), out, state, cp).awaitTermination()
    run()
    spark.createDataFrame([(4, "s", "OTHER"), (5, "s", "third")], schema).write.mode("append").parquet(src)
    run()
    run()
    assert sorted(r["doc_id"] for r in spark.read.parquet(out).collect()) == [1, 3, 5]


def test_event_windows_batch_equals_stream(spark, sf_dir, tmp_path):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    batch = {tuple(r) for r in ingest.event_windows(e).collect()}
    e.write.parquet(str(tmp_path / "events"))
    s = ingest.event_windows(spark.readStream.schema(e.schema).parquet(str(tmp_path / "events")))
    q = s.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {tuple(r) for r in spark.sql("select * from windows").collect()} == batch


def test_library_stands_without_llm():
    import pathlib

    root = pathlib.Path(__file__).resolve().parents[1] / "loamstone"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "loamstone.llm" not in p.read_text(), p


def test_settings(spark, tmp_path):
    from loamstone.config import Settings, pin

    s = Settings()
    folder = str(tmp_path / "run")
    assert pin(spark, folder, s) and not pin(spark, folder, Settings())
    with pytest.raises(ValueError):
        pin(spark, folder, s.with_values(min_chars=5))
    with pytest.raises(ValueError):
        Settings(min_alpha=2)


def test_command_line(capsys):
    from loamstone.__main__ import main

    assert main(["list"]) == 0 and "flagship" in capsys.readouterr().out
    assert main(["run", "no_such"]) == 2


def test_package_ships_into_the_shared_folder(spark, monkeypatch):
    from loamstone.sources import tables

    monkeypatch.setattr(tables, "_shipped", set())
    folder = tables.shared_dir(spark)
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = lambda: {f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)}
    tables.ship_package(spark)
    before = files()
    assert any(f.startswith("loamstone_") and f.endswith(".zip") for f in before)
    tables.ship_package(spark)
    assert files() == before  # once for each application


def test_nothing_but_sources_in_the_package():
    import pathlib

    root = pathlib.Path(__file__).resolve().parents[1] / "loamstone"
    assert not [p for p in root.rglob("*") if p.is_file() and p.suffix not in (".py", ".pyc")]
