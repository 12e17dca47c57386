"""What probing a batch holds and sends is bounded, whatever the size of the index and of the batch."""

import random

from loamstone.llm import batches


def texts(n, rng):
    vocab = [f"w{k}" for k in range(200)]
    return [[rng.choice(vocab) for _ in range(rng.randrange(30, 42))] for _ in range(n)]


def index_of(spark, base, monkeypatch):
    monkeypatch.setattr(batches, "BLOCK", 8)  # many blocks meet every query
    monkeypatch.setattr(batches, "STREAM", 8, raising=False)
    monkeypatch.setattr(batches, "CHUNK", 4)
    return batches.CellIndex.build(spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(base)], "doc_id long, text string"))


def placed(spark, index, rows):
    v = batches.vectors(spark.createDataFrame(rows, "doc_id long, text string"))
    return batches.written(batches.place(batches.classes(v), index.centroids), "test_queries")


def test_no_batch_that_a_probe_sends_grows_with_the_blocks(spark, monkeypatch):
    rng = random.Random(1)
    base = texts(160, rng)
    index = index_of(spark, base, monkeypatch)
    monkeypatch.setattr(batches, "FLUSH", 1000, raising=False)
    monkeypatch.setattr(batches, "SLICE", 16, raising=False)
    queries = placed(spark, index, [(1000 + k, " ".join(w)) for k, w in enumerate(texts(100, rng))])
    steps, plain = [], type(queries).mapInArrow

    def recorded(self, run, *args, **kwargs):
        steps.append((self.columns, run))
        return plain(self, run, *args, **kwargs)

    monkeypatch.setattr(type(queries), "mapInArrow", recorded)
    index.probe(queries)
    rows, longest, total = queries.toArrow(), 0, 0
    for columns, run in steps:
        if "side" not in columns:
            for b in run(rows.select(columns).combine_chunks().to_batches()):
                if "seq" in b.schema.names or "q_seq" in b.schema.names:
                    longest, total = max(longest, b.num_rows), total + b.num_rows
    assert total > 500  # queries times blocks
    assert longest <= 100


def test_vectors_go_only_to_the_queries_of_their_block(spark, monkeypatch):
    """Blocks without a query are not sent, and a block goes out once for each chunk of its own queries."""
    rng = random.Random(2)
    base = texts(60, rng) + [[f"x{rng.randrange(300)}" for _ in range(400)] for _ in range(60)]
    index = index_of(spark, base, monkeypatch)
    short = [(1000 + k, " ".join(w[:-2] + ["zz"])) for k, w in enumerate(base[:60])]
    long = [(2000, " ".join(base[60][:-9]))]
    queries = placed(spark, index, short + long)
    sent, plain = [], type(queries).mapInArrow

    def recorded(self, run, *args, **kwargs):
        if "side" in self.columns:
            sent.append(self)
        return plain(self, run, *args, **kwargs)

    monkeypatch.setattr(type(queries), "mapInArrow", recorded)
    got = {(r["q_id"], r["x_id"]) for r in index.probe(queries).collect()}
    assert {min(x for q, x in got if q == i) for i, _ in short + long} == set(range(61))
    assert sent[0].where("side = 1 and n = 400").count() == 60  # a single chunk of long queries


def test_holders_over_many_blocks_and_chunks(spark, monkeypatch):
    rng = random.Random(3)
    base = texts(120, rng)
    docs = [(k, " ".join(w)) for k, w in enumerate(base)] + [(200 + k, " ".join(base[k][1:])) for k in range(20)]
    batch = []
    for k in range(60):
        w = list(base[k])
        for at in rng.sample(range(len(w)), rng.choice([0, 3, 5, 7])):
            w[at] = f"zz{rng.randrange(10**6)}"
        batch.append((1000 + k, " ".join(w)))
    batch += [(1100 + k, batch[k][1]) for k in range(10)]
    index = index_of(spark, [["none"]], monkeypatch)
    index.append(spark.createDataFrame(docs, "doc_id long, text string"))
    got = {(r["first_doc_id"], r["doc_id"]) for r in batches.holders(None, spark.createDataFrame(batch, "doc_id long, text string"), index).collect()}
    rows = [(i, t.split()) for i, t in docs + batch]
    want = {(min(h), i) for i, w in rows if i >= 1000 and (h := [j for j, v in rows if j < i and (v == w or batches.near(w, v))])}
    assert got == want and len(want) > 40
