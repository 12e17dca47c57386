"""Running sums over ids of any kind."""

import random

from loamstone.operators.order import groups, running


def test_running_sums_over_any_ids(spark):
    rng = random.Random(3)
    for ids in (
        list(range(1, 500)), [rng.getrandbits(64) - (1 << 63) for _ in range(500)], [*range(-50, 200), *[(1 << 62) + k for k in range(200)], -(1 << 63), (1 << 63) - 1], [7], [],
    ):
        rows = [(i, rng.choice("ab") if rng.random() < 0.9 else None, rng.randrange(5)) for i in ids]
        df = spark.createDataFrame(rows, "doc_id long, source string, n long")
        want, total = {}, 0
        for i, _, n in sorted(rows):
            want[i], total = total, total + n
        assert {r["doc_id"]: r["s"] for r in running(df, "n", "s").collect()} == want
        part, got = {}, {r["doc_id"]: r["s"] for r in running(df.where("source is not null"), "n", "s", by=("source",)).collect()}
        for i, s, n in sorted((r for r in rows if r[1]), key=lambda r: r[0]):
            assert got[i] == part.get(s, 0)
            part[s] = part.get(s, 0) + n


def test_groups_stay_even(spark):
    rng = random.Random(5)
    ids = [rng.getrandbits(64) - (1 << 63) for _ in range(3000)] + list(range(3000))
    g = groups(spark.createDataFrame([(i,) for i in ids], "doc_id long"), step=100)
    sizes = [r["count"] for r in g.groupBy("grp").count().collect()]
    assert max(sizes) <= 150 and len(sizes) < 4000
    order = [r["doc_id"] for r in g.orderBy("grp", "doc_id").collect()]
    assert order == sorted(ids)
