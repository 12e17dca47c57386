"""Problem 8: filling containers of fixed capacity with texts, measured in tokens.

Shortest-pack-first over the length histogram (Krell et al. 2021): lengths are
placed longest first, each into the pattern with the most space left, and only
counts of packing patterns are kept. The histogram has at most as many rows
as the capacity, so the plan is made on the driver; the patterns go back to
the documents by rank among the texts of equal length.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamstone.functions.arrow import flat_map
from loamstone.functions.tokens import encoder, path_of
from loamstone.sources.tables import spread, table, written

ROWS_PER_RANK_GROUP = 100_000


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, tokens) of every row of docs (doc_id, text); null and blank texts count as their tokens, a null as none."""
    path = path or path_of(docs.sparkSession)

    def make():
        enc = encoder(path)
        return lambda i, t: [(i, len(enc.encode_ordinary(t)) if t else 0)]

    return flat_map(docs.select("doc_id", "text"), make, "doc_id long, tokens int")


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing patterns (containers, [(length, times), ...]) for lengths 1..capacity; lengths longest first within each.

    Of the open patterns that a length fits in, the one with the most space
    left takes it; a new container is opened only where none fits.
    """
    heap: list[tuple[int, int, int, tuple]] = []  # (-space, order, containers, pattern as a linked list)
    closed: list[tuple[int, tuple]] = []
    order = 0

    def put(space: int, containers: int, pattern: tuple) -> None:
        nonlocal order
        order += 1
        if space:
            heapq.heappush(heap, (-space, order, containers, pattern))
        else:
            closed.append((containers, pattern))

    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            if heap and -heap[0][0] >= length:
                space, _, containers, pattern = heapq.heappop(heap)
                space = -space
                used = min(n, containers)
                if used < containers:
                    put(space, containers - used, pattern)
                put(space - length, used, ((length, 1), pattern))
                n -= used
                continue
            each = capacity // length
            full, rest = divmod(n, each)
            if full:
                put(capacity - each * length, full, ((length, each), ()))
            if rest:
                put(capacity - rest * length, 1, ((length, rest), ()))
            n = 0
    closed += [(c, p) for _, _, c, p in heap]
    out = []
    for containers, pattern in closed:
        times: dict[int, int] = {}
        while pattern:
            (length, k), pattern = pattern
            times[length] = times.get(length, 0) + k
        out.append((containers, sorted(times.items(), reverse=True)))
    return out


def assignment(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, tuple[list[int], list[tuple[int, int, int, int]]]]:
    """For each length: starts of its rank intervals, and (first container, times, position, fill) of each."""
    out: dict[int, tuple[list[int], list]] = {}
    given: dict[int, int] = {}
    first = 0
    for containers, pattern in patterns:
        fill = sum(length * times for length, times in pattern)
        position = 0
        for length, times in pattern:
            starts, rows = out.setdefault(length, ([], []))
            starts.append(given.get(length, 0))
            rows.append((first, times, position, fill))
            given[length] = given.get(length, 0) + containers * times
            position += times
        first += containers
    return out


def pack(docs: DataFrame, capacities: DataFrame, path: str | None = None) -> DataFrame:
    """(capacity_id, container_id, position, doc_id, piece_no, tokens, fill) of every piece of every text and capacity.

    tokens counts the piece with the separator that ends its text; fill is the
    sum over the container. A text is split only where its tokens and
    separator exceed the capacity: into full containers and a rest. Texts
    without tokens and null texts go nowhere. Capacities that are null or no
    larger than their separator are left out. Repeated doc_ids are packed as
    often as they occur.
    """
    counts = written(token_counts(docs, path), "token_counts")
    sizes = counts.where("tokens > 0").groupBy("tokens").agg(F.count("*").alias("n"))
    caps = [r for r in capacities.where("capacity_id is not null and capacity_tokens is not null").select("capacity_id", "capacity_tokens", F.coalesce("separator_tokens", F.lit(0)).alias("separator_tokens")).distinct().collect() if r["capacity_tokens"] > r["separator_tokens"]]
    spark = docs.sparkSession
    caps_df = spark.createDataFrame([(r["capacity_id"], r["capacity_tokens"], r["separator_tokens"]) for r in caps], "capacity_id int, capacity int, separator int")

    def split(frame: DataFrame) -> DataFrame:
        """Lengths of the pieces by capacity: few rows of capacities, a narrow map over the texts."""
        x = frame.crossJoin(F.broadcast(caps_df)).withColumn("size", F.col("tokens") + F.col("separator"))
        x = x.withColumn("full", F.floor((F.col("size") - 1) / F.col("capacity")).cast("int"))
        return x.withColumn("rest", (F.col("size") - F.col("full") * F.col("capacity")).cast("int"))

    # at most capacity rows of rests for each capacity come to the driver; full containers need no plan
    hist = split(sizes).groupBy("capacity_id", "rest").agg(F.sum("n").alias("n")).collect()
    plans, fulls, rows = {}, {}, 0
    for r in caps:
        h = {x["rest"]: x["n"] for x in hist if x["capacity_id"] == r["capacity_id"]}
        rows += sum(h.values())
        patterns = shortest_pack_first(h, r["capacity_tokens"])
        plans[r["capacity_id"]] = assignment(patterns)
        fulls[r["capacity_id"]] = (sum(c for c, _ in patterns), r["capacity_tokens"])
    # ranks among equal lengths, in groups so that a length that a third of the texts share is no single task
    groups = max(1, rows // ROWS_PER_RANK_GROUP)
    items = split(counts.where("tokens > 0")).withColumn("grp", F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int"))
    rests = items.select("capacity_id", "doc_id", "rest", "full", "grp")
    local = rests.withColumn("r", F.row_number().over(Window.partitionBy("capacity_id", "rest", "grp").orderBy("doc_id")) - 1)
    sums = rests.groupBy("capacity_id", "rest", "grp").agg(F.count("*").alias("n"))
    before = sums.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("capacity_id", "rest").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("capacity_id", "rest", "grp", "before")
    ranked = (local if groups == 1 else local.join(before, ["capacity_id", "rest", "grp"])).select("capacity_id", "doc_id", "rest", "full", (F.col("r") + (F.lit(0) if groups == 1 else F.col("before"))).cast("long").alias("rank"))

    def make():
        def one(cap, doc, rest, full, rank):
            starts, where = plans[cap][rest]
            k = bisect_right(starts, rank) - 1
            first, times, position, fill = where[k]
            instance, nth = divmod(rank - starts[k], times)
            return [(cap, f"p{first + instance}", position + nth, doc, full, rest, fill)]

        return one

    packed = flat_map(ranked, make, "capacity_id int, container_id string, position int, doc_id long, piece_no int, tokens int, fill int")
    # whole containers of one text's pieces are named by the text: no ranks needed
    whole = items.where("full > 0").select("capacity_id", "capacity", "doc_id", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("piece_no"))
    whole = whole.select("capacity_id", F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit("."), F.col("piece_no").cast("string")).alias("container_id"), F.lit(0).alias("position"), "doc_id", "piece_no", F.col("capacity").alias("tokens"), F.col("capacity").alias("fill"))
    return packed.unionByName(whole)


def p8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), table(spark, sf_dir, "pack_capacities"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers and share of unused space by capacity."""
    p = p8_pack(spark, sf_dir).where("position = 0").groupBy("capacity_id").agg(F.count("*").alias("containers"), F.sum("fill").alias("tokens"))
    caps = table(spark, sf_dir, "pack_capacities").select("capacity_id", "capacity_tokens").distinct()
    return p.join(caps, "capacity_id").select("capacity_id", "containers", "tokens", (1 - F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("unused"))
