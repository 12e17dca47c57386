"""Training sequences: texts packed into windows of fixed length, batches of windows, and their order for every rank and epoch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamstone.functions.arrow import flat_map
from loamstone.operators.order import running

ROW = "shard long, seq int, used int, padding int, documents int, segments array<struct<doc_id:long,start:int,tokens:int>>"


def pack(lengths: list[tuple[int, int]], size: int, delimiter: int = 1, most: int = 64) -> list[tuple[int, int, int, list[tuple[int, int, int]]]]:
    """(used, padding, documents, segments) of the windows that texts fill in their order.

    A window holds size + 1 tokens, so that inputs and labels are one apart. A
    text that no longer fits opens the next window; only one that is longer
    than a whole window is split, and its rest goes first into the next. A
    delimiter stands between texts, and a window has at most `most` of them.
    What stays free is padding, whose labels are ignored.
    """
    room, out, at, start = size + 1, [], 0, 0
    queue = [(i, n) for i, n in lengths if n and n > 0]
    while at < len(queue):
        window, used = [], 0
        while at < len(queue) and len(window) < most:
            doc, n = queue[at][0], queue[at][1] - start
            apart = delimiter if window else 0
            if used + apart + n <= room:
                window.append((doc, start, n))
                used += apart + n
                at, start = at + 1, 0
            elif window:
                break
            else:
                window.append((doc, start, room))
                used, start = room, start + room
                break
        out.append((used, room - used, len({d for d, _, _ in window}), window))
    return out


def packed(lengths: DataFrame, size: int = 2048, shard_tokens: int = 1_000_000, delimiter: int = 1, most: int = 64) -> DataFrame:
    """The windows of lengths (doc_id, tokens) in id order, shard by shard.

    The running sum of tokens deals texts out to shards; within a shard packing
    is sequential by definition, and a shard is one group of bounded size.
    Null and zero lengths take no place.
    """
    c = running(lengths.where("tokens > 0").select("doc_id", F.col("tokens").cast("long").alias("tokens")), "tokens", "cursor")
    shards = c.groupBy(F.floor(F.col("cursor") / shard_tokens).alias("shard")).agg(F.array_sort(F.collect_list(F.struct("doc_id", "tokens"))).alias("d"))
    one = lambda shard, d: [(shard, k, u, p, n, [dict(zip(("doc_id", "start", "tokens"), s)) for s in seg]) for k, (u, p, n, seg) in enumerate(pack([(x["doc_id"], x["tokens"]) for x in d], size, delimiter, most))]
    return flat_map(shards, lambda: one, ROW)


def pack_stats(windows: DataFrame, size: int = 2048) -> DataFrame:
    """One row: windows, texts, segments, tokens in use, padding, and the share in use."""
    return windows.agg(
        F.count("*").alias("sequences"), F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"), F.coalesce(F.sum(F.size("segments")), F.lit(0)).alias("segments"), F.coalesce(F.sum("used"), F.lit(0)).alias("used"),
        F.coalesce(F.sum("padding"), F.lit(0)).alias("padding"), F.round(F.coalesce(F.sum("used") / (F.count("*") * (size + 1)), F.lit(0.0)), 6).alias("efficiency"),
    )


def batches(windows: DataFrame, rows: int, rank: int = 0, world: int = 1, epoch: int = 0, seed: int = 0) -> DataFrame:
    """(batch, place, shard, seq, lengths, masked): the batches of one rank in an epoch, windows in an order by hash.

    Every rank takes its residue of the hash, so ranks share nothing and
    together hold every window; lengths are those of the segments, masked the
    number of labels that padding takes. Shards are the groups of the order,
    so no sort holds all windows.
    """
    h = F.xxhash64(F.lit(seed), F.lit(epoch), "shard", "seq")
    mine = windows.withColumn("h", h).where(F.pmod(F.col("h"), F.lit(world)) == rank).select("shard", "seq", "h", F.transform("segments", lambda s: s["tokens"]).alias("lengths"), F.col("padding").alias("masked"))
    place = F.row_number().over(Window.partitionBy("shard").orderBy("h")) - 1
    x = mine.withColumn("place", place)
    return x.select(F.concat_ws("-", F.col("shard").cast("string"), F.floor(F.col("place") / rows).cast("string")).alias("batch"), (F.col("place") % rows).alias("place"), "shard", "seq", "lengths", "masked")
