"""Places and running sums over the order of a whole table, without a sort that holds it all and whatever its ids look like."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STEP = 4096  # rows of a group, about
CELLS = 65_536  # cells of the first cut: the bound of what is broadcast


def groups(t: DataFrame, order: str = "doc_id", keys: DataFrame | None = None, step: int = STEP, name: str = "grp") -> DataFrame:
    """t with the number of its group: ranges of the order of about `step` rows each, numbered in it.

    The range of the ids is cut into CELLS cells of even width, and each cell
    by its own number of rows and its own range, so that dense ids, hashed
    ones and islands of both give groups of like size. keys: a cheaper table
    of the same ids, where t is the outcome of work that should run once.
    """
    k = (t if keys is None else keys).select(F.col(order).alias("_k")).where("_k is not null")
    ends = k.agg(F.min("_k").cast("double").alias("_low"), F.max("_k").cast("double").alias("_high"))  # one row
    # in doubles: monotone in the id, and no overflow for ids over all 64 bits
    cell = lambda c: F.least(F.lit(CELLS - 1), F.floor((F.col(c).cast("double") - F.col("_low")) / (F.col("_high") - F.col("_low") + 1) * CELLS)).cast("bigint")
    cells = k.crossJoin(F.broadcast(ends)).groupBy(cell("_k").alias("_cell")).agg(F.count("*").alias("_n"), F.min("_k").alias("_first"), F.max("_k").alias("_last"))
    x = t.crossJoin(F.broadcast(ends)).withColumn("_cell", cell(order)).join(F.broadcast(cells), "_cell")  # at most CELLS rows
    parts = F.ceil(F.col("_n") / step)
    sub = F.least(parts - 1, F.floor((F.col(order) - F.col("_first")) / (F.col("_last") - F.col("_first") + 1) * parts)).cast("bigint")
    return x.withColumn(name, F.shiftleft("_cell", 32) + sub).drop("_cell", "_n", "_first", "_last", "_low", "_high")


def running(t: DataFrame, value: str, key: str, order: str = "doc_id", by: tuple[str, ...] = (), keys: DataFrame | None = None) -> DataFrame:
    """t with the sum of a value over all rows before each, within `by`.

    Sums of groups first, then within the group: the only step without a
    partition is a window over the groups, a 4096th of the rows.
    """
    g = groups(t, order, keys)
    sums = g.groupBy(*by, "grp").agg(F.sum(value).alias("_s"))
    over = Window.partitionBy(*by) if by else Window.partitionBy()
    before = sums.select(*by, "grp", F.coalesce(F.sum("_s").over(over.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inner = F.coalesce(F.sum(value).over(Window.partitionBy(*by, "grp").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return g.join(before, [*by, "grp"]).withColumn(key, F.col("_before") + inner).drop("grp", "_before")
