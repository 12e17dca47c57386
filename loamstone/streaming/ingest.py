"""Structured Streaming: incremental ingest with a persistent hash index, and event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loamstone.functions.text import content_hash
from loamstone.sources.tables import ship_package


def dedup_ingest(stream: DataFrame, out: str, state: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Texts of a stream (doc_id, source, text) that the index at state lacks go to out; the index grows by them.

    Each micro-batch writes into folders of its own number and overwrites them
    when it is run again after a failure, so a restart neither doubles nor
    loses rows. The index is read in one column and meets the batch by an anti-join.
    """
    spark = stream.sparkSession
    ship_package(spark)

    def batch(df: DataFrame, number: int) -> None:
        h = df.withColumn("hash", content_hash(F.col("text")))
        first = h.groupBy("hash").agg(F.min_by(F.struct("doc_id", "source", "text"), "doc_id").alias("r")).select("hash", "r.*")
        known = _known(spark, state, number)
        new = (first.join(known, "hash", "left_anti") if known is not None else first).persist()
        new.select("doc_id", "source", "text").write.mode("overwrite").parquet(f"{out}/batch={number}")
        new.select("hash", "doc_id").write.mode("overwrite").parquet(f"{state}/batch={number}")
        new.unpersist()

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def _known(spark: SparkSession, state: str, before: int) -> DataFrame | None:
    """Hashes of the batches before a number; None before the first."""
    if before == 0:
        return None
    return spark.read.option("basePath", state).schema("hash string, doc_id long, batch int").parquet(state).where(F.col("batch") < before).select("hash")


def event_windows(events: DataFrame, width: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """Count and sum of events by window of event time and type; works on streams and tables alike."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if e.isStreaming:
        e = e.withWatermark("ts", late)
    g = e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("window_start"), "event_type", "events", "total")
