"""Sinks: JSON lines, mixture index, reject log, token shards with digests, sequence windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstone.functions.tokens import encoded
from loamstone.operators.order import running


def write_jsonl(df: DataFrame, path: str, order: str = "seq", partitions: int | None = None) -> None:
    """Rows as JSON lines in ranges of the order: files sorted by name hold the whole order, no single task writes it all."""
    out = df.repartitionByRange(partitions, order) if partitions else df.repartitionByRange(order)
    out.sortWithinPartitions(order).write.mode("errorifexists").json(path)


def write_index(df: DataFrame, path: str) -> None:
    """The mixture index as Parquet with zstd."""
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)


def split_kept_rejected(df: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Rows without and with a reason; together they are all rows."""
    return df.where(F.col(reason).isNull()), df.where(F.col(reason).isNotNull())


def token_shards(docs: DataFrame, shard_tokens: int = 65_536, path: str | None = None) -> DataFrame:
    """(shard, tokens, documents, sha256, payload): flat 32-bit token shards in id order; a document lies in the shard where it begins.

    A shard is one group of bounded size: shard_tokens and the rest of its last document.
    """
    e = encoded(docs, path).withColumn("n", (F.octet_length("ids") / 4).cast("bigint"))
    c = running(e, "n", "cursor", keys=docs).withColumn("shard", F.floor(F.col("cursor") / shard_tokens))
    parts = c.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("doc_id", "ids"))).alias("d"), F.sum("n").alias("tokens"), F.count("*").alias("documents"))
    hexed = F.array_join(F.transform("d", lambda x: F.hex(x["ids"])), "")
    out = parts.select("shard", "tokens", "documents", F.unhex(hexed).alias("payload"))
    return out.select("shard", "tokens", "documents", F.sha2("payload", 256).alias("sha256"), "payload")
