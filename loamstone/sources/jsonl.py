"""JSON-lines sources: folders of raw/<source>/data.jsonl and single files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fields that may hold the text, first present first.
TEXT_FIELDS = ("text", "content", "body", "markdown")


def scan_tree(spark: SparkSession, root: str, only: list[str] | None = None) -> DataFrame:
    """(source, value) of every line under root/<source>/data.jsonl; the source is the folder's name."""
    lines = spark.read.text(f"{root}/*/data.jsonl").withColumn("_path", F.input_file_name())
    out = lines.select(F.regexp_extract("_path", r"([^/]+)/data\.jsonl$", 1).alias("source"), "value")
    return out.where(F.col("source").isin(only)) if only else out


def parse_lines(lines: DataFrame) -> DataFrame:
    """Adds kind (blank, parse_error, ok) and text, the first present of the text fields; no line is dropped."""
    schema = ", ".join(f"{f} STRING" for f in TEXT_FIELDS)
    trimmed = F.trim(F.coalesce("value", F.lit("")))
    parsed = F.from_json("value", schema + ", _bad STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    x = lines.withColumn("_j", parsed)
    bad = F.col("_j").isNull() | F.col("_j._bad").isNotNull() | ~trimmed.startswith("{")
    kind = F.when(trimmed == "", "blank").when(bad, "parse_error").otherwise("ok")
    text = F.coalesce(*[F.col(f"_j.{f}") for f in TEXT_FIELDS], F.lit(""))
    return x.withColumn("kind", kind).withColumn("text", F.when(F.col("kind") == "ok", text)).drop("_j")


def count_lines(lines: DataFrame) -> DataFrame:
    """Lines by source and kind."""
    return parse_lines(lines).groupBy("source", "kind").agg(F.count("*").alias("lines"))
