"""Runs: a lock on a folder, stages by name with their cost, plug-ins by name, and metrics as text."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstone.sources.tables import written

KINDS = ("stage", "embedding", "similarity", "language", "formatter")
_registry: dict[tuple[str, str], Callable] = {}


def register(kind: str, name: str, f: Callable) -> Callable:
    """Name a plug-in of a kind; the last one of a name holds."""
    if kind not in KINDS:
        raise ValueError(f"no such kind: {kind}")
    _registry[kind, name] = f
    return f


def resolve(kind: str, name: str) -> Callable:
    """The plug-in of a name, or what `module:object` points at."""
    if (kind, name) in _registry:
        return _registry[kind, name]
    module, _, attribute = name.partition(":")
    if not attribute:
        raise KeyError(f"no {kind} of the name {name}")
    return getattr(import_module(module), attribute)


def chain(df: DataFrame, stages: list[str]) -> DataFrame:
    """The frame through stages by name, each a function from frame to frame: one plan, nothing runs yet."""
    for name in stages:
        df = df.transform(resolve("stage", name))
    return df


def timed(df: DataFrame, stages: list[str]) -> tuple[DataFrame, DataFrame]:
    """(frame, costs): the stages one by one, each written, with rows in and out, seconds, and seconds for a rejected row.

    For a profile of a run: between the stages their rows are on disk, so a
    stage's seconds are its own.
    """
    spark, rows = df.sparkSession, []
    before = df.count()
    for k, name in enumerate(stages):
        start = time.time()
        df = written(df.transform(resolve("stage", name)), "stage")
        after, took = df.count(), time.time() - start
        lost = max(0, before - after)
        rows.append((k, name, before, after, lost / before if before else 0.0, took, took / lost if lost else None))
        before = after
    return df, spark.createDataFrame(rows, "place int, stage string, rows_in long, rows_out long, reject_rate double, seconds double, seconds_per_reject double")


@contextmanager
def run_lock(spark: SparkSession, folder: str, owner: str, stale_seconds: float = 3600.0):
    """One writer for a run folder: a file that Hadoop's file system makes only where there is none; one too old is taken over."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/run.lock")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path) and time.time() - fs.getFileStatus(path).getModificationTime() / 1000 > stale_seconds:
        fs.delete(path, False)
    try:
        out = fs.create(path, False)
    except Exception as e:
        raise RuntimeError(f"the run folder is in use: {folder}") from e
    out.write(bytearray(owner.encode()))
    out.close()
    try:
        yield f"{folder}/run.lock"
    finally:
        fs.delete(path, False)


def metrics_text(df: DataFrame, name: str, value: str, labels: list[str]) -> DataFrame:
    """One column `line`: an aggregate as the text lines that monitoring systems scrape, name{label="..."} value."""
    parts = [F.concat(F.lit(f'{x}="'), F.regexp_replace(F.coalesce(F.col(x).cast("string"), F.lit("")), r'(["\\])', r"\\$1"), F.lit('"')) for x in labels]
    return df.select(F.concat(F.lit(name + "{"), F.concat_ws(",", *parts), F.lit("} "), F.col(value).cast("double").cast("string")).alias("line"))
