"""Parquet table access and the shared work folder of a session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder; columns and filters are left to the scan."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Only where the setting is absent (local tests) is a folder under the
    warehouse taken, because there the driver and executors are one process.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/loamstone_work"


def written(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}_{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Put this package on the path of the Python workers, once for each application.

    The archive is written to the shared folder by Hadoop's file system and
    registered with the session, so executors need no copy of the repository.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    try:
        folder = shared_dir(spark)
    except ValueError:  # no shared folder: the workers must have the package on their path
        _shipped.add(app)
        return
    import io
    import os
    import zipfile

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(root)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for inside, _, files in sorted(os.walk(root)):
            for f in sorted(files):
                if f.endswith(".py"):
                    path = os.path.join(inside, f)
                    z.write(path, os.path.join(name, os.path.relpath(path, root)))
    target = f"{folder}/{name}_{uuid.uuid4().hex}.zip"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(buffer.getvalue()))
    finally:
        out.close()
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer splits than the session has cores, dealt out over them; a scan with enough splits stays as it is.

    Only for scans and projections of them: the number of splits is read from the plan.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
