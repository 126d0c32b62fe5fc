"""Session settings and places that every executor can reach."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def session(app: str = "tarifa", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, ANSI, AQE and Arrow on; ``conf`` overrides, dots written as ``__``."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        b = b.config(k, v)
    return shipped(b.getOrCreate())


def shipped(spark: SparkSession) -> SparkSession:
    """Give executors this package, once for each Spark application, and Arrow batches a size for rows of texts."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        here = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="tarifa-code-")
        shutil.copytree(here, f"{folder}/code/tarifa", ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/tarifa", "zip", f"{folder}/code"))
        _SHIPPED.add(app)
    if int(spark.conf.get(BATCH, "10000")) == 10_000:  # Spark's own value: with long texts, too much for JVM and Python to hold at once
        spark.conf.set(BATCH, "2000")
    return spark


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the input tables; only Spark's reader touches the path."""
    return shipped(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is missing a temporary folder is made and kept for the rest of
    the session, on one machine only: on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("tarifa.shared.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tarifa-")
        spark.conf.set("tarifa.shared.dir", found)
    return found.rstrip("/")


def written(df, what: str):
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    survives lost executors, and gives the planner real sizes."""
    spark = df.sparkSession
    path = folder(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folder(spark: SparkSession, what: str) -> str:
    """The name of a new folder in the shared one, which ``clean`` deletes."""
    _WRITTEN.append(f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}")
    return _WRITTEN[-1]


_WRITTEN: list[str] = []


def clean(spark: SparkSession) -> int:
    """Delete the folders that ``written`` and ``folder`` have made; call it when the results are stored. Returns their number."""
    conf, number = spark._jsc.hadoopConfiguration(), 0
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        number += bool(path.getFileSystem(conf).delete(path, True))
    return number
