"""Which stored files a job has read: new and changed files are read, the others aren't opened."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa import schemas
from tarifa.operators.commits import Tables
from tarifa.operators.upsert import upsert
from tarifa.session import written
from tarifa.sources import readers

FILE = "path string, length bigint, modified timestamp, md5 string"


class FileLedger:
    """A stored table of (path, length, modified, md5).

    Files are listed without their content. One whose length and time are known is done. Of the others the content is
    summed: one whose sum is known was only touched. ``mark`` what was read when its results are stored: a job that fails before reads it again.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.tables = spark, Tables(spark, path)

    def known(self) -> DataFrame:
        return self.tables.read().get("files", self.spark.createDataFrame([], FILE))

    def _listed(self, *paths: str, pattern: str | None = None) -> DataFrame:
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        files = (files.option("pathGlobFilter", pattern) if pattern else files).load(list(paths))
        return files.select("path", "length", F.col("modificationTime").alias("modified"), "content")

    def pending(self, root: str, pattern: str | None = None) -> DataFrame:
        """(path, length, modified, md5, change) of files under the root that are ``new``, ``changed`` or ``touched``."""
        old = self.known().select("path", *[F.col(n).alias(f"old_{n}") for n in ("length", "modified", "md5")])
        listed = self._listed(root, pattern=pattern).select("path", "length", "modified").join(old, "path", "left")
        open_ = listed.where("old_md5 is null or length <> old_length or modified <> old_modified").select("path")
        paths = [r.path for r in open_.collect()]  # names of files that came since the last run
        if not paths:
            return self.spark.createDataFrame([], FILE + ", change string")
        summed = self._listed(*paths).select("path", "length", "modified", F.md5("content").alias("md5")).join(old.select("path", "old_md5"), "path", "left")
        change = F.when(F.col("old_md5").isNull(), "new").when(F.col("old_md5") != F.col("md5"), "changed").otherwise("touched")
        return written(summed.select("path", "length", "modified", "md5", change.alias("change")), "pending-files")

    def mark(self, files: DataFrame) -> None:
        rows = files.select("path", "length", "modified", "md5")
        self.tables.change(lambda t: {"files": upsert(t["files"], rows, ["path"]) if "files" in t else rows})


def new_bronze(spark: SparkSession, ledger: FileLedger, root: str) -> tuple[DataFrame, DataFrame]:
    """(records, files): the fetch records of new and changed files, and the files to mark when the records are stored."""
    files = ledger.pending(root, "*.json.gz")
    paths = [r.path for r in files.where("change <> 'touched'").select("path").collect()]
    if not paths:
        empty = spark.createDataFrame([], schemas.BRONZE)
        return empty.selectExpr("*", "CAST(NULL AS STRING) AS domain", "CAST(NULL AS DATE) AS fetched_date", "CAST(NULL AS STRING) AS bronze_source_key"), files
    return readers.bronze_columns(spark.read.schema(schemas.BRONZE).json(paths)), files
