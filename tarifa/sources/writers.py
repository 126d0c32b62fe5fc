"""Writers of listings, manifests, fetch records and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.functions import text
from tarifa.plans import analytics

ROW_GROUP = 128 << 20


def extracted_ok(listings: DataFrame) -> DataFrame:
    """Rows of a method that found something, with a name."""
    return listings.where((F.col("extraction_method") != "failed") & (F.coalesce("raw_name", F.lit("")) != ""))


def write_listings(listings: DataFrame, root: str, replace_partitions: bool = False, rows_per_file: int = 1_000_000) -> None:
    """Good rows by site and date, zstd. Added beside what is there, or in place of the partitions that occur.

    Rows of a partition are brought together before the write, split by a hash where
    there are many, so that neither files nor a hot site's task grow without bound.
    """
    rows = extracted_ok(listings)
    rows = rows.repartition(F.col("domain"), F.col("fetched_date"), F.pmod(F.xxhash64("url"), F.lit(8)))
    writer = rows.write.mode("overwrite" if replace_partitions else "append").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("domain", "fetched_date").parquet(root)


def write_manifest(listings: DataFrame, path: str, run_id: str) -> None:
    analytics.manifest(listings, run_id).write.mode("append").option("compression", "zstd").parquet(path)


def write_bronze(records: DataFrame, root: str, per_file: int = 500) -> None:
    """Fetch records as gzip JSON lines under site=<host>/date=<day>, 500 to a file, each row under its own host."""
    rows = records.withColumn("html", text.without_nul(F.col("html"))).withColumn("site", F.coalesce(text.url_host(F.col("url")), F.lit("unknown")))
    rows = rows.withColumn("date", F.to_date(F.timestamp_seconds("fetched_at_utc")))
    rows.repartition(F.col("site"), F.col("date"), F.pmod(F.xxhash64("url"), F.lit(8))).write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", per_file).partitionBy("site", "date").json(root)


def append_log(rows: DataFrame, path: str, time_col: str, unit: str = "month") -> None:
    """Append-only time series, a folder for each month or week."""
    part = F.to_date(F.date_trunc(unit, F.col(time_col)))
    rows.withColumn("period", part).write.mode("append").partitionBy("period").option("compression", "zstd").parquet(path)


def compacted(log: DataFrame, segment: list[str], time_col: str) -> DataFrame:
    """A closed period rewritten by segment, newest first, so that columns compress and segments prune."""
    return log.repartition(*segment).sortWithinPartitions(*segment, F.desc(time_col))
