"""The queue of URLs: discovery, fetch outcomes and the states between."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Outcomes by HTTP code, and the queue's status after an outcome.
TERMINAL = ("done", "failed", "blocked", "not_found")
NOT_FOUND = (404, 410, 451)
RETRYABLE = (500, 502, 503, 504)
AFTER = {"success": "done", "blocked": "blocked", "not_found": "not_found"}


def outcome(code: Column, error: Column | None = None) -> Column:
    """The outcome of a fetch, from its HTTP code or the kind of its error."""
    failed = F.lit("unknown_error") if error is None else F.when(error.contains("timeout"), "timeout").when(error.contains("network") | error.contains("connection"), "network_error").otherwise("unknown_error")
    return F.when(code.isNull(), failed).when(code.between(200, 299), "success").when(code == 403, "blocked").when(code.isin(*NOT_FOUND), "not_found").when(code == 429, "rate_limited").otherwise("http_error")


def retries(code: Column, attempt: Column, most: int = 3) -> Column:
    """Whether a fetch is tried again."""
    return (code.isNull() | code.isin(429, *RETRYABLE)) & (attempt < most)


def status_after(outcome_: Column) -> Column:
    out = F.lit("failed")
    for name, status in AFTER.items():
        out = F.when(outcome_ == name, status).otherwise(out)
    return out


def discovered(queue: DataFrame, urls: DataFrame, now: Column, rescrape: bool = False, ttl: Column | None = None) -> DataFrame:
    """The queue after a discovery of (site_id, url): new URLs are pending, finished ones whose time has come too.

    ``change`` says what happened to each row: created, reset or kept.
    """
    new = urls.select("site_id", "url").distinct().withColumn("_found", F.lit(True))
    joined = queue.withColumn("_known", F.lit(True)).join(new, ["site_id", "url"], "full_outer")
    due = F.lit(True) if rescrape else F.col("next_scrape_after").isNull() | (F.col("next_scrape_after") <= now)
    reset = F.col("_known") & F.col("_found") & F.col("status").isin(*TERMINAL) & due
    change = F.when(F.col("_known").isNull(), "created").when(F.coalesce(reset, F.lit(False)), "reset").otherwise("kept")
    out = joined.withColumn("change", change)
    created, pending = F.col("change") == "created", F.col("change") != "kept"
    values = {
        "id": F.when(created, F.md5(F.concat_ws("|", "site_id", "url"))).otherwise(F.col("id")),
        "status": F.when(pending, "pending").otherwise(F.col("status")),
        "url_type": F.when(created, "product").otherwise(F.col("url_type")),
        "priority": F.when(created, 5).otherwise(F.col("priority")),
        "discovered_at": F.when(created, now).otherwise(F.col("discovered_at")),
    }
    if ttl is not None:
        values["next_scrape_after"] = F.when(pending, now + ttl).otherwise(F.col("next_scrape_after"))
    return out.withColumns(values).select(*queue.columns, "change")


def enqueued(queue: DataFrame, site_id: str | None = None) -> DataFrame:
    """Product pages that wait or were under way get a job and are under way; the job's name is the same on a rerun."""
    mine = F.col("status").isin("pending", "in_progress") & (F.col("url_type") == "product") & (F.col("site_id") == site_id if site_id else F.lit(True))
    return queue.withColumns({"job_id": F.when(mine, F.concat(F.lit("fetch:"), "id")), "status": F.when(mine, "in_progress").otherwise(F.col("status"))})


def fetched(queue: DataFrame, results: DataFrame) -> DataFrame:
    """The queue after fetches (id, http_status_code, fetched_at, error_message) that are stored; the latest of a URL counts."""
    said = results.withColumn("_status", status_after(outcome(F.col("http_status_code"), F.col("error_message"))))
    last = said.groupBy("id").agg(F.max_by(F.struct("_status", F.col("error_message").alias("_error")), "fetched_at").alias("r")).select("id", "r.*")
    out = queue.join(last, "id", "left").withColumns({"status": F.coalesce("_status", "status"), "error_message": F.coalesce("_error", "error_message") if "error_message" in queue.columns else F.col("_error")})
    return out.drop("_status", "_error")


def fetch_logged(log: DataFrame, worker: str) -> DataFrame:
    """Log rows of all fetches of a batch, with outcome and worker."""
    return log.withColumn("status", outcome(F.col("http_status_code"))).withColumn("worker", F.lit(worker))


def changed(queue: DataFrame, changes: DataFrame) -> DataFrame:
    """Partial update by id: only what ``changes`` has a value for."""
    from tarifa.operators.upsert import upsert

    return upsert(queue, changes, ["id"], only_if=F.col("old.id").isNotNull()).where("url is not null")


def requeued(queue: DataFrame, where: Column) -> DataFrame:
    return queue.withColumn("status", F.when(where, "pending").otherwise(F.col("status")))


def excluded(queue: DataFrame, where: Column) -> DataFrame:
    return queue.withColumn("status", F.when(where, "excluded").otherwise(F.col("status")))


def site_status(sites: DataFrame, where: Column, status: str) -> DataFrame:
    return sites.withColumn("status", F.when(where, status).otherwise(F.col("status")))


def proxy_reset(proxies: DataFrame, where: Column) -> DataFrame:
    return proxies.withColumn("failures", F.when(where, 0).otherwise(F.col("failures")))


def unfinished(queue: DataFrame) -> int:
    """URLs still to come; a run polls it."""
    return queue.where(F.col("status").isin("pending", "in_progress")).count()


def wait(read: Callable[[], DataFrame], timeout: float = 6 * 3600, poll: float = 60, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> dict[str, int] | None:
    """URLs by status once none waits or is under way; null after ``timeout`` seconds. ``read`` gives the queue as it is now."""
    end = clock() + timeout
    while clock() < end:
        counts = {r.status: r["count"] for r in read().groupBy("status").count().collect()}  # as many rows as statuses
        if not counts.get("pending") and not counts.get("in_progress"):
            return counts
        sleep(poll)
    return None
