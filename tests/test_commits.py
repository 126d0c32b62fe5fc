import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarifa.operators import chunks
from tarifa.operators.commits import Conflict, Store, Tables
from tarifa.operators.upsert import SnapshotTable, insert_missing


def ids(rows):
    return sorted(r.id for r in rows.collect())


def test_a_number_is_taken_once(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    assert (store.version(), store.manifest()) == (0, {})
    assert store.commit(0, {"a": 1}) == 1
    with pytest.raises(Conflict):
        store.commit(0, {"a": 2})
    assert store.manifest() == {"a": 1} and store.commit(1, {"a": 3}) == 2 and store.manifest(1) == {"a": 1}
    assert len([n for n in (tmp_path / "s/_commits").iterdir() if n.name.endswith(".json") and n.name[0] != "."]) == 2


def test_two_interleaved_runs_lose_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    one, two = Tables(spark, path, ("log",)), Tables(spark, path, ("log",))
    one.change(lambda t: {"rows": spark.range(2), "log": spark.range(2)})
    calls = []

    def slow(tables):
        if not calls:  # while this run works, another one commits
            two.change(lambda t: {"rows": t["rows"].union(spark.range(10, 12)), "log": spark.range(10, 12)})
        calls.append(ids(tables["rows"]))
        return {"rows": tables["rows"].union(spark.range(20, 22)), "log": spark.range(20, 22)}

    assert one.change(slow) == 3
    assert calls == [[0, 1], [0, 1, 10, 11]]
    assert {n: ids(t) for n, t in one.read().items()} == {n: [0, 1, 10, 11, 20, 21] for n in ("rows", "log")}
    assert {n: ids(t) for n, t in one.read(1).items()} == {"rows": [0, 1], "log": [0, 1]}  # readers keep their commit


def test_an_append_only_table_cannot_be_replaced(spark, tmp_path):
    Tables(spark, f"file://{tmp_path}/t", ("log",)).change(lambda t: {"log": spark.range(3)})
    with pytest.raises(ValueError, match="append-only"):
        Tables(spark, f"file://{tmp_path}/t").change(lambda t: {"log": spark.range(1)})
    kept = Tables(spark, f"file://{tmp_path}/t", ("log",))
    kept.change(lambda t: {"log": spark.range(0)})
    assert ids(kept.read()["log"]) == [0, 1, 2]


def test_a_writer_that_always_loses_says_so(spark, tmp_path):
    table = SnapshotTable(spark, f"file://{tmp_path}/t")
    table.write(spark.range(1))
    store = table.tables.store
    with pytest.raises(Conflict, match="3 commits"):
        store.change(lambda m, n: store.commit(n - 1, m) and m, tries=3)


def test_missing_rows_are_inserted_alike_in_reruns(spark):
    rows = spark.createDataFrame([(1, "b"), (1, "c"), (2, "a"), (3, "x")], "k int, v string")
    for df in (rows, rows.orderBy(F.desc("v")).repartition(3)):
        assert sorted(map(tuple, insert_missing(rows.where("k = 3"), df, ["k"]).collect())) == [(1, "c"), (2, "a")]


LOG = "logged_at timestamp, master_id string, site_id string, price decimal(12,2), in_stock boolean"


def prices(spark, *rows):
    from decimal import Decimal

    return spark.createDataFrame([(dt.datetime.fromisoformat(t), m, s, None if p is None else Decimal(p), k) for t, m, s, p, k in rows], LOG)


def day_rows(aggregate):
    return sorted((str(r.day), r.master_id, None if r.price_min is None else str(r.price_min), None if r.price_avg is None else float(r.price_avg), r.any_in_stock) for r in chunks.finished(aggregate.read()).collect())


def test_chunks_live(spark, tmp_path):
    log = chunks.ChunkedLog(spark, f"file://{tmp_path}/l", "logged_at", "month", ("master_id",))
    with pytest.raises(FileNotFoundError):
        log.read()
    log.append(prices(spark, ("2024-01-05T01:00:00", "b", "s", "1", True), ("2024-01-09T01:00:00", "a", "s", "2", True), ("2024-03-01T01:00:00", "a", "s", "3", True)))
    log.append(prices(spark, ("2024-01-05T02:00:00", "a", "s", "4", True)))
    state = lambda: [tuple(r) for r in log.chunks().collect()]
    assert state() == [("2024-01-01", 2, 3, 2, "open"), ("2024-03-01", 1, 1, 1, "open")]
    before = log.store.version()
    now, older = dt.datetime(2024, 5, 10), dt.timedelta(90)
    assert log.compress(now, older) == ["2024-01-01"] and log.compress(now, older) == []
    assert state() == [("2024-01-01", 1, 3, 2, "compressed"), ("2024-03-01", 1, 1, 1, "open")]
    (part,) = [p for p in log.parts() if p["state"] == "compressed"]
    assert [r.master_id for r in spark.read.parquet(f"{log.store.path}/{part['folder']}").coalesce(1).collect()].count("a") == 2
    assert log.read().count() == log.read(version=before).count() == 4  # readers of the old commit still have its parts
    log.append(prices(spark, ("2024-01-07T02:00:00", "c", "s", "4", True)))
    assert state()[0] == ("2024-01-01", 2, 4, 3, "partly compressed")
    assert log.compress(now, older) == ["2024-01-01"] and state()[0] == ("2024-01-01", 1, 4, 3, "compressed")
    assert log.read(["2024-01-05"]).count() == 2
    assert log.drop("2024-02-01") == ["2024-01-01"] and log.read().count() == 1
    with pytest.raises(ValueError, match="without logged_at"):
        log.append(log.read().withColumn("logged_at", F.lit(None).cast("timestamp")))


def test_rows_appended_while_a_chunk_is_rewritten_stay(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/l"
    log, other = (chunks.ChunkedLog(spark, path, "logged_at", "month") for _ in range(2))
    log.append(prices(spark, ("2024-01-05T01:00:00", "b", "s", "1", True)))
    write = log.store.write

    def slow(rows, *by):
        other.append(prices(spark, ("2024-01-06T01:00:00", "c", "s", "1", True)))
        return write(rows, *by)

    monkeypatch.setattr(log.store, "write", slow)
    assert log.compress(dt.datetime(2024, 9, 1), dt.timedelta(90)) == ["2024-01-01"]
    assert [tuple(r) for r in log.chunks().collect()] == [("2024-01-01", 2, 2, 2, "partly compressed")]


@pytest.mark.parametrize("folders", [30, 1])
def test_a_refresh_reads_changed_days_only(spark, tmp_path, monkeypatch, folders):
    monkeypatch.setattr(chunks, "FOLDERS", folders)
    log = chunks.ChunkedLog(spark, f"file://{tmp_path}/l", "logged_at", "month")
    daily = chunks.DailyAggregate(log)
    log.append(prices(spark, *[(f"2024-01-{d:02d}T05:00:00", "m", "s", "10", False) for d in range(1, 11)]))
    now = dt.datetime(2024, 1, 10, 0, 30)
    # the 9th ended half an hour ago, within the hour that is left out; the 2nd began over 7 days ago
    assert daily.refresh(now) == [f"2024-01-{d:02d}" for d in range(4, 9)]
    assert daily.refresh(dt.datetime(2024, 1, 10, 1)) == ["2024-01-09"]
    assert daily.refresh(now) == []
    log.append(prices(spark, ("2024-01-06T23:00:00", "m", "s", "5.01", True), ("2024-01-01T00:00:00", "n", "s", None, None)))
    assert daily.refresh(now) == ["2024-01-06"]
    assert ("2024-01-06", "m", "5.01", 7.51, True) in day_rows(daily) and len(day_rows(daily)) == 6
    assert daily.refresh(dt.datetime(2024, 3, 1), None) == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-10"]
    assert day_rows(daily)[:2] == [("2024-01-01", "m", "10.00", 10.0, False), ("2024-01-01", "n", None, None, None)]
    assert log.compress(dt.datetime(2024, 9, 1), dt.timedelta(90)) == ["2024-01-01"]
    assert daily.refresh(dt.datetime(2024, 3, 1), None) == []  # rewritten rows are not new
    month = chunks.finished(daily.rolled("month")).where("master_id = 'm'").first()
    assert (str(month.day), str(month.price_min), float(month.price_avg), month.any_in_stock) == ("2024-01-01", "5.01", 9.55, True)


def test_a_batch_that_comes_again_is_appended_once(spark, tmp_path):
    log = chunks.ChunkedLog(spark, f"file://{tmp_path}/l", "logged_at", "month")
    sink = chunks.kept_fresh(chunks.DailyAggregate(log), lambda: dt.datetime(2024, 1, 8), None)
    batch = prices(spark, ("2024-01-05T01:00:00", "b", "s", "1", True))
    sink(batch, 0)
    sink(batch, 0)
    sink(batch, 1)
    assert log.read().count() == 2 and len(day_rows(chunks.DailyAggregate(log))) == 1


def test_sitemaps_of_any_depth_and_cycles(spark):
    from tarifa.sources import readers

    index = lambda *locs: "<sitemapindex>" + "".join(f"<sitemap><loc>{x}</loc></sitemap>" for x in locs) + "</sitemapindex>"
    urls = lambda *locs: "<urlset>" + "".join(f"<url><loc>{x}</loc></url>" for x in locs) + "</urlset>"
    docs = [(f"http://s/{i}.xml", index(f"http://s/{i + 1}.xml", f"http://s/p{i}.xml")) for i in range(7)]
    docs += [(f"http://s/p{i}.xml", urls(f"http://s/page{i}")) for i in range(7)] + [("http://s/7.xml", index("http://s/0.xml", "http://s/7.xml"))]
    pages = readers.sitemap_pages(spark.createDataFrame(docs, "url string, xml string"), ["http://s/0.xml"])
    assert sorted(r.url for r in pages.collect()) == [f"http://s/page{i}" for i in range(7)]
