import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from tarifa.plans import stages
from tarifa.sources import ledger, readers


def put(root, name, rows, at):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress("".join(json.dumps(r) + "\n" for r in rows).encode(), mtime=0))
    os.utime(path, (at, at))


def test_only_new_and_changed_files_are_read(spark, tmp_path):
    root, known = tmp_path / "bronze", ledger.FileLedger(spark, f"file://{tmp_path}/files")
    put(root, "site=a/date=2024-01-01/1.json.gz", [{"url": "http://a/1"}], 1000)
    put(root, "site=b/date=2024-01-02/1.json.gz", [{"url": "http://b/1"}], 1000)
    (root / "site=b/_SUCCESS").write_text("")

    def run(mark=True):
        rows, files = ledger.new_bronze(spark, known, f"file://{root}")
        out = sorted((r.url, r.domain, str(r.fetched_date)) for r in rows.collect()), sorted(r.change for r in files.collect())
        if mark:
            known.mark(files)
        return out

    first = ([("http://a/1", "a", "2024-01-01"), ("http://b/1", "b", "2024-01-02")], ["new", "new"])
    assert run(mark=False) == first  # the job failed before its results were stored
    assert run() == first
    assert run() == ([], [])
    put(root, "site=a/date=2024-01-01/1.json.gz", [{"url": "http://a/2"}], 2000)
    put(root, "site=b/date=2024-01-02/1.json.gz", [{"url": "http://b/1"}], 2000)
    put(root, "site=a/date=2024-01-03/2.json.gz", [{"url": "http://a/3"}], 2000)
    assert run() == ([("http://a/2", "a", "2024-01-01"), ("http://a/3", "a", "2024-01-03")], ["changed", "new", "touched"])
    assert run() == ([], []) and known.known().count() == 3


def test_a_run_begins_at_the_first_stage_that_is_not_done(spark, tmp_path):
    days, calls, broken = stages.Ledger(spark, f"file://{tmp_path}/d"), [], ["b"]

    def make(name, f):
        def of(inputs, day):
            calls.append((name, day))
            if name in broken:
                raise RuntimeError(f"{name} is broken")
            return f(inputs)

        return of

    plan = [stages.Stage("a", make("a", lambda _: spark.range(4))), stages.Stage("b", make("b", lambda x: x["a"].where("id > 1")), ("a",)), stages.Stage("c", make("c", lambda x: x["b"].union(x["a"])), ("a", "b"))]
    with pytest.raises(RuntimeError, match="b is broken"):
        days.run(plan, "2024-01-01")
    assert [tuple(r) for r in days.entries().collect()] == [("2024-01-01", "a", "done", 1, 4, None), ("2024-01-01", "b", "failed", 1, None, "b is broken")]
    broken.clear()
    assert days.run(plan, "2024-01-01") == ["b", "c"] and days.run(plan, "2024-01-01") == []
    assert [n for n, _ in calls] == ["a", "b", "b", "c"]
    assert sorted(r.id for r in days.result("2024-01-01", "c").collect()) == [0, 1, 2, 2, 3, 3]
    assert days.run(plan, "2024-01-02") == ["a", "b", "c"]
    # a stage that is made again makes those after it stale
    days._put("2024-01-01", "a", {"state": "failed", "tries": 1, "error": "lost"})
    assert days.run(plan, "2024-01-01") == ["a", "b", "c"]
    with pytest.raises(ValueError, match="c needs"):
        days.run(plan[::-1], "2024-01-03")


def test_chains_end_at_the_first_empty_or_missing_page(spark):
    body = lambda *codes: json.dumps({"items": [{"ref": x, "price": "2,5", "stock": "oui", "id": "7" if x == "k" else "none"} for x in codes]})
    docs = [("s", 1, body("a", "b")), ("s", 2, body("c")), ("s", 3, body()), ("s", 4, body("d")), ("t", 1, body("k")), ("t", 3, body("m")), ("u", 2, body("n")), ("v", 1, "no json"), ("w", 1, None), ("x", 1, body(None))]
    pages = spark.createDataFrame(docs, "supplier string, page int, body string")
    got = readers.supplier_list(pages, {"code": "ref", "price": "price", "in_stock": "stock", "id": "id"})
    assert sorted((r.supplier, r.code, float(r.prix_pharmacien), r.in_stock, r.vendor_product_id, r.name) for r in got.collect()) == [("s", "a", 2.5, True, None, None), ("s", "b", 2.5, True, None, None), ("s", "c", 2.5, True, None, None), ("t", "k", 2.5, True, 7, None)]
    assert readers.paged(pages.limit(0), "supplier").count() == 0
