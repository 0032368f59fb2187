"""Dimension, reconciliation and monitoring."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tillflow.operators import dimension, monitor, reconcile
from tillflow.plans.product import current_version, read_runs, run_dimension
from tillflow.sources import readers


def product(sku, price=1.0, day=1, **over):
    record = {"sku": sku, "product_name": "n", "category": "toys", "unit_price": price, "active": True,
              "updated_at": f"2024-01-{day:02d}T00:00:00+00:00", **over}
    return json.dumps(record)


def checked(spark, *records):
    return dimension.check_products(spark.createDataFrame([(1, r) for r in records], "page int, record string"))


def test_products_are_split(spark):
    good, bad = dimension.split_products(checked(spark, product("A"), product("B", -1), product("C", active="yes"), "{"))
    assert [r.sku for r in good.collect()] == ["A"]
    assert {r._validation_error for r in bad.collect()} == {"minimum:unit_price", "type:active", "type:$"}


def test_upsert_latest_wins_and_is_idempotent(spark):
    rows = checked(spark, product("A", 1, 5), product("B", 1, 5)).drop("page", "_validation_error")
    changes = checked(spark, product("A", 2, 9), product("B", 3, 1), product("C", 4, 1), product("C", 5, 2)).drop("page", "_validation_error")
    once = dimension.upsert_scd1(rows, changes)
    assert {r.sku: r.unit_price for r in once.collect()} == {"A": 2.0, "B": 1.0, "C": 5.0}
    twice = dimension.upsert_scd1(once, changes)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_summary_and_mark(spark):
    frame = checked(spark, product("A", 1, 3), product("B", -1, 9))
    r = dimension.run_summary(frame).first()
    assert (r.pages_fetched, r.valid_records, r.invalid_records, r.status, r.watermark.day) == (1, 1, 1, "success", 3)
    empty = dimension.run_summary(frame.limit(0)).first()
    assert (empty.pages_fetched, empty.valid_records, empty.status, empty.watermark) == (0, 0, "no_data", None)
    assert dimension.newer_than(frame, "2024-01-03T00:00:00+00:00").count() == 2  # a tie with the mark is taken
    assert dimension.newer_than(frame, "2024-01-03T00:00:01+00:00").count() == 1
    assert dimension.newer_than(frame, None).count() == 2


def write_pages(path, pages):
    path.mkdir(parents=True, exist_ok=True)
    lines = [f'{{"page":{n},"data":[{",".join(records)}]}}' for n, records in pages.items()]
    (path / f"{len(list(path.iterdir()))}.json").write_text("\n".join(lines) + "\n")


def test_all_landed_pages_are_read(spark, tmp_path):
    write_pages(tmp_path, {1: [product("A")], 2: [product("B")], 3: []})
    write_pages(tmp_path, {1: [product("C")], 2: [product("D")], 3: [product("E")], 4: []})
    assert sorted(r.page for r in readers.read_pages(spark, str(tmp_path)).collect()) == [1, 1, 2, 2, 3]


def test_dimension_runs_take_every_page_file_once(spark, tmp_path):
    root, feed = str(tmp_path / "silver"), tmp_path / "feed"
    assert run_dimension(spark, root, str(feed))["status"] == "no_data" and current_version(spark, root) == (0, None)
    write_pages(feed, {1: [product("A", 1, 3), product("B", -1, 9)]})
    first = run_dimension(spark, root, str(feed))
    assert (first["valid_records"], first["version"], first["mark"][:10]) == (1, 1, "2024-01-03")
    again = run_dimension(spark, root, str(feed))
    assert (again["status"], again["valid_records"], again["version"]) == ("no_data", 0, 1)
    # a tie with the mark arrives later and is taken, what is older is not
    write_pages(feed, {2: [product("A", 7, 3), product("C", 2, 6), product("D", 2, 1)]})
    assert run_dimension(spark, root, str(feed))["valid_records"] == 2
    write_pages(feed, {3: [product("E", -1, 9), '"{"']})
    (feed / "cut.json").write_text('{"page":4,"data":[{"sku"')
    bad = run_dimension(spark, root, str(feed))
    assert (bad["status"], bad["invalid_records"], bad["version"], bad["mark"][:10]) == ("no_data", 3, 2, "2024-01-06")
    version, table = current_version(spark, root)
    assert version == 2 and {r.sku: r.unit_price for r in table.collect()} == {"A": 7.0, "C": 2.0}
    assert sorted((r.run, r.sku) for r in spark.read.parquet(f"{root}/quarantine/sku_api").select("run", "sku").collect() if r.sku) == [(1, "B"), (3, "E")]
    assert {r.run for r in read_runs(spark, root).collect()} == {1, 2, 3}


def test_a_failed_dimension_run_is_repeated_whole(spark, tmp_path, monkeypatch):
    from tillflow.plans import product as plan
    root, feed = str(tmp_path / "silver"), tmp_path / "feed"
    write_pages(feed, {1: [product("A", 1, 3), product("B", -1, 9)]})
    monkeypatch.setattr(plan.dimension, "upsert_scd1", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_dimension(spark, root, str(feed))
    assert current_version(spark, root) == (0, None)
    monkeypatch.undo()
    assert run_dimension(spark, root, str(feed))["version"] == 1
    assert spark.read.parquet(f"{root}/quarantine/sku_api").count() == 1


@pytest.mark.parametrize("expected, actual, pct, status", [
    (0, 0, 0.0, "OK"), (0, 3, 300.0, "FAIL"), (100, 95, 5.0, "WARN"), (100, 115, 15.0, "FAIL"), (1000, 951, 4.9, "OK"), (3, None, 100.0, "FAIL")])
def test_reconcile(spark, expected, actual, pct, status):
    files = spark.createDataFrame([] if actual is None else [("d", "f", actual)], "date_prefix string, file string, records long")
    r = reconcile.reconcile(files, spark.createDataFrame([("d", expected)], "date_prefix string, expected_count long")).first()
    assert (r.variance_pct, r.status, r.blob_count) == (pct, status, 0 if actual is None else 1)


def test_counts_by_file_and_estimates(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "day=1"))
    files = readers.count_by_file(spark, str(tmp_path), F.regexp_extract("file", "day=([^/]+)", 1))
    assert files.agg(F.sum("records")).first()[0] == 10 and {r.date_prefix for r in files.collect()} == {"1"}
    sizes = spark.createDataFrame([("f", 1_050)], "file string, size_bytes long")
    assert reconcile.estimated_records(sizes).first().records == 5


def test_file_issues(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("c", 2), ("e", 2)], "file string, v int")
    listed = reconcile.content_sums(rows, F.col("file"), ["v"])
    expected = spark.createDataFrame([("a",), ("z",)], "file string")
    got = {(r.file, r.issue, r.copies) for r in reconcile.file_issues(listed, expected).collect()}
    assert got == {("z", "missing", 0), ("a", "duplicate", 2), ("b", "duplicate", 2)}


@pytest.mark.parametrize("end, committed, status", [(9_999, 0, "OK"), (10_000, None, "WARN"), (100_005, 5, "CRITICAL")])
def test_lag(spark, end, committed, status):
    ends = spark.createDataFrame([("t", 0, end)], "topic string, partition int, end_offset long")
    done = spark.createDataFrame([("t", 0, committed)], "topic string, partition int, committed_offset long")
    r = monitor.lag_report(ends, done).first()
    assert (r.total_lag, r.partitions, r.status) == (end - (committed or 0), 1, status)


def test_drift_kinds(spark):
    df = spark.createDataFrame([('{"event_id":1,"store_id":null,"colour":"red","quantity_on_hand":2}',), ("[]",)], "value string")
    got = {r.field: (r.expected_type, r.seen_type, r.drift) for r in monitor.schema_drift(df, "inventory").collect()}
    assert got == {"event_id": ("string", "integer", "type_changed"), "store_id": ("string", "null", "null_value"),
                   "colour": (None, "string", "new_field"), "quantity_on_hand": ("integer", "integer", "none")}


def test_missing_path_is_none_and_other_errors_raise(spark, tmp_path):
    assert readers.or_none(spark.read.parquet, str(tmp_path / "nowhere")) is None
    with pytest.raises(Exception):
        readers.or_none(spark.read.format("no-such-format").load, str(tmp_path))


def test_read_any(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"event_id":"a"}')
    (tmp_path / "many.json").write_text('[{"event_id":"a"},\n{"event_id":"b"}]')
    assert readers.read_any(spark, str(tmp_path / "one.json")).count() == 1
    assert [r.e for r in readers.read_any(spark, str(tmp_path / "many.json")).selectExpr("record:event_id::string AS e").collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        readers.read_any(spark, "x.txt")


def test_drift_counts_what_cannot_be_told_apart(spark):
    texts = ['{"event_id":"a","event_id":"b"}', '{"metadata":{"x":1,"x":2}}', "[]", '{"event_id":"c"} rest']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {(r.field, r.seen_type, r.records, r.drift) for r in monitor.schema_drift(df, "inventory").collect()}
    assert got == {("event_id", "string", 1, "none"), ("$", None, 1, "unparsable")}
    stored = df.limit(2).select(F.try_parse_json("value").alias("v"))
    assert {(r.field, r.records) for r in monitor.schema_drift(stored, "inventory", "v").collect()} == {("$", 2)}


def waits_frame(spark, waits):
    rows = [(t, "2024-01-01T00:00:00+00:00", w) for t, ws in waits.items() for w in ws]
    df = spark.createDataFrame(rows, "_kafka_topic string, timestamp string, wait bigint")
    at = F.timestamp_micros(F.unix_micros(F.col("timestamp").cast("timestamp")) + F.col("wait"))
    return df.withColumn("_ingestion_ts", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


def test_latency_percentiles_are_exact(spark):
    draw = random.Random(3)
    waits = {"a": [draw.randrange(-10**9, 86_400 * 10**6) for _ in range(500)], "b": [7], "c": [0] * 90 + [5] * 10, "d": [draw.randrange(20) for _ in range(99)]}
    got = {r._kafka_topic: (r.measured, r.p50, r.p95, r.p99) for r in monitor.latency_percentiles(waits_frame(spark, waits)).collect()}
    want = {t: (len(w), *(sorted(w)[max(1, math.ceil(p * len(w))) - 1] / 1e6 for p in (0.5, 0.95, 0.99))) for t, w in waits.items()}
    assert got == want
    assert monitor.latency_percentiles(waits_frame(spark, waits).limit(0)).count() == 0


def test_unexpected_files_are_reported_with_details(spark):
    files = spark.createDataFrame([("d1", "f", 1_000, 5), ("d9", "g", 400, 2)], "date_prefix string, file string, size_bytes long, records long")
    expected = spark.createDataFrame([("d1", 5), ("d2", 1)], "date_prefix string, expected_count long")
    report = reconcile.reconcile(files, expected)
    assert {(r.date_prefix, r.actual_count, r.status, r.blob_count) for r in report.collect()} == {("d1", 5, "OK", 1), ("d2", 0, "FAIL", 0), ("d9", 2, "FAIL", 1)}
    assert {(r.date_prefix, r.file, r.status) for r in reconcile.file_details(files, report).collect()} == {("d1", "f", "OK"), ("d9", "g", "FAIL")}
    guessed = reconcile.reconcile(reconcile.estimated_records(files), expected)
    assert {r.date_prefix: r.actual_count for r in guessed.collect()} == {"d1": 5, "d2": 0, "d9": 2}
