"""Bronze, silver and gold on hand-written rows."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillflow.functions.money import exact_sum
from tillflow.operators import bronze, gold, silver
from tillflow.schemas import BRONZE, RAW

ITEMS = '[{"sku":"A","product_name":"a","category":"toys","quantity":2,"unit_price":1.5,"line_total":3.0}]'


def raw_pos(spark, rows):
    """Raw POS rows from dicts; missing keys are null."""
    names = [c.split()[0] for c in RAW["pos"].split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RAW["pos"])


def sale(n, total=10.0, **over):
    row = {"event_id": f"e{n}", "event_type": "sale", "store_id": "STR0001", "terminal_id": "T", "cashier_id": "c1",
           "timestamp": "2024-01-01T10:00:00+00:00", "transaction_id": f"t{n}", "items": ITEMS,
           "payment": '{"method":"cash","amount_tendered":10}',
           "totals": f'{{"subtotal":9.0,"discount":1.0,"tax":0.5,"total":{total}}}',
           "_ingestion_ts": "2024-01-01T10:00:30+00:00", "_kafka_topic": "retail.pos.events", "_kafka_partition": 0, "_kafka_offset": n}
    return {**row, **over}


def silver_of(spark, rows):
    return silver.build_silver(bronze.add_metadata(raw_pos(spark, rows), "pos"), "pos")


def test_calendar_is_utc_and_bad_time_is_null(spark):
    rows = [sale(1, timestamp="2024-01-01T23:30:00-05:00"), sale(2, timestamp="not-a-time")]
    got = {r.event_id: (r.event_date, r.event_hour) for r in bronze.add_metadata(raw_pos(spark, rows), "pos").collect()}
    assert got == {"e1": (date(2024, 1, 2), 4), "e2": (None, None)}


def test_redelivered_copy_keeps_its_fingerprint(spark):
    rows = [sale(1), sale(1, _kafka_offset=99, _ingestion_ts="2024-01-02T00:00:00+00:00"), sale(1, metadata="{}")]
    hashes = [r._record_hash for r in bronze.add_metadata(raw_pos(spark, rows), "pos").collect()]
    assert hashes[0] == hashes[1] != hashes[2]


def test_absent_required_column_makes_every_row_invalid(spark):
    df = bronze.add_metadata(raw_pos(spark, [sale(1), sale(2, store_id=None)]).drop("transaction_id"), "pos")
    good, bad = bronze.split_required(df, "pos")
    assert good.count() == 0
    assert {r.event_id: r._missing_fields for r in bad.collect()} == {"e1": "transaction_id", "e2": "store_id,transaction_id"}
    assert {r._validation_error for r in bad.collect()} == {"missing_required_field"}


def test_valid_and_invalid_are_the_input(spark):
    df = bronze.add_metadata(raw_pos(spark, [sale(i, transaction_id=None if i % 3 == 0 else "t") for i in range(20)]), "pos")
    good, bad = bronze.split_required(df, "pos")
    assert (good.count(), bad.count()) == (13, 7)


def test_clean_pos_tolerates_malformed_parts(spark):
    rows = [sale(1, items="{bad", totals="{bad", payment=None), sale(2, items="[]"), sale(3, total="-0.01"), sale(4, total="NaN")]
    got = {r.event_id: r for r in silver_of(spark, rows).collect()}
    assert (got["e1"].item_count, got["e1"].total_amount, got["e1"].payment_method, got["e1"]._is_valid) == (0, None, None, False)
    assert got["e2"].item_count == 0
    assert not got["e3"]._is_valid
    assert got["e4"].total_amount is None and not got["e4"]._is_valid


def test_latest_copy_wins_with_equal_load_time(spark):
    rows = [sale(1, total=1.0, _kafka_offset=5), sale(1, total=2.0, _kafka_offset=7), sale(1, total=3.0, _kafka_offset=6)]
    once = silver_of(spark, rows)
    assert [r.total_amount for r in once.collect()] == [2.0]
    assert not [c for c in once.columns if c in silver.RECENCY]


def test_hot_key_is_cut_before_the_exchange(spark):
    plan = silver_of(spark, [sale(1)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_schema_is_enforced(spark):
    df = spark.createDataFrame([("e1", "x", "10"), ("e2", None, "a")], "event_id string, event_type string, item_count string")
    good, bad = silver.enforce_schema(df, "pos")
    assert good.count() == 0
    errors = {r.event_id: r._validation_error.split(",") for r in bad.collect()}
    assert "cast:item_count" in errors["e2"] and "null:event_type" in errors["e2"]
    assert "cast:item_count" not in errors["e1"] and "null:store_id" in errors["e1"]


def test_daily_sales(spark):
    rows = [sale(1, 10.1), sale(2, 20.2, cashier_id="c2"), sale(3, 0.3, cashier_id=None, payment='{"method":"gift_card"}'),
            sale(4, -1.0), sale(5, 99.0, event_type="refund")]
    r = gold.daily_sales(silver_of(spark, rows)).first()
    assert (r.transaction_count, r.gross_revenue, r.total_discounts, r.total_tax) == (3, 30.6, 3.0, 1.5)
    assert (r.max_transaction_value, r.total_items_sold, r.unique_cashiers, r.payment_methods_used) == (20.2, 3, 2, 2)
    assert r.net_revenue == 30.6 - 3.0 and math.isclose(r.avg_transaction_value, 10.2)


def test_sums_do_not_depend_on_order_and_keep_large_amounts(spark):
    values = [0.1] * 10 + [1e15, 0.2, None]
    total = spark.createDataFrame([(v,) for v in values], "x double").agg(exact_sum(F.col("x"))).first()[0]
    assert total == 1e15 + 1.2
    assert spark.createDataFrame([(None,)], "x double").agg(exact_sum(F.col("x"))).first()[0] is None
    small = spark.range(1000).agg(exact_sum(F.lit(0.00004))).first()[0]
    large = spark.range(2000).agg(exact_sum(F.lit(8e11))).first()[0]
    assert (small, large) == (0.04, 1.6e15)
    assert math.isnan(spark.createDataFrame([(1.0,), (float("nan"),)], "x double").agg(exact_sum(F.col("x"))).first()[0])


def test_hourly_uses_last_present_hour_and_skips_zero(spark):
    def at(h):
        return f"2024-01-01T{h:02d}:15:00+00:00"
    rows = [sale(1, 10, timestamp=at(8)), sale(2, 0, timestamp=at(11)), sale(3, 5, timestamp=at(12)), sale(4, 20, timestamp=at(13)),
            sale(5, 20, timestamp="2024-01-02T00:10:00+00:00")]
    got = {(r.event_date.day, r.event_hour): (r.prev_hour_revenue, r.revenue_change_pct) for r in gold.hourly_trend(silver_of(spark, rows)).collect()}
    assert got == {(1, 8): (None, None), (1, 11): (10.0, -100.0), (1, 12): (0.0, None), (1, 13): (5.0, 300.0), (2, 0): (None, None)}
    spikes = gold.hourly_spikes(gold.hourly_trend(silver_of(spark, rows)), 100.0)
    assert {(r.event_hour, r.direction) for r in spikes.collect()} == {(11, "down"), (13, "up")}


def test_hourly_counts_invalid_sales_unless_told_otherwise(spark):
    df = silver_of(spark, [sale(1, 10), sale(2, -4)])
    assert gold.hourly_trend(df).first().hourly_revenue == 6.0
    assert gold.hourly_trend(df, valid_only=True).first().hourly_revenue == 10.0


def test_rank_ties_at_the_edge_stay(spark):
    def with_item(n, sku, total):
        return sale(n, items=f'[{{"sku":"{sku}","quantity":1,"unit_price":1,"line_total":{total}}}]')
    rows = [with_item(1, "A", 5), with_item(2, "B", 3), with_item(3, "C", 3), with_item(4, "D", 1)]
    got = {r.sku: r.revenue_rank for r in gold.top_products(silver_of(spark, rows), top_n=2).collect()}
    assert got == {"A": 1, "B": 2, "C": 2}


INV = "event_id string, event_ts timestamp, store_id string, sku string, quantity_on_hand int, reorder_point int, below_reorder boolean, location string"


def stock(spark, rows):
    t = datetime(2024, 1, 1)
    return spark.createDataFrame([(f"i{n}", t, "S", f"sku{n}", q, p, None if p is None else q <= p, "A1")
                                  for n, (q, p) in enumerate(rows)], INV)


def test_urgency_and_days_of_stock(spark):
    snap = gold.inventory_snapshot(stock(spark, [(0, 10), (2, 10), (3, 10), (11, 10), (5, None), (-1, 10)]))
    days = {r.sku: r.days_of_stock_remaining for r in snap.collect()}
    assert days == {"sku0": 0.0, "sku1": 0.2, "sku2": 0.3, "sku3": 1.1, "sku4": 0.5, "sku5": 0.0}
    alerts = [(r.sku, r.urgency) for r in gold.low_stock_alerts(snap).collect()]
    assert alerts == [("sku0", "CRITICAL"), ("sku5", "HIGH"), ("sku1", "HIGH"), ("sku2", "MEDIUM")]
    assert [r.sku for r in gold.critical_stock(gold.low_stock_alerts(snap)).collect()] == ["sku0"]


def test_snapshot_has_one_row_per_store_and_sku(spark):
    t = datetime(2024, 1, 1)
    rows = [("i1", t, "S", "A", 1, None, None, "x"), ("i2", t, "S", "A", 2, None, None, "x"), ("i3", None, "S", "A", 3, None, None, "x")]
    assert [r.quantity_on_hand for r in gold.inventory_snapshot(spark.createDataFrame(rows, INV)).collect()] == [2]


@pytest.mark.parametrize("source", ["pos", "inventory", "ecommerce"])
def test_empty_input(spark, source):
    empty = spark.createDataFrame([], BRONZE[source])
    table = silver.build_silver(empty, source)
    assert table.count() == 0
    if source == "pos":
        assert gold.daily_sales(table).count() == gold.hourly_trend(table).count() == gold.top_products(table).count() == 0
