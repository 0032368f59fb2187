"""What keeps the cost of an event from growing with the plan around it: texts made once, parsed once, by all cores."""

import datetime
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillflow.functions import documents as D
from tillflow.plans.catalogue import QUERIES
from tillflow.sources import readers, retail_inputs as inputs, writers
from tillflow.streaming import envelope, landing


@pytest.fixture
def tables(spark, tmp_path):
    """Events in one file of one row group."""
    start = datetime.datetime(2024, 1, 1)
    rows = [(i, start + datetime.timedelta(minutes=7 * i), i % 50, ("view", "signup", "error", "purchase")[i % 4], i / 4, '{"k": %d}' % (i % 100)) for i in range(2000)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").coalesce(1).write.parquet(
        f"{tmp_path}/events.parquet")
    return str(tmp_path)


def filters(df):
    return [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter " in line]


def test_filters_do_not_make_the_message_again(spark, tables):
    found = filters(QUERIES["dlq_route"](spark, tables))
    assert found and not any("to_json" in line or "StructsToJson" in line for line in found)


def test_copies_of_one_row_group_are_made_by_many_tasks(spark, tables):
    for made in (inputs.envelope, inputs.late_envelope):
        rows = made(spark, tables, "pos")
        assert rows.count() == 2200
        assert rows.select(F.spark_partition_id()).distinct().count() > 1


def test_the_event_is_not_parsed_inside_another(spark):
    df = spark.createDataFrame([("{}",)], "text string").select(D.event_variant(F.col("text")).alias("v"))
    assert "variant_get" not in df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("text,expected", [
    ('{"a":1}', '{"a":1}'), (' \n{"a":{"b":[1,null]}} ', '{"a":{"b":[1,null]}}'), ('{"a":1} rest', None), ('{"a":1}]', None), ('{"a":1}}', None),
    ('{"a":1},{"a":2}', None), ('{"a":1},"b":2', None), ('{"a":', None), ("[1]", None), ("1", None), ("", None), (None, None),
    ('{"a":1,"b":2,"a":3}', '{"a":3,"b":2}'), ('{"a":{"b":1,"b":2}}', None)])
def test_exactly_one_object_is_an_event(spark, text, expected):
    row = spark.createDataFrame([(text,)], "text string").select(D.event_variant(F.col("text")).cast("string").alias("v")).first()
    assert row.v == expected


def test_raw_rows_of_one_row_group_are_made_by_many_tasks(spark, tables):
    for made in inputs.RAW_INPUTS.values():
        rows = made(spark, tables)
        assert rows.count() == 2200
        assert rows.select(F.spark_partition_id()).distinct().count() > 1


def test_events_are_dealt_before_they_are_parsed(spark, tables):
    lines = inputs.late_envelope(spark, tables, "pos")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    dealt = next(i for i, line in enumerate(lines) if "Repartition" in line)
    assert any("get_json_object" in line for line in lines[:dealt]) and not any("get_json_object" in line for line in lines[dealt:])


def test_one_look_tells_exactly_one_value(spark):
    df = spark.createDataFrame([("{}",)], "text string").select(D.is_whole_json(F.col("text")).alias("whole"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("jsonObjectKeys") == 1 and "lengthOfJsonArray" not in plan


@pytest.mark.parametrize("text,expected", [
    ('{"a":1},"w":0} rest', False), ('{"a":1},"v":1', False), ('{"a":1},2]', False), ('{"a":1}],[{"b":1}', False), ("1,2", False), ("1", True), ("[1,2]", True),
    (' {"v":{"v":1}} ', True), (" ", False), (None, False)])
def test_what_closes_the_test_itself_is_no_value(spark, text, expected):
    assert spark.createDataFrame([(text,)], "text string").select(D.is_whole_json(F.col("text")).alias("whole")).first().whole is expected


def columns_of(path):
    files = glob.glob(f"{path}/**/*.parquet", recursive=True)
    return {column.path for f in files for column in pq.ParquetFile(f).schema if column.path.startswith("_event.")}


def test_layers_keep_the_event_as_one_value(spark, tables, tmp_path):
    inputs.envelope(spark, tables, "pos").write.parquet(f"{tmp_path}/topics")
    before = spark.conf.get("spark.sql.variant.inferShreddingSchema")
    landing.land_raw(envelope.read_files(spark, f"{tmp_path}/topics"), str(tmp_path), f"{tmp_path}/_checkpoint", once=True).awaitTermination()
    rows = readers.read_raw(spark, f"{tmp_path}/raw", "pos")
    writers.write_table(rows, f"{tmp_path}/bronze", "overwrite", ["store_id"])
    for path in ("raw", "bronze"):
        assert columns_of(f"{tmp_path}/{path}") == {"_event.value", "_event.metadata"}
    assert rows.where(F.try_variant_get("_event", "$.event_id", "string") == F.col("event_id")).count() == rows.count() > 0
    assert spark.conf.get("spark.sql.variant.inferShreddingSchema") == before


def test_the_lag_counts_events_of_any_id(spark, tmp_path):
    """Ids beyond a million are events like others; every event is one message of each topic."""
    day, high = datetime.datetime(2024, 1, 5), 1_000_000
    ids = [(0, 0), (12, 25), (high + 1, 0), (high + 40, 25), (3 * high + 1, 25)]
    rows = [(n, day + datetime.timedelta(days=later), 7, "view", 1.0, '{"k": 3}') for n, later in ids]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.topic: (r.total_lag, r.partitions) for r in QUERIES["lag_from_progress"](spark, str(tmp_path)).collect()}
    expected = {}
    for topic, width in (("retail.pos.events", 12), ("retail.inventory.events", 6), ("retail.ecommerce.events", 8)):
        last, read = {}, {}
        for n, later in ids:
            last[n % width] = max(last.get(n % width, 0), n + 1)
            if later < 15:
                read[n % width] = max(read.get(n % width, 0), n + 1)
        expected[topic] = (sum(end - read.get(p, 0) for p, end in last.items()), len(last))
    assert got == expected
