"""Contracts, rules, reports, gates, file drops and intake on hand-written events."""

import json
from copy import deepcopy

import pytest
from pyspark.sql import functions as F

from tillflow.functions import documents as D
from tillflow.operators import quality
from tillflow.operators.contract import STRICT, check_contract, open_text
from tillflow.operators.rules import price_consistency, rules_for, rules_text
from tillflow.schemas import RAW
from tillflow.plans import drops
from tillflow.sources import inventory, readers

GOOD = {"event_id": "e", "event_type": "sale", "store_id": "S", "terminal_id": "T", "timestamp": "2024-01-01T00:00:00+00:00",
        "transaction_id": "t", "items": [{"sku": "A", "quantity": 1, "unit_price": 2.5, "line_total": 2.5}],
        "payment": {"method": "cash", "amount_tendered": 3}, "totals": {"subtotal": 2.5, "tax": 0, "total": 2.5}}


def changed(**over):
    event = deepcopy(GOOD)
    for path, value in over.items():
        owner, keys = event, path.split("__")
        for key in keys[:-1]:
            owner = owner[int(key) if key.isdigit() else key]
        if value is KeyError:
            owner.pop(keys[-1])
        else:
            owner[keys[-1]] = value
    return json.dumps(event)


def violations(spark, text, source="pos", mode="lenient", formats=False):
    df = spark.createDataFrame([(text,)], "value string")
    return check_contract(df, "value", source, mode, formats).first().violations


CASES = [
    (changed(), []),
    (changed(store_id=KeyError), ["missing:store_id"]),
    (changed(store_id=None), ["missing:store_id"]),
    (changed(store_id=5), ["type:store_id"]),
    (changed(event_type="gift"), ["enum:event_type"]),
    (changed(cashier_id=None), []),
    (changed(items=[]), ["min_items:items"]),
    (changed(items=None), ["missing:items"]),
    (changed(items="{bad"), ["type:items"]),
    (changed(items={"sku": "A"}), ["type:items"]),
    (changed(items=[1]), ["type:items[]"]),
    (changed(items=[None, GOOD["items"][0]]), ["type:items[]"]),
    (changed(items__0__quantity=0), ["minimum:items[].quantity"]),
    (changed(items__0__quantity=1.0), []),
    (changed(items__0__quantity=1.5), ["type:items[].quantity"]),
    (changed(items__0__quantity=True), ["type:items[].quantity"]),
    (changed(items__0__quantity="1"), ["type:items[].quantity"]),
    (changed(items__0__sku=KeyError), ["missing:items[].sku"]),
    (changed(items__0__discount=-1), ["minimum:items[].discount"]),
    (changed(items__0__discount=None), []),
    (changed(totals=KeyError), ["missing:totals"]),
    (changed(totals=[]), ["type:totals"]),
    (changed(totals__total=KeyError), ["missing:totals.total"]),
    (changed(totals__total="7"), ["type:totals.total"]),
    (changed(payment__card_last_four=1234), ["type:payment.card_last_four"]),
    (changed(metadata=[]), ["type:metadata"]),
    (changed(timestamp="soon"), []),
    ("[1]", ["type:$"]),
    ("7", ["type:$"]),
    ('{"event_id":', ["type:$"]),
    (changed() + " trailing", ["type:$"]),
    (changed() + "] [{}", ["type:$"]),
    (None, ["type:$"]),
]


def test_contract_cases(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "i int, value string")
    got = {r.i: r.violations for r in check_contract(df, "value", "pos").collect()}
    assert {i: (CASES[i][0], v) for i, v in got.items()} == {i: case for i, case in enumerate(CASES)}


def test_strict_mode_and_formats(spark):
    assert violations(spark, changed(cashier_id=None), mode=STRICT) == ["type:cashier_id"]
    assert violations(spark, changed(store_id=None), mode=STRICT) == ["type:store_id"]
    assert violations(spark, changed(timestamp="soon"), formats=True) == ["bad_timestamp:timestamp"]
    event = {"event_id": "e", "event_type": "search", "session_id": "s", "customer_id": "c", "timestamp": "t", "sku": None, "order": None}
    assert violations(spark, json.dumps(event), "ecommerce", STRICT) == []
    assert violations(spark, json.dumps({**event, "order": {"total": "x"}}), "ecommerce") == ["type:order.total"]
    with pytest.raises(ValueError):
        violations(spark, changed(), mode="loose")


def broken(spark, text, source="pos"):
    opened = open_text(spark.createDataFrame([(text,)], "value string"), "value", source)
    return opened.df.select(rules_text(rules_for(source, opened))).first()[0]


@pytest.mark.parametrize("text, names", [
    (changed(), ""),
    (changed(totals=KeyError), ""),
    (changed(totals="x"), "total_amount_positive;reasonable_total"),
    (changed(totals__total=0), ""),
    (changed(totals__total=-0.01), "total_amount_positive"),
    (changed(totals__total=99_999.99), ""),
    (changed(totals__total=100_000), "reasonable_total"),
    (changed(items=KeyError), "has_items"),
    (changed(items=[]), "has_items"),
    (changed(payment=KeyError), "valid_payment_method"),
    (changed(store_id=" \t"), "store_id_not_empty"),
])
def test_pos_rules(spark, text, names):
    assert broken(spark, text) == names


def test_inventory_rules(spark):
    event = {"event_type": "restock", "sku": "A", "store_id": "S"}
    assert broken(spark, json.dumps(event), "inventory") == ""
    assert broken(spark, json.dumps({**event, "quantity_on_hand": -1, "sku": " ", "event_type": "x"}), "inventory") == \
        "quantity_on_hand_nonneg;sku_not_empty;valid_event_type"


def test_rows_and_documents_agree(spark):
    """The contract of a raw row equals that of the JSON it was landed from, but for text that is no JSON object and not landed."""
    from tillflow.streaming.envelope import decode, events_of
    texts = [t for t, _ in CASES if t is not None] + ['{"store_id":"S","store_id":5}', '{"payment":{"method":"cash","method":"cash"}}']
    df = spark.createDataFrame([(t.encode(), "retail.pos.events", 0, i) for i, t in enumerate(texts)],
                               "value binary, topic string, partition int, offset bigint")
    decoded = decode(df)
    rows = {r._kafka_offset: r.errors for r in quality.annotate_bronze(events_of(decoded, "pos"), "pos").collect()}
    docs = {r.offset: r.errors for r in quality.annotate(decoded.where("is_event"), "pos", "text").collect()}
    assert rows == docs and len(rows) > 20


def test_extra_rules_can_be_passed(spark):
    df = spark.createDataFrame([(changed(),)], "value string")
    got = quality.annotate(df, "pos", "value", more_rules=lambda o: [("cash_only", o.part("payment.method", "text") != "cash")])
    assert got.first().errors == ["business_rule: cash_only"]


def errors_frame(spark, good, bad):
    rows = [("a", [])] * good + [(None, ["x", "y"])] * bad
    return spark.createDataFrame(rows, "event_id string, errors array<string>")


def test_report_threshold_and_empty(spark):
    assert quality.report(errors_frame(spark, 95, 5), "pos").first().passed
    assert not quality.report(errors_frame(spark, 94, 5), "pos").first().passed
    empty = quality.report(errors_frame(spark, 0, 0), "pos").first()
    assert (empty.total_records, empty.pass_rate, empty.passed) == (0, 0.0, False)


def test_samples_breakdown_and_gate(spark):
    frame = errors_frame(spark, 3, 2)
    assert [(r.event_id, r.errors) for r in quality.error_samples(frame, 1).collect()] == [("unknown", "x; y")]
    assert {(r.error, r.records) for r in quality.error_breakdown(frame).collect()} == {("x", 2), ("y", 2)}
    good, bad = quality.report(errors_frame(spark, 1, 0), "a"), quality.report(frame, "b")
    assert quality.gate([good]).first().branch == "validation_passed"
    assert quality.gate([good, bad]).first().branch == "quarantine_alert"


def drop_records(spark, *rows):
    lines = [(f, json.dumps({k: v for k, v in zip(("sku", "store_id", "quantity_on_hand"), more) if v is not None})) for f, *more in rows]
    return spark.createDataFrame(lines, "file string, text string").select("file", F.parse_json("text").alias("record"))


def test_file_gate(spark):
    records = drop_records(spark, *[("f80", "A", "S", 0)] * 4, ("f80", "A", "S", " "), ("f50", "A", "S", 1), ("f50", None, "S", 1))
    manifest = spark.createDataFrame([("f80",), ("f50",), ("gone",)], "file string")
    verdicts = quality.file_gate(records, manifest=manifest)
    assert {r.file: (r.verdict, r.reason) for r in verdicts.collect()} == {
        "f80": ("accept", None), "f50": ("reject", "low_pass_rate_50pct"), "gone": ("skip", "empty_or_missing")}
    assert quality.accepted_records(records, verdicts).count() == 5
    assert [r.file for r in quality.rejected_files(verdicts).collect()] == ["f50"]


def write_drops(spark, folder):
    (folder / "lines.json").write_text('{"sku":"A","store_id":"S","quantity_on_hand":0,"more":{"x":[1]}}\n{broken\n\n')
    (folder / "array.json").write_text('[{"sku":"B","store_id":"S","quantity_on_hand":1},\n {"sku":"C","store_id":"S","quantity_on_hand":2.5}]')
    (folder / "pretty.json").write_text('{\n "sku": "D",\n "store_id": "S",\n "quantity_on_hand": 3\n}\n')
    (folder / "broken.json").write_text("[{")
    (folder / "empty.json").write_text("")
    (folder / "a.csv").write_text('sku,store_id,quantity_on_hand\nE,S,4\n')
    (folder / "b.csv").write_text('note,quantity_on_hand,store_id,sku\n"two\nlines, quoted",5,S,F\n,6,S,G\n')
    (folder / "low.csv").write_text("sku,store_id,quantity_on_hand\nH,S,\nI,S,7\n")
    (folder / "c.txt").write_text("J")
    (folder / "bad.parquet").write_text("PAR?")
    for name, kind in (("int", "int"), ("long", "bigint")):
        rows = spark.createDataFrame([(f"K{kind}", "S", 8, 1.5)], f"sku string, store_id string, quantity_on_hand {kind}, extra double")
        rows.coalesce(1).write.parquet(str(folder / name))


def test_drops_of_every_shape_are_judged_and_staged_once(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "lake")
    folder.mkdir()
    write_drops(spark, folder)
    done = drops.run_drops(spark, root, str(folder))
    verdicts = {r.file.rsplit("/", 1)[-1]: (r.verdict, r.reason) for r in drops.read_verdicts(spark, root).collect() if "/int/" not in r.file and "/long/" not in r.file}
    assert verdicts == {
        "lines.json": ("reject", "low_pass_rate_50pct"), "array.json": ("accept", None), "pretty.json": ("accept", None), "broken.json": ("skip", "no_records"),
        "empty.json": ("skip", "empty_file"), "a.csv": ("accept", None), "b.csv": ("accept", None), "low.csv": ("reject", "low_pass_rate_50pct"),
        "c.txt": ("reject", "unsupported_format"), "bad.parquet": ("skip", "unreadable")}
    staged = drops.read_staged(spark, root).selectExpr("record:sku::string AS sku", "record:quantity_on_hand::string AS q", "record:note::string AS note", "record:extra::double AS extra")
    assert sorted(map(tuple, staged.collect()), key=str) == sorted([
        ("B", "1", None, None), ("C", "2.5", None, None), ("D", "3", None, None), ("E", "4", None, None), ("F", "5", "two\nlines, quoted", None), ("G", "6", None, None),
        ("Kint", "8", None, 1.5), ("Kbigint", "8", None, 1.5)], key=str)
    assert done == {"accept": 6, "reject": 3, "skip": 3, "staged_records": 8}
    rejected = spark.read.schema("file string, reason string").option("recursiveFileLookup", "true").json(f"{root}/rejected/inventory").collect()
    assert sorted(r.reason for r in rejected) == ["low_pass_rate_50pct", "low_pass_rate_50pct", "unsupported_format"]
    # nothing new, then a file more and one that was completed
    assert drops.run_drops(spark, root, str(folder)) == {"accept": 0, "reject": 0, "skip": 0, "staged_records": 0}
    (folder / "new.csv").write_text("sku,store_id,quantity_on_hand\nZ,S,9\n")
    (folder / "empty.json").write_text('{"sku":"Y","store_id":"S","quantity_on_hand":9}')
    assert drops.run_drops(spark, root, str(folder), files_per_load=1) == {"accept": 2, "reject": 0, "skip": 0, "staged_records": 2}
    assert drops.read_staged(spark, root).count() == 10


def test_no_drops(spark, tmp_path):
    assert drops.run_drops(spark, str(tmp_path / "lake"), str(tmp_path / "nowhere")) == {"accept": 0, "reject": 0, "skip": 0, "staged_records": 0}


def test_inventory_lists_every_file(spark, tmp_path):
    (tmp_path / "day=1" / "deep").mkdir(parents=True)
    (tmp_path / "day=1" / "deep" / "none.parquet").write_bytes(b"")
    (tmp_path / "day=1" / "bad.parquet").write_bytes(b"no")
    (tmp_path / "top.csv").write_text("a,b\n1,2\n")
    (tmp_path / "_hidden").mkdir()
    (tmp_path / "_hidden" / "x.csv").write_text("x")
    spark.range(7).coalesce(1).write.parquet(str(tmp_path / "_part=2"))
    rows = {r.file.removeprefix(f"{tmp_path}/"): r for r in inventory.list_files(spark, str(tmp_path), footers=True, heads=True).collect()}
    part = next(n for n in rows if n.startswith("_part=2"))
    assert {n: (r.size_bytes > 0, r.records, (r.problem or "").split(":")[0]) for n, r in rows.items()} == {
        "day=1/deep/none.parquet": (False, None, "empty"), "day=1/bad.parquet": (True, None, "unreadable"), "top.csv": (True, None, ""), part: (True, 7, "")}
    assert rows["top.csv"].shape == "a,b\n1,2\n" and rows[part].shape == "id int64"
    assert inventory.list_files(spark, str(tmp_path), "*.csv").count() == 1 and inventory.list_files(spark, str(tmp_path / "gone")).count() == 0


@pytest.mark.parametrize("text, reason", [
    (changed(), "OK"),
    (changed(store_id=KeyError, totals=KeyError), "Missing required fields: ['store_id', 'totals']"),
    (changed(totals=None), "Missing required fields: ['totals']"),
    (changed(totals={}), "Negative total amount"),
    (changed(totals__total=-1), "Negative total amount"),
    (changed(store_id="  "), "Empty store_id"),
])
def test_intake_reason(spark, text, reason):
    event = spark.createDataFrame([(text,)], "t string").select(F.from_json("t", quality.INTAKE_SCHEMA).alias("e"))
    assert event.select(quality.intake_reason(F.col("e"))).first()[0] == reason


def test_price_tolerance(spark):
    items = "array<struct<sku:string,quantity:int,unit_price:double,discount:double,line_total:double>>"
    rows = [("ok", [("A", 3, 1.0, None, 3.03)]), ("off", [("A", 3, 1.0, 0.5, 1.54)])]
    got = price_consistency(spark.createDataFrame(rows, f"event_id string, items {items}"))
    assert [r.event_id for r in got.collect()] == ["off"]


def test_stringify_nested(spark):
    df = spark.sql("select 1 as a, struct(2 as b) as s, array(1) as l, map('k', 1) as m")
    assert D.stringify_nested(df).first().asDict() == {"a": 1, "s": '{"b":2}', "l": "[1]", "m": '{"k":1}'}


def test_bronze_annotation_of_empty_table(spark):
    assert quality.report(quality.annotate_bronze(spark.createDataFrame([], RAW["pos"]), "pos"), "pos").first().total_records == 0


def test_validate_on_request(spark, tmp_path, capsys):
    from tillflow.__main__ import main
    (tmp_path / "one.json").write_text(changed())
    (tmp_path / "many.json").write_text("[" + changed() + ",\n" + changed(event_id="bad", items=[]) + "]")
    assert main(["validate", "--file", str(tmp_path / "one.json"), "--source", "pos"]) == 0
    assert main(["validate", "--file", str(tmp_path / "many.json"), "--source", "pos"]) == 1
    out = capsys.readouterr().out
    assert "[PASS] pos: 1/1 valid (100.0%)" in out and "[FAIL] pos: 1/2 valid (50.0%)" in out
    assert "bad: schema: min_items:items; business_rule: has_items" in out


def test_validate_parquet(spark, tmp_path):
    from tillflow.plans.validate import validate
    path = str(tmp_path / "rows.parquet")
    spark.createDataFrame([], RAW["ecommerce"]).write.parquet(path)
    assert not validate(spark, path, "ecommerce")
    with pytest.raises(ValueError):
        validate(spark, "x.csv", "pos")
