"""Files, headers, contracts, the workflow and the channel join on small rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import columns, text
from ledgerloom.operators import channels, contracts, workflow
from ledgerloom.sources import files

HEADER = '"date/time","settlement id","type","order id","Sku","quantity","product sales","selling fees","total","Sku"'


def test_csv_under_a_preamble(spark, tmp_path):
    lines = ['"Includes all transactions"', '"All amounts in INR, unless said"', HEADER, '"1 May 2026 10:00:00 am UTC","1","Order","O-1","SKU-1","2","1,000","-100","900","a"', '"x","1","Refund","O-2",,"1","-300","0","-300","b ""q"""']
    (tmp_path / "t.csv").write_text("﻿" + "\n".join(lines), encoding="utf-8")
    df = files.with_preamble(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["date_time", "settlement_id", "type", "order_id", "sku", "quantity", "product_sales", "selling_fees", "total", "sku_1"]
    assert [tuple(r) for r in df.select("order_id", "sku", "product_sales", "sku_1").collect()] == [("O-1", "SKU-1", "1,000", "a"), ("O-2", None, "-300", 'b "q"')]
    (tmp_path / "none.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="no header"):
        files.with_preamble(spark, str(tmp_path / "none.csv"))
    assert set(files.stems(spark, str(tmp_path))) == {"t", "none"}


def test_sinks(spark, tmp_path):
    files.save_outputs({"one": spark.range(3)}, str(tmp_path))
    assert files.stems(spark, str(tmp_path))["one"].count() == 3
    files.save_metrics(spark, {"rows": 3, "label": "x"}, str(tmp_path / "m"))
    assert files.load_metrics(spark, str(tmp_path / "m")) == {"rows": 3, "label": "x"}


def test_names(spark):
    assert columns.normal_names(["Margin %", "A & B", "﻿date/time", "asin", "", None, "sku", "SKU"]) == ["margin_pct", "a_and_b", "date_time", "asin1", "unnamed", "unnamed_1", "sku", "sku_1"]
    df = columns.expected_first(columns.aliased(spark.createDataFrame([(1, "x")], "b int, old string"), {"old": "new", "b": "old"}), ["new", "absent", "b"])
    assert df.columns == ["new", "absent", "b", "old"] and tuple(df.first()) == ("x", None, 1, "x")


def test_amounts_fall_back_for_the_whole_frame(spark):
    rows = spark.createDataFrame([("1,000", 2, "-100", "-80", "5"), ("(50)", -1, "0", "x", "5")], "product_sales string, quantity int, selling_fees string, fba_fees string, unit_cost_private_rs string")
    got = [tuple(r) for r in columns.amounts(rows).select("gross", "units", "fee", "cogs", "profit").collect()]
    assert got == [(1000.0, 2.0, 180.0, 10.0, 810.0), (-50.0, 0.0, 0.0, 0.0, -50.0)]
    given = columns.amounts(rows.withColumn("amazon_fee_private", F.lit(7)).withColumn("estimated_profit_private_rs", F.lit(3)))
    assert {(r.fee, r.profit) for r in given.collect()} == {(7.0, 3.0)}


CONTRACT = """
fields:
  sku: {type: string, required: true, nullable: false, unique: true}
  price: {type: number, required: true, nullable: true, min: 0, max: 1000}
  marketplace: {type: string, allowed_values: [Amazon, Flipkart]}
forbidden_fields: [asin]
validation_severity: {out_of_range: warn, forbidden_field_present: reject}
"""


def test_contracts(spark, tmp_path):
    (tmp_path / "c.yml").write_text(CONTRACT)
    contract = contracts.load(spark, str(tmp_path / "c.yml"))
    (tmp_path / "bad.yml").write_text("a: 1")
    for name in ("bad.yml", "absent.yml"):
        with pytest.raises(contracts.ContractError):
            contracts.load(spark, str(tmp_path / name))
    df = spark.createDataFrame([("a", "5", "Amazon", 1), (None, "5", "Amazon", 2), ("b", "x", "Amazon", 3), ("c", "5000", "Other", 4), ("a", None, " Amazon ", 5), (" ", " ", None, 6)], "sku string, price string, marketplace string, row_number int")
    got = contracts.validate(df, contract, "t.csv", at="2026-01-01T00:00:00Z")
    assert {r.row_number for r in got.accepted.collect()} == {1, 4, 5} and got.accepted.columns == df.columns
    want = {(2, "MISSING_REQUIRED_VALUE", "fields.sku.nullable=false", "reject"), (6, "MISSING_REQUIRED_VALUE", "fields.sku.nullable=false", "reject"), (3, "TYPE_MISMATCH", "fields.price.type=number", "reject")}
    want |= {(4, "OUT_OF_RANGE", "fields.price.range=[0,1000]", "warn"), (4, "UNKNOWN_VALUE", "fields.marketplace.allowed_values", "warn"), (5, "DUPLICATE_KEY", "fields.sku.unique", "warn")}
    assert {(r.row_number, r.error_code, r.validation_rule, r.severity) for r in got.records.collect()} == want and got.records.count() == len(want)
    first = got.records.where("error_code = 'TYPE_MISMATCH'").first()
    assert (first.source_name, first.error_category, first.timestamp) == ("t.csv", "VALIDATION_ERROR", "2026-01-01T00:00:00Z") and "x" not in first.reason.split()
    assert tuple(contracts.totals(got, got).first()) == (12, 6, 6, 6)
    assert {(r.error_code, r.severity): r.row_count for r in contracts.summarized(contracts.combined(got.records, got.records)).collect()}["MISSING_REQUIRED_VALUE", "reject"] == 4
    with pytest.raises(ValueError, match="safe"):
        contracts.combined(got.records.withColumn("cell", F.lit("x")))
    with pytest.raises(contracts.ContractError, match="first"):
        contracts.validate(df.drop("row_number"), contract, "t.csv")
    none = contracts.validate(df.withColumn("asin", F.lit("B0")), contract, "t.csv")
    assert none.accepted.isEmpty() and [(r.error_code, r.row_number) for r in none.records.collect()] == [("FORBIDDEN_FIELD_PRESENT", None)]
    none = contracts.validate(df.where("row_number = 1").drop("price"), contract, "t.csv")
    assert none.accepted.isEmpty() and [r.error_code for r in none.records.collect()] == ["MISSING_REQUIRED_COLUMN"]
    assert contracts.validate(df.limit(0), contract, "t.csv").records.isEmpty()
    assert contracts.validate_outputs({"t": df.where("row_number in (1, 4)")}, {"t": contract, "other": contract}) == {"t": 2}
    with pytest.raises(contracts.ContractError, match="breaks fields.sku"):
        contracts.validate_outputs({"t": df}, {"t": contract})
    with pytest.raises(contracts.ContractError, match="forbidden_fields:asin"):
        contracts.validate_outputs({"t": df.limit(1).withColumn("asin", F.lit(1))}, {"t": contract})


def test_wide_headers_are_refused(spark, tmp_path, monkeypatch):
    (tmp_path / "w.csv").write_text("x\n" + HEADER + "\n")
    monkeypatch.setattr(files, "WIDEST", 10)
    assert len(files.with_preamble(spark, str(tmp_path / "w.csv")).columns) == 10
    monkeypatch.setattr(files, "WIDEST", 9)
    with pytest.raises(ValueError, match="more than 9"):
        files.with_preamble(spark, str(tmp_path / "w.csv"))


def test_declared_contracts():
    assert all("fields" in contracts.declared(n) for n in (*contracts.OUTPUTS, "marketplace_transactions", "product_master", "settlement_export"))
    assert contracts.declared("marketplace_transactions")["fields"]["sku"] == {"type": "string", "required": True, "nullable": True}
    with pytest.raises(contracts.ContractError):
        contracts.declared("absent")


def test_dates(spark):
    given = ["03 Jan 2024 04:05:06 PM UTC", " 2024-02-03 ", "2024-02-03 10:00:00", "2024-02-03T10:00:00Z", "03 Feb 2024", "Feb 3, 2024", "13/13/2024", "soon", "", None]
    df = spark.createDataFrame(list(enumerate(given)), "k int, t string")
    got = {r.k: (r.m, r.bad) for r in df.select("k", text.month(F.col("t")).alias("m"), text.unparsed(F.col("t")).alias("bad")).collect()}
    assert got == {0: ("2024-01", False)} | {k: ("2024-02", False) for k in range(1, 6)} | {6: ("Unknown", True), 7: ("Unknown", True), 8: ("Unknown", False), 9: ("Unknown", False)}
    assert df.where("k = 0").select(F.date_format(text.timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss")).first()[0] == "2024-01-03 16:05:06"
    open_ = spark.createDataFrame([("2024-02-03 10:00:00 IST",), ("2024-02-03",), ("nan",), ("IST",)], "t string")
    assert [r[0] for r in open_.select(text.open_date(F.col("t"))).collect()] == ["2024-02-03", "2024-02-03", None, None]
    counts = spark.createDataFrame([(100_000, 0), (5, 60_000), (30_000, 1), (10_000, None), (9_999, 9)], "a int, b int")
    assert [r[0] for r in counts.select(text.period_of_counts(F.col("a"), F.col("b"))).collect()] == ["12m", "6m", "3m", "1m", "custom_upload"]


def test_workflow(spark, tmp_path):
    queue = spark.createDataFrame([("A", "New"), ("B", "Approved"), ("C", "Closed")], "exception_id string, status string")
    at = datetime.datetime(2026, 5, 1, 10)
    asks = spark.createDataFrame([("A", "Under Review", "p", "r", at), ("B", "New", "p", "r", at), ("C", "Closed", "p", "r", at), ("X", "Closed", "p", "r", at)], "exception_id string, new_status string, reviewer_persona string, reason string, at timestamp")
    after, log = workflow.transitions(queue, asks)
    assert {tuple(r) for r in after.collect()} == {("A", "Under Review"), ("B", "Approved"), ("C", "Closed")}
    assert {r.exception_id: r.error for r in log.collect()} == {"A": None, "B": "transition not allowed", "C": "transition not allowed", "X": "unknown exception"}
    for _ in range(2):
        workflow.append_log(log, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    counts = {r.status: r.exceptions for r in workflow.status_counts(after).collect()}
    assert counts == dict.fromkeys(workflow.STATUSES, 0) | {"Under Review": 1, "Approved": 1, "Closed": 1, "total": 3}
    fresh = spark.createDataFrame([("A",), ("D",)], "exception_id string")
    assert {tuple(r) for r in workflow.refreshed(fresh, after).collect()} == {("A", "Under Review"), ("D", "New")}


def test_channels(spark):
    lines = spark.createDataFrame([("s1", "Amazon", 1), ("s1", "Meesho", 2), (None, None, 3), ("s9", "Amazon", 4)], "sku string, marketplace string, brand int")
    sheet = spark.createDataFrame([("s1", "Amazon", "late", 2, 9), ("s1", "Amazon", "first", 1, 8), (None, None, "none", 3, 7)], "seller_sku string, marketplace string, channel string, n int, brand int")
    got = channels.with_channels(lines, sheet, "n")
    assert {(r.brand, r.channel, r.brand_channel, r.marketplace_channel_match) for r in got.collect()} == {(1, "first", 8, True), (2, None, None, False), (3, "none", 7, True), (4, None, None, False)}
    assert tuple(channels.coverage(got).first()) == (3, 1, pytest.approx(100 / 3))
