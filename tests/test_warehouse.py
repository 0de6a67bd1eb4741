"""Reload in place, rollback, retry, history, layers and staged tables that follow their inputs."""

import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import lakehouse, warehouse
from ledgerloom.sources import staging, tables


def small(spark, month="2024-01"):
    """A star of a few rows."""
    dims = {
        "dim_product": spark.createDataFrame([(0, "Unknown"), (1, "P0001")], "product_key int, public_product_id string"),
        "dim_marketplace": spark.createDataFrame([(0, "Unknown", "Marketplace"), (1, " Amazon ", "Marketplace")], "marketplace_key int, marketplace string, channel string"),
        "dim_month": spark.createDataFrame([(0, "Unknown"), (1, month)], "month_key int, transaction_month string"),
        "dim_fulfillment": spark.createDataFrame([(0, "Unknown")], "fulfillment_key int, fulfillment_type string"),
    }
    for c in lakehouse.star.ATTRIBUTES:
        dims["dim_product"] = dims["dim_product"].withColumn(c, F.lit("x"))
    one = spark.range(1)
    fact = lambda keys, values: one.select(F.lit(1).alias("fact_key"), *[F.lit(1).alias(k) for k in keys], *[F.lit("High" if v == "action_priority" else 7).alias(v) for v in values])
    s = lakehouse.star
    facts = {
        "fact_marketplace_activity": fact(["month_key", "marketplace_key"], s.ACTIVITY).withColumn("sales_index", F.lit(float("nan"))), "fact_product_performance": fact(["product_key", "marketplace_key"], [*s.PERFORMANCE, "dataset_period"]),
        "fact_inventory_action": fact(["product_key", "marketplace_key"], s.INVENTORY), "fact_performance_variance": fact(["marketplace_key", "metric", "previous_month_key", "current_month_key"], s.DRIVERS),
    }
    audits = {
        "audit_validation": spark.createDataFrame([(1, "a", "FAIL", "0", "> 0", ""), (2, "b", "WARN", "0", "", "")], "audit_key int, check_name string, check_status string, check_value string, expected_value string, notes string"),
        "audit_dataset_profile": spark.createDataFrame([(1, "o", 3)], "audit_key int, public_output_name string, row_count long"),
    }
    return dims | facts | audits


def test_reload_keeps_the_old_version_when_it_fails(spark, tmp_path):
    root = str(tmp_path / "w")
    with pytest.raises(warehouse.LoadError, match="nothing"):
        warehouse.read(spark, root)
    first = warehouse.load(spark, small(spark), root)
    opened = warehouse.read(spark, root)
    assert [t["table"] for t in first["tables"]] == list(warehouse.LOAD_ORDER) and first["before"] is None
    assert opened["fact_marketplace_activity"].first().sales_index is None  # NaN is no value
    # an orphan, a repeated natural key, a table that can't be read: each leaves the first version
    orphan = small(spark) | {"fact_inventory_action": small(spark)["fact_inventory_action"].withColumn("product_key", F.lit(9))}
    repeated = small(spark) | {"dim_month": small(spark)["dim_month"].union(small(spark)["dim_month"])}
    broken = small(spark) | {"fact_product_performance": small(spark)["fact_product_performance"].withColumn("dataset_period", F.expr("raise_error('lost')").cast("string"))}
    for bad, said in ((orphan, "no member"), (repeated, "not unique"), (broken, "2 attempts")):
        with pytest.raises(warehouse.LoadError, match=said):
            warehouse.load(spark, bad, root)
        assert warehouse.current(spark, root)["version"] == first["version"] and os.listdir(f"{root}/versions") == [first["version"]]
    assert warehouse.read(spark, root)["dim_month"].count() == 2
    # an equal reload is another version with the same rows; what was open stays open until it is cleaned
    second = warehouse.load(spark, small(spark), root)
    assert second["before"] == first["version"] and [t["rows"] for t in second["tables"]] == [t["rows"] for t in first["tables"]]
    assert opened["dim_month"].count() == 2 and warehouse.cleaned(spark, root, 1) == [first["version"]]
    assert {r.status for r in warehouse.load_report(spark, small(spark), root).collect()} == {"OK"}
    assert warehouse.read(spark, root)["fact_inventory_action"].count() == 1 and not [f for f in os.listdir(root) if f.startswith(".next")]


def test_a_write_that_fails_once_is_tried_again(spark, tmp_path):
    flag = tmp_path / "tried"

    def flaky(batches):
        if not flag.exists():
            flag.write_text("")
            raise OSError("lost")
        yield from batches

    df = spark.range(5).mapInArrow(flaky, "id long")
    assert warehouse.write_counted(df, str(tmp_path / "t")) == 5 and flag.exists()


def test_newest_load_of_the_history(spark, tmp_path):
    root = str(tmp_path)
    warehouse.append_history(small(spark)["audit_validation"].where("check_name = 'b'"), root, "audit_validation", "2024-01-01")
    assert warehouse.failing(spark, root).isEmpty()  # a WARN is no failure
    for _ in range(2):  # the same load again adds nothing
        warehouse.append_history(small(spark)["audit_validation"], root, "audit_validation", "2024-02-01")
    assert [(r.check_name, r.load_timestamp) for r in warehouse.failing(spark, root).collect()] == [("a", "2024-02-01")]
    assert warehouse.history(spark, root, "audit_validation").count() == 3
    plan = warehouse.latest(spark, root, "audit_validation")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_timestamp" in plan


def test_layers_set_aside_what_has_no_key(spark, tmp_path):
    folder = str(tmp_path)
    got = {r.check_name: (r.result, r.measured) for r in lakehouse.checked(spark, small(spark), folder).collect()}
    assert len(got) == 14 and {x[0] for x in got.values()} == {"PASS"} and got["business_metric_total_orders"][1] == 7 and got["table_format_validation"][1] == 25
    assert [r.marketplace for r in spark.read.parquet(f"{folder}/gold/gold_marketplace_performance").collect()] == ["Amazon"]
    tables = small(spark)
    extra = spark.createDataFrame([(None, "Lost", "Marketplace"), (1, "Other", "Marketplace"), (1, "Amazon", "Marketplace")], "marketplace_key int, marketplace string, channel string")
    tables["dim_marketplace"] = tables["dim_marketplace"].unionByName(extra)
    got = {r.check_name: (r.result, r.measured) for r in lakehouse.checked(spark, tables, folder).collect()}
    assert got["null_key_validation"] == ("FAIL", 1) and got["duplicate_key_validation"] == ("FAIL", 2) and got["row_count_conformance_bronze_to_silver"] == ("FAIL", 1)
    aside = spark.read.parquet(f"{folder}/silver_rejected/dim_marketplace").collect()
    assert sorted((r.marketplace, r.reason) for r in aside) == [("Amazon", "repeated key"), ("Lost", "null key"), ("Other", "repeated key")]


def test_staged_tables_follow_their_inputs(spark, tmp_path):
    folder, calls = str(tmp_path), []
    write = lambda n: spark.range(n).write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")

    def build():
        calls.append(1)
        return spark.read.parquet(f"{folder}/lineitem.parquet")

    get = lambda at=folder: staging.cached(spark, at, "t", ["lineitem", "absent"], build)
    write(3)
    first = get()
    assert get().count() == first.count() == 3 and len(calls) == 1
    time.sleep(0.01)
    write(5)
    assert get().count() == 5 and len(calls) == 2 and not os.path.exists(first._staged_at)
    last = get()
    for k in range(staging.FOLDERS):  # a folder that was not asked for lately goes
        get(f"{folder}/../{tmp_path.name}/{'./' * (k + 1)}")
    assert not os.path.exists(last._staged_at) and get().count() == 5


def test_row_numbers_over_files_and_splits(spark, tmp_path):
    for k in range(3):
        spark.range(k * 100, k * 100 + 40 + k).coalesce(1).write.parquet(f"{tmp_path}/x/part={k}")
    got = tables.with_row_numbers(spark.read.parquet(f"{tmp_path}/x")).orderBy("row_number").select("row_number", "id").collect()
    assert [r.row_number for r in got] == list(range(123)) and [r.id for r in got] == [k * 100 + i for k in range(3) for i in range(40 + k)]
