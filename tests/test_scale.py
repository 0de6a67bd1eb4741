"""What keeps disk and work small on large tables, on small ones."""

import glob
import os
import time
from collections.abc import Mapping

from pyspark.sql import functions as F

from ledgerloom.operators import kernel, master, privacy, star
from ledgerloom.sources import staging


class Named(Mapping):
    """Tables by name; notes which were asked for."""

    def __init__(self, spark):
        self.spark, self.asked = spark, []

    def __getitem__(self, name):
        self.asked.append(name)
        return self.spark.range(1).withColumnRenamed("id", "SKU" if name == "fact_b" else "x")

    def __iter__(self):
        return iter(["product_performance", "dim_a", "audit_validation", "fact_b"])

    def __len__(self):
        return 4


def test_forbidden_columns_ask_for_dimensions_and_facts_alone(spark):
    tables = Named(spark)
    assert [tuple(r) for r in star.forbidden_columns(tables).collect()] == [("fact_b", "SKU")]
    assert tables.asked == ["dim_a", "fact_b"]


def test_scan_of_columns_together_counts_the_same(spark):
    rows = [("P0001", "Amazon", "B0ABCDEFG1", 560001, 1e-9), ("P0001", "Amazon", "ORDER-1234", 560001, float("nan")), ("P0001", None, "a b c d e", None, 2.5)] * 3
    df = spark.createDataFrame(rows, "public_product_id string, marketplace string, remark string, number int, share double")
    known = spark.createDataFrame([("P0001",), ("560001",)], "value string")
    plain, grouped = (privacy.scan({"x": df}, known, together=t).drop("is_safe").first().asDict() for t in ({}, {"x": [("public_product_id", "marketplace"), ("remark", "absent")]}))
    assert plain == grouped and plain["known_private_identifier_values"] == 9 and plain["asin_like_values"] == 3 and plain["order_id_like_values"] == 3 and plain["long_title_like_values"] == 3
    assert privacy._cells(df.select("number", "share"), "x").count() == 0


def test_lines_without_sku_are_dealt_over_tasks(spark):
    was = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for k, v in zip(was, ("false", "-1", "4"), strict=True):
        spark.conf.set(k, v)
    try:
        lines = spark.range(401).select(F.when(F.col("id") == 400, "SKU-1").alias("sku"), F.col("id").cast("string").alias("order_id"), F.lit(1).cast("decimal(18,2)").alias("gross"), *[F.lit(0).cast("decimal(18,4)").alias(c) for c in ("units", "fee", "promo", "refund")])
        sheet = spark.createDataFrame([("SKU-1", 1, "P0001", "b", "c", "s", "g", 1.0, 1, "High", None, "India", "No")], "seller_sku string, src_row long, public_product_id string, brand string, category string, subcategory string, product_group string, price double, quantity int, restock_priority string, landed_cost decimal(18,4), origin_country string, imported_flag string")
        got = master.matched(lines, sheet)
        assert got.where("mapping_status = 'Non-product'").count() == 400
        bare = got.groupBy(F.spark_partition_id().alias("task")).agg(F.count_if(F.col("mapping_status") == "Non-product").alias("n")).where("n > 0")
        assert bare.count() == 4
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_groups_made_in_slices_are_the_same(spark):
    rows = [(f"P{k % 7}", f"o{k % 5}", "Order" if k % 3 else "Refund", k + 1) for k in range(60)]
    df = spark.createDataFrame(rows, "public_product_id string, order_id string, transaction_type_group string, n int").select("*", *[F.col("n").cast("decimal(18,4)").alias(c) for c in ("gross", "units", "fee", "refund", "promo", "net", "profit")], *[F.col("n").cast("double").alias(c) for c in ("margin_risk_score", "revenue_quality_score")])
    whole, parts = kernel.aggregate(df, ["public_product_id"]), kernel.aggregate(df, ["public_product_id"], (), 3)
    assert set(whole.columns) - set(parts.columns) == {"product_count", "order_count", "order_count_index"}
    assert sorted(map(tuple, whole.select(*parts.columns).collect())) == sorted(map(tuple, parts.collect())) and parts.count() == 7


def test_steps_of_a_kept_table_go_and_so_do_its_shuffles(spark, tmp_path):
    steps = []

    def build():
        steps.append(staging.staged(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "step"))
        return steps[0].groupBy("k").agg(F.sum("count").alias("n"))

    local = os.path.dirname(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    shuffles = lambda: set(glob.glob(f"{local}/**/shuffle_*.data", recursive=True))
    before, folder = shuffles(), str(tmp_path)
    assert staging.cached(spark, folder, "kept", (), build).count() == 7
    fs, at = staging.hadoop_path(spark, steps[0]._staged_at)
    assert not fs.exists(at)
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert len(shuffles() - before) <= 1  # of the count here
