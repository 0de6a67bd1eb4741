"""Queries of the catalog against DuckDB; the whole catalog is compared by the driver at a larger size."""

import pytest
from conftest import SF
from pyspark.sql import functions as F

from ledgerloom.operators import checks, star, variance
from ledgerloom.operators.numbering import numbered
from ledgerloom.plans import catalog

NAMES = [
    "mart_marketplace_summary", "mart_channel_performance", "mart_product_performance", "mart_inventory_action", "mart_fulfillment", "variance_periods", "variance_product", "variance_driver_summary",
    "row_metrics", "row_actions", "join_product_match", "contract_violations_by_code", "privacy_pattern_counts", "variance_narrative", "bi_measures_by_marketplace", "sku_overlap",
    *catalog.STAR, *catalog.OPERATIONS,
]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(same, name):
    query = catalog.QUERIES[name]
    same(query.run, query.oracle)


def test_every_query_has_sql():
    assert all(q.oracle for q in catalog.QUERIES.values())


def test_filters_are_pushed_down_and_sorts_have_no_limit(spark):
    plan = lambda name: catalog.QUERIES[name].run(spark, SF)._jdf.queryExecution().executedPlan().toString()
    pushed = plan("filtered_products").split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "In(marketplace, [Amazon,Meesho])" in pushed and "category_group" in pushed
    assert "CollectLimit" not in plan("dash_candidates_weak")


def test_sorted_reports_are_sorted(spark):
    rows = catalog.QUERIES["sql_05_inventory_actions"].run(spark, SF).select("action_priority", "units_index").collect()
    assert rows == sorted(rows, key=lambda r: (r[0], -r[1])) and {r[0] for r in rows} >= {"High", "Low"}
    rows = catalog.QUERIES["sql_06_action_queue"].run(spark, SF).select("action_priority", "sales_index", "units_index").collect()
    assert rows == sorted(rows, key=lambda r: (["High", "Medium", "Low"].index(r[0]), -r[1], -r[2]))


def test_numbers_without_one_task(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).cast("string").alias("x"))
    got = {r.x: r.k for r in numbered(df, ["x"], "k").collect()}
    assert got == {x: k + 1 for k, x in enumerate(sorted(str(i) for i in range(1000)))}


def test_star_refuses_orphans_repeats_and_private_columns(spark):
    tables = dict(star.load(spark, SF))
    broken = tables | {"fact_inventory_action": tables["fact_inventory_action"].withColumn("product_key", F.when(F.col("fact_key") == 1, -5).otherwise(F.col("product_key")))}
    assert {(r.fact, r.fact_column): r.orphans for r in star.orphans(broken).collect()}["fact_inventory_action", "product_key"] == 1
    with pytest.raises(ValueError, match="no member"):
        star.assert_foreign_keys(broken)
    with pytest.raises(ValueError, match="not unique"):
        star.assert_unique(tables | {"dim_month": tables["dim_month"].union(tables["dim_month"])})
    with pytest.raises(ValueError, match="private"):
        star.dim_product(tables["product_performance"].withColumn("sku", F.lit("x")))


def test_privacy_counts_occurrences(spark):
    df = spark.createDataFrame([("b012345678 B0ABCDEF12", "ORD-12345", 560001), ("560001, 560002 rs. 5", "JIO-9999 x", 560002), ("one two three four five", None, None)], "notes string, other string, n int")
    got = {(r.column_name, r.pattern): r.hits for r in checks.pattern_counts(df, ["notes", "other", "n"]).collect() if r.hits}
    assert got == {("notes", "asin_like_values"): 2, ("notes", "postal_code_like_values"): 2, ("notes", "currency_marker_values"): 1, ("other", "order_id_like_values"): 2}


def test_excluded_message():
    assert variance.excluded_message([]) == ""
    assert variance.excluded_message(["2024-02"]) == "2024-02 was excluded from period comparison because it contains no transaction activity."
    assert variance.excluded_message(["a", "b", "c"]).startswith("a, b and c were excluded")
