"""The privacy gate, filters, measures, the driver report and the channel join on small rows."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import checks, filters, measures, privacy, variance

CELLS = [
    "b012345678 B0ABCDEF12", "xB012345678", "ORD-12345", "web_ab12", "JIO-9999-", "JIO-9999-é", "560001", "5600011", "é560001", "560001é 560002", "₹5", "INR 5", "éINR", "rs. 5", "Rs.x", "RS", "RSS",
    "öl äh üb öd ös", "a b c d", "one two three\x1cfour five", "x_1 y_2 z_3 a b", "", " ",
]
PYTHON = {
    "asin_like_values": re.compile(r"\bB0[A-Z0-9]{8}\b", re.I), "order_id_like_values": re.compile(r"\b(?:ORDER|ORD|AMZ|FLP|MEE|JIO|WEB)[-_]?[A-Z0-9-]{4,}\b", re.I),
    "postal_code_like_values": re.compile(r"\b[1-9][0-9]{5}\b"), "currency_marker_values": re.compile(r"(?:₹|\bINR\b|\bRS\.?\b)", re.I),
}
TITLE = re.compile(r"\w+\s+\w+\s+\w+\s+\w+\s+\w+")


def test_shapes_are_unicode(spark):
    for cell in CELLS:
        got = privacy.shape_counts(spark.createDataFrame([(cell,)], "other string"), "o").first()
        assert {n: got[n] for n in PYTHON} == {n: len(p.findall(cell)) for n, p in PYTHON.items()}, cell
        assert got.long_title_like_values == bool(TITLE.search(cell)), cell


def test_gate(spark):
    products = spark.createDataFrame([("SKU-77", "B0ABCDEF12", "A fairly long private title", "nan"), ("ab", "short", "too short", None), (" SKU-77 ", None, None, "Order")], "seller_sku string, asin1 string, item_name string, listing_id string")
    lines = spark.createDataFrame([("SKU-77", "O-12345", "Service Fee", "560001"), ("plain", "x/y", "refund", "56000")], "sku string, order_id string, description string, order_postal string")
    known = privacy.known_values(products, lines)
    assert {r.value for r in known.collect()} == {"SKU-77", "B0ABCDEF12", "A fairly long private title", "O-12345", "560001"}
    fine = spark.createDataFrame([("Amazon", "P0001", 50.5, 560001), ("JioMart", "P0002", None, 1)], "marketplace string, public_product_id string, sales_index double, n int")
    leak = spark.createDataFrame([(" SKU-77 ", "x"), ("SKU-77", "x"), ("O-12345", None)], "notes string, brand_group string")
    named = fine.withColumnRenamed("n", "raw_units")
    got = {r.output: r for r in privacy.scan({"fine": fine, "leak": leak, "named": named, "validation_summary": leak}, known).collect()}
    assert set(got) == {"fine", "leak", "named"} and got["fine"].is_safe and got["fine"].total_content_hits == 0
    assert got["leak"].known_private_identifier_values == 3 and not got["leak"].is_safe and got["named"].unsafe_columns == "raw_units" and not got["named"].is_safe
    assert privacy.scan({"leak": leak}, known, max_rows=1).first().known_private_identifier_values == 1
    privacy.assert_safe({"fine": fine}, known)
    written = []
    for bad in ({"fine": fine, "leak": leak}, {"fine": fine, "named": named}):
        with pytest.raises(privacy.PrivacyError) as e:
            privacy.published(bad, lambda n, df: written.append(n), known)
        assert "SKU-77" not in str(e.value)
    privacy.published({"fine": fine}, lambda n, df: written.append(n), known)
    assert written == ["fine"]
    assert privacy.unsafe_columns(["ASIN", "total_orders", "my_sku_hash", "sales_index", "price", "listing_price_band"]) == ["ASIN", "my_sku_hash", "price"]
    assert privacy.file_checks({"a": fine, "b": leak.withColumn("sku", F.lit(1)), "dataset_profile": leak}) == [("a", [], True), ("b", ["sku"], False), ("dataset_profile", [], True)]


def test_filters(spark, tmp_path):
    spark.createDataFrame([("Amazon", "P1", 1), ("Amazon", "P2", 2), ("Meesho", "P1", 3), (None, "P3", 4)], "marketplace string, public_product_id string, n int").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    ns = lambda rows: sorted(r.n for r in rows.collect())
    assert ns(filters.applied(df, {"marketplace": ["All", "Amazon"], "absent": ["x"], "public_product_id": []})) == [1, 2, 3, 4]
    assert ns(filters.applied(df, {"marketplace": ["Amazon", " "], "n": [2, 3]})) == [2]
    assert ns(filters.of_marketplace_product(df, "Amazon", "P1")) == [1] and ns(filters.of_marketplace_product(df, None, "P1")) == [1, 3] and ns(filters.of_marketplace_product(df, "All", "All")) == [1, 2, 3, 4]
    assert ns(filters.scoped(df, df.where("n = 3"))) == [3]
    assert sorted(r.value for r in filters.options(df, "public_product_id", "Amazon").collect()) == ["P1", "P2"] and filters.options(df, "marketplace", "Meesho").count() == 2
    assert not filters.active({"a": ["All"], "b": []}) and filters.active({"a": ["x"]})
    plan = filters.applied(df, {"marketplace": ["Amazon", "Meesho"]})._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(marketplace, [Amazon,Meesho])]" in plan


def test_measures(spark):
    outputs = {"a": spark.createDataFrame([(1.0, "x"), (120.0, None)], "s double, t string"), "b": spark.createDataFrame([(None,)], "s double"), "c": spark.createDataFrame([(1,)], "other int")}
    registry = (("S", "s", (0.0, 100.0), ("a", "b", "c", "absent")), ("T", "t", None, ("a", "c")))
    assert {(r.kpi_name, r.present, r.present_in, r.missing_from, r["values"]) for r in measures.presence(outputs, registry).collect()} == {("S", True, "a, b", "c", 2), ("T", True, "a", "c", 1)}
    assert [tuple(r) for r in measures.ranges(outputs, registry).collect()] == [("S", "a", 0.0, 100.0, 1.0, 120.0, False)]


def matrix(spark, months):
    rows = [(m, market, n, *[float(k + len(market) + 3 * i) for k in range(9)]) for i, (m, n) in enumerate(months) for market in ("A", "BB")]
    return spark.createDataFrame(rows, "transaction_month string, marketplace string, order_count long, " + ", ".join(f"{m} double" for m in variance.METRICS))


def test_driver_report(spark):
    got = variance.driver_report(matrix(spark, [("2024-01", 3), ("2024-02", 4), ("2024-03", 0), ("2024-04", 0)])).collect()
    assert len(got) == 9 and {(r.previous_period, r.current_period, r.excluded_trailing_periods) for r in got} == {("2024-01", "2024-02", "2024-03, 2024-04")}
    assert {r.metric: r.total_abs_variance for r in got}["sales_index"] == 6.0 and all(r.narrative for r in got)
    gone = " 2024-02 was excluded from period comparison because it contains no transaction activity."
    single = "Only one transaction month with recorded activity is available (2024-01); at least two are required for a period-over-period comparison."
    none = "No transaction months with recorded activity are present in this dataset, so no period-over-period comparison is available."
    for months, said, excluded in (([("2024-01", 3)], single, ""), ([("2024-01", 3), ("2024-02", 0)], single + gone, "2024-02"), ([("2024-01", 0)], none, ""), ([], none, "")):
        rows = variance.driver_report(matrix(spark, months)).collect()
        assert [(r.metric, r.movement, r.narrative, r.excluded_trailing_periods, r.total_abs_variance) for r in rows] == [("n/a", "Insufficient Periods", said, excluded, None)]
    empty = variance.compare(matrix(spark, [("2024-01", 3)]), variance.periods(matrix(spark, [("2024-01", 3)])), ["marketplace"])
    assert empty.isEmpty() and {"previous_value", "contribution_share", "movement"} <= set(empty.columns)
    shown = spark.createDataFrame([([],), (["a"],), (["a", "b", "c"],)], "m array<string>").select(variance.excluded_text(F.col("m"))).collect()
    assert [r[0] for r in shown] == [variance.excluded_message([]), variance.excluded_message(["a"]), variance.excluded_message(["a", "b", "c"])]


def test_validation_of_an_empty_upload(spark):
    lines = spark.createDataFrame([], "sku string, transaction_type_group string, marketplace string, mapping_status string, dataset_period string")
    master, sheet = spark.createDataFrame([], "seller_sku string"), spark.createDataFrame([], "seller_sku string, marketplace string")
    out = {"anonymized_master": spark.createDataFrame([], "sales_index double"), "product_performance": spark.createDataFrame([], "sales_index double, sku string")}
    counts = spark.createDataFrame([(2, 0)], "rejected_rows long, warning_rows long")
    got = {r.check_name: (r.check_status, r.check_value) for r in checks.validation_summary(lines, master, sheet, out, counts).collect()}
    assert len(got) == 32 and got["Raw product master loaded"] == ("FAIL", "0") and got["All 5 marketplaces present"] == ("FAIL", "0") and got["Marketplace master loaded"] == ("WARN", "0")
    assert got["No sensitive columns in public outputs"] == ("FAIL", "product_performance: sku") and got["Ratios generated"][0] == "FAIL" and got["Public sales indexes contain activity"] == ("WARN", "False")
    assert got["Upload contract validation — rejected rows"] == ("WARN", "2") and got["Upload contract validation — warning rows"] == ("PASS", "0")
