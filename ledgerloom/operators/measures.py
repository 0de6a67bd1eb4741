"""Declared measures over the published outputs: presence, ranges and the pages' scalars, one aggregate for each output."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import half_even

# Each measure's name, column, range and outputs.
_WIDE = ("anonymized_master", "marketplace_summary", "product_performance", "category_performance", "brand_performance")
_FEES = ("anonymized_master", "product_performance", "fee_refund_summary")
_PROFITS = ("anonymized_master", "product_performance", "profitability_summary")
_ACTIONS = ("anonymized_master", "product_performance", "product_action_review", "inventory_action_review")
REGISTRY = (
    ("Sales Index", "sales_index", (0.0, 100.0), _WIDE), ("Units Index", "units_index", (0.0, 100.0), _WIDE),
    ("Fee % of Gross", "fee_pct_of_gross", (0.0, 300.0), _FEES), ("Refund % of Gross", "refund_pct_of_gross", (0.0, 300.0), _FEES), ("Promotion % of Gross", "promotion_pct_of_gross", (0.0, 300.0), _FEES),
    ("Net-to-Gross %", "net_to_gross_pct", (-300.0, 300.0), _FEES), ("Margin Index", "margin_index", (0.0, 100.0), _PROFITS), ("Estimated Profitability Index", "estimated_profitability_index", (0.0, 100.0), _PROFITS),
    ("Margin Risk Score", "margin_risk_score", (0.0, 100.0), ("anonymized_master", "marketplace_summary", "product_performance", "margin_risk_review")),
    ("Revenue Quality Score", "revenue_quality_score", (0.0, 100.0), ("anonymized_master", "marketplace_summary", "product_performance")),
    ("Recommended Action", "recommended_action", None, _ACTIONS), ("Action Priority", "action_priority", None, _ACTIONS),
)


def _by_output(outputs: Mapping[str, DataFrame], registry) -> DataFrame:
    """(kpi_name, output_column, output, present, values, expected and observed range) by one aggregate for each output."""
    rows = []
    for output in dict.fromkeys(o for _, _, _, outs in registry for o in outs if o in outputs):
        df, made = outputs[output], []
        for name, column, span, outs in registry:
            if output not in outs:
                continue
            there = column in df.columns
            number = F.col(column).cast("double") if there and span else F.lit(None).cast("double")
            made.append(F.struct(
                F.lit(name).alias("kpi_name"), F.lit(column).alias("output_column"), F.lit(output).alias("output"), F.lit(there).alias("present"), (F.count(column) if there else F.lit(0).cast("long")).alias("values"),
                F.lit(span[0] if span else None).cast("double").alias("expected_min"), F.lit(span[1] if span else None).cast("double").alias("expected_max"), F.min(number).alias("observed_min"), F.max(number).alias("observed_max"),
            ))
        rows.append(df.agg(F.array(*made).alias("m")).select(F.inline("m")))
    return reduce(lambda a, b: a.unionByName(b), rows)


def presence(outputs: Mapping[str, DataFrame], registry=REGISTRY) -> DataFrame:
    """Q14: a row for each measure, with the outputs that have and lack its column and how many values they hold."""
    listed = lambda test: F.array_join(F.array_sort(F.collect_list(F.when(test, F.col("output")))), ", ")  # noqa: E731  a few outputs
    return _by_output(outputs, registry).groupBy("kpi_name", "output_column").agg(F.max("present").alias("present"), listed(F.col("present")).alias("present_in"), listed(~F.col("present")).alias("missing_from"), F.sum("values").alias("values"))


def ranges(outputs: Mapping[str, DataFrame], registry=REGISTRY) -> DataFrame:
    """Q15: a row for each measure with a range and output that holds values of it."""
    got = _by_output(outputs, registry).where("expected_min is not null and observed_min is not null")
    return got.select("kpi_name", "output", "expected_min", "expected_max", "observed_min", "observed_max", ((F.col("observed_min") >= F.col("expected_min")) & (F.col("observed_max") <= F.col("expected_max"))).alias("in_range"))


def scalars(outputs: Mapping[str, DataFrame], lines: DataFrame, master: DataFrame) -> DataFrame:
    """the 23 scalars of the pages, one row."""
    mean = lambda c: F.coalesce(half_even(F.try_divide(F.sum(F.col(c).cast("decimal(18,1)")).cast("double"), F.count(c)), 1), F.lit(0.0))
    review = lambda what: F.count_if(F.col("recommended_action") == f"{what} Review")
    parts = [
        master.agg(F.count("*").alias("product_master_rows")),
        lines.agg(F.count("*").alias("transaction_rows"), F.count_if(F.col("transaction_type_group") == "Order").alias("order_rows"), F.coalesce(half_even(F.try_divide(F.count_if(F.col("mapping_status") == "Matched"), F.count("sku")) * 100.0, 2), F.lit(0.0)).alias("join_coverage_pct")).withColumn("channel_mapping_status", F.lit("Unavailable")),
        outputs["product_performance"].agg(
            F.count_distinct("public_product_id").alias("products_in_analysis"), F.count_distinct("public_product_id").alias("products_with_transactions"), F.count_distinct("category_group").alias("category_count"), F.count_distinct("brand_group").alias("brand_count"),
            mean("fee_pct_of_gross").alias("average_fee_pct"), mean("refund_pct_of_gross").alias("average_refund_pct"), mean("promotion_pct_of_gross").alias("average_promotion_pct"), mean("net_to_gross_pct").alias("average_net_to_gross_pct"), mean("revenue_quality_score").alias("average_revenue_quality_score"),
        ),
        outputs["marketplace_channel_performance"].agg(F.count_distinct("marketplace").alias("marketplaces")), outputs["margin_risk_review"].agg(mean("margin_risk_score").alias("average_margin_risk_score")),
        outputs["product_action_review"].agg(F.count_if(F.col("action_priority") == "High").alias("high_priority_actions"), *[review(w).alias(f"{w.lower().replace(' ', '_')}_review_count") for w in ("Refund", "Promotion", "Fee", "Slow Mover", "Margin Risk", "Restock")]),
    ]
    return reduce(lambda a, b: a.crossJoin(b), parts)  # one row each
