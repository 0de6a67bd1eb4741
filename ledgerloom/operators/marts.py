"""The public marts as DataFrames over the row-level frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.functions.columns import words
from ledgerloom.operators import kernel, master
from ledgerloom.operators.master import NON_PRODUCT
from ledgerloom.sources import tables
from ledgerloom.sources.staging import cached

# The names and the order of the published columns.
RATIOS = {f"{c}_pct_of_gross": f"avg_{c}_pct_of_gross" for c in ("fee", "refund", "promotion")} | {"net_to_gross_pct": "avg_net_to_gross_pct"}
PRODUCT_KEYS = ["public_product_id", "marketplace", "brand_group", "category_group", "subcategory_group", "product_group", "fulfillment_type", "listing_price_band", "inventory_band", "margin_band_public", "profitability_band_public"]
PRODUCT_METRICS = ["sales_index", "units_index", "fee_pct_of_gross", "refund_pct_of_gross", "promotion_pct_of_gross", "net_to_gross_pct", "margin_index", "estimated_profitability_index", "margin_risk_score", "margin_risk_band", "revenue_quality_score", "revenue_quality_band"]
ACTION = ["recommended_action", "action_priority", "action_reason"]
SCORES = ["margin_risk_score", "revenue_quality_score"]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matched lines, staged until an input changes: every mart reads of them the columns that it needs."""
    return cached(spark, sf_dir, "lines", tables.INPUTS, lambda: _lines(spark, sf_dir))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    place, groups = tables.places(spark, sf_dir), ["marketplace_group", "state_group"]
    made = lambda rows, keep: master.amounts(tables.settled(rows, place, [*keep, *groups]), keep)
    found = master.matched(tables.sold(spark, sf_dir), tables.product_master(spark, sf_dir), made)
    return public_context(found, "12m", True)


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row-level frame: lines with metrics and actions."""
    return kernel.actions(kernel.metrics(lines(spark, sf_dir)))


# The columns of the published rows, where their context comes from and what stands in for it.
PUBLIC = (
    "transaction_month", "dataset_period", "marketplace", "channel", "public_product_id", "brand_group", "category_group", "subcategory_group", "product_group", "fulfillment_type", "state_group",
    "origin_country_group", "imported_flag", "listing_price_band", "inventory_band", "margin_band_public", "channel_margin_band_public", "profitability_band_public", "transaction_type_group", "sales_index",
    "units_index", "fee_pct_of_gross", "refund_pct_of_gross", "promotion_pct_of_gross", "net_to_gross_pct", "margin_index", "estimated_profitability_index", "margin_risk_score", "margin_risk_band",
    "revenue_quality_score", "revenue_quality_band", "recommended_action", "action_priority", "action_reason", "mapping_status",
)
#: Published columns that go with each other: of the product, of the line, of its figures.
TOGETHER = (
    ("public_product_id", "brand_group", "category_group", "subcategory_group", "product_group", "origin_country_group", "imported_flag", "listing_price_band", "inventory_band", "mapping_status"),
    ("transaction_month", "dataset_period", "marketplace", "channel", "fulfillment_type", "state_group", "transaction_type_group"),
    ("margin_band_public", "channel_margin_band_public", "profitability_band_public", "margin_risk_band", "revenue_quality_band", "recommended_action", "action_priority", "action_reason"),
)
GROUPED = {
    "marketplace": (["marketplace"], "Unknown"), "channel": (["channel"], "Marketplace"), "brand_group": (["brand_group", "brand"], "Unmapped"), "category_group": (["category_group", "category"], "Unmapped"),
    "subcategory_group": (["subcategory_group", "subcategory"], "Unmapped"), "product_group": (["product_group"], "Unmapped Product"), "fulfillment_type": (["fulfillment_type", "fulfillment_channel"], "Unknown"),
    "state_group": (["state_group"], "Unknown"), "imported_flag": (["imported_flag"], "Unknown"),
}
PLAIN = {
    "transaction_month": (["transaction_month"], "Unknown"), "public_product_id": (["public_product_id"], NON_PRODUCT), "listing_price_band": (["listing_price_band", "channel_price_band_public"], "Unknown"),
    "inventory_band": (["inventory_band"], "Unknown"), "margin_band_public": (["margin_band_public"], "Unknown"), "channel_margin_band_public": (["channel_margin_band_public", "margin_band_public_channel", "margin_band_public"], "Unknown"),
    "profitability_band_public": (["profitability_band_public", "profitability_band_public_channel"], "Unknown"), "transaction_type_group": (["transaction_type_group"], "Other"), "mapping_status": (["mapping_status"], "Unmatched"),
    "restock_priority": (["restock_priority"], "Monitor"),
}


def public_context(df: DataFrame, period: str = "custom", clean: bool = False) -> DataFrame:
    """The columns of context by the first existing name, with a default, white space collapsed where values are groups.
    Of a `clean` frame, columns that have their own name stay as they are: products were cleaned before they met the lines."""
    found = {c: words(df, names, default) for c, (names, default) in (PLAIN | {"dataset_period": (["dataset_period"], period)}).items()}
    found |= {c: text.group_value(words(df, names, default), default) for c, (names, default) in GROUPED.items()}
    found["origin_country_group"] = text.origin(words(df, ["origin_country_group", "origin_country"], "Unknown"))
    return df.withColumns({c: e for c, e in found.items() if not (clean and c in df.columns)})


def anonymized_master(df: DataFrame) -> DataFrame:
    """The published columns of the row-level frame; those that it lacks are null."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in PUBLIC])


def products(df: DataFrame) -> DataFrame:
    return df.where(F.col("public_product_id") != NON_PRODUCT)


def renamed(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(RATIOS)


MONTHLY = ["dataset_period", "transaction_month", "marketplace"]


def monthly(df: DataFrame) -> DataFrame:
    """The groups of the marketplace summary, with every figure."""
    return kernel.aggregate(df, MONTHLY)


def marketplace_summary(df: DataFrame) -> DataFrame:
    return summary_of(monthly(df))


def summary_of(groups: DataFrame) -> DataFrame:
    keys = MONTHLY
    return renamed(groups).withColumnRenamed("order_count", "total_orders").select(*keys, "total_orders", "product_count", "sales_index", "units_index", *RATIOS.values(), *SCORES)


def channel_performance(df: DataFrame) -> DataFrame:
    """Distinct high-priority products come from the same grouping keys; channels without products and sales go."""
    keys = ["dataset_period", "marketplace", "channel"]
    high = products(df).where("action_priority = 'High'").groupBy(*keys).agg(F.count_distinct("public_product_id").alias("high"))
    got = renamed(kernel.aggregate(df, keys)).join(high, keys, "left")
    got = got.select(*keys, "product_count", "order_count_index", "sales_index", "units_index", *RATIOS.values(), F.col("margin_risk_score").alias("avg_margin_risk_score"), F.col("revenue_quality_score").alias("avg_revenue_quality_score"), F.coalesce("high", F.lit(0)).alias("high_priority_action_count"))
    return got.where("product_count > 0 or sales_index > 0")


#: Of the product groups, which are half as many as lines and wide.
SLICES = 4


def product_performance(df: DataFrame) -> DataFrame:
    return kernel.actions(kernel.aggregate(products(df), PRODUCT_KEYS, (), SLICES)).select(*PRODUCT_KEYS, *PRODUCT_METRICS, *ACTION)


def product_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product mart, staged until an input changes, as most pages and reports read it."""
    return cached(spark, sf_dir, "product_performance", tables.INPUTS, lambda: product_performance(rows(spark, sf_dir)))


def grouped(df: DataFrame, keys: list[str], extra: list[str]) -> DataFrame:
    return renamed(kernel.aggregate(products(df), keys, ("product_count", *[c for c in extra if c == "order_count"]))).select(*keys, "product_count", *extra)


def category_performance(df: DataFrame) -> DataFrame:
    return grouped(df, ["dataset_period", "marketplace", "category_group", "subcategory_group"], ["sales_index", "units_index", *RATIOS.values(), *SCORES])


def brand_performance(df: DataFrame) -> DataFrame:
    return grouped(df, ["dataset_period", "marketplace", "brand_group", "category_group"], ["sales_index", "units_index", *RATIOS.values(), *SCORES])


def fulfillment_comparison(df: DataFrame) -> DataFrame:
    return grouped(df, ["dataset_period", "fulfillment_type"], ["order_count", "sales_index", "units_index", "avg_fee_pct_of_gross", "avg_refund_pct_of_gross", "avg_net_to_gross_pct", *SCORES])


def profitability_summary(df: DataFrame) -> DataFrame:
    keys = ["dataset_period", "marketplace", "category_group", "brand_group", "product_group", "margin_band_public", "profitability_band_public"]
    return grouped(df, keys, ["sales_index", "units_index", "margin_index", "estimated_profitability_index", *SCORES, "margin_risk_band", "revenue_quality_band"])


def fee_refund_summary(product: DataFrame) -> DataFrame:
    flag = lambda test: F.when(test, "Review").otherwise("Monitor")
    keep = ["public_product_id", "marketplace", "brand_group", "category_group", "product_group", "fee_pct_of_gross", "refund_pct_of_gross", "promotion_pct_of_gross", "net_to_gross_pct", "revenue_quality_score", "revenue_quality_band"]
    return product.select(
        *keep, flag(F.col("fee_pct_of_gross") >= 25).alias("fee_review_flag"), flag(F.col("refund_pct_of_gross") >= 10).alias("refund_review_flag"),
        flag((F.col("promotion_pct_of_gross") >= 10) & (F.col("net_to_gross_pct") < 70)).alias("promotion_review_flag"),
    )


def margin_risk_review(product: DataFrame) -> DataFrame:
    keep = ["public_product_id", "marketplace", "brand_group", "category_group", "product_group", "listing_price_band", "inventory_band", *PRODUCT_METRICS[:6], "margin_risk_score", "margin_risk_band", "revenue_quality_score", *ACTION]
    return product.select(*keep)


def inventory_action_review(df: DataFrame, product: DataFrame) -> DataFrame:
    """A product with several restock priorities keeps a row for each."""
    keys = ["public_product_id", "marketplace", "brand_group", "category_group", "product_group", "inventory_band"]
    context = products(df).select(*keys, "restock_priority").distinct()
    return product.join(context, keys, "left").select(*keys, "units_index", "sales_index", "margin_risk_band", "revenue_quality_band", "restock_priority", *ACTION)


def product_action_review(product: DataFrame) -> DataFrame:
    rank = F.when(F.col("action_priority") == "High", 1).when(F.col("action_priority") == "Medium", 2).when(F.col("action_priority") == "Low", 3).otherwise(4)
    return product.orderBy(rank, F.desc("sales_index"), F.desc("units_index"), *PRODUCT_KEYS)
