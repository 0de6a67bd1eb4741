"""The star schema: dimensions with dense keys (0 is Unknown), facts, audits, constraints and reconciliation.

Keys of products and of facts on products are numbered range by range; marketplaces, months and fulfillment types are a
handful of distinct values, sorted in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators import checks, marts, variance
from ledgerloom.operators.numbering import numbered
from ledgerloom.sources import tables
from ledgerloom.sources.staging import cached

# Attributes of products, columns that none of the tables may have, labels of periods, sources of facts.
ATTRIBUTES = ["brand_group", "category_group", "subcategory_group", "product_group", "listing_price_band", "inventory_band", "margin_band_public", "profitability_band_public"]
FORBIDDEN = ("asin", "asin1", "seller_sku", "sku", "order_id", "listing_id", "item_name", "item_description", "order_postal")
LABELS = checks.PERIOD_LABELS
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
ACTIVITY = ["total_orders", "product_count", "sales_index", "units_index", "avg_fee_pct_of_gross", "avg_refund_pct_of_gross", "avg_promotion_pct_of_gross", "avg_net_to_gross_pct", "margin_risk_score", "revenue_quality_score"]
PERFORMANCE = ["sales_index", "units_index", "fee_pct_of_gross", "refund_pct_of_gross", "promotion_pct_of_gross", "net_to_gross_pct", "margin_index", "estimated_profitability_index", "margin_risk_score", "revenue_quality_score", "recommended_action", "action_priority"]
INVENTORY = ["units_index", "sales_index", "restock_priority", "recommended_action", "action_priority"]
DRIVERS = ["previous_value", "current_value", "abs_variance", "pct_variance", "contribution_share_pct", "movement"]
FOREIGN_KEYS = (
    ("fact_marketplace_activity", "month_key", "dim_month", "month_key"),
    ("fact_marketplace_activity", "marketplace_key", "dim_marketplace", "marketplace_key"),
    ("fact_product_performance", "product_key", "dim_product", "product_key"),
    ("fact_product_performance", "marketplace_key", "dim_marketplace", "marketplace_key"),
    ("fact_inventory_action", "product_key", "dim_product", "product_key"),
    ("fact_inventory_action", "marketplace_key", "dim_marketplace", "marketplace_key"),
    ("fact_performance_variance", "previous_month_key", "dim_month", "month_key"),
    ("fact_performance_variance", "current_month_key", "dim_month", "month_key"),
    ("fact_performance_variance", "marketplace_key", "dim_marketplace", "marketplace_key"),
)
NATURAL_KEYS = (("dim_product", ["public_product_id"]), ("dim_marketplace", ["marketplace", "channel"]), ("dim_month", ["transaction_month"]), ("dim_fulfillment", ["fulfillment_type"]))
LOADS = (
    ("marketplace_summary", "fact_marketplace_activity"), ("product_performance", "fact_product_performance"), ("inventory_action_review", "fact_inventory_action"),
    ("mart_marketplace_variance_drivers", "fact_performance_variance"), ("validation_summary", "audit_validation"), ("dataset_profile", "audit_dataset_profile"),
)


def dimension(values: DataFrame, column: str, key: str) -> DataFrame:
    """Keys by sorted distinct value. A value 'Unknown' is the member 0 itself."""
    own = values.select(F.col(column)).where(F.col(column).isNotNull() & (F.trim(column) != "") & (F.col(column) != "Unknown")).distinct()
    own = own.withColumn(key, F.row_number().over(Window.orderBy(column)))
    return own.select(key, column).unionByName(own.sparkSession.createDataFrame([(0, "Unknown")], f"{key} int, {column} string"))


def dim_product(product: DataFrame) -> DataFrame:
    """Each product once, with its least tuple of attributes, and the Unknown member; private columns are refused."""
    private = sorted({*FORBIDDEN, "item_name"} & {c.lower() for c in product.columns})
    if private:
        raise ValueError(f"private columns {private}: no dim_product is built from them")
    one = product.where("public_product_id is not null").groupBy("public_product_id").agg(F.min(F.struct(*ATTRIBUTES)).alias("a")).select("public_product_id", "a.*")
    unknown = product.sparkSession.range(1).select(F.lit(0).alias("product_key"), *[F.lit("Unknown").alias(c) for c in ["public_product_id", *ATTRIBUTES]])
    return unknown.unionByName(numbered(one, ["public_product_id"], "product_key"))


def dim_marketplace(*frames: DataFrame) -> DataFrame:
    """The marketplaces of all frames, under one constant channel."""
    names = None
    for f in frames:
        own = f.select("marketplace")
        names = own if names is None else names.union(own)
    return dimension(names, "marketplace", "marketplace_key").withColumn("channel", F.lit("Marketplace"))


def dim_month(summary: DataFrame) -> DataFrame:
    """The calendar of month labels. A label that is no month has no attributes."""
    label = F.trim("transaction_month")
    own = dimension(summary.where(~F.lower(label).isin("", "unknown", "nan")), "transaction_month", "month_key")
    month = F.when(F.col("transaction_month").rlike(r"^\d+-\d+$"), F.split_part("transaction_month", F.lit("-"), F.lit(2)).try_cast("int"))
    month = F.when(month.between(1, 12), month)
    year = F.when(month.isNotNull(), F.split_part("transaction_month", F.lit("-"), F.lit(1)).try_cast("int"))
    period = summary.agg(F.first("dataset_period", ignorenulls=True).alias("dataset_period"))
    return own.crossJoin(F.broadcast(period)).select(
        "month_key", "transaction_month", year.alias("year"), month.alias("month_number"),
        F.coalesce(F.get(F.array(*map(F.lit, MONTHS)), month - 1), F.lit("Unknown")).alias("month_name"),
        F.floor((month + 2) / 3).cast("int").alias("quarter"), F.col("transaction_month").alias("year_month"), "dataset_period",
    )


def lookup(fact: DataFrame, dim: DataFrame, column: str, key: str) -> DataFrame:
    """The key of a value, 0 if the dimension lacks it."""
    return fact.join(dim.select(column, key), column, "left").withColumn(key, F.coalesce(key, F.lit(0)))


def _fact(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Numbered by keys; the values break ties, equal rows by chance."""
    rows = rows.select(*keys, *values).withColumn("_tie", F.monotonically_increasing_id())
    return numbered(rows, [*keys, *values, "_tie"], "fact_key").select("fact_key", *keys, *values)


def fact_marketplace(summary: DataFrame, months: DataFrame, markets: DataFrame) -> DataFrame:
    """N05."""
    return _fact(lookup(lookup(summary, markets, "marketplace", "marketplace_key"), months, "transaction_month", "month_key"), ["month_key", "marketplace_key"], ACTIVITY)


def fact_product(product: DataFrame, products: DataFrame, markets: DataFrame, period: str) -> DataFrame:
    """No month, as the mart has none."""
    rows = lookup(lookup(product, markets, "marketplace", "marketplace_key"), products, "public_product_id", "product_key")
    return _fact(rows, ["product_key", "marketplace_key"], PERFORMANCE).withColumn("dataset_period", F.lit(period))


def fact_inventory(review: DataFrame, products: DataFrame, markets: DataFrame) -> DataFrame:
    """N07."""
    return _fact(lookup(lookup(review, markets, "marketplace", "marketplace_key"), products, "public_product_id", "product_key"), ["product_key", "marketplace_key"], INVENTORY)


def fact_variance(drivers: DataFrame, months: DataFrame, markets: DataFrame) -> DataFrame:
    """Empty where there are no two periods to compare, as then no drivers are."""
    rows = lookup(drivers, markets, "marketplace", "marketplace_key")
    for which in ("previous", "current"):
        month = months.select(F.col("transaction_month").alias(f"{which}_period"), F.col("month_key").alias(f"{which}_month_key"))
        rows = rows.join(F.broadcast(month), f"{which}_period", "left").withColumn(f"{which}_month_key", F.coalesce(f"{which}_month_key", F.lit(0)))
    rows = rows.withColumnsRenamed({"absolute_variance": "abs_variance", "percentage_variance": "pct_variance", "contribution_share": "contribution_share_pct"})
    return _fact(rows, ["marketplace_key", "metric"], ["previous_month_key", "current_month_key", *DRIVERS])


def view(tables: Mapping[str, DataFrame], fact: str, columns: list[str], how: str = "inner") -> DataFrame:
    """A fact with attributes of its dimensions. A column is the fact's own, or 'key.attribute', with a name
    after 'as' if it needs another; the key says which dimension, and the same dimension may come by several keys."""
    rows, out = tables[fact], []
    wanted: dict[str, list[str]] = {}
    for c in columns:
        source, _, name = c.partition(" as ")
        key, _, attribute = source.rpartition(".")
        if key:
            wanted.setdefault(key, []).append(attribute)
        out.append(F.col(f"_{key}_{attribute}" if key else source).alias(name or attribute))
    for _, key, dim, member in (x for x in FOREIGN_KEYS if x[0] == fact and x[1] in wanted):
        own = tables[dim].select(F.col(member).alias(key), *[F.col(a).alias(f"_{key}_{a}") for a in wanted[key]])
        rows = rows.join(own, key, how)
    return rows.select(*out)


def profile(outputs: dict[str, DataFrame], period: str) -> DataFrame:
    """a row per output with its row count."""
    got = None
    for k, (name, df) in enumerate(outputs.items()):
        own = df.agg(F.count("*").alias("row_count")).select(F.lit(k + 1).alias("audit_key"), F.lit(name).alias("public_output_name"), "row_count", F.lit(period).alias("dataset_period"), F.lit(LABELS.get(period, period)).alias("dataset_label"))
        got = own if got is None else got.unionByName(own)
    return got


class Star(Mapping):
    """The marts, dimensions, facts and audits of a folder by name. Each is built, and staged until an input changes,
    when it is first asked for, with no more than it needs: a month's calendar reads no product."""

    PERIOD = "12m"

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        if name in PLAIN:
            return PLAIN[name](self)
        return cached(self.spark, self.sf_dir, name, tables.INPUTS, lambda: BUILT[name](self))

    def __iter__(self) -> Iterator[str]:
        return iter([*PLAIN, *BUILT])

    def __len__(self) -> int:
        return len(PLAIN) + len(BUILT)

    @property
    def rows(self) -> DataFrame:
        return marts.rows(self.spark, self.sf_dir)

    def outputs(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in OUTPUTS}


# The profiled outputs in order.
OUTPUTS = (
    "anonymized_master", "marketplace_summary", "marketplace_channel_performance", "product_performance", "category_performance", "brand_performance", "fulfillment_comparison", "profitability_summary",
    "fee_refund_summary", "margin_risk_review", "inventory_action_review", "product_action_review", "mart_marketplace_variance_drivers", "mart_performance_driver_summary",
)
TOGETHER = {"anonymized_master": marts.TOGETHER}
#: Tables that are no more than another name or a projection of a staged one.
PLAIN = {
    "anonymized_master": lambda s: marts.anonymized_master(s.rows), "product_performance": lambda s: marts.product_mart(s.spark, s.sf_dir), "product_action_review": lambda s: s["product_performance"], "fee_refund_summary": lambda s: marts.fee_refund_summary(s["product_performance"]),
    "matrix": lambda s: variance.matrix_of(s["monthly"]), "marketplace_summary": lambda s: marts.summary_of(s["monthly"]),
    "margin_risk_review": lambda s: marts.margin_risk_review(s["product_performance"]), "dataset_profile": lambda s: s["audit_dataset_profile"].drop("audit_key"), "validation_summary": lambda s: s["audit_validation"],
}
BUILT = {
    # all rows are of one period, so that the groups by month and marketplace are those of the summary
    "monthly": lambda s: marts.monthly(s.rows),
    "mart_marketplace_variance_drivers": lambda s: variance.compare(s["matrix"], variance.periods(s["matrix"]), ["marketplace"]),
    "mart_performance_driver_summary": lambda s: variance.driver_report(s["matrix"]),
    "marketplace_channel_performance": lambda s: marts.channel_performance(s.rows),
    "category_performance": lambda s: marts.category_performance(s.rows), "brand_performance": lambda s: marts.brand_performance(s.rows), "fulfillment_comparison": lambda s: marts.fulfillment_comparison(s.rows),
    "profitability_summary": lambda s: marts.profitability_summary(s.rows), "inventory_action_review": lambda s: marts.inventory_action_review(s.rows, s["product_performance"]),
    "audit_dataset_profile": lambda s: profile(s.outputs(), s.PERIOD),
    "audit_validation": lambda s: checks.validation_summary(marts.lines(s.spark, s.sf_dir), tables.product_master(s.spark, s.sf_dir), tables.channels(s.spark, s.sf_dir), s.outputs(), hits=s["content_hits"]),
    "content_hits": lambda s: checks.content_hits(s.outputs(), TOGETHER),
    "dim_product": lambda s: dim_product(s["product_performance"]),
    "dim_marketplace": lambda s: dim_marketplace(s["marketplace_summary"], s["product_performance"], s["inventory_action_review"], s["mart_marketplace_variance_drivers"]),
    "dim_month": lambda s: dim_month(s["marketplace_summary"]), "dim_fulfillment": lambda s: dimension(s["product_performance"], "fulfillment_type", "fulfillment_key"),
    "fact_marketplace_activity": lambda s: fact_marketplace(s["marketplace_summary"], s["dim_month"], s["dim_marketplace"]),
    "fact_product_performance": lambda s: fact_product(s["product_performance"], s["dim_product"], s["dim_marketplace"], s.PERIOD),
    "fact_inventory_action": lambda s: fact_inventory(s["inventory_action_review"], s["dim_product"], s["dim_marketplace"]),
    "fact_performance_variance": lambda s: fact_variance(s["mart_marketplace_variance_drivers"], s["dim_month"], s["dim_marketplace"]),
}


def load(spark: SparkSession, sf_dir: str) -> Star:
    return Star(spark, sf_dir)


def duplicates(star: Mapping[str, DataFrame]) -> DataFrame:
    """Natural keys that occur more than once, a row per dimension."""
    got = None
    for name, keys in NATURAL_KEYS:
        own = star[name].groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("duplicates")).select(F.lit(name).alias("dimension"), "duplicates")
        got = own if got is None else got.unionByName(own)
    return got


def orphans(star: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows whose key no member has, a row per relation."""
    got = None
    for fact, key, dim, member in FOREIGN_KEYS:
        own = star[fact].join(star[dim].select(F.col(member).alias(key)), key, "left_anti").agg(F.count("*").alias("orphans"))
        own = own.select(F.lit(fact).alias("fact"), F.lit(key).alias("fact_column"), "orphans")
        got = own if got is None else got.unionByName(own)
    return got


def assert_unique(star: Mapping[str, DataFrame]) -> None:
    bad = [r.dimension for r in duplicates(star).where("duplicates > 0").collect()]  # at most one row per dimension
    if bad:
        raise ValueError(f"natural keys are not unique in {bad}")


def assert_foreign_keys(star: Mapping[str, DataFrame]) -> None:
    bad = [(r.fact, r.fact_column) for r in orphans(star).where("orphans > 0").collect()]  # at most one row per relation
    if bad:
        raise ValueError(f"keys that no member has in {bad}")


def reconciliation(star: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each source and of the table loaded from it."""
    got = None
    for source, target in LOADS:
        left, right = (star[x].agg(F.count("*").alias(n)) for x, n in ((source, "source_rows"), (target, "target_rows")))
        own = left.crossJoin(right).select(F.lit(source).alias("source_name"), "source_rows", F.lit(target).alias("target_table"), "target_rows")  # one row each
        got = own if got is None else got.unionByName(own)
    return got.withColumn("difference", F.col("source_rows") - F.col("target_rows")).withColumn("status", F.when(F.col("difference") == 0, "OK").otherwise("MISMATCH"))


def forbidden_columns(star: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of dimensions and facts that must not be there."""
    frames = {t: star[t] for t in star if t.startswith(("dim_", "fact_"))}  # by name: no other table is built for this
    found = [(t, c) for t, df in frames.items() for c in df.columns if c.lower() in FORBIDDEN]
    return next(iter(frames.values())).sparkSession.createDataFrame(found, "table_name string, column_name string")
