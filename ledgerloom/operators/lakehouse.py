"""Bronze, silver and gold layers of the warehouse's tables, with the checks between them.

Bronze is a copy. Silver trims strings and sets aside rows without a key and all but one of the rows of a key. Gold joins facts
to the attributes of their dimensions, from the left, so that it keeps the facts' grain. Every count comes from the pass
that writes the table.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import star, warehouse
from ledgerloom.sources.staging import removed

# The key of each table, the gold tables, the checks with their layer and scope.
KEYS = {
    "dim_product": "product_key", "dim_marketplace": "marketplace_key", "dim_month": "month_key", "dim_fulfillment": "fulfillment_key", "fact_marketplace_activity": "fact_key", "fact_product_performance": "fact_key",
    "fact_inventory_action": "fact_key", "fact_performance_variance": "fact_key", "audit_validation": "audit_key", "audit_dataset_profile": "audit_key",
}
GOLD = {
    "gold_marketplace_performance": ("fact_marketplace_activity", ["month_key.transaction_month", "marketplace_key.marketplace", "marketplace_key.channel", *star.ACTIVITY]),
    "gold_product_performance": ("fact_product_performance", ["product_key.public_product_id", *[f"product_key.{c}" for c in star.ATTRIBUTES], "marketplace_key.marketplace", *star.PERFORMANCE, "dataset_period"]),
    "gold_inventory_actions": ("fact_inventory_action", ["product_key.public_product_id", "product_key.brand_group", "product_key.category_group", "product_key.inventory_band", "marketplace_key.marketplace", *star.INVENTORY]),
    "gold_variance_drivers": ("fact_performance_variance", ["marketplace_key.marketplace", "metric", "previous_month_key.transaction_month as previous_month", "current_month_key.transaction_month as current_month", *star.DRIVERS]),
    "gold_validation_summary": ("audit_validation", ["check_name", "check_status", "check_value", "expected_value", "notes"]),
}
CHECKS = (
    ("source_target_row_reconciliation", "Bronze", "All 10 tables"), ("table_format_validation", "Bronze+Silver+Gold", "All 25 tables"), ("null_key_validation", "Silver", "All 10 tables"),
    ("duplicate_key_validation", "Silver", "All 10 tables"), ("row_count_conformance_bronze_to_silver", "Silver", "All 10 tables"), ("grain_preservation_silver_to_gold", "Gold", "5 fact-derived Gold tables"),
    ("business_metric_total_orders", "Gold", "gold_marketplace_performance"), ("business_metric_marketplace_count", "Silver", "silver_dim_marketplace"), ("business_metric_product_performance_rows", "Gold", "gold_product_performance"),
    ("business_metric_high_priority_actions", "Gold", "gold_product_performance"), ("idempotency_bronze", "Bronze", "2 runs"), ("idempotency_silver_gold", "Silver+Gold", "2 runs"),
    ("controlled_failure_test", "Pipeline", "a table that is not there"), ("recovery_rerun_test", "Pipeline", "the same run, corrected"),
)


@dataclass(frozen=True)
class Silver:
    rows: int
    null_keys: int
    repeats: int


def bronze(tables: Mapping[str, DataFrame], folder: str, names: list[str] | None = None) -> dict[str, int]:
    """Copies over what is there; a table that fails is tried again, then the run fails."""
    return {name: warehouse.write_counted(tables[name], f"{folder}/bronze/{name}") for name in names or KEYS}


def silver(spark: SparkSession, folder: str) -> dict[str, Silver]:
    """What is set aside goes to silver_rejected, with its reason."""
    out = {}
    for name, key in KEYS.items():
        rows = spark.read.parquet(f"{folder}/bronze/{name}")
        rows = rows.select(*[F.trim(c).alias(c) if kind == "string" else F.col(c) for c, kind in rows.dtypes])
        # the key alone says whether rows must go; only then whole rows are brought together by it
        n, none = F.col("n"), F.col(key).isNull()
        nulls, extra = rows.groupBy(key).agg(F.count("*").alias("n")).agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in (F.when(none, n), F.when(~none, n - 1))]).first()
        kept = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rows.columns)).alias("_row")).select("_row.*") if nulls or extra else rows
        out[name] = Silver(warehouse.write_counted(kept, f"{folder}/silver/{name}", 1), nulls, extra)
        if nulls or extra:
            again = rows.where(F.col(key).isNotNull()).exceptAll(spark.read.parquet(f"{folder}/silver/{name}").select(*rows.columns))
            aside = rows.where(F.col(key).isNull()).withColumn("reason", F.lit("null key")).unionByName(again.withColumn("reason", F.lit("repeated key")))
            aside.write.mode("overwrite").parquet(f"{folder}/silver_rejected/{name}")
    return out


def gold(spark: SparkSession, folder: str) -> dict[str, int]:
    """N22."""
    tables = {name: spark.read.parquet(f"{folder}/silver/{name}") for name in KEYS}
    return {name: warehouse.write_counted(star.view(tables, fact, columns, "left"), f"{folder}/gold/{name}") for name, (fact, columns) in GOLD.items()}


def _readable(spark: SparkSession, folder: str) -> int:
    """Tables of the three layers that open as Parquet with columns."""
    paths = [f"{folder}/{layer}/{name}" for layer in ("bronze", "silver") for name in KEYS] + [f"{folder}/gold/{name}" for name in GOLD]
    return sum(bool(spark.read.parquet(p).columns) for p in paths)


def run(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> dict:
    return {"bronze": bronze(tables, folder), "silver": silver(spark, folder), "gold": gold(spark, folder)}


def checked(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> DataFrame:
    """Runs all layers twice, then a run that must fail and one that must not; the 14 checks with what each measured."""
    first, second = run(spark, tables, folder), run(spark, tables, folder)
    source = {name: tables[name].count() for name in KEYS}
    spark.range(1).write.mode("overwrite").parquet(f"{folder}/doomed")
    doomed = spark.read.parquet(f"{folder}/doomed")
    removed(spark, f"{folder}/doomed")  # what is read goes before it is read
    try:
        bronze({"dim_month": doomed}, f"{folder}/failing", ["dim_month"])
        failed = 0
    except warehouse.LoadError:
        failed = 1
    again = bronze(tables, folder, ["dim_month"])["dim_month"]
    at = lambda layer, name: spark.read.parquet(f"{folder}/{layer}/{name}")
    orders = at("gold", "gold_marketplace_performance").agg(F.sum("total_orders")).first()[0]
    high = at("gold", "gold_product_performance").where("action_priority = 'High'").count()
    markets = at("silver", "dim_marketplace").select("marketplace").distinct().count()
    facts = {fact: n for (fact, _), n in zip(GOLD.values(), second["gold"].values(), strict=True)}
    measured = [
        (sum(n != second["bronze"][t] for t, n in source.items()), 0), (_readable(spark, folder), 2 * len(KEYS) + len(GOLD)), (sum(s.null_keys for s in second["silver"].values()), 0),
        (sum(s.repeats for s in second["silver"].values()), 0), (sum(s.rows != second["bronze"][t] for t, s in second["silver"].items()), 0), (sum(n != second["silver"][f].rows for f, n in facts.items()), 0),
        (orders, tables["fact_marketplace_activity"].agg(F.sum("total_orders")).first()[0]), (markets, tables["dim_marketplace"].count()), (second["gold"]["gold_product_performance"], source["fact_product_performance"]),
        (high, tables["fact_product_performance"].where("action_priority = 'High'").count()), (sum(first["bronze"].values()), sum(second["bronze"].values())),
        (sum(s.rows for s in first["silver"].values()) + sum(first["gold"].values()), sum(s.rows for s in second["silver"].values()) + sum(second["gold"].values())), (failed, 1), (again, first["bronze"]["dim_month"]),
    ]
    rows = [(*c, "PASS" if got == want else "FAIL", got, want) for c, (got, want) in zip(CHECKS, measured, strict=True)]
    return spark.createDataFrame(rows, "check_name string, layer string, scope string, result string, measured long, expected long")
