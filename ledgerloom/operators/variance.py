"""Period-over-period variance: valid periods, comparison by metric, contributors, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import half_even
from ledgerloom.operators import kernel, marts

# The headline metrics in order, and those that get worse when they rise.
METRICS = ("sales_index", "units_index", "fee_pct_of_gross", "refund_pct_of_gross", "promotion_pct_of_gross", "net_to_gross_pct", "margin_risk_score", "revenue_quality_score", "estimated_profitability_index")
WORSE_UP = ("fee_pct_of_gross", "refund_pct_of_gross", "promotion_pct_of_gross", "margin_risk_score")
PLACEHOLDERS = ("", "unknown", "nan", "none", "custom")


def marketplace_matrix(df: DataFrame) -> DataFrame:
    return matrix_of(kernel.aggregate(df, ["transaction_month", "marketplace"], ("order_count",)))


def matrix_of(groups: DataFrame) -> DataFrame:
    return groups.select("transaction_month", "marketplace", "order_count", *METRICS)


def product_matrix(df: DataFrame) -> DataFrame:
    keys = ["transaction_month", "public_product_id", "marketplace", "brand_group", "category_group"]
    return kernel.aggregate(marts.products(df), keys, ()).select(*keys, *METRICS)


def periods(matrix: DataFrame) -> DataFrame:
    """Months with their activity, whether valid, and the place of the newest valid ones (1, 2)."""
    by = matrix.where(~F.lower(F.trim("transaction_month")).isin(*PLACEHOLDERS)).groupBy("transaction_month").agg(F.sum("order_count").alias("orders"))
    by = by.withColumn("valid", F.col("orders") > 0)
    newest = Window.partitionBy("valid").orderBy(F.desc("transaction_month"))  # one row per month
    by = by.withColumn("place", F.when(F.col("valid"), F.row_number().over(newest)))
    last = by.agg(F.max(F.when(F.col("valid"), F.col("transaction_month"))).alias("last"))
    return by.crossJoin(F.broadcast(last)).withColumn("excluded", ~F.col("valid") & (F.col("transaction_month") > F.col("last"))).drop("last")


def movement(metric: Column, change: Column) -> Column:
    worse = metric.isin(*WORSE_UP) == (change > 0)
    return F.when(F.abs(change) < 1e-9, "No Change").when(worse, "Deterioration").otherwise("Improvement")


def compare(matrix: DataFrame, chosen: DataFrame, dims: list[str]) -> DataFrame:
    """A row per member and metric for the two newest valid periods; absent members count as 0. One pass, no outer join."""
    pair = chosen.agg(F.max(F.when(F.col("place") == 1, F.col("transaction_month"))).alias("current_period"), F.max(F.when(F.col("place") == 2, F.col("transaction_month"))).alias("previous_period"))
    pair = pair.where("previous_period is not null")  # without two periods the comparison is empty, with its columns
    long = matrix.crossJoin(F.broadcast(pair)).where("transaction_month in (current_period, previous_period)")
    long = long.unpivot([*dims, "transaction_month", "current_period", "previous_period"], list(METRICS), "metric", "value")
    at = lambda c: F.coalesce(F.max(F.when(F.col("transaction_month") == F.col(c), F.col("value"))), F.lit(0.0))
    got = long.groupBy(*dims, "metric", "previous_period", "current_period").agg(at("previous_period").alias("previous_value"), at("current_period").alias("current_value"))
    change = F.col("current_value") - F.col("previous_value")
    got = got.withColumns({"absolute_variance": half_even(change, 2), "percentage_variance": half_even(F.try_divide(change, F.abs("previous_value")) * 100.0, 2)})
    total = F.sum(F.abs("absolute_variance").cast("decimal(18,2)")).over(Window.partitionBy("metric")).cast("double")
    got = got.withColumn("contribution_share", F.coalesce(half_even(F.abs("absolute_variance") / F.when(total > 0, total) * 100.0, 1), F.lit(0.0)))
    return got.withColumn("movement", movement(F.col("metric"), F.col("absolute_variance")))


def top_contributors(variance: DataFrame, dims: list[str], n: int = 3) -> DataFrame:
    """G05, K09."""
    order = Window.partitionBy("metric").orderBy(F.desc(F.abs("absolute_variance")), *dims)
    return variance.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def totals(variance: DataFrame) -> DataFrame:
    """Sums of levels, then their change."""
    s = lambda c: F.sum(F.col(c).cast("decimal(18,1)")).cast("double")
    got = variance.groupBy("metric", "previous_period", "current_period").agg(s("previous_value").alias("previous_total"), s("current_value").alias("current_total"))
    change = F.col("current_total") - F.col("previous_total")
    got = got.withColumns({"absolute_variance": half_even(change, 2), "percentage_variance": half_even(F.try_divide(change, F.abs("previous_total")) * 100.0, 2)})
    return got.withColumn("movement", movement(F.col("metric"), F.col("absolute_variance")))


def driver_summary(variance: DataFrame) -> DataFrame:
    """A row per headline metric with its total change and two largest contributors."""
    top = top_contributors(variance, ["marketplace"], 2)
    at = lambda k, c: F.max(F.when(F.col("rank") == k, F.col(c)))
    two = top.groupBy("metric").agg(at(1, "marketplace").alias("top_contributor"), at(1, "contribution_share").alias("top_share"), at(2, "marketplace").alias("second_contributor"), at(2, "contribution_share").alias("second_share"))
    return totals(variance).join(two, "metric")


# The metrics' labels.
LABELS = {
    "sales_index": "Sales Index", "units_index": "Units Index", "fee_pct_of_gross": "Fee % of Gross", "refund_pct_of_gross": "Refund % of Gross", "promotion_pct_of_gross": "Promotion % of Gross",
    "net_to_gross_pct": "Net-to-Gross %", "margin_risk_score": "Margin Risk Score", "revenue_quality_score": "Revenue Quality Score", "estimated_profitability_index": "Estimated Profitability Index",
}


def narrative(summary: DataFrame) -> DataFrame:
    """A sentence for each metric, of association, never of cause; none where the movement is negligible."""
    label = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv]), F.col("metric")), F.col("metric"))
    one = lambda c: F.format_string("%.1f", half_even(c, 1))
    change = F.col("absolute_variance")
    pct = F.coalesce(F.concat(one(F.abs("percentage_variance")), F.lit("%")), F.lit("an unquantified percentage change (previous period value was zero)"))
    pct = F.when(F.col("percentage_variance").isNull(), "an unquantified percentage change (previous period value was zero)").otherwise(pct)
    lead = F.concat(label, F.when(change > 0, " increased by ").otherwise(" decreased by "), one(F.abs(change)), F.lit(" points ("), pct, F.lit(") period-over-period, a "), F.lower("movement"), F.lit("."))
    detail = F.concat(F.lit(" "), F.col("top_contributor"), F.lit(" was associated with the largest share of this movement, contributing "), one(F.col("top_share")), F.lit("% of the total variance."))
    second = F.when(F.col("second_contributor").isNull(), "").otherwise(F.concat(F.lit(" "), F.col("second_contributor"), F.lit(" contributed a further "), one(F.col("second_share")), F.lit("%.")))
    nothing = F.concat(F.lit("No meaningful driver identified for "), label, F.lit("; period-over-period movement was negligible."))
    return summary.withColumn("narrative", F.when((F.abs(change) < 0.05) | F.col("top_contributor").isNull(), nothing).otherwise(F.concat(lead, detail, second)))


def excluded_message(months: list[str]) -> str:
    """What is said of trailing months without activity; empty where there are none."""
    if not months:
        return ""
    if len(months) == 1:
        return f"{months[0]} was excluded from period comparison because it contains no transaction activity."
    return f"{', '.join(months[:-1])} and {months[-1]} were excluded from period comparison because they contain no transaction activity."


def excluded_text(months: Column) -> Column:
    """K06 for a sorted array of months."""
    said = F.array_join(F.slice(months, 1, F.greatest(F.size(months) - 1, F.lit(0))), ", ")
    many = F.concat(said, F.lit(" and "), F.element_at(months, -1), F.lit(" were excluded from period comparison because they contain no transaction activity."))
    one = F.concat(F.get(months, 0), F.lit(" was excluded from period comparison because it contains no transaction activity."))
    return F.when(F.size(months) == 0, "").when(F.size(months) == 1, one).otherwise(many)


def driver_report(matrix: DataFrame) -> DataFrame:
    """A row for each headline metric, or one that says why two periods can't be compared. Which of both is decided
    by the data, inside the plan: the months' activity is one row, joined to the metrics and alone."""
    chosen = periods(matrix)
    valid = F.col("valid")
    one = chosen.agg(F.count_if(valid).alias("n"), F.max(F.when(valid, F.col("transaction_month"))).alias("last"), F.array_sort(F.collect_list(F.when(F.col("excluded"), F.col("transaction_month")))).alias("gone"))  # a few months
    one = one.withColumns({"excluded_trailing_periods": F.array_join("gone", ", "), "note": excluded_text(F.col("gone"))})
    found = narrative(driver_summary(compare(matrix, chosen, ["marketplace"])))
    label = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv]), F.col("metric")), F.col("metric"))
    found = found.join(F.broadcast(one.where("n >= 2").select("excluded_trailing_periods")), how="cross").select(
        "metric", label.alias("metric_label"), "previous_period", "current_period", F.col("absolute_variance").alias("total_abs_variance"), F.col("percentage_variance").alias("total_pct_variance"), "movement", "narrative", "excluded_trailing_periods",
    )
    # The wordings.
    single = F.concat(F.lit("Only one transaction month with recorded activity is available ("), F.col("last"), F.lit("); at least two are required for a period-over-period comparison."))
    none = F.lit("No transaction months with recorded activity are present in this dataset, so no period-over-period comparison is available.")
    why = F.when(F.col("n") == 1, single).otherwise(none)
    lone = one.where("n < 2").select(
        *[F.lit("n/a").alias(c) for c in ("metric", "metric_label", "previous_period", "current_period")], F.lit(None).cast("double").alias("total_abs_variance"), F.lit(None).cast("double").alias("total_pct_variance"),
        F.lit("Insufficient Periods").alias("movement"), F.concat(why, F.when(F.col("note") != "", F.concat(F.lit(" "), F.col("note"))).otherwise("")).alias("narrative"), "excluded_trailing_periods",
    )
    return found.unionByName(lone)
