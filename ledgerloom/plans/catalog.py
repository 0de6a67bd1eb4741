"""Every named query with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.operators import checks, marts, master, star, variance
from ledgerloom.plans import exports, operations, oracle, reports
from ledgerloom.sources import tables


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


def _on(f: Callable[[DataFrame], DataFrame], source: Callable = marts.rows) -> Callable:
    return lambda spark, sf_dir: f(source(spark, sf_dir))


def _product(f: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable:
    return lambda spark, sf_dir: f(marts.product_mart(spark, sf_dir))


RATIO_SQL = ", ".join(f"{a} as {b}" for a, b in marts.RATIOS.items())
SCORE_SQL = "margin_risk_score, revenue_quality_score"
PRODUCT_SQL = ", ".join([*marts.PRODUCT_KEYS, *marts.PRODUCT_METRICS, *marts.ACTION])
REVIEW_KEYS = "public_product_id, marketplace, brand_group, category_group, product_group"
MARTS = {
    "mart_marketplace_summary": Query(_on(marts.marketplace_summary), oracle.sql(f"select dataset_period, transaction_month, marketplace, order_count as total_orders, product_count, sales_index, units_index, {RATIO_SQL}, {SCORE_SQL} from mp")),
    "mart_channel_performance": Query(_on(marts.channel_performance), oracle.sql(f"""select dataset_period, marketplace, channel, product_count, order_count_index, sales_index, units_index, {RATIO_SQL}, margin_risk_score as avg_margin_risk_score, revenue_quality_score as avg_revenue_quality_score,
        (select count(distinct public_product_id) from prod r where r.action_priority = 'High' and r.marketplace = ch.marketplace and r.channel = ch.channel) as high_priority_action_count from ch where product_count > 0 or sales_index > 0""")),
    "mart_product_performance": Query(_product(), oracle.sql(f"select {PRODUCT_SQL} from pp")),
    "mart_category": Query(_on(marts.category_performance), oracle.sql(f"select dataset_period, marketplace, category_group, subcategory_group, product_count, sales_index, units_index, {RATIO_SQL}, {SCORE_SQL} from cat")),
    "mart_brand": Query(_on(marts.brand_performance), oracle.sql(f"select dataset_period, marketplace, brand_group, category_group, product_count, sales_index, units_index, {RATIO_SQL}, {SCORE_SQL} from brd")),
    "mart_fulfillment": Query(_on(marts.fulfillment_comparison), oracle.sql(f"select dataset_period, fulfillment_type, product_count, order_count, sales_index, units_index, fee_pct_of_gross as avg_fee_pct_of_gross, refund_pct_of_gross as avg_refund_pct_of_gross, net_to_gross_pct as avg_net_to_gross_pct, {SCORE_SQL} from ful")),
    "mart_profitability": Query(_on(marts.profitability_summary), oracle.sql(f"select dataset_period, marketplace, category_group, brand_group, product_group, margin_band_public, profitability_band_public, product_count, sales_index, units_index, margin_index, estimated_profitability_index, {SCORE_SQL}, margin_risk_band, revenue_quality_band from pro")),
    "mart_fee_refund_flags": Query(_product(marts.fee_refund_summary), oracle.sql(f"""select {REVIEW_KEYS}, fee_pct_of_gross, refund_pct_of_gross, promotion_pct_of_gross, net_to_gross_pct, revenue_quality_score, revenue_quality_band,
        case when fee_pct_of_gross >= 25 then 'Review' else 'Monitor' end as fee_review_flag, case when refund_pct_of_gross >= 10 then 'Review' else 'Monitor' end as refund_review_flag,
        case when promotion_pct_of_gross >= 10 and net_to_gross_pct < 70 then 'Review' else 'Monitor' end as promotion_review_flag from pp""")),
    "mart_margin_risk": Query(_product(marts.margin_risk_review), oracle.sql(f"select {REVIEW_KEYS}, listing_price_band, inventory_band, {', '.join(marts.PRODUCT_METRICS[:6])}, margin_risk_score, margin_risk_band, revenue_quality_score, {', '.join(marts.ACTION)} from pp")),
    "mart_inventory_action": Query(lambda s, d: marts.inventory_action_review(marts.rows(s, d), marts.product_mart(s, d)), oracle.sql(f"""select {REVIEW_KEYS}, inventory_band, units_index, sales_index, margin_risk_band, revenue_quality_band, restock_priority, {', '.join(marts.ACTION)}
        from pp left join (select distinct {REVIEW_KEYS}, inventory_band, restock_priority from prod) c using ({REVIEW_KEYS}, inventory_band)""")),
    "mart_product_action": Query(_product(marts.product_action_review), oracle.sql(f"select {PRODUCT_SQL} from pp")),
}


def _vm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variance.marketplace_matrix(marts.rows(spark, sf_dir))


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = _vm(spark, sf_dir)
    return variance.compare(matrix, variance.periods(matrix), ["marketplace"])


def _compared_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = marts.rows(spark, sf_dir)
    return variance.compare(variance.product_matrix(df), variance.periods(variance.marketplace_matrix(df)), ["public_product_id", "marketplace", "brand_group", "category_group"])


TOTAL_SQL = f"""tot as (select metric, previous_period, current_period, sum(previous_value::decimal(18,1))::double as previous_total, sum(current_value::decimal(18,1))::double as current_total from vmc group by all),
totv as (select *, round_even(current_total - previous_total, 2) as absolute_variance, round_even((current_total - previous_total) / nullif(abs(previous_total), 0) * 100.0::double, 2) as percentage_variance from tot),
totals as (select *, {oracle.moved("absolute_variance")} as movement from totv),
ranked as (select *, row_number() over (partition by metric order by abs(absolute_variance) desc, marketplace) as rank from vmc)"""
VARIANCES = {
    "variance_periods": Query(_on(variance.periods, _vm), oracle.sql("select transaction_month, orders, valid, place, excluded from periods", oracle.VARIANCE)),
    "variance_marketplace": Query(_compared, oracle.sql("select * from vmc", oracle.VARIANCE)),
    "variance_product": Query(_compared_products, oracle.sql("select * from vpc", oracle.VARIANCE)),
    "variance_top_contributors": Query(lambda s, d: variance.top_contributors(_compared(s, d), ["marketplace"]), oracle.sql("select * from ranked where rank <= 3", f"{oracle.VARIANCE}, {TOTAL_SQL}")),
    "variance_driver_summary": Query(lambda s, d: variance.driver_summary(_compared(s, d)), oracle.sql("""select t.*, max(case when rank = 1 then marketplace end) as top_contributor, max(case when rank = 1 then contribution_share end) as top_share,
        max(case when rank = 2 then marketplace end) as second_contributor, max(case when rank = 2 then contribution_share end) as second_share from totals t join ranked r on r.metric = t.metric group by all""", f"{oracle.VARIANCE}, {TOTAL_SQL}")),
}


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.lines(spark, sf_dir)


def _coverage(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.count_if(F.col("transaction_type_group") == "Order").alias("order_rows"), F.count("sku").alias("rows_with_sku"), F.count_if(F.col("mapping_status") == "Matched").alias("matched_rows"), F.count_if(F.col("mapping_status") == "Unmatched").alias("unmatched_rows"), F.count_distinct(F.when(F.col("mapping_status") == "Matched", F.col("sku"))).alias("matched_skus"))


FIELDS = [
    checks.Field("sku", required=True), checks.Field("order_id", required=True), checks.Field("marketplace", allowed=("amazon.in", "Flipkart", "MEESHO", "Jio Mart")),
    checks.Field("quantity", "number", least=1, most=45), checks.Field("product_sales", "number", least=0, range_severity="reject"),
]
CONTRACT_SQL = """checked as (select *, list_filter([
    case when sku is null then {'field': 'sku', 'code': 'missing_required_field', 'severity': 'reject'} end,
    case when marketplace not in ('amazon.in', 'Flipkart', 'MEESHO', 'Jio Mart') then {'field': 'marketplace', 'code': 'unknown_value', 'severity': 'warn'} end,
    case when quantity < 1 or quantity > 45 then {'field': 'quantity', 'code': 'out_of_range', 'severity': 'warn'} end,
    case when product_sales < 0 then {'field': 'product_sales', 'code': 'out_of_range', 'severity': 'reject'} end], lambda x: x is not null) as v from txn)"""


def _contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.violations(tables.transactions(spark, sf_dir), FIELDS, ["order_id"])


def _privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.pattern_counts(tables.read(spark, sf_dir, "documents"), ["text", "source"])


# The shapes as DuckDB writes them.
SHAPES = {"asin_like_values": r"\b[Bb]0[A-Za-z0-9]{8}\b", "order_id_like_values": r"(?i)\b(?:ORDER|ORD|AMZ|FLP|MEE|JIO|WEB)[-_]?[A-Z0-9-]{4,}\b", "postal_code_like_values": r"\b[1-9][0-9]{5}\b", "currency_marker_values": r"(?i)(?:₹|\bINR\b|\bRS\.?\b)"}
PRIVACY_SQL = "\nunion all\n".join(
    [f"select '{c}' as column_name, '{n}' as pattern, sum(len(regexp_extract_all(coalesce({c}, ''), {oracle.q(p)})))::bigint as hits from documents" for c in ("text", "source") for n, p in SHAPES.items()]
    + [rf"select '{c}' as column_name, 'long_title_like_values' as pattern, count(*) filter (where regexp_matches({c}, '[\pL\pN_]+\s+[\pL\pN_]+\s+[\pL\pN_]+\s+[\pL\pN_]+\s+[\pL\pN_]+')) as hits from documents" for c in ("text", "source")]
)


def _star(f: Callable) -> Callable:
    return lambda spark, sf_dir: f(star.load(spark, sf_dir))


ROW_QUERIES = {
    "txn_amounts": Query(lambda s, d: master.amounts(tables.transactions(s, d)).groupBy("transaction_month", "marketplace", "fulfillment_type", "transaction_type_group").agg(*[F.sum(c).cast("double").alias(c) for c in ("gross", "refund", "promo", "fee", "net", "units")]), oracle.sql("select transaction_month, marketplace, fulfillment_type, transaction_type_group, " + ", ".join(f"sum({c})::double as {c}" for c in ("gross", "refund", "promo", "fee", "net", "units")) + " from amounts group by all", oracle.BASE)),
    "std_groups": Query(lambda s, d: master.amounts(tables.transactions(s, d)).groupBy("transaction_type_group", "fulfillment_type", "marketplace", "state_group").agg(F.count("*").alias("rows")), oracle.sql("select transaction_type_group, fulfillment_type, marketplace, state_group, count(*) as rows from amounts group by all", oracle.BASE)),
    "band_price_inventory": Query(lambda s, d: tables.product_master(s, d).select("seller_sku", text.price_band(F.col("price")).alias("price_band"), text.inventory_band(F.col("quantity")).alias("inventory_band"), text.origin(F.col("origin_country")).alias("origin_group")), oracle.sql(f"select seller_sku, {oracle.band('price', oracle.PRICE_BAND, '4000+')} as price_band, {oracle.band('quantity', oracle.STOCK_BAND, 'Very High / 100+')} as inventory_band, case when origin_country is null then 'Unknown' when origin_country = 'India' then 'India' else 'Imported / Other' end as origin_group from product_master", oracle.BASE)),
    "public_id_generation": Query(lambda s, d: master.with_public_ids(tables.product_master(s, d)).select("seller_sku", "public_product_id"), oracle.sql("select seller_sku, pid as public_product_id from ids", oracle.BASE)),
    "join_product_match": Query(lambda s, d: _lines(s, d).groupBy("public_product_id", "mapping_status", "brand_group", "product_group").agg(F.count("*").alias("rows"), F.sum("profit").cast("double").alias("profit")), oracle.sql("select public_product_id, mapping_status, brand_group, product_group, count(*) as rows, sum(profit)::double as profit from lines group by all", oracle.BASE)),
    "join_coverage_metrics": Query(_on(_coverage, _lines), oracle.sql("select count(*) as rows, count(*) filter (where transaction_type_group = 'Order') as order_rows, count(sku) as rows_with_sku, count(*) filter (where mapping_status = 'Matched') as matched_rows, count(*) filter (where mapping_status = 'Unmatched') as unmatched_rows, count(distinct case when mapping_status = 'Matched' then sku end) as matched_skus from lines", oracle.BASE)),
    "row_metrics": Query(lambda s, d: marts.rows(s, d).select("order_id", "public_product_id", "transaction_month", *marts.PRODUCT_METRICS, "margin_band_public"), oracle.sql(f"select order_id, public_product_id, transaction_month, {', '.join(marts.PRODUCT_METRICS)}, margin_band_public from rowa", oracle.ROWS)),
    "row_actions": Query(_on(lambda df: df.groupBy("marketplace", *marts.ACTION).agg(F.count("*").alias("rows"))), oracle.sql(f"select marketplace, {', '.join(marts.ACTION)}, count(*) as rows from rowa group by all", oracle.ROWS)),
    "contract_violations_by_code": Query(_on(checks.quarantine_summary, _contract), oracle.sql("select x.field as field, x.code as code, x.severity as severity, count(*) as records from (select unnest(v) as x from checked) group by all", f"{oracle.BASE}, {CONTRACT_SQL}")),
    "contract_accepted_rows": Query(_on(lambda df: checks.accepted(df).groupBy("type", "marketplace").agg(F.count("*").alias("rows")), _contract), oracle.sql("select type, marketplace, count(*) as rows from checked where len(list_filter(v, lambda x: x.severity = 'reject')) = 0 group by all", f"{oracle.BASE}, {CONTRACT_SQL}")),
    "privacy_pattern_counts": Query(_privacy, PRIVACY_SQL),
    "privacy_known_values": Query(lambda s, d: checks.known_values(tables.read(s, d, "documents"), "text", tables.read(s, d, "benchmark"), "text").select("doc_id"), "select doc_id from documents where trim(text) in (select trim(text) from benchmark where trim(text) <> '')"),
}


STAR = {name: Query(reports.run(name), reports.duck(text)) for name, text in (reports.REPORTS | {n: t for n, (_, t) in reports.FRAMES.items()}).items()} | {
    "dim_uniqueness": Query(_star(star.duplicates), reports.duck(" union all ".join(f"select '{t}' as dimension, (select count(*) from (select {', '.join(k)} from {t} group by all having count(*) > 1)) as duplicates" for t, k in star.NATURAL_KEYS))),
    "fk_orphans": Query(_star(star.orphans), reports.duck(" union all ".join(f"select '{f}' as fact, '{c}' as fact_column, (select count(*) from {f} where {c} not in (select {k} from {d})) as orphans" for f, c, d, k in star.FOREIGN_KEYS))),
    "reconciliation": Query(_star(star.reconciliation), reports.duck("select *, source_rows - target_rows as difference, case when source_rows = target_rows then 'OK' else 'MISMATCH' end as status from ("
        + " union all ".join(f"select '{a}' as source_name, (select count(*) from {'audit_dataset_profile' if a == 'dataset_profile' else a}) as source_rows, '{b}' as target_table, (select count(*) from {b}) as target_rows" for a, b in star.LOADS) + ")")),
    "v4_forbidden_columns": Query(_star(star.forbidden_columns), "select table_name, column_name from (select 'x' as table_name, 'y' as column_name) where false"),
}

PRODUCT_FILTERS = {
    "dash_candidates_fee": ("fee_pct_of_gross >= 25", "fee_pct_of_gross desc, sales_index desc"),
    "dash_candidates_refund": ("recommended_action = 'Refund Review'", "refund_pct_of_gross desc, sales_index desc"),
    "dash_candidates_promo": ("recommended_action = 'Promotion Review'", "promotion_pct_of_gross desc, sales_index desc"),
    "dash_candidates_weak": ("revenue_quality_score < 45", "revenue_quality_score, sales_index desc"),
    "dash_candidates_risk": ("sales_index >= 50 and margin_risk_score >= 45", "margin_risk_score desc, sales_index desc"),
    "dash_candidates_slow": ("units_index < 10 and lower(inventory_band) like '%high%'", "units_index, sales_index desc"),
    "dash_top_margin_risk": ("true", "margin_risk_score desc, sales_index desc"),
}
KEYS_SQL = ", ".join(marts.PRODUCT_KEYS)


def _filtered(test: str, order: str, n: int | None) -> Query:
    """Filtered products; with a limit only where the page shows a top-k. All keys break ties."""
    run = _product(lambda df: df.where(test).orderBy(*[F.expr(x.removesuffix(" desc")).desc() if x.endswith(" desc") else F.expr(x).asc() for x in order.split(", ")], *marts.PRODUCT_KEYS).select(*marts.PRODUCT_KEYS, *marts.PRODUCT_METRICS, *marts.ACTION))
    whole = run
    run = (lambda spark, sf_dir: whole(spark, sf_dir).limit(n)) if n else whole
    return Query(run, oracle.sql(f"select {PRODUCT_SQL} from pp where {test} order by {order}, {KEYS_SQL}" + (f" limit {n}" if n else "")))


MEASURES = {
    "total_products": ("count(distinct public_product_id)", "count(distinct public_product_id)"),
    "marketplaces": ("count(distinct marketplace)", "count(distinct marketplace)"),
    "recommended_action_rows": ("count(*)", "count(*)"),
    "high_priority_products": ("count(distinct case when action_priority = 'High' then public_product_id end)",) * 2,
} | {f"{a.lower().replace(' ', '_')}_rows": (f"count(case when recommended_action = '{a}' then 1 end)",) * 2 for a in ("Fee Review", "Refund Review", "Restock Review", "Revenue Quality Review", "Monitor")}
MEASURES |= {f"average_{c}": (f"rint(try_divide(cast(sum(cast({c} as decimal(12,1))) as double), count({c})) * 1e6D) / 1e6D", f"round_even(sum({c}::decimal(12,1))::double / nullif(count({c}), 0), 6)") for c in ("sales_index", "units_index", "fee_pct_of_gross", "refund_pct_of_gross", "promotion_pct_of_gross", "net_to_gross_pct", "margin_index", "estimated_profitability_index", "margin_risk_score", "revenue_quality_score")}


def measures(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """Every measure for any slice."""
    return df.groupBy(*by).agg(*[F.expr(e).alias(n) for n, (e, _) in MEASURES.items()])


MEASURE_SQL = ", ".join(f"{e} as {n}" for n, (_, e) in MEASURES.items())
DASH = {k: _filtered(t, o, None if k.endswith(("weak", "risk")) and k != "dash_top_margin_risk" else 10) for k, (t, o) in PRODUCT_FILTERS.items()} | {
    "dash_action_counts": Query(_product(lambda df: df.groupBy("recommended_action", "action_priority").agg(F.count("*").alias("rows"))), oracle.sql("select recommended_action, action_priority, count(*) as rows from pp group by all")),
    "bi_measures_total": Query(_product(measures), oracle.sql(f"select {MEASURE_SQL} from pp")),
    "bi_measures_by_marketplace": Query(_product(lambda df: measures(df, ["marketplace"])), oracle.sql(f"select marketplace, {MEASURE_SQL} from pp group by marketplace")),
    "duplicate_skus": Query(lambda sp, d: tables.product_master(sp, d).agg((F.count("seller_sku") - F.count_distinct("seller_sku")).alias("duplicates")), oracle.sql("select count(seller_sku) - count(distinct seller_sku) as duplicates from product_master", oracle.BASE)),
    "sku_overlap": Query(lambda sp, d: tables.product_master(sp, d).select(F.col("seller_sku").alias("sku")).distinct().join(tables.transactions(sp, d).where("sku is not null").select("sku", F.lit(1).alias("t")).distinct(), "sku", "full").agg(F.count("t").alias("transaction_skus"), F.count_if(F.col("t").isNull()).alias("unmatched_listings")), oracle.sql("select (select count(distinct sku) from txn) as transaction_skus, (select count(distinct seller_sku) from product_master where seller_sku not in (select sku from txn where sku is not null)) as unmatched_listings", oracle.BASE)),
    "cleaning_metrics": Query(lambda sp, d: tables.product_master(sp, d).agg(F.count("*").alias("rows"), F.count_if(F.col("brand").isNull()).alias("missing_brand"), F.count_if(F.col("origin_country").isNull()).alias("missing_origin"), F.count_if(F.col("public_product_id").isNull()).alias("missing_id"), F.count_distinct("seller_sku").alias("skus")), oracle.sql("select count(*) as rows, count(*) filter (where brand is null) as missing_brand, count(*) filter (where origin_country is null) as missing_origin, count(*) filter (where public_product_id is null) as missing_id, count(distinct seller_sku) as skus from product_master", oracle.BASE)),
    "ratio_and_activity_checks": Query(_product(lambda df: df.agg(*[e for c in marts.PRODUCT_METRICS[:6] for e in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))], F.max(F.col("sales_index") > 0).alias("active"))), oracle.sql("select " + ", ".join(f"min({c}) as {c}_min, max({c}) as {c}_max" for c in marts.PRODUCT_METRICS[:6]) + ", max(sales_index > 0) as active from pp")),
}

NARRATIVE_SQL = """select t.metric, case when abs(t.absolute_variance) < 0.05 or n.top_contributor is null then 'No meaningful driver identified for ' || l.label || '; period-over-period movement was negligible.'
    else l.label || case when t.absolute_variance > 0 then ' increased by ' else ' decreased by ' end || printf('%.1f', round_even(abs(t.absolute_variance), 1)) || ' points ('
      || case when t.percentage_variance is null then 'an unquantified percentage change (previous period value was zero)' else printf('%.1f', round_even(abs(t.percentage_variance), 1)) || '%' end || ') period-over-period, a ' || lower(t.movement) || '. '
      || n.top_contributor || ' was associated with the largest share of this movement, contributing ' || printf('%.1f', n.top_share) || '% of the total variance.'
      || case when n.second_contributor is null then '' else ' ' || n.second_contributor || ' contributed a further ' || printf('%.1f', n.second_share) || '%.' end end as narrative
  from totals t join (select metric, max(case when rank = 1 then marketplace end) as top_contributor, max(case when rank = 1 then contribution_share end) as top_share,
        max(case when rank = 2 then marketplace end) as second_contributor, max(case when rank = 2 then contribution_share end) as second_share from ranked group by metric) n using (metric)
  join (values ('sales_index', 'Sales Index'), ('units_index', 'Units Index'), ('fee_pct_of_gross', 'Fee % of Gross'), ('refund_pct_of_gross', 'Refund % of Gross'), ('promotion_pct_of_gross', 'Promotion % of Gross'), ('net_to_gross_pct', 'Net-to-Gross %'),
    ('margin_risk_score', 'Margin Risk Score'), ('revenue_quality_score', 'Revenue Quality Score'), ('estimated_profitability_index', 'Estimated Profitability Index')) l(metric, label) using (metric)"""
VARIANCES["variance_narrative"] = Query(lambda s, d: variance.narrative(variance.driver_summary(_compared(s, d))).select("metric", "narrative"), oracle.sql(NARRATIVE_SQL, f"{oracle.VARIANCE}, {TOTAL_SQL}"))

DRIVER_SQL = f"""select 'all' as scope, t.metric, l.label as metric_label, t.previous_period, t.current_period, t.absolute_variance as total_abs_variance, t.percentage_variance as total_pct_variance, t.movement, n.narrative,
    (select coalesce(string_agg(transaction_month, ', ' order by transaction_month), '') from periods where excluded) as excluded_trailing_periods
    from totals t join ({NARRATIVE_SQL}) n using (metric) join (values {", ".join(f"('{k}', '{v}')" for k, v in variance.LABELS.items())}) l(metric, label) using (metric)
  union all select 'first month', 'n/a', 'n/a', 'n/a', 'n/a', null, null, 'Insufficient Periods', 'Only one transaction month with recorded activity is available (' || min(transaction_month) || '); at least two are required for a period-over-period comparison.', '' from months having min_by(orders, transaction_month) > 0
  union all select 'without orders', 'n/a', 'n/a', 'n/a', 'n/a', null, null, 'Insufficient Periods', 'No transaction months with recorded activity are present in this dataset, so no period-over-period comparison is available.', ''"""
OPERATIONS = {name: Query(run, sql) for name, (run, sql) in (operations.queries() | exports.queries(operations.CHANNELS)).items()}
OPERATIONS["variance_driver_report"] = Query(operations.driver_reports, oracle.sql(DRIVER_SQL, f"{oracle.VARIANCE}, {TOTAL_SQL}"))
QUERIES: dict[str, Query] = MARTS | VARIANCES | ROW_QUERIES | STAR | DASH | OPERATIONS
