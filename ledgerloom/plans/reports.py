"""Reports on the star schema and the marts.

Views, reconciliations and the analyses of performance and of root causes are DataFrames over the star, with SQL of their own
to check them. The plainer reports are one SQL text over named tables, in words that Spark and DuckDB share. In DuckDB the
tables are a chain of common table expressions written on its own, so that a text agrees only where marts and star do.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import marts, star
from ledgerloom.plans import oracle

RATIOS = "fee_pct_of_gross as avg_fee_pct_of_gross, refund_pct_of_gross as avg_refund_pct_of_gross, promotion_pct_of_gross as avg_promotion_pct_of_gross, net_to_gross_pct as avg_net_to_gross_pct"
ATTRIBUTES = ", ".join(star.ATTRIBUTES)
PERFORMANCE = ", ".join(star.PERFORMANCE)
REVIEW = "public_product_id, marketplace, brand_group, category_group, product_group, inventory_band"
ACTIVITY, INVENTORY, DRIVERS = (", ".join(x) for x in (star.ACTIVITY, star.INVENTORY, star.DRIVERS))
UNKNOWN = ", ".join(f"'Unknown' as {c}" for c in ["public_product_id", *ATTRIBUTES.split(", ")])
OUTPUTS = star.OUTPUTS


def _fact(name: str, given: str, keys: str, values: str) -> str:
    return f"{name} as (select row_number() over (order by {keys}, {values}) as fact_key, {keys}, {values} from {given})"


def _check_rows() -> str:
    """The checks of an upload over the one row of counts."""
    some = lambda c, otherwise="FAIL": f"case when {c} > 0 then 'PASS' else '{otherwise}' end"
    safe = [(f"No {w} in public outputs", "case hits when 0 then 'PASS' else 'FAIL' end", "hits", "0 content hits", "") for w in ("ASIN-like values", "known SKU values", "order-ID-like values", "postal-code-like values", "raw rupee amount leakage")]
    fixed = lambda name, value: (name, "'PASS'", f"'{value}'", "present", "")
    more = "nonzero when transactions contain sales activity"
    rows = [
        ("Raw product master loaded", some("products"), "products", "> 0", ""), ("Marketplace master loaded", some("channel_rows", "WARN"), "channel_rows", "> 0 for 5-marketplace mode", ""),
        ("All 5 marketplaces present", "case when channel_markets >= 5 then 'PASS' when channel_markets > 0 then 'WARN' else 'FAIL' end", "channel_markets", "5", ""), ("Each product has 5 marketplace rows", "case when fewer = 0 then 'PASS' else 'WARN' end", "fewer", "0 missing", ""),
        ("Raw transaction report loaded", some("lines"), "lines", "> 0", ""), ("Dataset period detected", "'PASS'", "'12M / 120K Orders'", "known or custom", ""), ("Transaction row count valid", some("lines"), "lines", "> 0", ""),
        ("Order row count valid", some("orders", "WARN"), "orders", "> 0 order rows", ""), ("SKU column detected", some("with_sku"), "with_sku", "> 0 rows with SKU", ""), ("Marketplace column detected", some("markets", "WARN"), "markets", "> 0 marketplaces", ""),
        ("SKU join coverage calculated", "'PASS'", "coalesce(round_even(matched / nullif(with_sku, 0)::double * 100.0::double, 2), 0.0::double)", "calculated", ""),
        ("Marketplace-channel mapping status", "'WARN'", "'Unavailable'", "available mapping keys", "Marketplace-channel enrichment is unavailable because Marketplace_Channel_Master mapping keys are incomplete."),
        ("Unmatched SKUs counted", "'PASS'", "strange", "calculated", "Only counts are shown; SKU values are private."), ("Duplicate SKUs counted", "'PASS'", "repeated", "calculated", ""), ("Public outputs generated", some("public_rows"), "public_rows", "> 0 rows", ""),
        ("No sensitive columns in public outputs", "'PASS'", "'safe'", "safe", ""), *safe, fixed("Indexes generated", "sales_index, units_index"),
        ("Public sales indexes contain activity", "case public_active when 'True' then 'PASS' else 'WARN' end", "public_active", more, ""), ("Aggregated sales indexes contain activity", "case active when 'True' then 'PASS' else 'WARN' end", "active", more, ""),
        fixed("Ratios generated", "fee/refund/promotion/net ratios"), *[fixed(f"{w} generated", c) for w, c in (("Profitability bands", "profitability_band_public"), ("Margin risk scores", "margin_risk_score"), ("Revenue quality scores", "revenue_quality_score"))],
        ("Recommended actions generated", some("action_rows"), "action_rows", "> 0 rows", ""), fixed("Dataset profile includes display label", "dataset_label"),
    ]
    return " union all ".join(f"select {k} as audit_key, '{n}' as check_name, {s} as check_status, ({v})::varchar as check_value, '{e}' as expected_value, '{w}' as notes from one" for k, (n, s, v, e, w) in enumerate(rows, 1))


_CHECKS = _check_rows()
_PUBLIC = ", ".join("'Unknown' as channel_margin_band_public" if c == "channel_margin_band_public" else c for c in marts.PUBLIC)
TABLES = f"""
anonymized_master as (select {_PUBLIC} from rowa),
marketplace_summary as (select dataset_period, transaction_month, marketplace, order_count as total_orders, product_count, sales_index, units_index, {RATIOS}, margin_risk_score, revenue_quality_score from mp),
marketplace_channel_performance as (select dataset_period, marketplace, channel, product_count, order_count_index, sales_index, units_index, {RATIOS}, margin_risk_score as avg_margin_risk_score, revenue_quality_score as avg_revenue_quality_score,
    (select count(distinct public_product_id) from prod r where r.action_priority = 'High' and r.marketplace = ch.marketplace and r.channel = ch.channel) as high_priority_action_count from ch where product_count > 0 or sales_index > 0),
product_performance as (select * from pp), product_action_review as (select * from pp), margin_risk_review as (select * from pp), fee_refund_summary as (select * from pp),
category_performance as (select * from cat), brand_performance as (select * from brd), fulfillment_comparison as (select * from ful),
profitability_summary as (select * from pro),
inventory_action_review as (select {REVIEW}, units_index, sales_index, margin_risk_band, revenue_quality_band, restock_priority, recommended_action, action_priority, action_reason
    from pp left join (select distinct {REVIEW}, restock_priority from prod) c using ({REVIEW})),
mart_marketplace_variance_drivers as (select * from vmc), mart_performance_driver_summary as (select distinct metric from vmc),
dim_product as (select 0 as product_key, {UNKNOWN} union all
    select row_number() over (order by public_product_id), public_product_id, {", ".join(f"a.{c}" for c in ATTRIBUTES.split(", "))} from (select public_product_id, min({{{", ".join(f"'{c}': {c}" for c in ATTRIBUTES.split(", "))}}}) as a from pp group by 1)),
dim_marketplace as (select 0 as marketplace_key, 'Unknown' as marketplace, 'Marketplace' as channel union all
    select row_number() over (order by marketplace), marketplace, 'Marketplace' from (select marketplace from mp union select marketplace from pp union select marketplace from vmc) where marketplace <> 'Unknown'),
dim_month as (select 0 as month_key, 'Unknown' as transaction_month, null::int as year, null::int as month_number, 'Unknown' as month_name, null::int as quarter, 'Unknown' as year_month, '12m' as dataset_period union all
    select row_number() over (order by m), m, m[1:4]::int, m[6:7]::int, monthname((m || '-01')::date), (m[6:7]::int + 2) // 3, m, '12m' from (select distinct transaction_month as m from mp)),
dim_fulfillment as (select 0 as fulfillment_key, 'Unknown' as fulfillment_type union all select row_number() over (order by fulfillment_type), fulfillment_type from (select distinct fulfillment_type from pp)),
fma as (select coalesce(month_key, 0) as month_key, coalesce(marketplace_key, 0) as marketplace_key, {ACTIVITY} from marketplace_summary left join dim_month using (transaction_month) left join dim_marketplace using (marketplace)),
{_fact("fact_marketplace_activity", "fma", "month_key, marketplace_key", ACTIVITY)},
fpp as (select product_key, coalesce(marketplace_key, 0) as marketplace_key, {PERFORMANCE} from pp left join (select product_key, public_product_id from dim_product) using (public_product_id) left join dim_marketplace using (marketplace)),
fpp2 as (select row_number() over (order by product_key, marketplace_key, {PERFORMANCE}) as fact_key, * from fpp),
fact_product_performance as (select *, '12m' as dataset_period from fpp2),
fia as (select product_key, coalesce(marketplace_key, 0) as marketplace_key, {INVENTORY} from inventory_action_review left join (select product_key, public_product_id from dim_product) using (public_product_id) left join dim_marketplace using (marketplace)),
{_fact("fact_inventory_action", "fia", "product_key, marketplace_key", INVENTORY)},
fpv as (select coalesce(m.marketplace_key, 0) as marketplace_key, metric, p.month_key as previous_month_key, c.month_key as current_month_key, previous_value, current_value, absolute_variance as abs_variance, percentage_variance as pct_variance, contribution_share as contribution_share_pct, movement
    from vmc v left join dim_marketplace m on m.marketplace = v.marketplace join dim_month p on p.transaction_month = v.previous_period join dim_month c on c.transaction_month = v.current_period),
fact_performance_variance as (select row_number() over (order by marketplace_key, metric) as fact_key, * from fpv),
audit_dataset_profile as ({" union all ".join(f"select {k + 1} as audit_key, '{n}' as public_output_name, count(*) as row_count, '12m' as dataset_period, '12M / 120K Orders' as dataset_label from {n}" for k, n in enumerate(OUTPUTS))}),
counted as (select count(*) as lines, count(*) filter (where transaction_type_group = 'Order') as orders, count(sku) as with_sku, count(distinct marketplace) as markets, count(*) filter (where mapping_status = 'Matched') as matched, count(distinct case when mapping_status = 'Unmatched' then sku end) as strange from lines),
sheet as (select 'SKU-' || p_partkey as seller_sku, k, p_partkey % 19 = k as again from part, range(5) r(k) where (p_partkey + k) % 13 > 0),
sheet_counts as (select sum(1 + again::int) as channel_rows, count(distinct k) as channel_markets, (select count(*) from (select seller_sku from sheet group by 1 having count(distinct k) < 5)) as fewer from sheet),
one as (select *, (select count(*) from product_master) as products, (select count(seller_sku) - count(distinct seller_sku) from product_master) as repeated, (select count(*) from rowa) as public_rows, (select count(*) from pp) as action_rows,
    case when (select max(sales_index) from rowa) > 0 then 'True' else 'False' end as public_active, case when (select max(sales_index) from pp) > 0 then 'True' else 'False' end as active,
    (select count(*) filter (where regexp_matches(brand_group || '|' || category_group || '|' || subcategory_group || '|' || product_group || '|' || state_group, '(?i)\\b(b0[a-z0-9]{{8}}|[1-9][0-9]{{5}}|(order|ord|amz|flp|mee|jio|web)[-_]?[a-z0-9-]{{4,}})\\b')) from rowa) as hits from counted, sheet_counts),
audit_validation as ({_CHECKS}),
validation_summary as (select * from audit_validation)"""

#: The reporting views as fact, columns and a filter. Names and order of the columns.
_PRODUCTS = ["product_key.public_product_id", "product_key.brand_group", "product_key.category_group"]
VIEWS = {
    "vw_marketplace_performance": ("fact_marketplace_activity", ["month_key.transaction_month", "marketplace_key.marketplace", "marketplace_key.channel", *star.ACTIVITY], "true"),
    "vw_product_performance": ("fact_product_performance", ["dataset_period", *_PRODUCTS, "product_key.subcategory_group", "product_key.product_group", "marketplace_key.marketplace", *star.PERFORMANCE], "true"),
    "vw_inventory_action": ("fact_inventory_action", [*_PRODUCTS, "product_key.inventory_band", "marketplace_key.marketplace", *star.INVENTORY], "true"),
    "vw_revenue_quality": ("fact_product_performance", ["dataset_period", "marketplace_key.marketplace", *_PRODUCTS, "revenue_quality_score", *star.PERFORMANCE[2:6]], "true"),
    "vw_margin_risk": ("fact_product_performance", ["dataset_period", "marketplace_key.marketplace", *_PRODUCTS, "margin_risk_score", "recommended_action", "action_priority"], "margin_risk_score is not null"),
    "vw_performance_drivers": ("fact_performance_variance", ["previous_month_key.transaction_month as previous_month", "current_month_key.transaction_month as current_month", "marketplace_key.marketplace", "metric", *star.DRIVERS], "true"),
    "vw_validation_summary": ("audit_validation", ["check_name", "check_status", "check_value", "expected_value", "notes"], "true"),
}
#: The same for DuckDB, by names that facts and dimensions share.
DUCK_VIEWS = {
    "vw_marketplace_performance": "select * from fact_marketplace_activity join dim_month using (month_key) join dim_marketplace using (marketplace_key)",
    "vw_product_performance": "select * from fact_product_performance join dim_product using (product_key) join dim_marketplace using (marketplace_key)",
    "vw_inventory_action": "select * from fact_inventory_action join dim_product using (product_key) join dim_marketplace using (marketplace_key)",
    "vw_revenue_quality": "select * from vw_product_performance", "vw_margin_risk": "select * from vw_product_performance where not margin_risk_score is null",
    "vw_performance_drivers": "select v.*, marketplace, was.transaction_month as previous_month, now.transaction_month as current_month from fact_performance_variance v, dim_month was, dim_month now, dim_marketplace mk where (was.month_key, now.month_key, mk.marketplace_key) = (v.previous_month_key, v.current_month_key, v.marketplace_key)",
    "vw_validation_summary": "select * from audit_validation",
}


def names(view: str) -> str:
    return ", ".join(c.split(" as ")[-1].split(".")[-1] for c in VIEWS[view][1])


def newest_active_month(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row: the last month in which anything was ordered."""
    active = t["fact_marketplace_activity"].where("total_orders > 0").select("month_key").distinct()
    return t["dim_month"].join(active, "month_key", "left_semi").agg(F.max("transaction_month").alias("transaction_month"))


def newest_drivers(t: Mapping[str, DataFrame]) -> DataFrame:
    rows = t["vw_performance_drivers"]
    return rows.join(F.broadcast(rows.agg(F.max("current_month").alias("current_month"))), "current_month", "left_semi")


def of_newest_month(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["vw_marketplace_performance"].join(F.broadcast(newest_active_month(t)), "transaction_month", "left_semi")


def variance_against_activity(t: Mapping[str, DataFrame]) -> DataFrame:
    """Sales indexes of the two periods that differ between the variance and the activity fact. Where either fact
    lacks the month, there is nothing to compare."""
    sales = t["fact_marketplace_activity"].select("marketplace_key", "month_key", "sales_index")
    rows = t["fact_performance_variance"].where("metric = 'sales_index'").select("marketplace_key", "previous_month_key", "current_month_key", F.col("previous_value").alias("variance_previous_value"), F.col("current_value").alias("variance_current_value"))
    for which in ("previous", "current"):
        rows = rows.join(sales.withColumnsRenamed({"month_key": f"{which}_month_key", "sales_index": f"fact_{which}_value"}), ["marketplace_key", f"{which}_month_key"])
    differs = (F.col("variance_previous_value") != F.col("fact_previous_value")) | (F.col("variance_current_value") != F.col("fact_current_value"))
    return rows.where(differs).select("marketplace_key", "previous_month_key", "current_month_key", "variance_previous_value", "fact_previous_value", "variance_current_value", "fact_current_value")


def net_variance(t: Mapping[str, DataFrame]) -> DataFrame:
    level = {n: F.sum(F.col(c).cast("decimal(18,1)")) for n, c in (("total_previous_value", "previous_value"), ("total_current_value", "current_value"))}
    got = newest_drivers(t).groupBy("metric").agg(*[e.alias(n) for n, e in level.items()])
    return got.select("metric", *[F.col(n).cast("double").alias(n) for n in level], (F.col("total_current_value") - F.col("total_previous_value")).cast("double").alias("net_abs_variance")).orderBy("metric")


_NEWEST = "with newest as (select max(transaction_month) as month from fact_marketplace_activity natural join dim_month where total_orders <> 0)"
#: Reports as DataFrames, with the SQL that checks them: O08-O18, F22, H11, H13.
FRAMES = {
    "recon_1_unused_products": (lambda t: t["dim_product"].where("product_key <> 0").join(t["fact_product_performance"], "product_key", "left_anti").select("product_key", "public_product_id"),
        "select product_key, public_product_id from dim_product where product_key > 0 and product_key not in (select product_key from fact_product_performance)"),
    "recon_2_orphan_inventory": (lambda t: t["fact_inventory_action"].join(t["fact_product_performance"], ["product_key", "marketplace_key"], "left_anti").select("product_key", "marketplace_key"),
        "select product_key, marketplace_key from fact_inventory_action where (product_key, marketplace_key) not in (select (product_key, marketplace_key) from fact_product_performance)"),
    "recon_3_variance_activity": (variance_against_activity, """select * from (select marketplace_key, previous_month_key, current_month_key, previous_value as variance_previous_value, (select sales_index from fact_marketplace_activity x where x.marketplace_key = v.marketplace_key and x.month_key = v.previous_month_key) as fact_previous_value,
        current_value as variance_current_value, (select sales_index from fact_marketplace_activity x where x.marketplace_key = v.marketplace_key and x.month_key = v.current_month_key) as fact_current_value from fact_performance_variance v where metric = 'sales_index')
        where (variance_previous_value, variance_current_value) <> (fact_previous_value, fact_current_value)"""),
    "perf_1_top_marketplaces": (lambda t: of_newest_month(t).orderBy(F.desc("sales_index"), "marketplace").select("marketplace", "sales_index", "units_index", "avg_fee_pct_of_gross", "avg_net_to_gross_pct").limit(10),
        f"{_NEWEST} select marketplace, sales_index, units_index, avg_fee_pct_of_gross, avg_net_to_gross_pct from (select *, rank() over (order by sales_index desc, marketplace) as place from vw_marketplace_performance semi join newest on transaction_month = month) where place <= 10"),
    "perf_2_top_products": (lambda t: t["vw_product_performance"].orderBy(F.desc("sales_index"), F.desc("units_index"), "public_product_id", "marketplace").select(*[c.split(".")[-1] for c in _PRODUCTS], "marketplace", "sales_index", "units_index").limit(20),
        "select public_product_id, brand_group, category_group, marketplace, sales_index, units_index from (select *, row_number() over (order by sales_index desc, units_index desc, public_product_id, marketplace) as place from vw_product_performance) where place <= 20"),
    "perf_3_high_priority": (lambda t: t["vw_product_performance"].where("action_priority = 'High'").orderBy(F.desc("margin_risk_score")).select(*[c.split(".")[-1] for c in _PRODUCTS], "marketplace", "recommended_action", "action_priority", "margin_risk_score", "revenue_quality_score"),
        "select public_product_id, brand_group, category_group, marketplace, recommended_action, action_priority, margin_risk_score, revenue_quality_score from vw_product_performance where starts_with(action_priority, 'High')"),
    "perf_4_fee_pressure": (lambda t: of_newest_month(t).orderBy(F.desc("avg_fee_pct_of_gross")).select("marketplace", "avg_fee_pct_of_gross", "avg_refund_pct_of_gross", "avg_promotion_pct_of_gross"),
        f"{_NEWEST} select marketplace, avg_fee_pct_of_gross, avg_refund_pct_of_gross, avg_promotion_pct_of_gross from vw_marketplace_performance semi join newest on transaction_month = month"),
    "rca_1_movement": (lambda t: newest_drivers(t).orderBy("metric", F.desc(F.abs("abs_variance"))).select("marketplace", "metric", *star.DRIVERS),
        f"select marketplace, metric, {', '.join(star.DRIVERS)} from (select *, max(current_month) over () as newest from vw_performance_drivers) where current_month = newest"),
    "rca_2_top_contributors": (lambda t: newest_drivers(t).where("metric = 'sales_index'").orderBy(F.desc(F.abs("abs_variance")), "marketplace").select("marketplace", "abs_variance", "contribution_share_pct", "movement").limit(3),
        "select marketplace, abs_variance, contribution_share_pct, movement from (select *, row_number() over (partition by metric order by current_month desc, abs(abs_variance) desc, marketplace) as place from vw_performance_drivers) where metric = 'sales_index' and place <= 3"),
    "rca_3_net_variance": (net_variance, "select metric, sum(previous_value::decimal(18,1))::double as total_previous_value, sum(current_value::decimal(18,1))::double as total_current_value, sum(current_value::decimal(18,1) - previous_value::decimal(18,1))::double as net_abs_variance from (select *, max(current_month) over () as newest from vw_performance_drivers) where current_month = newest group by all"),
    "rca_4_deteriorations": (lambda t: newest_drivers(t).where("movement = 'Deterioration'").orderBy("metric", F.desc(F.abs("abs_variance"))).select("marketplace", "metric", "abs_variance", "contribution_share_pct"),
        "select marketplace, metric, abs_variance, contribution_share_pct from (select *, max(current_month) over () as newest from vw_performance_drivers) where current_month = newest and movement like 'Det%'"),
}

_MEAN = "cast(sum(cast(coalesce({0}, 0) as decimal(18,1))) as double) / count(*) as {0}"


def _means(*columns: str) -> str:
    return ", ".join(_MEAN.format(c) for c in columns)


_RANK = "case action_priority when 'High' then 1 when 'Medium' then 2 when 'Low' then 3 else 4 end"
REPORTS = {name: f"select {names(name)} from {{{name}}}" for name in VIEWS} | {
    # O01-O05, O07, H02, H03, H12
    "sql_01_marketplace_performance": "select dataset_period, marketplace, channel, product_count, order_count_index, sales_index, units_index, avg_fee_pct_of_gross, avg_refund_pct_of_gross, avg_promotion_pct_of_gross, avg_net_to_gross_pct, avg_margin_risk_score, avg_revenue_quality_score, high_priority_action_count from {marketplace_channel_performance} order by sales_index desc, units_index desc",
    "sql_02_product_performance": "select marketplace, brand_group, category_group, subcategory_group, product_group, listing_price_band, inventory_band, sales_index, units_index, net_to_gross_pct, revenue_quality_score, recommended_action, action_priority from {product_performance} order by sales_index desc, units_index desc",
    "sql_03_fee_refund_promotion": "select marketplace, brand_group, category_group, product_group, fee_pct_of_gross, refund_pct_of_gross, promotion_pct_of_gross, net_to_gross_pct, revenue_quality_score, revenue_quality_band from {fee_refund_summary} order by revenue_quality_score asc, fee_pct_of_gross desc",
    "sql_04_profitability_signals": "select dataset_period, marketplace, category_group, brand_group, product_group, margin_band_public, profitability_band_public, sales_index, units_index, margin_index, estimated_profitability_index, margin_risk_score, margin_risk_band, revenue_quality_score, revenue_quality_band from {profitability_summary} order by margin_risk_score desc, sales_index desc",
    "sql_05_inventory_actions": "select public_product_id, marketplace, brand_group, category_group, product_group, inventory_band, units_index, sales_index, margin_risk_band, revenue_quality_band, restock_priority, recommended_action, action_priority, action_reason from {inventory_action_review} order by action_priority, units_index desc",
    "sql_06_action_queue": "select public_product_id, brand_group, category_group, product_group, sales_index, units_index, fee_pct_of_gross, refund_pct_of_gross, promotion_pct_of_gross, net_to_gross_pct, recommended_action, action_priority, action_reason from {product_action_review} where recommended_action <> 'Monitor' order by case action_priority when 'High' then 1 when 'Medium' then 2 else 3 end, sales_index desc, units_index desc",
    "sql_07_validation_summary": "select check_name, check_status, check_value, expected_value, notes from {validation_summary} order by case check_status when 'FAIL' then 1 when 'WARN' then 2 else 3 end, check_name",
    # O19, F23, F24, F25, H22
    "v2_fact_rows": " union all ".join(f"select '{t}' as fact_table, count(*) as row_count from {{{t}}}" for t in ("fact_marketplace_activity", "fact_product_performance", "fact_inventory_action", "fact_performance_variance")),
    "validation_status_counts": "select check_status, count(*) as checks from {audit_validation} group by check_status",
    # N01-N09
    "dim_product": "select * from {dim_product}", "dim_marketplace": "select * from {dim_marketplace}", "dim_month": "select * from {dim_month}", "dim_fulfillment": "select * from {dim_fulfillment}",
    "fact_marketplace_activity": "select * from {fact_marketplace_activity}", "fact_product_performance": "select * from {fact_product_performance}", "fact_inventory_action": "select * from {fact_inventory_action}",
    "fact_performance_variance": "select * from {fact_performance_variance}", "audit_validation": "select * from {audit_validation}", "audit_dataset_profile": "select * from {audit_dataset_profile}",
    # The gold layer keeps the fact's grain
    "gold_marketplace_activity": "select f.fact_key, m.transaction_month, m.quarter, mp.marketplace, f.sales_index, f.units_index from {fact_marketplace_activity} f left join {dim_month} m on m.month_key = f.month_key left join {dim_marketplace} mp on mp.marketplace_key = f.marketplace_key",
    "gold_inventory_action": "select f.fact_key, p.public_product_id, p.brand_group, mp.marketplace, f.units_index, f.restock_priority from {fact_inventory_action} f left join {dim_product} p on p.product_key = f.product_key left join {dim_marketplace} mp on mp.marketplace_key = f.marketplace_key",
    # Top-k blocks of the pages, the limit is the feature
    "dash_top_actions": f"select public_product_id, marketplace, sales_index, margin_risk_score, recommended_action, action_priority from {{product_action_review}} order by {_RANK}, sales_index desc, margin_risk_score desc, public_product_id, marketplace limit 10",
    "dash_top_marketplaces": "select marketplace, channel, product_count as products_in_analysis, sales_index, units_index from {marketplace_channel_performance} order by sales_index desc, units_index desc, marketplace limit 10",
    "dash_inventory_preview": f"select public_product_id, marketplace, category_group, brand_group, product_group, inventory_band, units_index, sales_index, restock_priority, recommended_action, action_priority from {{inventory_action_review}} order by {_RANK}, sales_index desc, units_index desc, public_product_id, marketplace, inventory_band, product_group, restock_priority limit 10",
    "dash_marketplace_contributors": "select marketplace, abs_variance, abs(abs_variance) as magnitude, contribution_share_pct, movement from {vw_performance_drivers} where metric = 'sales_index' order by magnitude desc",
    "chart_category_sales": f"select category_group, {_means('sales_index')} from {{product_performance}} group by category_group order by 2 desc, 1 limit 12",
    # C15-C17, F16, F18
    "dash_restock": "select public_product_id, marketplace, inventory_band, units_index, restock_priority, recommended_action from {inventory_action_review} where units_index >= 50 and (lower(inventory_band) like '%low%' or lower(inventory_band) like '%out of stock%' or lower(restock_priority) like '%high%')",
    "dash_low_sales": f"select * from (select marketplace, product_group, count(distinct public_product_id) as product_count, {_means('sales_index', 'units_index', 'net_to_gross_pct')} from {{product_performance}} group by marketplace, product_group) g where sales_index < 10 order by sales_index, units_index",
    "dash_top_groups": f"select marketplace, product_group, count(distinct public_product_id) as product_count, {_means('sales_index', 'units_index', 'net_to_gross_pct', 'margin_risk_score', 'revenue_quality_score')} from {{product_performance}} group by marketplace, product_group order by 4 desc, 5 desc, 1, 2 limit 20",
    "dash_priority_counts": "select p.action_priority, count(a.public_product_id) as rows from (select 'High' as action_priority union all select 'Medium' union all select 'Low') p left join {product_action_review} a on a.action_priority = p.action_priority group by p.action_priority",
    # Channels of the filtered products
    "dash_channels_of_filtered_products": "select * from {marketplace_channel_performance} c where c.marketplace in (select marketplace from {product_performance} where category_group = 'PROMO' and marketplace <> 'Amazon')",
    # Filter options over eight marts
    "dash_filter_options": " union ".join(f"select '{c}' as filter, trim({c}) as value from {{{t}}} where trim({c}) <> '' and lower(trim({c})) <> 'nan'" for c, ts in {
        "marketplace": ("product_action_review", "product_performance", "inventory_action_review", "margin_risk_review", "profitability_summary", "category_performance", "brand_performance", "marketplace_channel_performance"),
        "brand_group": ("product_performance", "inventory_action_review", "profitability_summary", "brand_performance"), "category_group": ("product_performance", "inventory_action_review", "profitability_summary", "category_performance", "brand_performance"),
        "fulfillment_type": ("product_performance",), "inventory_band": ("product_performance", "inventory_action_review"),
    }.items() for t in ts),
    # Q02: products of one marketplace
    "dash_products_of_marketplace": "select distinct public_product_id from {product_performance} where marketplace = 'Amazon'",
    # Q03: the trend line
    "chart_trend": "select transaction_month, marketplace, sales_index, units_index from {marketplace_summary} order by transaction_month, marketplace",
    # outcomes by the largest mean and the most common value; names break ties
    "business_outcomes": "select * from (select 'Top Marketplace' as outcome, marketplace as value from (select marketplace, sum(cast(sales_index as decimal(18,1))) / count(*) as m from {marketplace_summary} group by marketplace) a order by m desc, marketplace limit 1) a"
    " union all select * from (select 'Top Product Group', product_group from (select product_group, sum(cast(sales_index as decimal(18,1))) / count(*) as m from {product_performance} group by product_group) a order by m desc, product_group limit 1) b"
    " union all select * from (select 'Highest Review Area', recommended_action from (select recommended_action, count(*) as m from {product_action_review} where recommended_action <> 'Monitor' group by recommended_action) a order by m desc, recommended_action limit 1) c"
    " union all select * from (select 'Most Common Action', recommended_action from (select recommended_action, count(*) as m from {product_action_review} group by recommended_action) a order by m desc, recommended_action limit 1) d"
    " union all select * from (select 'Top Revenue Quality Segment', channel from (select channel, sum(cast(coalesce(avg_revenue_quality_score, 0) as decimal(18,1))) / count(*) as m from {marketplace_channel_performance} where avg_revenue_quality_score is not null group by channel) a order by m desc, channel limit 1) e",
    # Q10: outputs without a profile row, and the worst status
    "profile_completion": "select (select count(*) from {audit_dataset_profile} where row_count > 0) as profiled, (select min(case check_status when 'FAIL' then 1 when 'WARN' then 2 else 3 end) from {audit_validation}) as worst",
    # Q12: the first whole number of a named check
    "validation_lookup": "select check_name, try_cast(check_value as bigint) as value from {audit_validation} where check_name = 'Order row count valid'",
    # Exceptions of two outputs, the product's first
    "workflow_queue": "select exception_id, source_output, public_product_id, marketplace, recommended_action, action_priority, action_reason, 'New' as status from ("
    "select *, row_number() over (partition by exception_id order by source_output desc, action_reason, recommended_action, action_priority, public_product_id, marketplace) as k from ("
    "select replace(concat('PAR-', public_product_id, '-', marketplace), ' ', '_') as exception_id, 'product_action_review' as source_output, public_product_id, marketplace, recommended_action, action_priority, action_reason from {product_action_review} where action_priority in ('High', 'Medium') union all "
    "select replace(concat('IAR-', public_product_id, '-', marketplace), ' ', '_'), 'inventory_action_review', public_product_id, marketplace, recommended_action, action_priority, action_reason from {inventory_action_review} where action_priority in ('High', 'Medium')) a) b where k = 1",
    # P21-P26
    "bi_measures_star": "select a.total_orders, a.activity_rows, i.inventory_rows, v.pass_checks, v.warn_checks, v.fail_checks, o.public_outputs from (select sum(total_orders) as total_orders, count(*) as activity_rows from {fact_marketplace_activity}) a cross join (select count(*) as inventory_rows from {fact_inventory_action}) i cross join "
    "(select count(case when check_status = 'PASS' then 1 end) as pass_checks, count(case when check_status = 'WARN' then 1 end) as warn_checks, count(case when check_status = 'FAIL' then 1 end) as fail_checks from {audit_validation}) v cross join (select count(distinct public_output_name) as public_outputs from {audit_dataset_profile}) o",
}


class Tables(star.Star):
    """The star and the views on it."""

    def __getitem__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            return super().__getitem__(name)
        fact, columns, test = VIEWS[name]
        return star.view(self, fact, columns).where(test)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def sql(spark: SparkSession, text: str, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Runs SQL over frames named in braces."""
    return spark.sql(text, **{n: frames[n] for n in set(re.findall(r"\{(\w+)\}", text))})


def run(name: str):
    if name in FRAMES:
        return lambda spark, sf_dir: FRAMES[name][0](tables(spark, sf_dir))
    return lambda spark, sf_dir: sql(spark, REPORTS[name], tables(spark, sf_dir))


def duck(text: str) -> str:
    """The same over common table expressions."""
    plain = lambda x: re.sub(r"\{([a-z]\w*)\}", r"\1", x)  # noqa: E731  numbers in braces are repeats of a pattern
    views = ",\n".join(f"{n} as ({t})" for n, t in DUCK_VIEWS.items())
    body = plain(text)
    return f"with {oracle.VARIANCE},{TABLES},\n{views}" + (",\n" + body.removeprefix("with ") if body.startswith("with ") else f"\n{body}")
