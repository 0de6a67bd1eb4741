"""Queries on loading, layers, contracts, privacy, filters and measures, with SQL written apart from them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.operators import channels, checks, contracts, filters, lakehouse, marts, measures, privacy, star, variance, warehouse, workflow
from ledgerloom.plans import oracle, reports
from ledgerloom.sources import staging, tables

FRESH = ("2024-01-01", "2024-02-01")


def _place(spark: SparkSession, name: str) -> str:
    return f"{staging.shared_dir(spark)}/ledgerloom/{uuid.uuid4().hex}/{name}"


# ---- loads, history, layers


def warehouse_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two full reloads in place; what the second left."""
    tables_ = {t: star.load(spark, sf_dir)[t] for t in warehouse.LOAD_ORDER}
    root = _place(spark, "warehouse")
    for _ in range(2):
        warehouse.load(spark, tables_, root)
    warehouse.cleaned(spark, root, 1)
    return warehouse.load_report(spark, tables_, root)


def _history(spark: SparkSession, sf_dir: str) -> str:
    """Audits of two loads: all lines, then, in the newest, the service fees alone, which have no SKU and no orders."""
    s, root = star.load(spark, sf_dir), _place(spark, "audits")
    fees = marts.lines(spark, sf_dir).where("transaction_type_group = 'Service Fee'")
    newest = checks.validation_summary(fees, tables.product_master(spark, sf_dir), tables.channels(spark, sf_dir), s.outputs(), hits=s["content_hits"])
    for stamp, audit in zip(FRESH, (s["audit_validation"], newest), strict=True):
        warehouse.append_history(audit, root, "audit_validation", stamp)
        warehouse.append_history(s["audit_dataset_profile"].where("row_count > 0" if stamp == FRESH[1] else "row_count > 100"), root, "audit_dataset_profile", stamp)
    return root


def not_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.failing(spark, _history(spark, sf_dir))


def newest_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.latest(spark, _history(spark, sf_dir), "audit_dataset_profile").select("public_output_name", "row_count", "dataset_period", "dataset_label", "load_timestamp")


def lakehouse_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = star.load(spark, sf_dir)
    return lakehouse.checked(spark, {t: s[t] for t in lakehouse.KEYS}, _place(spark, "lakehouse"))


def _gold(name: str) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fact, columns = lakehouse.GOLD[name]
        return star.view(star.load(spark, sf_dir), fact, columns, "left")

    return run


RELOAD_SQL = " union all ".join(f"select {k + 1} as load_order, '{t}' as table_name, count(*) as source_rows, count(*) as loaded_rows, 'OK' as status from {t}" for k, t in enumerate(warehouse.LOAD_ORDER))
_TEN = " union all ".join(f"select count(*) as n from {t}" for t in lakehouse.KEYS)
_FIVE = " union all ".join(f"select count(*) as n from {f}" for f, _ in lakehouse.GOLD.values())
_MEASURED = {
    "source_target_row_reconciliation": "0", "table_format_validation": "25", "null_key_validation": "0", "duplicate_key_validation": "0", "row_count_conformance_bronze_to_silver": "0", "grain_preservation_silver_to_gold": "0",
    "business_metric_total_orders": "(select sum(total_orders) from fact_marketplace_activity)", "business_metric_marketplace_count": "(select count(*) from dim_marketplace)", "business_metric_product_performance_rows": "(select count(*) from pp)",
    "business_metric_high_priority_actions": "(select count(*) from pp where action_priority = 'High')", "idempotency_bronze": f"(select sum(n) from ({_TEN}))", "idempotency_silver_gold": f"(select sum(n) from ({_TEN} union all {_FIVE}))",
    "controlled_failure_test": "1", "recovery_rerun_test": "(select count(*) from dim_month)",
}
LAKEHOUSE_SQL = " union all ".join(f"select '{n}' as check_name, '{layer}' as layer, '{scope}' as scope, 'PASS' as result, {_MEASURED[n]}::bigint as measured, {_MEASURED[n]}::bigint as expected" for n, layer, scope in lakehouse.CHECKS)
GOLD_SQL = {
    "gold_marketplace_performance": f"select transaction_month, marketplace, channel, {reports.ACTIVITY} from fact_marketplace_activity left join dim_month using (month_key) left join dim_marketplace using (marketplace_key)",
    "gold_product_performance": f"select public_product_id, {reports.ATTRIBUTES}, marketplace, {reports.PERFORMANCE}, dataset_period from fact_product_performance left join dim_product using (product_key) left join dim_marketplace using (marketplace_key)",
    "gold_inventory_actions": f"select public_product_id, brand_group, category_group, inventory_band, marketplace, {reports.INVENTORY} from fact_inventory_action left join dim_product using (product_key) left join dim_marketplace using (marketplace_key)",
    "gold_variance_drivers": f"select marketplace, metric, previous_month, current_month, {reports.DRIVERS} from vw_performance_drivers",
    "gold_validation_summary": "select check_name, check_status, check_value, expected_value, notes from audit_validation",
}
#: Checks of the newest load that fail: the fees have no SKU.
NOT_PASSED_SQL = f"""select 'SKU column detected' as check_name, 'FAIL' as check_status, count(sku)::varchar as check_value, '> 0 rows with SKU' as expected_value, '' as notes, '{FRESH[1]}' as load_timestamp
    from lines where transaction_type_group = 'Service Fee' having count(sku) = 0"""
NEWEST_PROFILE_SQL = f"select public_output_name, row_count, dataset_period, dataset_label, '{FRESH[1]}' as load_timestamp from audit_dataset_profile where row_count > 0"


# ---- contracts


def _checked(spark: SparkSession, sf_dir: str) -> contracts.Checked:
    return contracts.validate(tables.export(spark, sf_dir), contracts.declared("settlement_export"), "settlements.csv", at="2024-01-01T00:00:00+00:00")


def quarantine_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).records.select("source_name", "row_number", "error_code", "error_category", "validation_rule", "severity")


EXPORT = """exp as (select place as row_number, l_orderkey || '-' || l_linenumber as line_ref, l_orderkey::varchar as order_id, case when l_partkey % 10 <> 0 then 'SKU-' || l_partkey end as sku,
    (['Amazon', 'Flipkart', ' Meesho ', 'JioMart', 'Website', 'Corner Shop'])[l_suppkey % 6 + 1] as marketplace, l_quantity::decimal(18,2) as q, place % 97 = 0 as odd, place % 97 > 0 and place % 89 = 0 as bare,
    case when l_returnflag = 'R' and l_linenumber = 1 then -1 else 1 end * l_extendedprice::decimal(18,2) as amount, l_shipdate
    from (select *, row_number() over () - 1 as place from lineitem))"""
LEDGER = f"""{EXPORT}, broken as (
    select row_number, 'MISSING_REQUIRED_VALUE' as error_code, 'fields.quantity.nullable=false' as validation_rule, 'reject' as severity from exp where bare
    union all select row_number, 'TYPE_MISMATCH', 'fields.quantity.type=number', 'reject' from exp where odd
    union all select row_number, 'OUT_OF_RANGE', 'fields.quantity.range=[1,45]', 'warn' from exp where not odd and not bare and (q < 1 or q > 45)
    union all select row_number, 'OUT_OF_RANGE', 'fields.amount.range=[0,None]', 'warn' from exp where amount < 0
    union all select row_number, 'UNKNOWN_VALUE', 'fields.marketplace.allowed_values', 'warn' from exp where marketplace = 'Corner Shop'
    union all select row_number, 'DUPLICATE_KEY', 'fields.line_ref.unique', 'warn' from (select row_number, row_number() over (partition by line_ref order by row_number) as copy from exp) where copy > 1)"""


def marts_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of the six outputs' own contracts, and those of the raw export held to the published rows' contract."""
    s = star.load(spark, sf_dir)
    good = contracts.output_rules({n: s[n] for n in contracts.OUTPUTS})
    leak = contracts.broken_rules(tables.export(spark, sf_dir), contracts.declared("anonymized_master"), "settlement_export")
    return good.unionByName(leak)


def _rule_sql() -> str:
    """The declared rules of the outputs, none of which breaks on these tables, by the outputs' row counts."""
    made = []
    for name in contracts.OUTPUTS:
        spec = contracts.declared(name)
        for field, f in spec["fields"].items():
            kinds = []
            if f.get("required") and not f.get("nullable"):
                kinds.append(("MISSING_REQUIRED_VALUE", "nullable=false", "reject", f"count(*) filter (where {field} is null or trim({field}::varchar) = '')"))
            if f["type"] == "number":
                kinds.append(("TYPE_MISMATCH", "type=number", "reject", f"count(*) filter (where {field} is not null and try_cast({field} as double) is null)"))
                if "min" in f or "max" in f:
                    kinds.append(("OUT_OF_RANGE", f"range=[{f.get('min')},{f.get('max')}]", "warn", f"count(*) filter (where not ({field} between {f.get('min', -1e300)} and {f.get('max', 1e300)}))"))
            if f.get("allowed_values"):
                kinds.append(("UNKNOWN_VALUE", "allowed_values", spec["validation_severity"]["unknown_value"], f"count(*) filter (where {field} not in ({', '.join(map(oracle.q, f['allowed_values']))}))"))
            made += [f"select '{name}' as output, '{code}' as error_code, 'fields.{field}.{rule}' as validation_rule, '{severity}' as severity, count(*) as rows, {broken} as records from {'audit_dataset_profile' if name == 'dataset_profile' else name}" for code, rule, severity, broken in kinds]
    leak = [("FORBIDDEN_FIELD_PRESENT", f"forbidden_fields:{c}") for c in ("order_id", "sku")]
    leak += [("MISSING_REQUIRED_COLUMN", f"fields.{c}.required") for c in ("public_product_id", "sales_index", "units_index", "fee_pct_of_gross", "refund_pct_of_gross", "net_to_gross_pct")]
    made += [f"select 'settlement_export', '{code}', '{rule}', 'reject', count(*), 1 from lineitem" for code, rule in leak]
    return " union all ".join([*made, "select 'settlement_export', 'MISSING_REQUIRED_VALUE', 'fields.marketplace.nullable=false', 'reject', count(*), 0 from lineitem"])


# ---- dates and periods


def months_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.export(spark, sf_dir).select(text.month(F.col("date_time")).alias("month"), text.unparsed(F.col("date_time")).alias("bad"), text.open_date(F.col("open_date")).alias("open_date"))
    return rows.groupBy("month").agg(F.count("*").alias("rows"), F.count_if("bad").alias("unparsed"), F.count("open_date").alias("open_dates"), F.max("open_date").alias("last_open_date"))


MONTHS_SQL = """select case when row_number % 7 < 5 then strftime(l_shipdate, '%Y-%m') else 'Unknown' end as month, count(*) as rows, count(*) filter (where row_number % 7 = 5) as unparsed,
    count(*) filter (where row_number % 11 > 0) as open_dates, max(case when row_number % 11 > 0 then strftime(l_shipdate, '%Y-%m-%d') end) as last_open_date from exp group by 1"""


def dataset_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The period that the counts of each marketplace stand for, and of all."""
    lines = marts.lines(spark, sf_dir).groupBy("marketplace").agg(F.count("*").alias("transaction_rows"), F.count_if(F.col("transaction_type_group") == "Order").alias("order_rows"))
    both = lines.unionByName(lines.agg(F.sum("transaction_rows").alias("transaction_rows"), F.sum("order_rows").alias("order_rows")).withColumn("marketplace", F.lit("all")))
    labels = F.create_map(*[F.lit(x) for kv in checks.PERIOD_LABELS.items() for x in kv])
    return both.withColumn("period", text.period_of_counts(F.col("transaction_rows"), F.col("order_rows"))).withColumn("label", F.element_at(labels, F.col("period")))


PERIOD_SQL = """select *, case period when '12m' then '12M / 120K Orders' when '6m' then '6M / 60K Orders' when '3m' then '3M / 30K Orders' when '1m' then '1M / 10K Orders' else 'Custom Upload' end as label from (
    select *, case when greatest(transaction_rows, order_rows) >= 100000 then '12m' when greatest(transaction_rows, order_rows) >= 60000 then '6m' when greatest(transaction_rows, order_rows) >= 30000 then '3m' when greatest(transaction_rows, order_rows) >= 10000 then '1m' else 'custom_upload' end as period
    from (select coalesce(marketplace, 'all') as marketplace, count(*) as transaction_rows, count(*) filter (where transaction_type_group = 'Order') as order_rows from lines group by rollup (marketplace)))"""


def driver_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver summary of all months, of the first month alone, and of the months without orders."""
    matrix = star.load(spark, sf_dir)["matrix"]
    first = matrix.agg(F.min("transaction_month").alias("transaction_month"))
    cases = {"all": matrix, "first month": matrix.join(F.broadcast(first), "transaction_month", "left_semi"), "without orders": matrix.where("order_count = 0")}
    parts = [variance.driver_report(m).withColumn("scope", F.lit(scope)) for scope, m in cases.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- privacy


def privacy_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All outputs against the private values of both inputs, and the raw export as if it were to be published."""
    export = tables.export(spark, sf_dir)
    outputs = star.load(spark, sf_dir).outputs() | {"settlement_export": export}
    return privacy.scan(outputs, privacy.known_values(tables.product_master(spark, sf_dir), export), together=star.TOGETHER)


_BANDS = ["margin_risk_band", "revenue_quality_band"]
_REVIEW = ["public_product_id", "marketplace", "brand_group", "category_group", "product_group"]
#: The text columns of the outputs.
TEXTS = {
    "anonymized_master": [c for c in marts.PUBLIC if not c.endswith(("_index", "_pct", "_gross", "_score"))], "marketplace_summary": ["dataset_period", "transaction_month", "marketplace"],
    "marketplace_channel_performance": ["dataset_period", "marketplace", "channel"], "product_performance": [*marts.PRODUCT_KEYS, *_BANDS, *marts.ACTION], "category_performance": ["dataset_period", "marketplace", "category_group", "subcategory_group"],
    "brand_performance": ["dataset_period", "marketplace", "brand_group", "category_group"], "fulfillment_comparison": ["dataset_period", "fulfillment_type"],
    "profitability_summary": ["dataset_period", "marketplace", "category_group", "brand_group", "product_group", "margin_band_public", "profitability_band_public", *_BANDS], "fee_refund_summary": [*_REVIEW, "revenue_quality_band"],
    "margin_risk_review": [*_REVIEW, "listing_price_band", "inventory_band", "margin_risk_band", *marts.ACTION], "inventory_action_review": [*_REVIEW, "inventory_band", *_BANDS, "restock_priority", *marts.ACTION],
    "product_action_review": [*marts.PRODUCT_KEYS, *_BANDS, *marts.ACTION], "mart_marketplace_variance_drivers": ["marketplace", "metric", "previous_period", "current_period", "movement"], "mart_performance_driver_summary": ["metric"],
    "settlement_export": ["line_ref", "order_id", "sku", "marketplace", "quantity"],
}
_SHAPES = {"asin_like_values": r"\b[Bb]0[A-Za-z0-9]{8}\b", "order_id_like_values": r"(?i)\b(?:ORDER|ORD|AMZ|FLP|MEE|JIO|WEB)[-_]?[A-Z0-9-]{4,}\b", "postal_code_like_values": r"\b[1-9][0-9]{5}\b", "currency_marker_values": r"(?i)(?:₹|\bINR\b|\bRS\.?\b)"}
_FREE = {"order_id_like_values": ("marketplace", "channel", "narrative")}
_LONG = ("action_reason", "notes", "brand_group", "category_group", "subcategory_group", "product_group", "marketplace", "channel", "listing_price_band", "inventory_band", "margin_band_public", "profitability_band_public")


def _gate_sql() -> str:
    export = f"settlement_export as (select line_ref, order_id, sku, marketplace, case when odd then 'n/a' when bare then '  ' else q::varchar end as quantity from exp)"
    known = "known as (select distinct trim(v) as v from (select seller_sku as v from product_master union all select sku from settlement_export union all select order_id from settlement_export) where length(trim(v)) >= 5 and regexp_matches(v, '[0-9_/-]'))"
    rows = []
    for output, columns in TEXTS.items():
        count = {n: " + ".join(f"coalesce(sum(len(regexp_extract_all({c}, {oracle.q(p)}))), 0)" for c in columns if c not in _FREE.get(n, ())) for n, p in _SHAPES.items()}
        titles = " + ".join([f"count(*) filter (where regexp_matches({c}, '\\w+\\s+\\w+\\s+\\w+\\s+\\w+\\s+\\w+'))" for c in columns if c not in _LONG] or ["0"])
        hits = " + ".join(f"count(*) filter (where trim({c}) in (select v from known))" for c in columns)
        unsafe = "order_id, sku" if output == "settlement_export" else ""
        rows.append(f"select '{output}' as output, '{unsafe}' as unsafe_columns, {', '.join(f'({e})::bigint as {n}' for n, e in count.items())}, ({hits})::bigint as known_private_identifier_values, ({titles})::bigint as long_title_like_values from {output}")
    total = " + ".join(privacy.COUNTS)
    return f"with {EXPORT}, {export}, {known} select *, ({total})::bigint as total_content_hits, unsafe_columns = '' and {total} = 0 as is_safe from ({' union all '.join(rows)})"


# ---- pages


def filtered_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products under a specification with two real filters, an "All", an unknown column and blanks."""
    spec = {"marketplace": ["Amazon", "Meesho"], "category_group": ["PROMO", "ECONOMY", "STANDARD"], "brand_group": ["All", "Brand#11"], "fulfillment_type": [" "], "no_such_column": ["x"]}
    s = star.load(spark, sf_dir)
    got = filters.applied(s["product_performance"], spec)
    return got.groupBy("marketplace", "category_group").agg(F.count("*").alias("rows"), F.count_distinct("public_product_id").alias("products"))


def scoped_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = star.load(spark, sf_dir)
    kept = filters.applied(s["product_performance"], {"category_group": ["PROMO"], "fulfillment_type": ["FBA"]})
    return filters.scoped(s["marketplace_channel_performance"], filters.of_marketplace_product(kept, "Flipkart")).select("marketplace", "product_count", "sales_index")


def drill_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first product option of one marketplace, then its rows there and everywhere."""
    product = star.load(spark, sf_dir)["product_performance"]
    first = filters.options(product, "public_product_id", "Meesho").agg(F.min("value")).first()[0]
    rows = filters.of_marketplace_product(product, None, first).select("public_product_id", "marketplace", "fulfillment_type", "sales_index", "recommended_action")
    return rows.withColumn("chosen", F.col("marketplace") == "Meesho")


def channel_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = marts.lines(spark, sf_dir).select("sku", "marketplace", "units", "brand_group")
    got = channels.with_channels(lines, tables.channels(spark, sf_dir), "src_row")
    return got.groupBy("marketplace", "channel_readiness", "marketplace_channel_match").agg(F.count("*").alias("rows"), F.count("sku").alias("with_sku"), F.sum("units").cast("double").alias("units"))


def workflow_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue after a batch of requests and a refresh from fresh exceptions: counts by status."""
    queue = reports.run("workflow_queue")(spark, sf_dir)
    asks = queue.where("action_priority = 'High'").select("exception_id", F.when(F.col("marketplace") == "Amazon", "Under Review").when(F.col("marketplace") == "Meesho", "Approved").otherwise("Rejected").alias("new_status"), F.lit("Reviewer").alias("reviewer_persona"), F.lit("batch").alias("reason"), F.lit("2024-01-01").cast("timestamp").alias("at"))
    after, log = workflow.transitions(queue, asks)
    path = _place(spark, "actions")
    workflow.append_log(log, path)
    refreshed = workflow.refreshed(queue.where("marketplace <> 'Website'").drop("status"), after)
    counts = workflow.status_counts(refreshed).select("status", "exceptions")
    return counts.unionByName(spark.read.parquet(path).agg(F.count("*").alias("exceptions")).select(F.lit("logged").alias("status"), "exceptions"))


WORKFLOW_SQL = f"""select status, exceptions from (select 1) join lateral (with q as ({reports.duck(reports.REPORTS['workflow_queue'])}),
    after as (select *, case when action_priority <> 'High' or marketplace = 'Meesho' then 'New' when marketplace = 'Amazon' then 'Under Review' else 'Rejected' end as now from q),
    names as (select unnest(['New', 'Under Review', 'Analysis Required', 'Approved', 'Rejected', 'Actioned Externally', 'Closed']) as status)
    select n.status, (select count(*) from after where after.now = n.status and marketplace <> 'Website') as exceptions from names n union all select 'total', (select count(*) from after where marketplace <> 'Website')
    union all select 'logged', (select count(*) from after where now <> 'New')) on true"""
SCALARS_SQL = """select (select count(*) from product_master) as product_master_rows, l.*, 'Unavailable' as channel_mapping_status, p.*, (select count(distinct marketplace) from marketplace_channel_performance) as marketplaces, p.r as average_margin_risk_score
    from (select count(*) as transaction_rows, count(*) filter (where transaction_type_group = 'Order') as order_rows, round_even(count(*) filter (where mapping_status = 'Matched') / count(sku)::double * 100.0::double, 2) as join_coverage_pct from lines) l,
    (select count(distinct public_product_id) as products_in_analysis, count(distinct public_product_id) as products_with_transactions, count(distinct category_group) as category_count, count(distinct brand_group) as brand_count, """ + ", ".join(
    f"round_even(sum({c}::decimal(18,1))::double / count({c}), 1) as {n}" for c, n in (("fee_pct_of_gross", "average_fee_pct"), ("refund_pct_of_gross", "average_refund_pct"), ("promotion_pct_of_gross", "average_promotion_pct"), ("net_to_gross_pct", "average_net_to_gross_pct"), ("revenue_quality_score", "average_revenue_quality_score"), ("margin_risk_score", "r"))
) + ", count(*) filter (where action_priority = 'High') as high_priority_actions, " + ", ".join(f"count(*) filter (where recommended_action = '{w} Review') as {w.lower().replace(' ', '_')}_review_count" for w in ("Refund", "Promotion", "Fee", "Slow Mover", "Margin Risk", "Restock")) + " from pp) p"


def _kpi_sql() -> tuple[str, str]:
    rows = []
    for name, column, span, outputs in measures.REGISTRY:
        for o in outputs:
            there = not (o in ("marketplace_summary", "category_performance", "brand_performance") and column.endswith("_gross"))
            low, high = (f"{x}::double" for x in span) if span else ("null::double", "null::double")
            number = (f"min({column}::double)", f"max({column}::double)") if span and there else ("null::double", "null::double")
            rows.append(f"select '{name}' as kpi_name, '{column}' as output_column, '{o}' as output, {str(there).lower()} as present, {f'count({column})' if there else 0} as values, {low} as expected_min, {high} as expected_max, {number[0]} as observed_min, {number[1]} as observed_max from {o}")
    base = f"with kpi as ({' union all '.join(rows)}) "
    presence = base + "select kpi_name, output_column, bool_or(present) as present, coalesce(string_agg(output, ', ' order by output) filter (where present), '') as present_in, coalesce(string_agg(output, ', ' order by output) filter (where not present), '') as missing_from, sum(values)::bigint as values from kpi group by 1, 2"
    return presence, base + "select kpi_name, output, expected_min, expected_max, observed_min, observed_max, observed_min >= expected_min and observed_max <= expected_max as in_range from kpi where expected_min is not null and observed_min is not null"


PRESENCE_SQL, RANGES_SQL = _kpi_sql()
IMPORTED_SQL = "select imported_flag, sum(sales_index::decimal(18,1))::double / count(*) as sales_index, sum(units_index::decimal(18,1))::double / count(*) as units_index from rowa group by 1"


def imported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F19."""
    mean = lambda c: (F.sum(F.col(c).cast("decimal(18,1)")).cast("double") / F.count(c)).alias(c)
    return star.load(spark, sf_dir)["anonymized_master"].groupBy("imported_flag").agg(mean("sales_index"), mean("units_index"))


CHANNELS = """channel_sheet as (select p_partkey * 10 + k * 2 + copy as src_row, 'SKU-' || p_partkey as seller_sku, (['Amazon', 'Flipkart', 'Meesho', 'JioMart', 'Website'])[k + 1] as marketplace, case copy when 0 then 'Live ' else 'Draft ' end || p_size % 4 as channel_readiness
    from part, range(5) r(k), range(2) c(copy) where (p_partkey + k) % 13 <> 0 and (copy = 0 or p_partkey % 19 = k))"""
CHANNEL_SQL = """select marketplace, channel_readiness, channel_readiness is not null as marketplace_channel_match, count(*) as rows, count(sku) as with_sku, sum(units)::double as units
    from lines left join (select seller_sku as sku, marketplace, min_by(channel_readiness, src_row) as channel_readiness from channel_sheet group by 1, 2) using (sku, marketplace) group by 1, 2"""
PER_SKU_SQL = "select count(*) filter (where n >= 5) as all_five, count(*) filter (where n < 5) as fewer from (select seller_sku, count(distinct marketplace) as n from channel_sheet group by 1)"


def marketplaces_per_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.per_sku(tables.channels(spark, sf_dir)).agg(F.count_if(F.col("n") >= 5).alias("all_five"), F.count_if(F.col("n") < 5).alias("fewer"))


def _base(body: str, *extra: str) -> str:
    return oracle.sql(body, ", ".join([oracle.BASE, *extra]))


def _ledger(body: str) -> str:
    return f"with {LEDGER} {body}"


def queries() -> dict[str, tuple[Callable, str | None]]:
    gold = {n: (_gold(n), reports.duck(t)) for n, t in GOLD_SQL.items()}
    s = star.load
    return gold | {
        "warehouse_reload": (warehouse_reload, reports.duck(RELOAD_SQL)), "lakehouse_checks": (lakehouse_checks, reports.duck(LAKEHOUSE_SQL)),
        "v1_not_passed": (not_passed, _base(NOT_PASSED_SQL)), "v3_profile": (newest_profile, reports.duck(NEWEST_PROFILE_SQL)),
        "quarantine_ledger": (quarantine_ledger, _ledger("select 'settlements.csv' as source_name, row_number, error_code, 'VALIDATION_ERROR' as error_category, validation_rule, severity from broken")),
        "quarantine_summary": (lambda sp, d: contracts.summarized(_checked(sp, d).records), _ledger("select 'VALIDATION_ERROR' as error_category, error_code, severity, count(*) as row_count from broken group by all")),
        "quarantine_totals": (lambda sp, d: contracts.totals(_checked(sp, d)), _ledger("select (select count(*) from exp) as total_input_rows, (select count(*) from exp where not odd and not bare) as accepted_rows, count(*) filter (where severity = 'reject') as rejected_rows, count(*) filter (where severity = 'warn') as warning_rows from broken")),
        "quarantine_accepted": (lambda sp, d: _checked(sp, d).accepted.groupBy("marketplace").agg(F.count("*").alias("rows"), F.sum(F.col("quantity").cast("decimal(18,2)")).cast("double").alias("quantity")), _ledger("select marketplace, count(*) as rows, sum(q)::double as quantity from exp where not odd and not bare group by all")),
        "output_contract_rules": (marts_contracts, reports.duck(_rule_sql())),
        "dates_by_month": (months_parsed, f"with {EXPORT} {MONTHS_SQL}"), "dataset_period": (dataset_period, _base(PERIOD_SQL)), "privacy_gate": (privacy_gate, reports.duck(_gate_sql())),
        "filtered_products": (filtered_products, oracle.sql("select marketplace, category_group, count(*) as rows, count(distinct public_product_id) as products from pp where (marketplace = 'Amazon' or marketplace = 'Meesho') and category_group in ('PROMO', 'ECONOMY', 'STANDARD') group by all")),
        "filtered_channels": (scoped_channels, reports.duck("select marketplace, product_count, sales_index from marketplace_channel_performance where marketplace = 'Flipkart' and exists (select 1 from pp where pp.marketplace = 'Flipkart' and category_group = 'PROMO' and fulfillment_type = 'FBA')")),
        "filtered_drill_down": (drill_down, oracle.sql("select public_product_id, marketplace, fulfillment_type, sales_index, recommended_action, marketplace = 'Meesho' as chosen from pp where public_product_id = (select min(public_product_id) from pp where marketplace = 'Meesho')")),
        "channel_join": (channel_join, _base(CHANNEL_SQL, CHANNELS)), "marketplaces_per_sku": (marketplaces_per_sku, f"with {CHANNELS} {PER_SKU_SQL}"), "workflow_refresh": (workflow_refresh, WORKFLOW_SQL),
        "kpis": (lambda sp, d: measures.scalars(s(sp, d), marts.lines(sp, d), tables.product_master(sp, d)), reports.duck(SCALARS_SQL.replace("l.*, 'Unav", "l.*, 'Unav").replace("p.*, (select", "p.* exclude (r), (select"))),
        "kpi_presence": (lambda sp, d: measures.presence(s(sp, d)), reports.duck(PRESENCE_SQL)), "kpi_ranges": (lambda sp, d: measures.ranges(s(sp, d)), reports.duck(RANGES_SQL)), "dash_imported": (imported, oracle.sql(IMPORTED_SQL, oracle.ROWS)),
    }
