"""DuckDB SQL for the catalog's queries: one chain of common table expressions, built from the same definitions in SQL."""

from __future__ import annotations

from ledgerloom.operators.kernel import RULES
from ledgerloom.operators.marts import PRODUCT_KEYS
from ledgerloom.operators.variance import METRICS, WORSE_UP

TITLE = "array_to_string(list_transform(regexp_extract_all(lower({0}), '([A-Za-z]+|[^A-Za-z]+)'), lambda w: upper(w[1]) || w[2:]), '')"


def q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def idx(v: str, m: str) -> str:
    return f"coalesce(round_even(greatest(least({v}::double / (case when {m} > 0 then {m}::double end) * 100.0::double, 100), 0), 1), 0.0::double)"


def pct(v: str, lo: int) -> str:
    v = f"{v}::double" if lo else f"abs({v})::double"
    return f"coalesce(round_even(greatest(least({v} / (case when gross > 0 then gross::double end) * 100.0::double, 300), {lo}), 1), 0.0::double)"


def band(c: str, steps: list[tuple[str, str]], last: str) -> str:
    return "case " + " ".join(f"when {c} {t} then '{n}'" for t, n in steps) + f" else '{last}' end"


RISK_BAND = [(">= 70", "Critical Review"), (">= 45", "High Risk"), (">= 25", "Medium Risk")]
QUALITY_BAND = [(">= 80", "Strong"), (">= 65", "Healthy"), (">= 45", "Watch"), (">= 25", "At Risk")]
MARGIN_BAND = [("is null", "Unknown"), ("< 0", "Loss / Negative"), ("< 10", "Low Margin"), ("< 20", "Moderate Margin"), ("< 35", "Healthy Margin")]
PRICE_BAND = [("is null", "Unknown"), ("<= 0", "Unknown")] + [(f"between {a} and {b}", f"{a}-{b}") for a, b in ((0, 499), (500, 999), (1000, 1499), (1500, 1999), (2000, 2499), (2500, 2999), (3000, 3999))]
STOCK_BAND = [("is null", "Unknown"), ("<= 0", "Out of Stock / 0"), ("<= 5", "Very Low / 1-5"), ("<= 20", "Low / 6-20"), ("<= 50", "Moderate / 21-50"), ("<= 100", "High / 51-100")]

BASE = f"""
txn0 as (select case when l_partkey % 10 <> 0 then 'SKU-' || l_partkey end as sku,
  case when l_partkey % 10 = 0 then 'Service Fee' when l_shipdate >= timestamp '2001-10-01' then 'Adjustment' when l_returnflag = 'R' and l_linenumber = 1 then 'Refund' else 'Order' end as type,
  l_orderkey::varchar as order_id, strftime(l_shipdate, '%Y-%m') as transaction_month,
  (['amazon.in', 'Flipkart', 'MEESHO', 'Jio Mart', 'shopify'])[r_regionkey + 1] as marketplace,
  case l_linestatus when 'F' then 'Amazon' else 'Merchant' end as fulfillment, n_name as order_state,
  l_quantity::decimal(18,2) as quantity, l_extendedprice::decimal(18,2) as price, l_discount::decimal(6,4) as discount, l_tax::decimal(6,4) as tax, l_linestatus
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
txn1 as (select *, (case type when 'Order' then price when 'Refund' then -price else 0 end)::decimal(18,2) as product_sales,
  (case type when 'Order' then -price * discount else 0 end)::decimal(18,4) as promotional_rebates, (-price * 3 * tax)::decimal(18,4) as selling_fees,
  (case l_linestatus when 'F' then -price * 0.05::decimal(6,4) else 0 end)::decimal(18,4) as fba_fees from txn0),
txn as (select *, (product_sales + promotional_rebates + selling_fees + fba_fees)::decimal(18,4) as total from txn1),
product_master as (select 'SKU-' || p_partkey as seller_sku, p_partkey as src_row, case when p_partkey % 5 <> 0 then 'P' || lpad(p_partkey::varchar, greatest(4, length(p_partkey::varchar))::int, '0') end as public_product_id,
  p_brand as brand, p_type as category, split_part(p_name, ' ', 2) as subcategory, p_name as product_group, (p_retailprice::decimal(18,2) * p_size / 10)::double as price, 3 * p_size - 3 as quantity,
  case when p_size <= 5 then 'High' else 'Monitor' end as restock_priority, (p_retailprice::decimal(18,2) * 0.6::decimal(4,1))::decimal(18,4) as landed_cost,
  case when p_partkey % 3 = 0 then 'India' when p_partkey % 7 <> 0 then 'China' end as origin_country, case when p_partkey % 3 = 0 then 'No' when p_partkey % 7 <> 0 then ' Yes ' end as imported_flag from part where p_partkey % 17 <> 0),
amounts as (select sku, order_id, transaction_month, type as transaction_type_group,
  case when lower(marketplace) like '%amazon%' then 'Amazon' when lower(marketplace) like '%flipkart%' then 'Flipkart' when lower(marketplace) like '%meesho%' then 'Meesho' when lower(marketplace) like '%jio mart%' then 'JioMart' else 'Website' end as marketplace,
  case when fulfillment = 'Amazon' then 'FBA' else 'Merchant Fulfilled' end as fulfillment_type, {TITLE.format("order_state")} as state_group,
  greatest(product_sales, 0)::decimal(18,2) as gross, (case when product_sales < 0 or type = 'Refund' then abs(product_sales) else 0 end)::decimal(18,2) as refund,
  abs(promotional_rebates) as promo, (abs(selling_fees) + abs(fba_fees))::decimal(18,4) as fee, total as net,
  (case when type = 'Order' and product_sales > 0 then greatest(quantity, 0) else 0 end)::decimal(18,2) as units from txn),
ids as (select *, coalesce(public_product_id, 'P' || lpad((top + k)::varchar, greatest(4, length((top + k)::varchar))::int, '0')) as pid from
  (select *, row_number() over (partition by public_product_id is null order by src_row) as k, max(substr(public_product_id, 2)::int) over () as top from product_master)),
products as (select seller_sku as sku, pid as public_product_id, brand, category, subcategory, product_group, landed_cost, restock_priority, imported_flag,
  {band("price", PRICE_BAND, "4000+")} as listing_price_band, {band("quantity", STOCK_BAND, "Very High / 100+")} as inventory_band,
  case when lower(coalesce(origin_country, 'Unknown')) in ('india', 'in', 'bharat') then 'India' else 'Imported / Other' end as origin_country_group from ids),
strange as (select sku, 'UNMAPPED_' || printf('%04d', row_number() over (order by sku)) as unmapped from (select distinct sku from amounts where sku is not null and sku not in (select sku from products))),
lines as (select a.* exclude (sku), a.sku, '12m' as dataset_period, 'Marketplace' as channel, coalesce(p.public_product_id, s.unmapped, 'NON_PRODUCT_ACTIVITY') as public_product_id,
  coalesce(brand, case when a.sku is null then 'Non-product Activity' else 'Unmapped' end) as brand_group, coalesce(category, case when a.sku is null then 'Non-product Activity' else 'Unmapped' end) as category_group,
  coalesce(subcategory, case when a.sku is null then 'Non-product Activity' else 'Unmapped' end) as subcategory_group, coalesce(product_group, case when a.sku is null then 'Non-product Activity' else 'Unmapped Product' end) as product_group,
  coalesce(listing_price_band, 'Unknown') as listing_price_band, coalesce(inventory_band, 'Unknown') as inventory_band, coalesce(origin_country_group, 'Imported / Other') as origin_country_group,
  coalesce(restock_priority, 'Monitor') as restock_priority, coalesce(trim(imported_flag), 'Unknown') as imported_flag, case when p.sku is not null then 'Matched' when a.sku is null then 'Non-product' else 'Unmatched' end as mapping_status,
  (gross - units * coalesce(landed_cost, 0::decimal(18,4)) - fee - promo - refund)::decimal(24,4) as profit
  from amounts a left join products p on a.sku = p.sku left join strange s on a.sku = s.sku)"""


def metrics(name: str, given: str, product: bool, bands: bool) -> str:
    none = "public_product_id = 'NON_PRODUCT_ACTIVITY'" if product else "false"
    own = lambda c: f"case when {none} then null else {c} end"
    blank = lambda c: f"case when {none} then 'Not Applicable' else {c} end"
    margin = band("_margin", MARGIN_BAND, "High Margin")
    given_band = lambda c: f"coalesce(nullif({c}, 'Unknown'), {margin})" if bands else margin
    drop = ", margin_band_public, profitability_band_public" if bands else ""
    return f"""
{name}_1 as (select *, {idx("gross", "(max(gross) over ())")} as sales_index, {idx("units", "(max(units) over ())")} as units_index, {idx("greatest(profit, 0)", "(max(greatest(profit, 0)) over ())")} as margin_index0,
  {pct("fee", 0)} as fee_pct_of_gross, {pct("refund", 0)} as refund_pct_of_gross, {pct("promo", 0)} as promotion_pct_of_gross, {pct("net", -300)} as net_to_gross_pct,
  coalesce(round_even(profit::double / (case when gross > 0 then gross::double end) * 100.0::double, 1), 0.0::double) as _margin from {given}),
{name}_2 as (select *, round_even(greatest(least(fee_pct_of_gross * 0.35::double + refund_pct_of_gross * 0.25::double + promotion_pct_of_gross * 0.15::double + greatest(0, 70 - net_to_gross_pct) * 0.15::double + greatest(0, 30 - _margin) * 0.10::double, 100), 0), 1) as risk0,
  round_even(greatest(least(net_to_gross_pct - fee_pct_of_gross * 0.30::double - refund_pct_of_gross * 0.25::double - promotion_pct_of_gross * 0.15::double, 100), 0), 1) as quality0 from {name}_1),
{name}_3 as (select *, round_even(greatest(least(margin_index0 * 0.40::double + quality0 * 0.25::double + greatest(least(100 - risk0, 100), 0) * 0.20::double + greatest(least(net_to_gross_pct, 100), 0) * 0.15::double, 100), 0), 1) as epi0 from {name}_2),
{name} as (select * exclude (margin_index0, risk0, quality0, epi0, _margin{drop}), {own("margin_index0")} as margin_index, {own("risk0")} as margin_risk_score, {own("quality0")} as revenue_quality_score, {own("epi0")} as estimated_profitability_index,
  {blank(band("risk0", RISK_BAND, "Low Risk"))} as margin_risk_band, {blank(band("quality0", QUALITY_BAND, "Critical"))} as revenue_quality_band,
  {blank(given_band("margin_band_public"))} as margin_band_public, {blank(given_band("profitability_band_public"))} as profitability_band_public from {name}_3)"""


def actions(name: str, given: str, restock: bool) -> str:
    high = " or lower(restock_priority) like '%high%'" if restock else ""
    tests = [
        "margin_risk_score >= 70", "refund_pct_of_gross >= 10 and sales_index >= 10", "fee_pct_of_gross >= 25 and sales_index >= 20",
        f"units_index >= 50 and (lower(inventory_band) like '%out of stock%' or lower(inventory_band) like '%low%'{high})",
        "promotion_pct_of_gross >= 10 and net_to_gross_pct < 70", "revenue_quality_score < 45 and sales_index >= 15",
        "sales_index < 10 and units_index < 10 and (listing_price_band like '3000%' or listing_price_band like '4000%' or listing_price_band like '%+')",
        "units_index < 10 and (lower(inventory_band) like '%high%' or inventory_band like '%100+%')",
    ]
    pick = lambda i: "case " + " ".join(f"when {t} then {q(r[i])}" for t, r in zip(tests, RULES, strict=False)) + f" else {q(RULES[-1][i])} end"
    return f"{name} as (select *, {pick(0)} as recommended_action, {pick(1)} as action_priority, {pick(2)} as action_reason from {given})"


def aggregate(name: str, given: str, keys: list[str]) -> str:
    by = ", ".join(keys)
    product = "public_product_id" in keys
    bands = "margin_band_public" in keys
    mean = lambda c: f"sum({c}::decimal(10,1))::double / nullif(count({c}), 0)"
    score = "round_even(_risk, 1) as margin_risk_score, round_even(_quality, 1) as revenue_quality_score"
    return f"""
{name}_0 as (select {by}, {", ".join(f"sum({c}) as {c}" for c in ("gross", "units", "fee", "refund", "promo", "net", "profit"))},
  count(distinct case when public_product_id <> 'NON_PRODUCT_ACTIVITY' then public_product_id end) as product_count,
  count(distinct case when transaction_type_group = 'Order' then order_id end) as order_count, {mean("margin_risk_score")} as _risk, {mean("revenue_quality_score")} as _quality
  from {given} group by {by}),
{metrics(name + "_m", name + "_0", product, bands)},
{name}_n as (select * exclude (margin_risk_score, revenue_quality_score, margin_risk_band, revenue_quality_band), {idx("order_count", "(max(order_count) over ())")} as order_count_index, {score} from {name}_m),
{name} as (select *, {band("margin_risk_score", RISK_BAND, "Low Risk")} as margin_risk_band, {band("revenue_quality_score", QUALITY_BAND, "Critical")} as revenue_quality_band from {name}_n)"""


ROWS = ",".join([BASE, metrics("rowm", "lines", True, False), actions("rowa", "rowm", True), "prod as (select * from rowa where public_product_id <> 'NON_PRODUCT_ACTIVITY')"])
CHAIN = ",".join([
    ROWS,
    aggregate("mp", "rowa", ["dataset_period", "transaction_month", "marketplace"]),
    aggregate("ch", "rowa", ["dataset_period", "marketplace", "channel"]),
    aggregate("pp0", "prod", PRODUCT_KEYS), actions("pp", "pp0", False),
    aggregate("cat", "prod", ["dataset_period", "marketplace", "category_group", "subcategory_group"]),
    aggregate("brd", "prod", ["dataset_period", "marketplace", "brand_group", "category_group"]),
    aggregate("ful", "prod", ["dataset_period", "fulfillment_type"]),
    aggregate("pro", "prod", ["dataset_period", "marketplace", "category_group", "brand_group", "product_group", "margin_band_public", "profitability_band_public"]),
    aggregate("vm", "rowa", ["transaction_month", "marketplace"]),
    aggregate("vp", "prod", ["transaction_month", "public_product_id", "marketplace", "brand_group", "category_group"]),
])

PERIODS = """
months as (select transaction_month, sum(order_count)::bigint as orders from vm group by all),
periods as (select *, orders > 0 as valid, case when orders > 0 then row_number() over (partition by orders > 0 order by transaction_month desc) end as place,
  orders = 0 and transaction_month > (select max(transaction_month) from months where orders > 0) as excluded from months),
pair as (select max(case when place = 1 then transaction_month end) as current_period, max(case when place = 2 then transaction_month end) as previous_period from periods)"""


def moved(c: str) -> str:
    worse = ", ".join(map(q, WORSE_UP))
    return f"case when abs({c}) < 1e-9 then 'No Change' when (metric in ({worse})) = ({c} > 0) then 'Deterioration' else 'Improvement' end"


def compare(name: str, given: str, dims: list[str]) -> str:
    by = ", ".join(dims)
    at = lambda c: f"coalesce(max(case when transaction_month = {c} then value end), 0.0::double)"
    union = " union all ".join(f"select {by}, transaction_month, '{m}' as metric, {m} as value from {given}" for m in METRICS)
    return f"""
{name}_l as ({union}),
{name}_c as (select {by}, metric, previous_period, current_period, {at("previous_period")} as previous_value, {at("current_period")} as current_value from {name}_l, pair
  where transaction_month in (previous_period, current_period) group by {by}, metric, previous_period, current_period),
{name}_v as (select *, round_even(current_value - previous_value, 2) as absolute_variance, round_even((current_value - previous_value) / nullif(abs(previous_value), 0) * 100.0::double, 2) as percentage_variance from {name}_c),
{name}_s as (select *, sum(abs(absolute_variance)::decimal(18,2)) over (partition by metric)::double as _t from {name}_v),
{name} as (select * exclude (_t), coalesce(round_even(abs(absolute_variance) / (case when _t > 0 then _t end) * 100.0::double, 1), 0.0::double) as contribution_share, {moved("absolute_variance")} as movement from {name}_s)"""


VARIANCE = ",".join([CHAIN, PERIODS, compare("vmc", "vm", ["marketplace"]), compare("vpc", "vp", ["public_product_id", "marketplace", "brand_group", "category_group"])])


def sql(body: str, chain: str = CHAIN) -> str:
    return f"with {chain}\n{body}"
