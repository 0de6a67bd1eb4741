"""Queries that go through files (exports under a preamble, folders of CSV) and the texts and tables of the pages, with SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import columns
from ledgerloom.functions.text import half_even
from ledgerloom.operators import checks, marts, star, variance
from ledgerloom.plans import oracle, reports
from ledgerloom.sources import files, staging, tables

#: Two layouts of an export: what stands above the header, and each column's heading.
PREAMBLES = (["Includes all transactions", "All amounts in INR, unless said", "Definitions,"], ["Settlement report"])
HEADINGS = (
    {"date_time": "date/time", "order_id": "order id", "type": "Type", "sku": "SKU", "quantity": "quantity", "product_sales": "product sales", "promotional_rebates": "promotional rebates", "selling_fees": "selling fees", "fba_fees": "fba fees", "total": "total", "gst_tcs_tds": "GST/TCS-TDS"},
    {"date_time": "Date", "sku": " sku ", "type": "type", "order_id": "Order-ID", "total": "TOTAL", "fba_fees": "FBA Fee", "selling_fees": "Selling Fee", "promotional_rebates": "Promotional Rebates", "product_sales": "Product  Sales", "quantity": "Quantity"},
)
EXPECTED = ["date_time", "order_id", "type", "sku", "quantity", "product_sales", "promotional_rebates", "selling_fees", "fba_fees", "other_transaction_fees", "shipping_credits", "total"]


def _place(spark: SparkSession, name: str) -> str:
    return f"{staging.shared_dir(spark)}/ledgerloom/{uuid.uuid4().hex}/{name}"


def write_exports(spark: SparkSession, sf_dir: str) -> str:
    """Settlement lines as one text file a year, in one of two layouts; the second writes negative numbers in parentheses."""
    rows = tables.transactions(spark, sf_dir).selectExpr("*", "concat(transaction_month, '-01') as date_time", "'7.5' as gst_tcs_tds", "left(transaction_month, 4) as year")
    layout = F.pmod(F.col("year").cast("int"), F.lit(2))
    plain = lambda c: F.col(c).cast("string")
    marked = lambda c: F.when(F.col(c) < 0, F.concat(F.lit("("), F.format_number(-F.col(c), 4), F.lit(")"))).otherwise(F.format_number(F.col(c), 4))
    amount = {"product_sales", "promotional_rebates", "selling_fees", "fba_fees", "total", "quantity"}
    line = lambda k: F.to_csv(F.struct(*[(marked if k and c in amount else plain)(c).alias(c) for c in HEADINGS[k]]))
    body = rows.select("year", F.lit(0).alias("place"), F.when(layout == 0, line(0)).otherwise(line(1)).alias("value"))
    above = [[p if "," not in p else f'"{p}"' for p in PREAMBLES[k]] + [",".join(HEADINGS[k].values())] for k in (0, 1)]
    top = F.when(layout == 0, F.array(*map(F.lit, above[0]))).otherwise(F.array(*map(F.lit, above[1])))
    head = rows.select("year").distinct().select("year", F.posexplode(top).alias("place", "value")).withColumn("place", F.col("place") - 10)
    root = _place(spark, "exports")
    body.unionByName(head).repartition("year").sortWithinPartitions("year", "place").select("year", "value").write.partitionBy("year").text(root)
    return root


def read_exports(spark: SparkSession, root: str) -> DataFrame:
    """All files under a folder, each under its own header, with the expected columns first; `year` is the folder's."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/year=*/part-*")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or []
    parts = []
    for f in found:
        path = f.getPath()
        part = columns.expected_first(files.with_preamble(spark, path.toString()), EXPECTED)
        parts.append(part.withColumn("year", F.lit(path.getParent().getName()[5:])))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def settlement_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports read back, and their amounts by year and type."""
    rows = read_exports(spark, write_exports(spark, sf_dir))
    got = columns.amounts(columns.private_amounts(rows).withColumn("unit_cost_private_rs", F.lit("(2)")))
    total = lambda c, n: F.sum(F.col(c).cast("decimal(18,4)")).cast("double").alias(n)
    return got.groupBy("year", columns.words(got, ["transaction_kind", "type"], "Unknown").alias("type")).agg(
        F.count("*").alias("rows"), F.count("sku").alias("with_sku"), F.count_distinct("order_id").alias("orders"), *[total(c, c) for c in ("gross", "units", "refund", "promo", "fee", "net", "cogs", "profit")], total("tax_amount_private_rs", "tax"),
    )


SETTLEMENT_SQL = """select year, type, count(*) as rows, count(sku) as with_sku, count(distinct order_id) as orders, sum(gross)::double as gross, sum(units)::double as units, sum(refund)::double as refund, sum(promo)::double as promo,
    sum(fee)::double as fee, sum(net)::double as net, 0.0::double as cogs, sum(gross - fee - promo - refund)::double as profit, case when year::int % 2 = 0 then count(*) * 7.5::double else 0 end as tax
    from (select left(transaction_month, 4) as year, transaction_type_group as type, * from amounts) group by 1, 2"""


def public_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs as CSV tables, read back by name; whether their numbers say anything."""
    s, folder = star.load(spark, sf_dir), _place(spark, "public")
    files.save_outputs({n: s[n] for n in PUBLISHED}, folder)
    parts = []
    for name, df in sorted(files.stems(spark, folder).items()):
        index = columns.numeric(df, ["sales_index"])
        parts.append(df.agg(F.lit(name).alias("output"), F.count("*").alias("rows"), F.sum(index.cast("decimal(18,1)")).cast("double").alias("sales_index_total"), checks.meaningful(index).alias("meaningful"), checks.meaningful(columns.numeric(df, ["no_such_column"])).alias("absent_meaningful")))
    return reduce(DataFrame.unionByName, parts)


PUBLISHED = ("brand_performance", "category_performance", "marketplace_summary", "product_performance")
FOLDER_SQL = " union all ".join(
    f"select '{n}' as output, count(*) as rows, sum(sales_index::decimal(18,1))::double as sales_index_total, max(sales_index) > 0 as meaningful, false as absent_meaningful from {n}" for n in PUBLISHED
)


def master_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A master and a channel sheet under private names; a name that is there is not written over."""
    given = tables.product_master(spark, sf_dir).selectExpr("seller_sku as seller_sku_private", "cast(price as string) as listing_price_private_rs", "quantity + 1000 as current_quantity", "cast(quantity as string) as quantity", "if(src_row % 4 = 0, ' nan ', brand) as brand")
    rows = columns.expected_first(columns.aliased(given, columns.PRODUCT_ALIASES), ["seller_sku", "asin1", "item_name", "price"])
    sheet = columns.aliased(tables.channels(spark, sf_dir).withColumnRenamed("seller_sku", "seller_sku_private"), columns.CHANNEL_ALIASES)
    listed = sheet.groupBy("seller_sku").agg(F.count("*").alias("listings"))
    rows = rows.join(listed, "seller_sku", "left")
    number = lambda *c: F.sum(columns.numeric(rows, list(c)).cast("decimal(18,4)")).cast("double")
    return rows.groupBy(columns.words(rows, ["brand_group", "brand"], "Unmapped").alias("brand")).agg(
        F.count("seller_sku").alias("skus"), F.count("asin1").alias("asins"), number("price").alias("price"), number("units_on_hand", "quantity").alias("quantity"), number("no_such_column").alias("absent"), F.sum("listings").alias("listings"),
    )


ALIASES_SQL = """select case when src_row % 4 = 0 then 'Unmapped' else brand end as brand, count(*) as skus, 0 as asins, sum(price::decimal(18,4))::double as price, sum(quantity)::double as quantity, 0.0::double as absent,
    sum((select count(*) from channel_sheet c where c.seller_sku = m.seller_sku))::bigint as listings from product_master m group by 1"""


def _page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one row that the summary sentence and the table of safe metrics are made from."""
    s, lines, master, sheet = star.load(spark, sf_dir), marts.lines(spark, sf_dir), tables.product_master(spark, sf_dir), tables.channels(spark, sf_dir)
    sku, status = F.col("sku"), F.col("mapping_status")
    rows = lines.agg(F.count("*").alias("transactions"), F.count_if(F.col("transaction_type_group") == "Order").alias("orders"), F.count(sku).alias("with_sku"), F.count_if(sku.isNotNull() & (status == "Matched")).alias("matched"))
    both = lines.where("sku is not null").select("sku", F.lit(True).alias("sold")).distinct().join(master.select(F.col("seller_sku").alias("sku"), F.lit(True).alias("listed")).distinct(), "sku", "full")
    both = both.agg(F.count_if(F.col("listed").isNull()).alias("unlisted"), F.count_if(F.col("sold").isNull()).alias("unsold"))
    own = master.agg(F.count("*").alias("products"), (F.count("seller_sku") - F.count_distinct("seller_sku")).alias("duplicates"))
    wide = checks.per_sku(sheet).agg(F.count_if(F.col("n") >= 5).alias("everywhere"), F.count_if(F.col("n") < 5).alias("missing_one"))
    review = lambda what: F.count_if(F.col("recommended_action") == f"{what} Review")
    acts = s["product_action_review"].agg(F.count_if(F.col("action_priority") == "High").alias("high"), *[review(w).alias(w.split()[0].lower()) for w in ("Refund", "Promotion", "Slow Mover", "Margin Risk")])
    parts = [rows, both, own, wide, acts, sheet.agg(F.count("*").alias("listings")), s["marketplace_channel_performance"].agg(F.count_distinct("marketplace").alias("marketplaces"))]
    one = reduce(lambda a, b: a.crossJoin(b), parts)  # one row each
    return one.withColumn("coverage", F.coalesce(half_even(F.try_divide(F.col("matched"), F.col("with_sku")) * 100.0, 2), F.lit(0.0)))


# The wording of the summary, its places filled in order.
SUMMARY = (
    "The uploaded transaction file joined successfully with the product master at %.1f%% coverage on rows with SKUs. Reporting spans %d public marketplace group(s); marketplace-channel enrichment is "
    "unavailable until seller-SKU/public-product mappings are populated. The privacy-safe action logic identified %d high-priority item(s), %d Refund Review candidate(s), %d Promotion Review candidate(s), "
    "%d Slow Mover Review candidate(s), and %d Margin Risk Review candidate(s). All dashboard metrics use indexed activity, ratios, scores, percentages, and bands instead of raw money values."
)
# The metrics of the table of counts, and where each comes from.
SAFE = {
    "Transaction Rows": "transactions", "Order Rows": "orders", "Product Master Rows": "products", "Marketplace Master Rows": "listings", "Transaction Rows With SKU": "with_sku",
    "Matched Transaction Rows": "matched", "Unmatched Transaction Rows": "with_sku - matched", "Unmatched Transaction SKU Count": "unlisted", "Unmatched Listing SKU Count": "unsold",
    "Duplicate SKU Count": "duplicates", "Products in All 5 Marketplaces": "everywhere", "Products Missing a Marketplace": "missing_one",
}


def executive_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q07."""
    one = _page_counts(spark, sf_dir)
    return one.select(F.format_string(SUMMARY, half_even(F.col("coverage"), 1), *[F.col(c) for c in ("marketplaces", "high", "refund", "promotion", "slow", "margin")]).alias("summary"))


def safe_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q08: counts that a page may show, one row each; two of them are no counts and stand as text."""
    one = _page_counts(spark, sf_dir)
    items = {n: F.expr(e).cast("string") for n, e in SAFE.items()} | {"Join Coverage %": F.format_string("%.2f", F.col("coverage")), "Channel Mapping Status": F.lit("Unavailable")}
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), e.alias("value")) for n, e in items.items()])))


COUNTS_SQL = """page as (select *, coalesce(round_even(matched / nullif(with_sku, 0)::double * 100.0::double, 2), 0) as coverage from
    (select count(*) as transactions, count(*) filter (where transaction_type_group = 'Order') as orders, count(sku) as with_sku, count(*) filter (where mapping_status = 'Matched') as matched from lines),
    (select count(*) as unlisted from (select distinct sku from amounts where sku is not null and sku not in (select seller_sku from product_master))),
    (select count(*) as unsold from (select distinct seller_sku from product_master where seller_sku not in (select sku from amounts where sku is not null))),
    (select count(*) as products, count(*) - count(distinct seller_sku) as duplicates, (select count(*) from channel_sheet) as listings from product_master),
    (select count(*) filter (where n = 5) as everywhere, count(*) filter (where n < 5) as missing_one from (select count(distinct marketplace) as n from channel_sheet group by seller_sku)),
    (select count(*) filter (where action_priority = 'High') as high, """ + ", ".join(f"count(*) filter (where recommended_action = '{w} Review') as {w.split()[0].lower()}" for w in ("Refund", "Promotion", "Slow Mover", "Margin Risk")) + """, count(distinct marketplace) as marketplaces from pp))"""  # fmt: skip
SUMMARY_SQL = f"select printf({oracle.q(SUMMARY)}, round_even(coverage, 1), marketplaces, high, refund, promotion, slow, margin) as summary from page"
SAFE_SQL = " union all ".join(f"select '{n}' as metric, ({e})::varchar as value from page" for n, e in SAFE.items()) + " union all select 'Join Coverage %', printf('%.2f', coverage) from page union all select 'Channel Mapping Status', 'Unavailable'"


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 products that moved one metric most; the limit is the feature."""
    rows, dims = marts.rows(spark, sf_dir), ["public_product_id", "marketplace", "brand_group", "category_group"]
    moved = variance.compare(variance.product_matrix(rows), variance.periods(variance.marketplace_matrix(rows)), dims).where("metric = 'sales_index'")
    return moved.orderBy(F.desc(F.abs("absolute_variance")), *dims).limit(25).select(*dims, "previous_value", "current_value", "absolute_variance", "movement")


TOP_SQL = """select public_product_id, marketplace, brand_group, category_group, previous_value, current_value, absolute_variance, movement from vpc
    where metric = 'sales_index' order by abs(absolute_variance) desc, public_product_id, marketplace, brand_group, category_group limit 25"""


def _pages(body: str, sheet: str) -> str:
    return reports.duck(f"with {sheet}, {COUNTS_SQL} {body}")


def queries(sheet: str) -> dict[str, tuple[Callable, str]]:
    """By name; sheet: the channel sheet as a common table expression."""
    return {
        "settlement_files": (settlement_files, oracle.sql(SETTLEMENT_SQL, oracle.BASE)), "public_folder": (public_folder, reports.duck(FOLDER_SQL)),
        "master_aliases": (master_aliases, oracle.sql(ALIASES_SQL, f"{oracle.BASE}, {sheet}")), "executive_summary": (executive_summary, _pages(SUMMARY_SQL, sheet)),
        "safe_metrics": (safe_metrics, _pages(SAFE_SQL, sheet)), "page_top_products": (top_products, oracle.sql(TOP_SQL, oracle.VARIANCE)),
    }
