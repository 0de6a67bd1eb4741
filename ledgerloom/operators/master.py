"""From raw lines and the product master to public rows: amounts, product match, ids, context."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.operators.numbering import numbered

NON_PRODUCT = "NON_PRODUCT_ACTIVITY"
NOT_APPLICABLE = "Not Applicable"
# The labels of lines without a SKU.
NO_GROUP, NO_STATUS = "Non-product Activity", "Non-product"


def amounts(txn: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Gross, refund, promotion, fee, net and units of each line, with its standard groups (D06-D09), which are not made
    again where the lines have them; columns to keep come last."""
    sales, kind = F.col("product_sales"), F.col("transaction_type_group")
    group = lambda name, made: F.col(name) if name in txn.columns else made.alias(name)
    return txn.withColumn("transaction_type_group", text.transaction_type(F.col("type"))).select(
        "sku", "order_id", "transaction_month", "transaction_type_group", group("marketplace_group", text.marketplace(F.col("marketplace"))).alias("marketplace"),
        text.fulfillment(F.col("fulfillment")).alias("fulfillment_type"), group("state_group", text.state(F.col("order_state"))),
        F.greatest(sales, F.lit(0)).cast("decimal(18,2)").alias("gross"),
        F.when((sales < 0) | (kind == "Refund"), F.abs(sales)).otherwise(0).cast("decimal(18,2)").alias("refund"),
        F.abs("promotional_rebates").alias("promo"), (F.abs("selling_fees") + F.abs("fba_fees")).cast("decimal(18,4)").alias("fee"),
        F.col("total").alias("net"),
        F.when((kind == "Order") & (sales > 0), F.greatest("quantity", F.lit(0))).otherwise(0).cast("decimal(18,2)").alias("units"), *keep,
    )


def with_public_ids(master: DataFrame) -> DataFrame:
    """Products without an id get the next ones after the largest, in file order."""
    first = master.withColumn("rn", F.row_number().over(Window.partitionBy("seller_sku").orderBy("src_row"))).where("rn = 1").drop("rn")
    top = first.agg(F.coalesce(F.max(F.expr("try_cast(substr(public_product_id, 2) as int)")), F.lit(0)).alias("top"))
    missing = numbered(first.where("public_product_id is null"), ["src_row", "seller_sku"], "k")
    number = (F.col("top") + F.col("k")).cast("string")
    named = missing.crossJoin(F.broadcast(top)).withColumn("public_product_id", F.concat(F.lit("P"), F.lpad(number, F.greatest(F.lit(4), F.length(number)), "0")))
    return first.where("public_product_id is not null").unionByName(named.drop("k", "top"))


def matched(lines: DataFrame, master: DataFrame, made: Callable[[DataFrame, list[str]], DataFrame] | None = None) -> DataFrame:
    """Lines with their product; unmatched SKUs get ids by sorted order, lines without SKU the sentinel.

    With `made`, lines need no more than their SKU yet: it makes the amounts of the matched ones, keeping the columns named, so
    that what the joins shuffle is as narrow as the line items are."""
    product = with_public_ids(master).select(
        F.col("seller_sku").alias("sku"), "public_product_id", "brand", "category", "subcategory", "product_group", "landed_cost", "restock_priority", text.group_value(F.coalesce("imported_flag", F.lit("")), "Unknown").alias("imported_flag"),
        text.price_band(F.col("price")).alias("listing_price_band"), text.inventory_band(F.col("quantity")).alias("inventory_band"),
        text.origin(F.coalesce("origin_country", F.lit("Unknown"))).alias("origin_country_group"), F.lit(True).alias("is_matched"),
    )
    strange = lines.where("sku is not null").select("sku").distinct().join(product.select("sku"), "sku", "left_anti")
    named = numbered(strange, ["sku"], "k").select("sku", F.format_string("UNMAPPED_%04d", "k").alias("unmapped"))
    known = product.unionByName(named, allowMissingColumns=True).withColumnRenamed("sku", "_sku")
    # lines without SKU, a tenth of all, match nothing; a salt in the place of their SKU spreads them over the tasks of the join
    salt = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*lines.columns), F.lit(4096)).cast("string"))
    dealt = lines.select(*[c for c in lines.columns if c != "sku"], F.coalesce("sku", salt).alias("_key"), F.col("sku").isNotNull().alias("_sold"))
    joined = dealt.join(known, F.expr("_key = _sku and _sold"), "left").withColumn("sku", F.when(F.col("_sold"), F.col("_key"))).drop("_key", "_sku", "_sold")
    found = [*[c for c in product.columns if c != "sku"], "unmapped"]
    joined = made(joined, found) if made else joined
    other = lambda c, unmapped, none: F.coalesce(F.col(c), F.when(F.col("sku").isNull(), none).otherwise(unmapped)).alias(c)
    return joined.select(
        *[c for c in joined.columns if c not in ("sku", *found)], "sku", F.lit("12m").alias("dataset_period"), F.lit("Marketplace").alias("channel"),
        F.coalesce("public_product_id", "unmapped", F.lit(NON_PRODUCT)).alias("public_product_id"),
        other("brand", "Unmapped", NO_GROUP).alias("brand_group"), other("category", "Unmapped", NO_GROUP).alias("category_group"),
        other("subcategory", "Unmapped", NO_GROUP).alias("subcategory_group"), other("product_group", "Unmapped Product", NO_GROUP).alias("product_group"),
        F.coalesce("listing_price_band", F.lit("Unknown")).alias("listing_price_band"), F.coalesce("inventory_band", F.lit("Unknown")).alias("inventory_band"),
        F.coalesce("origin_country_group", F.lit("Imported / Other")).alias("origin_country_group"), F.coalesce("restock_priority", F.lit("Monitor")).alias("restock_priority"), F.coalesce("imported_flag", F.lit("Unknown")).alias("imported_flag"),
        F.when(F.col("is_matched"), "Matched").when(F.col("sku").isNull(), NO_STATUS).otherwise("Unmatched").alias("mapping_status"),
        (F.col("gross") - F.col("units") * F.coalesce("landed_cost", F.lit(0).cast("decimal(18,4)")) - F.col("fee") - F.col("promo") - F.col("refund")).cast("decimal(24,4)").alias("profit"),
    )
