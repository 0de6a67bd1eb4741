"""The logical views of the commerce domain over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions import text

#: The tables that the commerce views read.
INPUTS = ("lineitem", "orders", "customer", "nation", "region", "part")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row_numbers(df: DataFrame, name: str = "row_number") -> DataFrame:
    """Adds each row's place, from 0, in the Parquet files that `df` is read from, one file after the other by path. The place
    in a file comes from the reader, so it is the same whatever the splits; only one count per file meets in one task."""
    placed = df.withColumns({"_file": F.col("_metadata.file_path"), "_index": F.col("_metadata.row_index")})
    sizes = df.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index")).groupBy("_file").agg((F.max("_index") + 1).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return placed.join(F.broadcast(base), "_file").withColumn(name, F.col("_base") + F.col("_index")).drop("_file", "_index", "_base")


def sold(spark: SparkSession, sf_dir: str, numbered: bool = False) -> DataFrame:
    """Line items with their SKU and their buyer's nation. Orders meet customers first, two keys wide, so that the lines are
    shuffled once, and flags stand for the texts that they are made from."""
    line, orders, customer = (read(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    line, extra = (with_row_numbers(line), ["row_number"]) if numbered else (line, [])
    line = line.selectExpr(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
        "coalesce(l_returnflag = 'R' and l_linenumber = 1, false) as l_refund", "coalesce(l_linestatus = 'F', false) as l_amazon", *extra,
    )
    customer = customer.select("c_custkey", "c_nationkey").join(F.broadcast(places(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    buyers = orders.select("o_orderkey", "o_custkey").join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    rows = line.join(buyers, line.l_orderkey == buyers.o_orderkey)
    return rows.selectExpr(
        "case when l_partkey % 10 <> 0 then concat('SKU-', l_partkey) end as sku", "coalesce(l_partkey % 10 = 0, false) as l_service", "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_refund", "l_amazon", "c_nationkey", *extra,
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their marketplace, as raw lines name both and as groups. Of fixed size, like regions, so it is broadcast."""
    place = read(spark, sf_dir, "nation").join(F.broadcast(read(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    place = place.selectExpr("n_nationkey", "get(array('amazon.in', 'Flipkart', 'MEESHO', 'Jio Mart', 'shopify'), r_regionkey) as marketplace", "n_name as order_state")
    return place.withColumns({"marketplace_group": text.marketplace(F.col("marketplace")), "state_group": text.state(F.col("order_state"))})


def settled(lines: DataFrame, place: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Settlement lines from line items; columns to keep come last."""
    return lines.join(F.broadcast(place), F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "sku",
        """case when l_service then 'Service Fee' when l_shipdate >= timestamp '2001-10-01' then 'Adjustment'
                when l_refund then 'Refund' else 'Order' end as type""",
        "cast(l_orderkey as string) as order_id", "date_format(l_shipdate, 'yyyy-MM') as transaction_month", "marketplace",
        "if(l_amazon, 'Amazon', 'Merchant') as fulfillment", "order_state",
        "cast(l_quantity as decimal(18,2)) as quantity", "cast(l_extendedprice as decimal(18,2)) as price",
        "cast(l_discount as decimal(6,4)) as discount", "cast(l_tax as decimal(6,4)) as tax", "l_amazon", *keep,
    ).selectExpr(
        "sku", "type", "order_id", "transaction_month", "marketplace", "fulfillment", "order_state", "quantity",
        "cast(case type when 'Order' then price when 'Refund' then -price else 0 end as decimal(18,2)) as product_sales",
        "cast(case type when 'Order' then -price * discount else 0 end as decimal(18,4)) as promotional_rebates",
        "cast(-price * 3 * tax as decimal(18,4)) as selling_fees",
        "cast(case when l_amazon then -price * cast(0.05 as decimal(6,4)) else 0 end as decimal(18,4)) as fba_fees", *keep,
    ).withColumn("total", F.expr("cast(product_sales + promotional_rebates + selling_fees + fba_fees as decimal(18,4))"))


def transactions(spark: SparkSession, sf_dir: str, numbered: bool = False) -> DataFrame:
    """Raw settlement lines: one per line item."""
    rows = settled(sold(spark, sf_dir, numbered), places(spark, sf_dir), ["row_number"] if numbered else [])
    return rows.select(*[c for c in rows.columns if c not in ("row_number", "total")], *(["row_number"] if numbered else []), "total")


def export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settlement lines as an export writes them: all text, dates in several formats, some cells blank or no number."""
    line = with_row_numbers(read(spark, sf_dir, "lineitem"))
    return line.selectExpr(
        "row_number", "concat(l_orderkey, '-', l_linenumber) as line_ref", "cast(l_orderkey as string) as order_id", "case when l_partkey % 10 <> 0 then concat('SKU-', l_partkey) end as sku",
        "get(array('Amazon', 'Flipkart', ' Meesho ', 'JioMart', 'Website', 'Corner Shop'), cast(l_suppkey % 6 as int)) as marketplace",
        "case when row_number % 97 = 0 then 'n/a' when row_number % 89 = 0 then '  ' else cast(cast(l_quantity as decimal(18,2)) as string) end as quantity",
        "case when l_returnflag = 'R' and l_linenumber = 1 then -1 else 1 end * cast(l_extendedprice as decimal(18,2)) as amount",
        """case row_number % 7 when 0 then date_format(l_shipdate, "dd MMM yyyy hh:mm:ss a 'UTC'") when 1 then date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') when 2 then date_format(l_shipdate, 'yyyy-MM-dd')
            when 3 then date_format(l_shipdate, "yyyy-MM-dd'T'HH:mm:ss'Z'") when 4 then date_format(l_shipdate, 'dd MMM yyyy') when 5 then 'soon' end as date_time""",
        "case when row_number % 11 <> 0 then date_format(l_shipdate, \"yyyy-MM-dd HH:mm:ss 'IST'\") when row_number % 2 = 0 then ' nan ' end as open_date",
    )


def product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").where("p_partkey % 17 <> 0").selectExpr(
        "concat('SKU-', p_partkey) as seller_sku", "p_partkey as src_row",
        "case when p_partkey % 5 <> 0 then concat('P', lpad(cast(p_partkey as string), greatest(4, length(cast(p_partkey as string))), '0')) end as public_product_id",
        "p_brand as brand", "p_type as category", "split_part(p_name, ' ', 2) as subcategory", "p_name as product_group",
        "cast(cast(p_retailprice as decimal(18,2)) * p_size / 10 as double) as price", "3 * p_size - 3 as quantity",
        "case when p_size <= 5 then 'High' else 'Monitor' end as restock_priority",
        "cast(cast(p_retailprice as decimal(18,2)) * cast(0.6 as decimal(4,1)) as decimal(18,4)) as landed_cost",
        "case when p_partkey % 3 = 0 then 'India' when p_partkey % 7 <> 0 then 'China' end as origin_country", "case when p_partkey % 3 = 0 then 'No' when p_partkey % 7 <> 0 then ' Yes ' end as imported_flag",
    )


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The channel sheet: a row for each product and marketplace that lists it, and a few repeated ones."""
    names = "array('Amazon', 'Flipkart', 'Meesho', 'JioMart', 'Website')"
    rows = read(spark, sf_dir, "part").selectExpr("p_partkey", "p_size", f"posexplode({names}) as (k, marketplace)").where("(p_partkey + k) % 13 <> 0")
    rows = rows.selectExpr("*", "explode(if(p_partkey % 19 = k, array(0, 1), array(0))) as copy")
    return rows.selectExpr("p_partkey * 10 + k * 2 + copy as src_row", "concat('SKU-', p_partkey) as seller_sku", "marketplace", "concat(if(copy = 0, 'Live ', 'Draft '), p_size % 4) as channel_readiness")
