"""Headers brought into one form, and columns found by the first of several names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text

# Names that stand for another.
SAME = {"date": "date_time", "asin": "asin1", "selling_fee": "selling_fees", "fba_fee": "fba_fees"}


def normal_name(name: object) -> str:
    """Lower case, words joined by single underscores, % and & spelled out."""
    words = str("" if name is None else name).strip().lstrip("﻿").lower().replace("%", " pct ").replace("&", " and ")
    out = re.sub("[^a-z0-9]+", "_", words).strip("_")
    return SAME.get(out, out)


def normal_names(names: list) -> list[str]:
    """Repeats get _1, _2; blank names are unnamed."""
    seen: dict[str, int] = {}
    out = []
    for name in map(normal_name, names):
        name = name or "unnamed"
        seen[name] = seen.get(name, -1) + 1
        out.append(f"{name}_{seen[name]}" if seen[name] else name)
    return out


def normalized(df: DataFrame) -> DataFrame:
    return df.toDF(*normal_names(df.columns))


def aliased(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """A copy under the target's name, where the target is absent."""
    for source, target in aliases.items():
        if source in df.columns and target not in df.columns:
            df = df.withColumn(target, F.col(source))
    return df


def expected_first(df: DataFrame, expected: list[str]) -> DataFrame:
    """Expected columns first, absent ones null; the others after them."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in expected], *[c for c in df.columns if c not in expected])


def first_existing(df: DataFrame, candidates: list[str]) -> str | None:
    """B06."""
    return next((c for c in candidates if c in df.columns), None)


def numeric(df: DataFrame, candidates: list[str], default: float = 0.0) -> Column:
    """The first existing column as a number, what is none is 0; a default without any."""
    c = first_existing(df, candidates)
    if c is None:
        return F.lit(float(default))
    return F.coalesce(text.money(F.col(c).cast("string")), F.lit(0.0))


def words(df: DataFrame, candidates: list[str], default: str) -> Column:
    """The first existing column as clean text, the default where there is none."""
    c = first_existing(df, candidates)
    return F.lit(default) if c is None else F.coalesce(text.clean(F.col(c).cast("string")), F.lit(default))


# The names under which private amounts come, the first existing one counts.
AMOUNTS = {
    "gross": ["_gross_sales_private_calc", "gross_sales_private_rs", "gross_sales_private", "product_sales"],
    "units": ["_units_private_calc", "units_private", "units_private_rs", "quantity"],
    "refund": ["_refund_private_calc", "refund_amount_private_rs", "refund_amount_private"],
    "promo": ["_promotion_private_calc", "promotion_amount_private_rs", "promotion_amount_private", "promotional_rebates"],
    "fee": ["_fee_private_calc", "total_fee_private_rs", "amazon_fee_private"],
    "net": ["_net_private_calc", "net_amount_private_rs", "net_amount_private", "total"],
}
FEES = (["selling_fee_private_rs", "selling_fees"], ["fba_fee_private_rs", "fba_fees"], ["other_fee_private_rs", "other_transaction_fees"])
UNIT_COST = ["total_channel_cost_private_rs", "landed_cost_private_rs", "total_estimated_cost_private_rs", "unit_cost_private_rs"]
COGS = ["estimated_cogs_private_rs"]
PROFIT = ["_estimated_profit_private_calc", "estimated_gross_profit_private_rs", "estimated_channel_profit_private_rs", "estimated_profit_private_rs"]


def amounts(df: DataFrame) -> DataFrame:
    """Gross, units, refund, promo, fee, net, cogs and profit. Fee, cogs and profit that are 0 in the whole frame are
    made from their parts; the test is one aggregate, its row is broadcast."""
    found = {k: numeric(df, names) for k, names in AMOUNTS.items()}
    found["units"] = F.greatest(found["units"], F.lit(0.0))
    found |= {k: F.abs(found[k]) for k in ("refund", "promo", "fee")}
    parts = sum((F.abs(numeric(df, names)) for names in FEES[1:]), F.abs(numeric(df, FEES[0])))
    given = {"fee": found["fee"], "cogs": numeric(df, COGS), "profit": numeric(df, PROFIT)}
    some = df.agg(*[F.coalesce(F.max(c != 0), F.lit(False)).alias(f"_{k}") for k, c in given.items()])
    cost = F.greatest(numeric(df, UNIT_COST), F.lit(0.0))
    df = df.crossJoin(F.broadcast(some)).withColumns({k: found[k] for k in ("gross", "units", "refund", "promo", "net")} | {"fee": F.when(F.col("_fee"), given["fee"]).otherwise(parts)})
    df = df.withColumn("cogs", F.when(F.col("_cogs"), given["cogs"]).otherwise(F.col("units") * cost))
    own = F.col("gross") - F.col("cogs") - F.col("fee") - F.col("promo") - F.col("refund")
    return df.withColumn("profit", F.when(F.col("_profit"), given["profit"]).otherwise(own)).drop("_fee", "_cogs", "_profit")


# Private names of a product master and the names that they stand for; the channel sheet has the first of them.
PRODUCT_ALIASES = {
    "seller_sku_private": "seller_sku", "asin_private": "asin1", "item_name_private": "item_name", "item_description_private": "item_description", "current_quantity": "quantity",
    "listing_price_private_rs": "price", "mrp_private_rs": "maximum_retail_price", "estimated_margin_pct_private": "estimated_profit_margin_pct_private",
}
CHANNEL_ALIASES = {"seller_sku_private": "seller_sku"}


def private_amounts(df: DataFrame, kind: str = "type") -> DataFrame:
    """Private amounts from a settlement export's text columns, absent ones as 0, and their mirrors in rupees."""
    n = {c: numeric(df, [c]) for c in ("product_sales", "promotional_rebates", "selling_fees", "fba_fees", "other_transaction_fees", "total", "quantity", "gst_tcs_tds", "shipping_credits")}
    sales, of = n["product_sales"], lambda what: F.coalesce(F.col(kind) == what, F.lit(False))
    zero = F.lit(0.0)
    made = {
        "gross_sales_private": F.greatest(sales, zero), "refund_amount_private": F.when((sales < 0) | of("Refund"), F.abs(sales)).otherwise(zero),
        "promotion_amount_private": F.abs(n["promotional_rebates"]), "amazon_fee_private": F.abs(n["selling_fees"]) + F.abs(n["fba_fees"]) + F.abs(n["other_transaction_fees"]),
        "net_amount_private": n["total"], "units_private": F.when(of("Order") & (sales > 0), F.greatest(n["quantity"], zero)).otherwise(zero),
    }
    mirrors = {f"{c}_rs": e for c, e in made.items() if c != "amazon_fee_private"}
    mirrors |= {
        "tax_amount_private_rs": n["gst_tcs_tds"], "shipping_credit_private_rs": n["shipping_credits"], "selling_fee_private_rs": n["selling_fees"],
        "fba_fee_private_rs": n["fba_fees"], "other_fee_private_rs": n["other_transaction_fees"], "total_fee_private_rs": made["amazon_fee_private"],
    }
    return df.withColumns(made | mirrors)
