"""The metric kernel, the scores, the ordered rules and the grouped aggregate that runs the kernel again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.functions.text import half_even
from ledgerloom.operators.master import NON_PRODUCT, NOT_APPLICABLE
from ledgerloom.sources.staging import staged

# The rules in order, with priority and reason; the last is the default.
RULES = (
    ("Margin Risk Review", "High", "Critical margin-risk score from fee, refund, promotion, net, and margin signals."),
    ("Refund Review", "High", "Meaningful sales-index product with elevated refund percentage."),
    ("Fee Review", "High", "High sales-index product with elevated fee percentage."),
    ("Restock Review", "High", "High indexed unit movement with low inventory or restock priority."),
    ("Promotion Review", "Medium", "Promotion percentage is elevated while net-to-gross is below target."),
    ("Revenue Quality Review", "Medium", "Revenue quality score is weak for a product with measurable indexed demand."),
    ("Pricing Review", "Medium", "Low indexed demand for a higher-price-band listing."),
    ("Slow Mover Review", "Low", "Low indexed unit movement with high inventory band."),
    ("Monitor", "Low", "No action threshold triggered; continue monitoring."),
)


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.least(c, F.lit(float(hi))), F.lit(float(lo)))


def index(value: Column, most: Column) -> Column:
    """Share of the frame's largest value, 0 to 100, one half-even decimal."""
    share = clip(value.cast("double") / F.when(most > 0, most.cast("double")) * 100.0, 0, 100)
    return F.coalesce(half_even(share, 1), F.lit(0.0))


def pct(part: Column, gross: Column, signed: bool = False) -> Column:
    """Percent of gross, 0 without sales."""
    value = part.cast("double") if signed else F.abs(part).cast("double")
    share = value / F.when(gross > 0, gross.cast("double")) * 100.0
    return F.coalesce(half_even(clip(share, -300 if signed else 0, 300), 1), F.lit(0.0))


def metrics(df: DataFrame) -> DataFrame:
    """I06-I14 for a frame with gross, units, fee, refund, promo, net, profit. Largest values are one broadcast row."""
    profit = F.greatest("profit", F.lit(0))
    most = df.agg(F.max("gross").alias("_g"), F.max("units").alias("_u"), F.max(profit).alias("_p"))
    df = df.crossJoin(F.broadcast(most)).withColumns({
        "sales_index": index(F.col("gross"), F.col("_g")), "units_index": index(F.col("units"), F.col("_u")), "margin_index": index(profit, F.col("_p")),
        "fee_pct_of_gross": pct(F.col("fee"), F.col("gross")), "refund_pct_of_gross": pct(F.col("refund"), F.col("gross")),
        "promotion_pct_of_gross": pct(F.col("promo"), F.col("gross")), "net_to_gross_pct": pct(F.col("net"), F.col("gross"), True),
        "_margin": F.coalesce(half_even(F.col("profit").cast("double") / F.when(F.col("gross") > 0, F.col("gross").cast("double")) * 100.0, 1), F.lit(0.0)),
    }).drop("_g", "_u", "_p")
    fee, refund, promo, net = (F.col(c) for c in ("fee_pct_of_gross", "refund_pct_of_gross", "promotion_pct_of_gross", "net_to_gross_pct"))
    below = lambda top, c: F.greatest(F.lit(0.0), F.lit(float(top)) - c)
    risk = fee * 0.35 + refund * 0.25 + promo * 0.15 + below(70, net) * 0.15 + below(30, F.col("_margin")) * 0.10
    df = df.withColumns({
        "margin_risk_score": half_even(clip(risk, 0, 100), 1),
        "revenue_quality_score": half_even(clip(net - fee * 0.30 - refund * 0.25 - promo * 0.15, 0, 100), 1),
    })
    blend = F.col("margin_index") * 0.40 + F.col("revenue_quality_score") * 0.25 + clip(100.0 - F.col("margin_risk_score"), 0, 100) * 0.20 + clip(net, 0, 100) * 0.15
    df = df.withColumns({
        "estimated_profitability_index": half_even(clip(blend, 0, 100), 1),
        "margin_risk_band": text.risk_band(F.col("margin_risk_score")), "revenue_quality_band": text.quality_band(F.col("revenue_quality_score")),
    })
    for c in ("margin_band_public", "profitability_band_public"):
        given = F.nullif(F.col(c), F.lit("Unknown")) if c in df.columns else F.lit(None).cast("string")
        df = df.withColumn(c, F.coalesce(given, text.margin_band(F.col("_margin"))))
    if "public_product_id" in df.columns:
        none = F.col("public_product_id") == NON_PRODUCT
        df = df.withColumns({c: F.when(~none, F.col(c)) for c in ("margin_risk_score", "revenue_quality_score", "margin_index", "estimated_profitability_index")})
        df = df.withColumns({c: F.when(none, NOT_APPLICABLE).otherwise(F.col(c)) for c in ("margin_band_public", "profitability_band_public", "margin_risk_band", "revenue_quality_band")})
    return df.drop("_margin")


def actions(df: DataFrame) -> DataFrame:
    """The first rule that holds gives action, priority and reason; a null score holds for none."""
    low = lambda c: F.lower(F.col(c)) if c in df.columns else F.lit("")
    price, stock, restock = low("listing_price_band"), low("inventory_band"), low("restock_priority")
    dear = price.contains("premium") | price.startswith("3000") | price.startswith("4000") | price.endswith("+")
    sales, units, net = F.col("sales_index"), F.col("units_index"), F.col("net_to_gross_pct")
    tests = [
        F.col("margin_risk_score") >= 70, (F.col("refund_pct_of_gross") >= 10) & (sales >= 10), (F.col("fee_pct_of_gross") >= 25) & (sales >= 20),
        (units >= 50) & (stock.contains("out of stock") | stock.contains("low") | restock.contains("high")),
        (F.col("promotion_pct_of_gross") >= 10) & (net < 70), (F.col("revenue_quality_score") < 45) & (sales >= 15),
        (sales < 10) & (units < 10) & dear, (units < 10) & (stock.contains("high") | stock.contains("100+")),
    ]
    rule = F.lit(len(tests))
    for k in range(len(tests) - 1, -1, -1):
        rule = F.when(tests[k], k).otherwise(rule)
    pick = lambda i: F.get(F.array(*[F.lit(r[i]) for r in RULES]), F.col("_rule"))
    return df.withColumn("_rule", rule).withColumns({"recommended_action": pick(0), "action_priority": pick(1), "action_reason": pick(2)}).drop("_rule")


def aggregate(df: DataFrame, keys: list[str], counts: tuple[str, ...] = ("product_count", "order_count"), slices: int = 1) -> DataFrame:
    """exact sums and distinct counts by keys, the kernel again, then scores as means of the rows' scores (I15). Of the
    two distinct counts, each of which shuffles every value of every group, only those named are made. Groups that are nearly as many as rows are made in `slices` of
    the first key, one after the other, so that the disk holds the shuffle of one slice."""
    mean = lambda c: F.try_divide(F.sum(F.col(c).cast("decimal(10,1)")).cast("double"), F.count(c))
    sums = [F.sum(c).alias(c) for c in ("gross", "units", "fee", "refund", "promo", "net", "profit")]
    got = df.groupBy(*keys).agg(*sums, mean("margin_risk_score").alias("_risk"), mean("revenue_quality_score").alias("_quality"))
    # distinct counts apart: beside the sums in one aggregate they would carry every row three times through the shuffle
    counted = {"product_count": (F.col("public_product_id") != NON_PRODUCT, "public_product_id"), "order_count": (F.col("transaction_type_group") == "Order", "order_id")}
    counted = {n: x for n, x in counted.items() if n in counts}
    for name, (test, column) in counted.items():
        own = df.where(test & F.col(column).isNotNull()).select(*keys, F.col(column).alias("_what")).distinct().groupBy(*keys).agg(F.count("*").alias(name))
        got = got.unionByName(own, allowMissingColumns=True)
    figures = [c for c in got.columns if c not in keys]
    if counted:
        got = got.groupBy(*keys).agg(*[(F.coalesce(F.max(c), F.lit(0)) if c in counted else F.max(c)).alias(c) for c in figures])
    # the kernel reads the groups twice, for their largest values and for themselves: the rows below are read once
    part = F.pmod(F.xxhash64(keys[0]), F.lit(slices))
    got = reduce(DataFrame.unionByName, [staged(got.where(part == k), "groups") for k in range(slices)]) if slices > 1 else staged(got, "groups")
    orders = got.agg(F.max("order_count").alias("_o")) if "order_count" in counted else None
    got = metrics(got)
    if orders is not None:
        got = got.crossJoin(F.broadcast(orders)).withColumn("order_count_index", index(F.col("order_count"), F.col("_o"))).drop("_o")
    got = got.withColumns({"margin_risk_score": half_even(F.col("_risk"), 1), "revenue_quality_score": half_even(F.col("_quality"), 1)})
    got = got.withColumns({"margin_risk_band": text.risk_band(F.col("margin_risk_score")), "revenue_quality_band": text.quality_band(F.col("revenue_quality_score"))})
    return got.drop("_risk", "_quality")
