"""Text clean-up, standard groups and bands, as built-in expressions."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels of groups and bands below, and here the spellings that stand for a missing value.
NULLS = ("", "nan", "NaN", "None", "<NA>", "null")
NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def half_even(c: Column, digits: int) -> Column:
    """Half-even on the binary value, scaled up and down again; never a negative zero."""
    scale = float(10**digits)
    return F.rint(c * scale) / scale + 0.0


def clean(c: Column) -> Column:
    """Trimmed text, null for a missing value's spellings."""
    t = F.trim(c)
    return F.when(t.isin(*NULLS), None).otherwise(t)


def group_value(c: Column, default: str) -> Column:
    """White space collapsed, a default where nothing is left."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit("")), F.lit(default))


def money(c: Column) -> Column:
    """Parentheses negate, marks and separators go, what is no number is 0."""
    t = F.trim(c)
    bare = F.trim(F.regexp_replace(t, r"INR|[(),₹$]", ""))
    number = F.when(bare.rlike(NUMBER), bare.try_cast("double")).otherwise(F.lit(0.0))
    return F.when(t.rlike(r"^\(.*\)$"), -F.abs(number)).otherwise(number)


# The formats of dates, tried in order.
DATE_FORMATS = ("d MMM yyyy h:mm:ss a 'UTC'", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd", "d MMM yyyy", "MMM d, yyyy", "MM/dd/yyyy")


def timestamp(c: Column) -> Column:
    """The first format that fits the trimmed text, in the session's time zone; null where none does."""
    t = F.trim(c)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in DATE_FORMATS])


def unparsed(c: Column) -> Column:
    """Whether a text is there that is no date."""
    return F.coalesce(F.trim(c) != "", F.lit(False)) & timestamp(c).isNull()


def month(c: Column) -> Column:
    """D04."""
    return F.coalesce(F.date_format(timestamp(c), "yyyy-MM"), F.lit("Unknown"))


def open_date(c: Column) -> Column:
    """A trailing time zone name goes; the day as text."""
    return F.date_format(timestamp(F.regexp_replace(clean(c), r"\s+IST$", "")), "yyyy-MM-dd")


def period_of_counts(rows: Column, orders: Column) -> Column:
    """The period that so many rows or orders stand for."""
    most = F.greatest(F.coalesce(rows, F.lit(0)), F.coalesce(orders, F.lit(0)))
    return F.when(most >= 100_000, "12m").when(most >= 60_000, "6m").when(most >= 30_000, "3m").when(most >= 10_000, "1m").otherwise("custom_upload")


def title(c: Column) -> Column:
    """Capital after every character that is no letter."""
    return F.array_join(F.transform(F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}]+|[^\p{L}]+)")), F.initcap), "")


def transaction_type(c: Column) -> Column:
    """Ordered rules on parts of the text."""
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    has = lambda *xs: reduce(and_, [t.contains(x) for x in xs])
    rules = [(("fulfillment", "refund"), "Fulfillment Fee Refund"), (("refund",), "Refund"), (("shipping", "service"), "Shipping Service"), (("reimburse",), "Reimbursement"), (("order",), "Order"), (("service", "fee"), "Service Fee"), (("adjust",), "Adjustment")]
    out = None
    for parts, name in rules:
        out = F.when(has(*parts), name) if out is None else out.when(has(*parts), name)
    return out.when(t != "", title(t)).otherwise("Other")


def fulfillment(c: Column) -> Column:
    """D07."""
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    named = F.when(t.contains("amazon") | t.contains("fba"), "FBA").when(t.contains("merchant") | t.contains("seller"), "Merchant Fulfilled")
    return F.when(t == "", "Non-order / Unknown").otherwise(F.coalesce(named, title(F.trim(c))))


def marketplace(c: Column) -> Column:
    """D08."""
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    named = (
        F.when(t.contains("amazon"), "Amazon").when(t.contains("flipkart"), "Flipkart").when(t.contains("meesho"), "Meesho")
        .when(t.contains("jiomart") | t.contains("jio mart"), "JioMart")
        .when(t.contains("website") | t.contains("shopify") | t.isin("web", "direct"), "Website")
    )
    return F.when(t == "", "Unknown").otherwise(F.coalesce(named, title(F.trim(c))))


def state(c: Column) -> Column:
    """D09."""
    t = F.trim(F.coalesce(c, F.lit("")))
    return F.when(t == "", "Unknown").otherwise(title(F.regexp_replace(t, r"\s+", " ")))


def origin(c: Column) -> Column:
    """D11."""
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(t == "", "Unknown").when(t.isin("india", "in", "bharat"), "India").otherwise("Imported / Other")


def _bands(c: Column, steps: list[tuple[float, str]], last: str, upper: bool = True) -> Column:
    out = None
    for limit, name in steps:
        test = (c <= limit) if upper else (c < limit)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(last)


def price_band(c: Column) -> Column:
    """Closed whole-number bounds, so that a price between two of them is in the last band."""
    bounds = [(0, 499), (500, 999), (1000, 1499), (1500, 1999), (2000, 2499), (2500, 2999), (3000, 3999)]
    out = F.when(c.isNull() | (c <= 0), "Unknown")
    for lo, hi in bounds:
        out = out.when(c.between(lo, hi), f"{lo}-{hi}")
    return out.otherwise("4000+")


def inventory_band(c: Column) -> Column:
    """D13."""
    steps = [(0, "Out of Stock / 0"), (5, "Very Low / 1-5"), (20, "Low / 6-20"), (50, "Moderate / 21-50"), (100, "High / 51-100")]
    return F.when(c.isNull(), "Unknown").otherwise(_bands(c, steps, "Very High / 100+"))


def margin_band(c: Column) -> Column:
    """D14."""
    steps = [(0, "Loss / Negative"), (10, "Low Margin"), (20, "Moderate Margin"), (35, "Healthy Margin")]
    return F.when(c.isNull(), "Unknown").otherwise(_bands(c, steps, "High Margin", upper=False))


def risk_band(c: Column) -> Column:
    """D15; null is the lowest band."""
    return F.when(c >= 70, "Critical Review").when(c >= 45, "High Risk").when(c >= 25, "Medium Risk").otherwise("Low Risk")


def quality_band(c: Column) -> Column:
    """D16; null is the lowest band."""
    return F.when(c >= 80, "Strong").when(c >= 65, "Healthy").when(c >= 45, "Watch").when(c >= 25, "At Risk").otherwise("Critical")
