r"""The gate before publishing: unsafe names of columns, private-looking cells, and known private values, over all outputs.

Every output is scanned whole. Its cells are first summed up by distinct value, so that a band or a label that stands in every
row meets each pattern once; known values come from the inputs by the shape of their columns and are joined by hash to the cells
of all outputs in one shuffle. Only counts leave the scan, never a
cell. The gate raises at the first sign. Letters, digits and white space are Unicode's, spelled out as classes because \w, \s
and \b are ASCII in Spark's patterns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of private columns, parts of such names, published columns that hold such a part, shapes of private
# values, columns free of a test, and how private values look by column.
SENSITIVE = (
    "asin", "asin1", "asin_private", "seller_sku", "seller_sku_private", "sku", "order_id", "listing_id", "product_id", "item_name", "item_name_private", "item_description", "description", "order_postal",
    "postal_code", "order_city", "gross_sales_private", "gross_sales_private_rs", "units_private", "refund_amount_private", "refund_amount_private_rs", "promotion_amount_private", "promotion_amount_private_rs",
    "amazon_fee_private", "total_fee_private_rs", "net_amount_private", "net_amount_private_rs", "product_sales", "selling_fees", "fba_fees", "other_transaction_fees", "total", "price",
    "listing_price_private_rs", "maximum_retail_price", "mrp_private_rs", "unit_cost_private_rs", "landed_cost_private_rs", "estimated_profit_private_rs", "estimated_gross_profit_private_rs",
)
TOKENS = ("private", "asin", "sku", "order_id", "listing_id", "description", "postal", "raw_", "rupee", "_rs")
BANNED = (
    "asin", "asin1", "seller_sku", "sku", "order_id", "listing_id", "product_id", "item_name", "item_description", "description", "order_postal",
    "gross_sales_private", "refund_amount_private", "promotion_amount_private", "amazon_fee_private", "net_amount_private", "product_sales", "selling_fees", "fba_fees", "other_transaction_fees", "total", "price", "maximum_retail_price",
)
METRIC_ENDINGS = ("_index", "_score", "_pct_of_gross", "_to_gross_pct")
WITHOUT_METRICS = ("validation_summary", "dataset_profile")
LONG_FORM = ("mart_marketplace_variance_drivers", "mart_product_variance_contributors", "mart_performance_driver_summary")
WORD, SPACE = r"[\p{L}\p{N}_]", r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
START, STOP = rf"(?<!{WORD})", rf"(?!{WORD})"
SHAPES = {
    "asin_like_values": rf"(?i){START}B0[A-Z0-9]{{8}}{STOP}",
    "order_id_like_values": rf"(?i){START}(?:ORDER|ORD|AMZ|FLP|MEE|JIO|WEB)[-_]?[A-Z0-9-]{{4,}}(?:(?<={WORD}){STOP}|(?<!{WORD})(?={WORD}))",
    "postal_code_like_values": rf"{START}[1-9][0-9]{{5}}{STOP}",
    "currency_marker_values": rf"(?i)(?:₹|{START}INR{STOP}|{START}RS(?:\.(?={WORD})|{STOP}))",
}
TITLE = f"{SPACE}+".join([f"{WORD}+"] * 5)
NO_ORDER_TEST = ("marketplace", "channel", "narrative")
LONG_TEXT = (
    "action_reason", "narrative", "notes", "check_name", "expected_value", "check_value", "brand_group", "category_group", "subcategory_group", "product_group",
    "marketplace", "channel", "listing_price_band", "inventory_band", "margin_band_public", "profitability_band_public",
)
COUNTS = ("asin_like_values", "known_private_identifier_values", "order_id_like_values", "postal_code_like_values", "currency_marker_values", "long_title_like_values")
GENERIC = ("nan", "none", "null", "n/a", "adjustment", "order", "refund", "service fee", "transfer")
IDENTIFIERS = ("seller_sku", "sku", "order_id", "listing_id", "product_id")
TEXTS = ("item_name", "item_description", "description")
PRODUCT_COLUMNS = ("seller_sku", "asin1", "item_name", "item_description", "listing_id", "product_id")
TRANSACTION_COLUMNS = ("sku", "order_id", "description", "order_postal")
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


class PrivacyError(ValueError):
    """Something that must not be published; says where, not what."""


def unsafe_columns(names: list[str], allowed: tuple[str, ...] = ()) -> list[str]:
    """The names of private columns, and names with a private part unless they are published ones."""
    bad = {n for n in names if n.lower() in SENSITIVE or (n.lower() not in allowed and any(t in n.lower() for t in TOKENS))}
    return sorted(bad)


def looks_private(value: Column, column: str, generic: tuple[str, ...] = GENERIC) -> Column:
    """C20: whether a trimmed value has the shape of a private one of its column."""
    fine = (value != "") & ~F.lower(value).isin(*generic)
    if column == "order_postal":
        return fine & value.rlike(r"^[1-9][0-9]{5}$")
    if column == "asin1":
        return fine & value.rlike(r"(?i)^B0[A-Z0-9]{8}$")
    if column in IDENTIFIERS:
        return fine & (F.char_length(value) >= 5) & value.rlike(r"[\p{Nd}_/-]")
    if column in TEXTS:
        return fine & (F.char_length(value) >= 20) & (F.regexp_count(value, F.lit(f"{WORD}+")) >= 3)
    return F.lit(False)


def known_values(products: DataFrame, transactions: DataFrame, generic: tuple[str, ...] = GENERIC) -> DataFrame:
    """The distinct private values of both inputs; one column, `value`."""
    parts = []
    for df, names in ((products, PRODUCT_COLUMNS), (transactions, TRANSACTION_COLUMNS)):
        for c in (n for n in names if n in df.columns):
            own = df.select(F.trim(F.col(c).cast("string")).alias("value"))
            parts.append(own.where(looks_private(F.col("value"), c, generic)))
    if not parts:
        return products.sparkSession.createDataFrame([], "value string")
    return reduce(lambda a, b: a.union(b), parts).distinct()


def _cells(df: DataFrame, output: str, max_rows: int | None = None, together: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Cells by value and by what they are free of, with how often each occurs. H23: `max_rows` is for developers; without it
    every row is scanned. A number's text, of digits, signs, a point, E, NaN or Infinity, has no shape but that of postal
    codes, of which numbers are free, so numbers have no cells here. Columns `together` are first summed up by their values
    side by side: where these go with each other, as a product's do, the rows that are taken apart into cells are few."""
    df = df if max_rows is None else df.limit(max_rows)
    kinds = {c: kind for c, kind in df.dtypes if not (kind in NUMERIC or kind.startswith("decimal("))}
    groups = [[c for c in group if c in kinds] for group in together]
    alone = [c for c in kinds if not any(c in group for group in groups)]
    free = lambda c: (NO_ORDER if c in NO_ORDER_TEST else 0) | (NUMBERS if kinds[c].startswith(NUMERIC) else 0) | (NO_TITLE if c in LONG_TEXT else 0)
    parts = [(df.groupBy(*[F.col(f"`{c}`") for c in group]).agg(F.count("*").alias(_N)), group) for group in groups if group]
    parts.append((df.withColumn(_N, F.lit(1).cast("long")), alone))
    found = []
    for rows, names in parts:
        cells = F.array(*[F.struct(F.lit(free(c)).alias("free"), F.col(f"`{c}`").cast("string").alias("value")) for c in names]) if names else F.array().cast("array<struct<free:int,value:string>>")
        found.append(rows.select(_N, F.explode(cells).alias("x")).where("x.value is not null").select("x.free", "x.value", _N))
    got = reduce(lambda a, b: a.union(b), found).groupBy("free", "value").agg(F.sum(_N).alias("n"))
    return got.select(F.lit(output).alias("output"), "free", "value", "n")


#: What a cell is free of: the test for order numbers, those for postal codes and known values, the test for titles.
NO_ORDER, NUMBERS, NO_TITLE = 1, 2, 4
_N = "_times"


def _counted(cells: DataFrame, known: Column) -> DataFrame:
    """Counts by output; a pattern meets each distinct value once."""
    may = lambda bit: F.col("free").bitwiseAND(bit) == 0
    tests = {"order_id_like_values": may(NO_ORDER), "postal_code_like_values": may(NUMBERS)}
    hits = {n: F.when(tests.get(n, F.lit(True)), F.regexp_count("value", F.lit(p))).otherwise(0) for n, p in SHAPES.items()}
    hits["long_title_like_values"] = F.when(may(NO_TITLE) & F.col("value").rlike(TITLE), 1).otherwise(0)
    hits["known_private_identifier_values"] = F.when(may(NUMBERS) & known, 1).otherwise(0)
    return cells.groupBy("output").agg(*[F.sum(hits[n] * F.col("n")).alias(n) for n in COUNTS])


def shape_counts(df: DataFrame, output: str, max_rows: int | None = None) -> DataFrame:
    """One row of counts by shape, if there are cells."""
    return _counted(_cells(df, output, max_rows), F.lit(False))


def scan(outputs: Mapping[str, DataFrame], known: DataFrame | None = None, max_rows: int | None = None, together: Mapping[str, Sequence[Sequence[str]]] = MappingProxyType({})) -> DataFrame:
    """A row for each output but the validation summary: unsafe columns, counts, total, is_safe. `together` has, by
    output, groups of columns whose values go with each other."""
    names = [n for n in outputs if n != "validation_summary"]
    spark = outputs[names[0]].sparkSession
    cells = reduce(lambda a, b: a.union(b), [_cells(outputs[n], n, max_rows, together.get(n, ())) for n in names])
    if known is None:
        counts = _counted(cells, F.lit(False))
    else:
        private = known.select(F.trim("value").alias("_trimmed")).where("_trimmed <> ''").distinct().withColumn("_known", F.lit(True))
        counts = _counted(cells.withColumn("_trimmed", F.trim("value")).join(private, "_trimmed", "left"), F.coalesce("_known", F.lit(False)))
    bad = [F.struct(F.lit(n).alias("output"), F.lit(", ".join(unsafe_columns(outputs[n].columns))).alias("unsafe_columns")) for n in names]
    all_ = spark.range(1).select(F.inline(F.array(*bad)))
    got = all_.join(F.broadcast(counts), "output", "left").fillna(0, list(COUNTS))  # a row for each output at most
    got = got.select("output", "unsafe_columns", *COUNTS, reduce(Column.__add__, [F.col(c) for c in COUNTS]).alias("total_content_hits"))
    return got.withColumn("is_safe", (F.col("unsafe_columns") == "") & (F.col("total_content_hits") == 0))


def assert_safe(outputs: Mapping[str, DataFrame], known: DataFrame | None = None) -> None:
    """Raises unless every output is safe."""
    for n, df in outputs.items():
        if bad := unsafe_columns(df.columns):
            raise PrivacyError(f"{n} contains sensitive columns: {', '.join(bad)}")
    for r in scan(outputs, known).where(~F.col("is_safe")).collect():  # a row for each output at most
        raise PrivacyError(f"{r.output} contains sensitive-looking values, {r.total_content_hits} hits")


def published(outputs: Mapping[str, DataFrame], write, known: DataFrame | None = None) -> None:
    """Writes the outputs if all of them are safe, else none."""
    assert_safe(outputs, known)
    for n, df in outputs.items():
        write(n, df)


def file_checks(outputs: Mapping[str, DataFrame]) -> list[tuple[str, list[str], bool]]:
    """(output, banned columns, whether it has metric columns) by the outputs' names of columns."""
    return [(n, sorted(set(df.columns) & set(BANNED)), n in WITHOUT_METRICS or (n in LONG_FORM and "metric" in df.columns) or any(c.endswith(METRIC_ENDINGS) for c in df.columns)) for n, df in outputs.items()]
