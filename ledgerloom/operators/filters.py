"""Filters of the pages as specifications, compiled to predicates that reach the scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL = "All"


def chosen(values: Sequence[object]) -> list[str]:
    """The values that restrict; none where "All" is among them or nothing but blanks."""
    kept = [str(v) for v in values if str(v).strip()]
    return [] if ALL in kept else kept


def active(spec: Mapping[str, Sequence[object]]) -> bool:
    return any(chosen(v) for v in spec.values())


def applied(df: DataFrame, spec: Mapping[str, Sequence[object]]) -> DataFrame:
    """Rows whose columns hold one of the chosen values. Columns that the frame lacks don't restrict it. Text columns are
    compared as they are, so that the predicate is pushed down; others by their text."""
    kinds = dict(df.dtypes)
    for column, values in spec.items():
        kept = chosen(values)
        if column in kinds and kept:
            cell = F.col(f"`{column}`") if kinds[column] == "string" else F.col(f"`{column}`").cast("string")
            df = df.where(cell.isin(*kept))
    return df


def of_marketplace_product(df: DataFrame, marketplace: str | None = None, product: str | None = None) -> DataFrame:
    """Both restrict together; None and "All" don't."""
    return applied(df, {"marketplace": [marketplace or ALL], "public_product_id": [product or ALL]})


def scoped(df: DataFrame, chosen_rows: DataFrame, column: str = "marketplace") -> DataFrame:
    """Rows of values that occur in other, filtered rows."""
    return df.join(chosen_rows.select(column).distinct(), column, "left_semi")


def options(df: DataFrame, column: str, marketplace: str | None = None) -> DataFrame:
    """Q01, Q02: the distinct values of a column that are there, of one marketplace or all."""
    own = of_marketplace_product(df, marketplace) if column != "marketplace" else df
    value = F.trim(F.col(f"`{column}`").cast("string"))
    return own.select(value.alias("value")).where((F.col("value") != "") & (F.lower("value") != "nan")).distinct()
