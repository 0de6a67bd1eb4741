"""Contracts, quarantine and privacy scans as predicates over whole frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import NUMBER, half_even
from ledgerloom.operators import privacy

# Labels of periods.
PERIOD_LABELS = {"1m": "1M / 10K Orders", "3m": "3M / 30K Orders", "6m": "6M / 60K Orders", "12m": "12M / 120K Orders", "custom": "Custom Upload", "custom_upload": "Custom Upload"}


@dataclass(frozen=True)
class Field:
    """A contract's field: L04-L08. Severities are reject or warn."""

    name: str
    kind: str = "string"
    required: bool = False
    least: float | None = None
    most: float | None = None
    allowed: tuple[str, ...] = ()
    unique: bool = False
    range_severity: str = "warn"


def _record(f: Field, code: str, severity: str, test: Column) -> Column:
    return F.when(test, F.struct(F.lit(f.name).alias("field"), F.lit(code).alias("code"), F.lit(severity).alias("severity")))


def violations(df: DataFrame, fields: list[Field], order: list[str]) -> DataFrame:
    """Adds `violations`, an array of (field, code, severity); `order` says which of equal keys comes first."""
    found = []
    for f in fields:
        c = F.col(f.name)
        number = F.when(c.cast("string").rlike(NUMBER), c.cast("string").try_cast("double"))
        if f.required:
            found.append(_record(f, "missing_required_field", "reject", c.isNull()))
        if f.kind == "number":
            found.append(_record(f, "type_mismatch", "reject", c.isNotNull() & number.isNull()))
        if f.least is not None or f.most is not None:
            low = F.lit(False) if f.least is None else number < f.least
            high = F.lit(False) if f.most is None else number > f.most
            found.append(_record(f, "out_of_range", f.range_severity, low | high))
        if f.allowed:
            found.append(_record(f, "unknown_value", "warn", c.isNotNull() & ~F.trim(c).isin(*f.allowed)))
        if f.unique:
            df = df.withColumn(f"_rn_{f.name}", F.when(c.isNotNull(), F.row_number().over(Window.partitionBy(f.name).orderBy(*order))))
            found.append(_record(f, "duplicate_key", "warn", F.col(f"_rn_{f.name}") > 1))
    df = df.withColumn("violations", F.filter(F.array(*found), lambda x: x.isNotNull()))
    return df.drop(*[f"_rn_{f.name}" for f in fields if f.unique])


def quarantine_summary(df: DataFrame) -> DataFrame:
    """records by field, code and severity."""
    return df.select(F.explode("violations").alias("v")).groupBy("v.field", "v.code", "v.severity").agg(F.count("*").alias("records"))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(~F.exists("violations", lambda v: v.severity == "reject")).drop("violations")


def pattern_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Occurrences of each shape and cells with long titles in each column, by one aggregate over the frame."""
    kinds, counts = dict(df.dtypes), []
    for c in columns:
        cell = F.col(c).cast("string")
        for name, p in privacy.SHAPES.items():
            exempt = name == "order_id_like_values" and c in privacy.NO_ORDER_TEST or name == "postal_code_like_values" and kinds[c].startswith(privacy.NUMERIC)
            counts.append((F.lit(0).cast("long") if exempt else F.coalesce(F.sum(F.regexp_count(cell, F.lit(p))), F.lit(0))).alias(f"{c}|{name}"))
        counts.append((F.lit(0).cast("long") if c in privacy.LONG_TEXT else F.count_if(cell.rlike(privacy.TITLE))).alias(f"{c}|long_title_like_values"))
    got = df.agg(*counts)
    got = got.unpivot([], [F.col(f"`{c}`") for c in got.columns], "check", "hits")
    return got.select(F.split_part("check", F.lit("|"), F.lit(1)).alias("column_name"), F.split_part("check", F.lit("|"), F.lit(2)).alias("pattern"), "hits")


# Names, expectations and notes of the checks of an upload, in order.
NO_MAPPING = "Marketplace-channel enrichment is unavailable because Marketplace_Channel_Master mapping keys are incomplete."
ONLY_COUNTS = "Only counts are shown; SKU values are private."
ACTIVITY = "nonzero when transactions contain sales activity"
REJECTED = "Rows failing required-field/type contract checks are excluded from analysis and quarantined (safe metadata only — no private values stored)."
WARNED = "Rows with out-of-range values or unrecognized-but-plausible categories are kept and logged as warnings."
HIT_CHECKS = ("ASIN-like values", "known SKU values", "order-ID-like values", "postal-code-like values", "raw rupee amount leakage")


def checklist(m: dict[str, Column], public: list[str], profile: list[str], unsafe: str) -> list[tuple[str, Column, Column, str, str]]:
    """Q18: (name, status, value, expectation, notes) of each check, from counts and the published columns' names."""
    some = lambda c, otherwise="FAIL": F.when(m[c] > 0, "PASS").otherwise(otherwise)
    text = lambda c: m[c].cast("string")
    have = lambda *cs: F.lit("PASS" if set(cs) <= set(public) else "FAIL")
    fine, no_hits = F.lit("PASS"), F.when(m["content_hits"] == 0, "PASS").otherwise("FAIL")
    bool_text = lambda c: F.initcap(m[c].cast("string"))
    rows = [
        ("Raw product master loaded", some("products"), text("products"), "> 0", ""),
        ("Marketplace master loaded", some("channel_rows", "WARN"), text("channel_rows"), "> 0 for 5-marketplace mode", ""),
        ("All 5 marketplaces present", F.when(m["channel_markets"] >= 5, "PASS").when(m["channel_markets"] > 0, "WARN").otherwise("FAIL"), text("channel_markets"), "5", ""),
        ("Each product has 5 marketplace rows", F.when((m["fewer_channels"] == 0) & (m["channel_rows"] > 0), "PASS").otherwise("WARN"), text("fewer_channels"), "0 missing", ""),
        ("Raw transaction report loaded", some("lines"), text("lines"), "> 0", ""),
        ("Dataset period detected", F.when(m["period"].isNotNull(), "PASS").otherwise("WARN"), m["label"], "known or custom", ""),
        ("Transaction row count valid", some("lines"), text("lines"), "> 0", ""),
        ("Order row count valid", some("orders", "WARN"), text("orders"), "> 0 order rows", ""),
        ("SKU column detected", some("with_sku"), text("with_sku"), "> 0 rows with SKU", ""),
        ("Marketplace column detected", some("markets", "WARN"), text("markets"), "> 0 marketplaces", ""),
        ("SKU join coverage calculated", fine, m["coverage"].cast("string"), "calculated", ""),
        ("Marketplace-channel mapping status", F.lit("WARN"), F.lit("Unavailable"), "available mapping keys", NO_MAPPING),
        ("Unmatched SKUs counted", fine, text("strange"), "calculated", ONLY_COUNTS),
        ("Duplicate SKUs counted", fine, text("repeated"), "calculated", ""),
        ("Public outputs generated", some("public_rows"), text("public_rows"), "> 0 rows", ""),
        ("No sensitive columns in public outputs", F.lit("FAIL" if unsafe else "PASS"), F.lit(unsafe or "safe"), "safe", ""),
        *[(f"No {what} in public outputs", no_hits, text("content_hits"), "0 content hits", "") for what in HIT_CHECKS],
        ("Indexes generated", have("sales_index", "units_index"), F.lit("sales_index, units_index"), "present", ""),
        ("Public sales indexes contain activity", F.when(m["public_active"], "PASS").otherwise("WARN"), bool_text("public_active"), ACTIVITY, ""),
        ("Aggregated sales indexes contain activity", F.when(m["active"], "PASS").otherwise("WARN"), bool_text("active"), ACTIVITY, ""),
        ("Ratios generated", have("fee_pct_of_gross", "refund_pct_of_gross", "promotion_pct_of_gross", "net_to_gross_pct"), F.lit("fee/refund/promotion/net ratios"), "present", ""),
        ("Profitability bands generated", have("profitability_band_public"), F.lit("profitability_band_public"), "present", ""),
        ("Margin risk scores generated", have("margin_risk_score"), F.lit("margin_risk_score"), "present", ""),
        ("Revenue quality scores generated", have("revenue_quality_score"), F.lit("revenue_quality_score"), "present", ""),
        ("Recommended actions generated", some("action_rows"), text("action_rows"), "> 0 rows", ""),
        ("Dataset profile includes display label", F.lit("PASS" if "dataset_label" in profile else "WARN"), F.lit("dataset_label" if "dataset_label" in profile else "missing"), "present", ""),
    ]
    if "rejected" in m:
        calm = lambda c: F.when(m[c] == 0, "PASS").otherwise("WARN")
        rows += [("Upload contract validation — rejected rows", calm("rejected"), text("rejected"), "0 rejected", REJECTED), ("Upload contract validation — warning rows", calm("warned"), text("warned"), "0 warnings", WARNED)]
    return rows


def content_hits(outputs: Mapping[str, DataFrame], together: Mapping[str, Sequence[Sequence[str]]] = MappingProxyType({})) -> DataFrame:
    """One row: the private-looking cells of all outputs."""
    return privacy.scan(outputs, together=together).agg(F.sum("total_content_hits").alias("content_hits"))


def validation_summary(lines: DataFrame, master: DataFrame, channels: DataFrame, outputs: Mapping[str, DataFrame], quarantine: DataFrame | None = None, hits: DataFrame | None = None) -> DataFrame:
    """The checks of an upload as rows of audit_key, check_name, check_status, check_value, expected_value, notes.

    Each frame is counted by one aggregate; the one-row results stand side by side. `quarantine` has one row with
    rejected_rows and warning_rows of an upload that was held to its contracts; `hits` the content_hits of the outputs, where
    they were scanned before.
    """
    sku = F.col("sku")
    parts = [
        lines.agg(
            F.count("*").alias("lines"), F.count_if(F.col("transaction_type_group") == "Order").alias("orders"), F.count(sku).alias("with_sku"), F.count_distinct("marketplace").alias("markets"),
            F.count_if(F.col("mapping_status") == "Matched").alias("matched"), F.count_distinct(F.when(F.col("mapping_status") == "Unmatched", sku)).alias("strange"), F.min("dataset_period").alias("period"),
        ),
        master.agg(F.count("*").alias("products"), (F.count("seller_sku") - F.count_distinct("seller_sku")).alias("repeated")),
        per_sku(channels).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("channel_rows"), F.count_if(F.col("n") < 5).alias("fewer_channels")),
        channels.agg(F.count_distinct("marketplace").alias("channel_markets")),
        outputs["product_performance"].agg(F.count("*").alias("action_rows"), F.coalesce(F.max(F.col("sales_index") > 0), F.lit(False)).alias("active")),
        outputs["anonymized_master"].agg(F.count("*").alias("public_rows"), F.coalesce(F.max(F.col("sales_index") > 0), F.lit(False)).alias("public_active")),
        content_hits(outputs) if hits is None else hits,
    ]
    if quarantine is not None:
        parts.append(quarantine.select(F.col("rejected_rows").alias("rejected"), F.col("warning_rows").alias("warned")))
    one = reduce(lambda a, b: a.crossJoin(b), parts)  # one row each
    coverage = F.coalesce(half_even(F.try_divide(F.col("matched"), F.col("with_sku")) * 100.0, 2), F.lit(0.0))
    one = one.withColumns({"coverage": coverage, "label": F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in PERIOD_LABELS.items() for x in kv]), F.coalesce("period", F.lit("custom"))), F.lit("Custom Upload"))})
    unsafe = "; ".join(f"{n}: {','.join(bad)}" for n, df in outputs.items() if (bad := privacy.unsafe_columns(df.columns)))
    rows = checklist({c: F.col(c) for c in one.columns}, outputs["anonymized_master"].columns, ["public_output_name", "row_count", "dataset_period", "dataset_label"], unsafe)
    made = [F.struct(F.lit(k + 1).alias("audit_key"), F.lit(n).alias("check_name"), s.alias("check_status"), v.alias("check_value"), F.lit(e).alias("expected_value"), F.lit(w).alias("notes")) for k, (n, s, v, e, w) in enumerate(rows)]
    return one.select(F.inline(F.array(*made)))


def meaningful(value: Column) -> Column:
    """Q05: whether any number is more than 0.000001 away from 0; none is in an empty column."""
    return F.coalesce(F.max(F.abs(value) > 0.000001), F.lit(False))


def per_sku(channels: DataFrame) -> DataFrame:
    """marketplaces of each SKU in the channel sheet."""
    return channels.where("seller_sku is not null").groupBy("seller_sku").agg(F.count_distinct("marketplace").alias("n"), F.count("*").alias("rows"))


def known_values(df: DataFrame, column: str, known: DataFrame, value: str) -> DataFrame:
    """Rows whose trimmed cell is a known private value."""
    keys = known.select(F.trim(value).alias("_v")).where("_v <> ''").distinct()
    return df.join(keys, F.trim(F.col(column)) == F.col("_v"), "left_semi")
