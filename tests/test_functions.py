import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text


def values(spark, f, given, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(given)], f"i int, c {kind}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("c")).alias("x")).collect()]


def test_half_even_as_numpy(spark):
    given = [float(x) for x in np.random.default_rng(1).integers(-40_000, 40_000, 3000) / 20 * 0.35]
    assert values(spark, lambda c: text.half_even(c, 1), given, "double") == [float(x) + 0.0 for x in np.round(given, 1)]


def test_money(spark):
    assert values(spark, text.money, ["(1,200.50)", "₹ 99", "$5", "INR 7", "-3", "x", ""]) == [-1200.5, 99, 5, 7, -3, 0, 0]


def test_clean(spark):
    assert values(spark, text.clean, [" a ", "nan", "None", "", "NAN", None]) == ["a", None, None, None, "NAN", None]


@pytest.mark.parametrize(
    "f, given, want",
    [
        (text.price_band, [None, 0.0, 499.0, 499.5, 500.0, 4000.0], ["Unknown", "Unknown", "0-499", "4000+", "500-999", "4000+"]),
        (text.margin_band, [None, -1.0, 0.0, 10.0, 35.0], ["Unknown", "Loss / Negative", "Low Margin", "Moderate Margin", "High Margin"]),
        (text.risk_band, [None, 25.0, 45.0, 70.0], ["Low Risk", "Medium Risk", "High Risk", "Critical Review"]),
        (text.quality_band, [None, 25.0, 45.0, 65.0, 80.0], ["Critical", "At Risk", "Watch", "Healthy", "Strong"]),
    ],
)
def test_bands(spark, f, given, want):
    assert values(spark, f, given, "double") == want


def test_standard_names(spark):
    assert values(spark, text.marketplace, ["amazon.in", "Jio Mart", "web", "site x", " ", None]) == ["Amazon", "JioMart", "Website", "Site X", "Unknown", "Unknown"]
    assert values(spark, text.transaction_type, ["Fulfillment fee REFUND", "refund", "order", "", "my type"]) == ["Fulfillment Fee Refund", "Refund", "Order", "Other", "My Type"]
