from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aeroledger.functions import columns as c


def one(spark, expr, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(expr.alias("x")).first().x


@pytest.mark.parametrize("text, value", [("₹ 1,200.50", 1200.5), ("45 %", 45.0), ("n/a", None), ("", None), (None, None)])
def test_clean_number(spark, text, value):
    assert one(spark, c.clean_number("s"), s=("string", text)) == value


@pytest.mark.parametrize("text, value", [("3.5", 3.5), ("x", 0.0), (None, 0.0), ("NaN", 0.0)])
def test_numeric(spark, text, value):
    assert one(spark, c.numeric("s"), s=("string", text)) == value


@pytest.mark.parametrize("text, value", [("TRUE", True), ("1", True), ("Breach", False), ("no", False), (None, False)])
def test_truthy(spark, text, value):
    assert one(spark, c.truthy("s"), s=("string", text)) is value


def test_round_half_up(spark):
    assert one(spark, c.round_to("v", 2), v=("double", 2.675)) == 2.68
    assert one(spark, c.round_to("v", 0), v=("double", 2.5)) == 3.0


def test_right_closed_bins(spark):
    def level(p):
        return one(spark, c.right_closed_bins("p", (0.3, 0.6, 1.01), ("LOW", "MEDIUM", "HIGH")), p=("double", p))
    assert [level(p) for p in (0.0, 0.3, 0.31, 0.6, 0.61, 1.0, None)] == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", None]


def test_boundaries_are_counted_not_elapsed_time(spark):
    a, b = datetime(2024, 1, 1, 0, 59), datetime(2024, 1, 1, 1, 1)
    assert one(spark, c.boundaries_crossed("hour", "a", "b"), a=("timestamp", a), b=("timestamp", b)) == 1
    assert one(spark, c.boundaries_crossed("minute", "a", "b"), a=("timestamp", a), b=("timestamp", b)) == 2


def test_minutes(spark):
    a, b = datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 1, 0, 100000)
    assert one(spark, c.minutes_between("b", "a"), a=("timestamp", a), b=("timestamp", b)) == 1.0
    assert one(spark, c.exact_minutes_between("b", "a"), a=("timestamp", a), b=("timestamp", b)) == pytest.approx(59.2 / 60)


def test_ratio_percent_clamp_compact(spark):
    assert one(spark, c.ratio("a", "b"), a=("int", 1), b=("int", 0)) is None
    assert one(spark, c.as_percent("p"), p=("double", 0.25)) == 25.0
    assert one(spark, c.as_percent("p"), p=("double", 25.0)) == 25.0
    assert one(spark, c.clamp("p", 0, 100), p=("double", 140.0)) == 100.0
    assert [one(spark, c.compact_amount("v"), v=("double", v)) for v in (1.25e6, -3400.0, 12.0)] == ["1.25M", "-3.4K", "12"]


def test_text_helpers(spark):
    assert one(spark, c.first_filled("a", "b"), a=("string", ""), b=("string", "z")) == "z"
    assert one(spark, c.contains_any("aB", "a", "b"), a=("string", None), b=("string", "xxABxx")) is True
    assert one(spark, c.spaced("a"), a=("string", "LOST_BAG")) == "LOST BAG"
    assert one(spark, c.same_text("a", "high"), a=("string", "High")) is True
    assert len(one(spark, c.short_id("a"), a=("string", None))) == 16


def test_lenient_timestamp(spark):
    assert one(spark, c.lenient_timestamp("s"), s=("string", "2024-01-02 03:04:05")) == datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, c.lenient_timestamp("s"), s=("string", "soon")) is None


def test_calendar_parts(spark):
    parts = c.calendar_parts("d")
    row = spark.createDataFrame([(datetime(2024, 1, 6),)], "d timestamp").select(*[v.alias(k) for k, v in parts.items()]).first()
    assert tuple(row) == (2024, 1, 6, "Saturday", True)


def test_exact_sum_does_not_depend_on_order(spark):
    df = spark.range(10_000).select((F.col("id") * 0.01 + 0.1).alias("v"))
    sums = {df.repartition(n).agg(c.exact_sum("v")).first()[0] for n in (1, 3, 8)}
    assert sums == {500950.0}


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, 2)], "` A ` int, b int")
    assert c.normalize_headers(df).columns == ["a", "b"]
    assert c.resolve_column(["x", "y"], ["z", "y"]) == "y" and c.resolve_column([], ["a"]) is None
    assert c.prefer_columns(df, ["b", "q"]).columns == ["b"]
    with pytest.raises(ValueError, match="q"):
        c.require_columns(df, ["b", "q"])


def test_json_safe_and_nan_to_null(spark):
    df = spark.createDataFrame([(float("inf"), datetime(2024, 1, 1)), (float("nan"), None), (1.5, None)], "v double, t timestamp")
    assert [r.v for r in c.json_safe(df).collect()] == [None, None, 1.5]
    assert c.json_safe(df).first().t == "2024-01-01 00:00:00"
    assert [r.v for r in c.nan_to_null(df).collect()] == [float("inf"), None, 1.5]
