from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrina.functions import dates, measures, rules


def one(df):
    return df.head()[0]


@pytest.mark.parametrize(
    ("price", "cost", "expected"), [(200.0, 111.0, 44), (200.0, 109.0, 46), (100.0, 55.0, 45), (0.0, 5.0, 0), (-1.0, 5.0, 0)]
)
def test_margin_is_half_even_and_guarded(spark, price, cost, expected):
    df = spark.createDataFrame([(price, cost)], "p DOUBLE, c DOUBLE")
    assert one(df.select(measures.guarded_margin_pct("p", "c"))) == expected


def test_line_subtotal_rounds_half_even(spark):
    df = spark.createDataFrame([(5.0, 1, 0.5), (7.0, 1, 0.5), (10.0, 3, 0.1)], "p DOUBLE, q BIGINT, d DOUBLE")
    assert [r[0] for r in df.select(measures.line_subtotal("p", "q", "d")).collect()] == [2.0, 4.0, 27.0]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-(10**13), 10**13), min_size=1, max_size=40))
def test_money_total_is_exact(spark, units):
    amounts = [(u / 10_000,) for u in units]
    found = one(spark.createDataFrame(amounts, "x DOUBLE").agg(measures.total("x")))
    assert found == float(Decimal(sum(units)) / 10_000)


def test_small_and_large_amounts_are_kept(spark):
    small = spark.createDataFrame([(0.00004,)] * 10 + [(0.000001,)], "x DOUBLE")
    assert one(small.agg(measures.total("x"))) == 0.000401
    large = spark.createDataFrame([(1e16,), (1e16,), (0.5,), (-1e16,)], "x DOUBLE")
    for parts in (1, 2, 4):
        assert one(large.repartition(parts).agg(measures.total("x"))) == 1e16
        assert one(large.repartition(parts).agg(measures.exact_sum("x"))) == Decimal("10000000000000000.5")


def test_total_cost_of_large_amounts(spark):
    df = spark.createDataFrame([(1e16, 40), (0.00004, 50), (3.0, 100), (None, 1)], "x DOUBLE, m INT")
    assert one(df.agg(measures.total_cost("x", "m"))) == pytest.approx(6e15, rel=1e-15)
    assert one(df.where("x < 1").agg(measures.total_cost("x", "m"))) == 0.00002


def test_total_of_nothing_is_zero_and_mean_is_null(spark):
    df = spark.createDataFrame([(None,)], "x DOUBLE")
    assert tuple(df.agg(measures.total("x"), measures.mean("x")).head()) == (0.0, None)


def test_growth_needs_a_base(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, None), (110.0, 100.0)], "a DOUBLE, b DOUBLE")
    assert [r[0] for r in df.select(measures.growth_pct("a", "b")).collect()] == [None, None, 10.0]


def test_elapsed_days_are_not_calendar_days(spark):
    df = spark.createDataFrame(
        [(datetime(2022, 12, 30, 23), datetime(2022, 12, 31, 1)), (datetime(2022, 1, 1), datetime(2022, 1, 3))],
        "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ",
    )
    assert [r[0] for r in df.select(dates.elapsed_days("a", "b")).collect()] == [0, 2]


def test_week_ends_on_sunday(spark):
    df = spark.createDataFrame([(date(2023, 1, 1),), (date(2023, 1, 2),)], "d DATE")
    assert [r[0] for r in df.select(dates.week_ending("d")).collect()] == [date(2023, 1, 1), date(2023, 1, 8)]


def test_calendar_expressions(spark):
    df = spark.createDataFrame([(date(2023, 1, 1),)], "d DATE")
    found = df.select(
        dates.weekday("d"), dates.season(F.month("d")), dates.period_label(F.year("d"), F.month("d"))
    ).head()
    assert tuple(found) == (6, "Invierno", "2023-01")


def test_unreadable_timestamp_is_null(spark):
    df = spark.createDataFrame([("x",), ("2024-05-06 07:08:09",), ("2024-05-06",)], "t STRING")
    found = [r[0] for r in df.select(dates.parse_timestamp("t")).collect()]
    assert found == [None, datetime(2024, 5, 6, 7, 8, 9), datetime(2024, 5, 6)]


@pytest.mark.parametrize(
    ("recency", "orders", "amount", "dimension", "snapshot"),
    [
        (90, 6, 2e7, "VIP", "VIP"),
        (90, 5, 2e7, "Regular", "VIP"),
        (91, 6, 2e7, "Regular", "Regular"),
        (180, 4, 0.0, "Regular", "Regular"),
        (180, 3, 0.0, "En riesgo", "Regular"),
        (180, 1, 0.0, "En riesgo", "En riesgo"),
        (365, 50, 2e7, "En riesgo", "En riesgo"),
        (366, 50, 2e7, "Perdido", "Perdido"),
        (90, 6, 1e7, "Regular", "Regular"),
    ],
)
def test_segment_boundaries(spark, recency, orders, amount, dimension, snapshot):
    df = spark.createDataFrame([(recency, orders, amount)], "r INT, f INT, m DOUBLE")
    found = df.select(
        rules.rfm_segment("r", "f", "m", rules.DIMENSION_RULE), rules.rfm_segment("r", "f", "m", rules.SNAPSHOT_RULE)
    ).head()
    assert tuple(found) == (dimension, snapshot)


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (100000.0,), (100001.0,), (2e7,)], "x DOUBLE")
    found = [r[0] for r in df.select(rules.right_closed_bins("x", [0, 100_000, 500_000], ["Bajo", "Medio"])).collect()]
    assert found == [None, "Bajo", "Medio", None]


def test_bands(spark):
    df = spark.createDataFrame([(5.0,), (0.1,), (0.0,), (-0.1,), (-5.0,), (None,)], "g DOUBLE")
    assert [r[0] for r in df.select(rules.growth_band("g")).collect()] == ["meta", "sube", "neutro", "baja", "alerta", "neutro"]
    df = spark.createDataFrame([(9.9,), (10.0,), (25.0,)], "m DOUBLE")
    assert [r[0] for r in df.select(rules.margin_band("m")).collect()] == ["critico", "medio", "meta"]


def test_stable_uniform_is_in_range_and_independent_of_partitions(spark):
    ids = spark.range(1000)
    a = {tuple(r) for r in ids.repartition(7).select("id", rules.stable_uniform("id", 1)).collect()}
    b = {tuple(r) for r in ids.coalesce(1).select("id", rules.stable_uniform("id", 1)).collect()}
    assert a == b
    assert all(0 <= u < 1 for _, u in a)
    assert 0.45 < sum(u for _, u in a) / 1000 < 0.55
