from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from touchline.functions import labels, scalars


def column(spark, values, expr, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_round_half_away_examples(spark):
    values = [0.125, -0.125, 1.005, 2.5, -2.5, None, -0.001, 1e300, 0.0]
    got = column(spark, values, lambda x: scalars.round_half_away(x, 2))
    assert got == [0.13, -0.13, 1.0, 2.5, -2.5, None, 0.0, 1e300, 0.0]
    assert str(got[6]) == "0.0"
    assert column(spark, [2.5, -2.5], lambda x: scalars.round_half_away(x, 0)) == [3.0, -3.0]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=50))
def test_round_half_away_is_half_up_on_eighths(spark, eighths):
    values = [e / 8 for e in eighths]  # exact in binary, so halves are real halves
    got = column(spark, values, lambda x: scalars.round_half_away(x, 2))
    want = [float(Decimal(v).quantize(Decimal("0.01"), ROUND_HALF_UP)) + 0.0 for v in values]
    assert got == want


def test_division_and_rates(spark):
    df = spark.createDataFrame([(6, 4), (6, 0), (None, 4), (6, None)], "a bigint, b bigint")
    rows = df.select(
        scalars.safe_divide(F.col("a"), F.col("b")).alias("q"),
        scalars.per_90(F.col("a"), F.col("b")).alias("r"),
    ).collect()
    assert [r.q for r in rows] == [1.5, None, None, None]
    assert [r.r for r in rows] == [135.0, None, None, None]


def test_price_is_double(spark):
    df = spark.createDataFrame([(47,), (100,), (None,)], "x bigint").select(
        scalars.price(F.col("x")).alias("p"), scalars.points_per_million(F.lit(31), F.col("x")).alias("m")
    )
    assert df.schema["p"].dataType.simpleString() == "double"
    assert [tuple(r) for r in df.collect()] == [(4.7, 6.6), (10.0, 3.1), (None, None)]


def test_exact_sum_does_not_depend_on_order(spark):
    values = [(0.1 * k, k) for k in range(1, 2000)]
    df = spark.createDataFrame(values, "x double, k int")
    sums = {
        df.repartition(n, "k").agg(scalars.exact_sum(F.round("x", 1))).first()[0] for n in (1, 3, 7)
    }
    assert sums == {199900.0}


def test_labels(spark):
    codes = [1, 2, 3, 4, 5, 9, 0, None]
    assert column(spark, codes, labels.position, "int") == [
        "Goalkeeper", "Defender", "Midfielder", "Forward", None, None, None, None,
    ]
    assert column(spark, codes, labels.difficulty, "int") == [
        "Very Easy", "Easy", "Medium", "Hard", "Very Hard", None, None, None,
    ]


@pytest.mark.parametrize(
    "bought,sold,want",
    [
        (10, 5, "Buy"),
        (11, 5, "Strong Buy"),
        (5, 5, "Neutral"),
        (5, 10, "Sell"),
        (5, 11, "Strong Sell"),
        (None, 1, "Neutral"),
        (1, None, "Neutral"),
        (0, 0, "Neutral"),
    ],
)
def test_momentum(spark, bought, sold, want):
    df = spark.createDataFrame([(bought, sold)], "b bigint, s bigint")
    assert df.select(labels.transfer_momentum(F.col("b"), F.col("s"))).first()[0] == want


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_exact_sum_loses_nothing_or_fails(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        total = lambda values: spark.createDataFrame([(v,) for v in values], "x double").agg(
            scalars.exact_sum(F.col("x"))
        ).first()[0]
        assert total([4e-7] * 10) == 4e-6
        assert total([1e-7, None, 1e13, 1e13]) == 2e13 + 1e-7
        assert total([None]) is None
        for bad in ([1e-25], [float("nan")], [9e19, 9e19]):
            with pytest.raises(Exception, match="exact|large|OUT_OF_RANGE"):
                total(bad)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_exact_sum_names_the_row_that_does_not_fit(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 1e-25)], "k int, x double")
    with pytest.raises(Exception, match=r"1\.0E-25 in \{2\}"):
        df.agg(scalars.exact_sum(F.col("x"), row=F.struct("k"))).collect()


def test_rounding_of_large_values(spark):
    cases = [(2.0**44 + 0.0078125, 2), (2.0**46 + 0.015625, 2), (5e13 + 0.015625, 2), (2.0**51 + 0.5, 0), (2.0**53, 2)]
    for x, digits in cases:
        step = Decimal(1).scaleb(-digits)
        want = float(Decimal(x).quantize(step, rounding=ROUND_HALF_UP))
        df = spark.createDataFrame([(x,), (-x,)], "x double")
        got = [r[0] for r in df.select(scalars.round_half_away(F.col("x"), digits)).collect()]
        assert got == [want, -want]
