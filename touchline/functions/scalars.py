"""Scalar and aggregate expressions shared by the models. All of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F
from pyspark.sql.window import WindowSpec

EXACT = "decimal(38,18)"


def as_number(text: Column) -> Column:
    """Number held as text -> double. Bad text raises, with ANSI mode on or off."""
    misfit = F.raise_error(F.concat(F.lit("not a number: "), text)).cast("double")
    return F.when(text.isNotNull(), F.coalesce(text.try_cast("double"), misfit))


def safe_divide(a: Column, b: Column) -> Column:
    """``a / b`` in double; NULL when ``b`` is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def round_half_away(x: Column, digits: int) -> Column:
    """Round a double half away from zero on its binary value.

    Spark's ``round`` goes through the shortest decimal text of the double (1.005 -> 1.01), which
    other engines do not. Integer arithmetic on the scaled value gives the same answer everywhere
    and never yields a negative zero. Where scaling would lose bits the value is rounded as a
    decimal; from 2**52 on doubles have no fraction and pass unchanged.
    """
    x = x.cast("double")
    scale = F.lit(10.0**digits)
    steps = F.when(x < 0, F.ceil(x * scale - 0.5)).otherwise(F.floor(x * scale + 0.5))
    large = F.when(F.abs(x) < 2.0**52, F.round(x.try_cast(EXACT), digits).cast("double")).otherwise(x)
    return F.when(F.abs(x) < 2.0**52 / 10.0**digits, steps / scale).otherwise(large)


def price(tenths: Column) -> Column:
    """Price in millions from a price in tenths. Double division: a bare 10.0 is a decimal in SQL."""
    return round_half_away(tenths / F.lit(10.0), 1)


def points_per_million(points: Column, tenths: Column) -> Column:
    return round_half_away(safe_divide(points, tenths / F.lit(10.0)), 2)


def per_90(total: Column, minutes: Column) -> Column:
    """Rate per 90 minutes to two digits; NULL without minutes."""
    return round_half_away(safe_divide(total, minutes) * 90, 2)


def exact_sum(x: Column, window: WindowSpec | None = None, row: Column | None = None) -> Column:
    """Sum of a double metric that does not depend on task order.

    Adding doubles gives a last bit that changes with the partitioning (or a retried task) and flips
    rounded halves, so values are added as decimals with 18 digits after the point. A value that
    has more digits, and a total beyond 10**20, fail with ANSI mode on or off; nothing is rounded off.
    The error shows the value, and ``row`` if given.
    """
    exact = x.try_cast(EXACT)
    lost = F.concat(F.lit("not exact with 18 decimals: "), x.cast("string"))
    if row is not None:
        lost = F.concat(lost, F.lit(" in "), row.cast("string"))
    misfit = F.raise_error(lost).cast(EXACT)
    total, n = F.sum(F.when(x.isNull() | (exact.cast("double") == x), exact).otherwise(misfit)), F.count(x)
    if window is not None:
        total, n = total.over(window), n.over(window)
    overflow = F.raise_error(F.lit("metric total is too large")).cast("double")
    return F.when(n > 0, F.coalesce(total.cast("double"), overflow))


def exact_avg(x: Column, window: WindowSpec | None = None, row: Column | None = None) -> Column:
    n = F.count(x)
    return safe_divide(exact_sum(x, window, row), n.over(window) if window else n)


def utc_wall_clock(ts: Column) -> Column:
    """The instant as a UTC timestamp without zone, whatever the session's time zone is."""
    seconds = (F.unix_micros(ts).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def register_sql(spark: SparkSession) -> None:
    """Make ``safe_divide`` callable from SQL. SQL functions are inlined, so plans stay the same."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION safe_divide(a DOUBLE, b DOUBLE) "
        "RETURNS DOUBLE RETURN try_divide(a, b)"
    )
