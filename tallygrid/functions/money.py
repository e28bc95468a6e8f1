"""Sums, means and ratios whose result does not depend on how rows are spread.

Adding doubles gives a different last digit for every partitioning and every
retried task. Amounts that are whole millionths are therefore counted in
millionths, in three longs of 21 bits a row, which no number of rows below 4e12
overflows and which are put together once per group. All other amounts (more
digits, above 9e12, infinite or not a number) are summed as plain doubles beside
them; a total with such amounts can differ in its last digits between runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
PART_BITS = 21
LARGEST = 9.0e12
SLACK = 1e-14  # noise of earlier arithmetic that still counts as whole


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _whole(c: Column) -> Column:
    """Whether the amount is whole millionths, up to the noise of double arithmetic."""
    scaled = c * F.lit(float(MICROS))
    near = F.abs(F.rint(scaled) - scaled) <= F.abs(scaled) * F.lit(SLACK)
    return (F.abs(c) < F.lit(LARGEST)) & near


def _micros(amount: Column) -> Column:
    """Whole millionths as a long; null for other amounts."""
    return F.when(_whole(amount), F.rint(amount * F.lit(float(MICROS)))).cast("bigint")


def exact_total(c: Column | str, times: Column | str | None = None) -> Column:
    """Sum of the amounts in ``c`` that are whole millionths, as a decimal with six
    places; ``times`` counts each value that often."""
    micros = _micros(column(c).cast("double"))
    mask = F.lit((1 << PART_BITS) - 1).cast("bigint")
    parts = [
        F.shiftright(micros, 2 * PART_BITS),
        F.shiftright(micros, PART_BITS).bitwiseAND(mask),
        micros.bitwiseAND(mask),
    ]
    if times is not None:
        parts = [p * column(times) for p in parts]
    # Precisions are chosen so that no step can lose or overflow digits.
    high, middle, low = (F.sum(p).cast("decimal(19,0)") for p in parts)
    total = (high * F.lit(1 << 2 * PART_BITS).cast("decimal(13,0)")
             + middle * F.lit(1 << PART_BITS).cast("decimal(7,0)") + low)
    return total.cast("decimal(31,0)") * F.lit("0.000001").cast("decimal(6,6)")


def other_total(c: Column | str, times: Column | str | None = None) -> Column:
    """Sum of the amounts that ``exact_total`` leaves out, as a double; null without any."""
    amount = column(c).cast("double")
    # By the long that ``exact_total`` needs too, so that Spark makes the test once a row.
    left = F.when(_micros(amount).isNull(), amount)
    return F.sum(left if times is None else left * column(times))


def put_together(exact: Column | str, other: Column | str) -> Column:
    """A total as a double from its two parts."""
    exact, other = column(exact).cast("double"), column(other)
    return F.when(other.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + other)


def exact_sum(c: Column | str) -> Column:
    return put_together(exact_total(c), other_total(c))


def exact_mean(c: Column | str) -> Column:
    """Mean over the non-null values, null when there are none."""
    return ratio(exact_sum(c), F.count(column(c)))


def exact_deviation(c: Column | str) -> Column:
    """Sample standard deviation, null for fewer than two values.

    Sums of whole millionths and of their squares are exact, and so is what the mean takes
    from them up to a remainder below one millionth a value; only then are doubles used. A
    group with other amounts, or whose squares pass 38 digits, has Spark's own deviation,
    the last digits of which depend on the order of its rows.
    """
    amount = column(c).cast("double")
    micros = _micros(amount)
    whole = micros.cast("decimal(19,0)")
    n, total = F.count(amount), F.sum(whole).cast("decimal(38,0)")
    squares = F.try_sum((whole * whole).cast("decimal(38,0)"))
    # With total = near * n + left, squares - total^2 / n is squares - near * (total + left) - left^2 / n.
    near = F.floor(total.cast("double") / n).cast("decimal(38,0)")
    left = (total - near * n.cast("decimal(19,0)")).cast("decimal(38,0)")
    bulk = F.try_subtract(squares, F.try_multiply(near, (total + left).cast("decimal(38,0)")))
    rest = left.cast("double") * left.cast("double") / n
    spread = F.greatest(bulk.cast("double") - rest, F.lit(0.0))
    exact = F.when(n > 1, F.sqrt(spread / (n - 1)) / float(MICROS))
    return F.when((F.count(micros) == n) & (bulk.isNotNull() | (n < 2)), exact).otherwise(F.stddev(amount))


def int_mean(c: Column | str) -> Column:
    """Mean of an integer column from its exact sum."""
    return ratio(F.sum(column(c)).cast("double"), F.count(column(c)))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that gives null for a zero divisor."""
    return F.try_divide(column(numerator).cast("double"), column(denominator).cast("double"))


def ratio_or_zero(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that gives 0 unless the divisor is positive."""
    quotient = F.when(column(denominator) > 0, ratio(numerator, denominator))
    return quotient.otherwise(F.lit(0.0))


def rows() -> Column:
    return F.count(F.lit(1))
