"""Column expressions for money, ratios and rounding.

Money is summed as ``SUM`` decimals, so a total is the same for any partitioning and keeps
ten decimals up to 1e28; one amount may have 18 digits before the point.  Ratios are plain
doubles.  Rounding is half-even throughout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLION = 1_000_000
MONEY, SUM = "decimal(28,10)", "decimal(38,10)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hundredths(value: Column | str) -> Column:
    """A double with at most two decimals as whole hundredths."""
    return F.rint(col(value) * 100).cast("long")


def exact_sum(value: Column | str) -> Column:
    """Sum of money as a decimal; null when there is no value.

    Further sums of it stay decimals; cast to double in the last projection.
    """
    return F.sum(col(value).cast(SUM))


def total(value: Column | str) -> Column:
    """Sum of money or of rates as a double; 0 when every value is null."""
    return F.coalesce(exact_sum(value).cast("double"), F.lit(0.0))


def mean(value: Column | str) -> Column:
    """Mean of money from the exact sum; null when there is no value."""
    return F.try_divide(exact_sum(value).cast("double"), F.count(col(value)))


def rows() -> Column:
    return F.count(F.lit(1))


def millions(value: Column | str) -> Column:
    return col(value) / MILLION


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient that is null for a zero denominator."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def half_even(value: Column | str, decimals: int = 0) -> Column:
    return F.bround(col(value), decimals)


def percent(numerator: Column | str, denominator: Column | str) -> Column:
    return ratio(numerator, denominator) * 100


def growth_pct(current: Column | str, previous: Column | str, decimals: int = 1) -> Column:
    """Growth in percent, null without a non-zero previous value."""
    return half_even(percent(col(current) - col(previous), previous), decimals)


def margin_pct(price: Column | str, cost: Column | str) -> Column:
    """Margin over price as a whole percentage."""
    return half_even(percent(col(price) - col(cost), price)).cast("int")


def guarded_margin_pct(price: Column | str, cost: Column | str) -> Column:
    """Margin that is 0 for free or negative prices."""
    return F.when(col(price) > 0, margin_pct(price, cost)).otherwise(F.lit(0))


def cost_hundredfold(amount: Column | str, margin: Column | str) -> Column:
    """A hundred times the amount without its whole-percent margin, as a decimal."""
    return col(amount).cast(MONEY) * (100 - col(margin)).cast("decimal(4,0)")


def total_hundredth(value: Column | str) -> Column:
    """A hundredth of the sum of ``cost_hundredfold`` values or of sums of them."""
    return F.coalesce(exact_sum(value).cast("double") / 100, F.lit(0.0))


def total_cost(amount: Column | str, margin: Column | str) -> Column:
    """Sum of amounts without their whole-percent margins."""
    return total_hundredth(cost_hundredfold(amount, margin))


def line_subtotal(price: Column | str, quantity: Column | str, discount: Column | str, decimals: int = 0) -> Column:
    return half_even(col(price) * col(quantity) * (F.lit(1) - col(discount)), decimals)


def clip(value: Column | str, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col(value)))


def flag(condition: Column) -> Column:
    """Condition as 0/1; an unknown condition counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))
