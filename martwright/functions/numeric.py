"""Money, rounding and ratios that give the same digits on every engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
PRICE, SHARE = "decimal(16,6)", "decimal(8,6)"  # of a sale, as landed


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def half_up(value: Column | str, places: int = 2) -> Column:
    """Round a double half away from zero as `floor(|x| * 10^n + 0.5) / 10^n`.

    From 2^53 units of the last place on a double has no digits to round.
    """
    scale = float(10**places)
    x = col(value).cast("double")
    rounded = F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / F.lit(scale) + F.lit(0.0)  # no negative zero
    return F.when(F.abs(x) * scale < float(2**53), rounded).otherwise(x)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division where a zero denominator gives NULL instead of an error."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def percent(numerator: Column | str, denominator: Column | str, places: int = 1) -> Column:
    return half_up(ratio(numerator, denominator) * 100.0, places)


def cents(df: DataFrame, name: str) -> Column:
    """A DECIMAL(18,2) column of `df` in whole cents.

    Sums of long cents are exact like decimal sums and cost a third of them per row; beyond 9e16 they
    raise an overflow error. A frame that has the cents already carries them as `<name>_cents`.
    """
    ready = f"{name}_cents"
    return F.col(ready) if ready in df.columns else (F.col(name) * 100).cast("bigint")


def units(amount_in_cents: Column | str) -> Column:
    """Cents as a double amount."""
    return col(amount_in_cents).cast("double") / 100.0


def total(amount_in_cents: Column | str) -> Column:
    """Sum of cents as a double amount."""
    return units(F.sum(col(amount_in_cents)))


def mean(sum_value: Column | str, count: Column | str, places: int = 2) -> Column:
    return half_up(ratio(sum_value, count), places)


def mean_amount(sum_in_cents: Column | str, count: Column | str) -> Column:
    return mean(units(sum_in_cents), count)


def sale_total(quantity: Column | str, unit_price: Column | str, discount: Column | str) -> Column:
    """quantity x price x (1 - discount) in decimal arithmetic; only the product is rounded, to the cent."""
    gross = col(quantity).cast("decimal(10,0)") * col(unit_price).cast(PRICE)
    return (gross * (F.lit(1).cast("decimal(1,0)") - col(discount).cast(SHARE))).cast(MONEY)


def first_digit(value: Column | str) -> Column:
    """First significant digit of a number; NULL when it has none."""
    digit = F.substring(F.ltrim(F.abs(col(value)).cast("string"), F.lit("0.")), 1, 1)
    return F.when(digit.between("1", "9"), digit.cast("int"))
