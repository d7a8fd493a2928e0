"""Numbers: tolerant parsing, rounding, percentages."""

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(c: Column) -> Column:
    """Double, or NULL where the text is no finite number.

    The pattern keeps out forms that only the JVM parser accepts ('12d', 'NaN').
    """
    text = c.cast("string")
    number = text.try_cast("double")
    return F.when(text.rlike(NUMBER) & (F.abs(number) < F.lit(float("inf"))), number)


def comma_number(c: Column) -> Column:
    """Number with a decimal comma; thousands dots make it NULL."""
    return to_number(F.replace(c.cast("string"), F.lit(","), F.lit(".")))


def floor_at_zero(c: Column) -> Column:
    """Clip below at 0; NULL stays NULL (greatest() would turn it into 0)."""
    return F.when(c < 0, F.lit(0)).otherwise(c)


def round_even(c: Column, digits: int) -> Column:
    """Round half to even on the binary value."""
    scale = 10**digits
    return F.rint(c * F.lit(float(scale))) / F.lit(float(scale))


def percent(part: Column, whole: Column) -> Column:
    """part / whole x 100 at one decimal; NULL where the whole is 0."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double"))
    return round_even(ratio * F.lit(100.0), 1)


def percent_text(pct: Column) -> Column:
    return F.concat(pct.cast("string"), F.lit("%"))


# Amounts have six decimals; from this size on, a number is no amount.
NO_AMOUNT = 1e16


def amount(c: Column) -> Column:
    """A number as an amount: six decimals, NULL where it is too large to be one."""
    return F.when(F.abs(c) < NO_AMOUNT, F.round(c, 6))


def money(c: Column) -> Column:
    """Exact decimal for sums: the result does not depend on the order of rows.

    NULL for what `amount` leaves out, so that one odd value does not end a job.
    """
    return c.try_cast("decimal(28,6)")
