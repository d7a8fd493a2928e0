"""Text clean-up and the number formats of the reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide import fixed_values as fv
from ebbtide.functions.numbers import round_even, to_number


def strip(c: Column) -> Column:
    """Drop white space of any kind at both ends (trim() drops blanks only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    """Blank-padded CHAR equals ''. NULL gives NULL, as in SQL."""
    return F.rtrim(c) == ""


def filled(c: Column) -> Column:
    return F.coalesce(c != "", F.lit(False))


def title_case(c: Column) -> Column:
    """Trimmed, with a capital after every character that is no letter.

    initcap() knows only blanks as word ends, so the words are cut before each
    letter run first and capitalised one by one.
    """
    runs = F.regexp_extract_all(F.lower(strip(c)), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(w.substr(1, 1)), w.substr(F.lit(2), F.length(w)))), "")


def seller_code(c: Column) -> Column:
    """Six digits, zero padded, longer codes kept whole; NULL where no number."""
    number = to_number(c).try_cast("bigint")
    return F.when(number.isNotNull(), F.format_string("%06d", number))


def thousands(c: Column) -> Column:
    """1234 -> 1.234"""
    return F.translate(F.format_number(c, 0), ",", ".")


def money_text(c: Column) -> Column:
    """1234.5 -> R$ 1.234,50"""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(round_even(c, 2), 2), ",.", ".,"))


def plain_money_text(c: Column) -> Column:
    """1234.5 -> R$ 1234.50"""
    return F.when(c.isNotNull(), F.format_string("R$ %.2f", round_even(c, 2)))


def whole_text(c: Column, unit: str = "") -> Column:
    """42.5 -> 42, half to even, with a unit behind."""
    return F.when(c.isNotNull(), F.concat(F.format_string("%.0f", F.rint(c)), F.lit(unit)))


def count_text(c: Column) -> Column:
    """Integer part as text, a dash for NULL."""
    return F.coalesce(c.cast("bigint").cast("string"), F.lit(fv.DASH))


def bar_width(pct: Column, is_total: Column) -> Column:
    """Width of the bar beside a percentage; none for totals and for 0."""
    return F.when(~is_total & (pct != 0), F.least(pct, F.lit(100.0)))


def progress_bar(pct: Column, cells: int = 10) -> Column:
    """Filled and empty cells with the rounded percentage.

    Over 100 % the bar grows beyond its cells and has no empty ones.
    """
    full = (pct / 100 * cells).cast("int")
    symbol = F.when(pct >= 100, fv.BAR_TOP).when(pct >= 70, fv.BAR_MID).otherwise(fv.BAR_LOW)
    bar = F.concat(F.repeat(symbol, full), F.repeat(F.lit(fv.BAR_EMPTY), F.lit(cells) - full))
    return F.concat(bar, F.lit(" "), F.format_string("%.0f%%", F.rint(pct)))


def progress_phrase(goal: Column, done: Column) -> Column:
    left = goal - done
    return (
        F.when(goal.isNull(), fv.NO_GOAL)
        .when(left <= 0, F.format_string(fv.GOAL_BEATEN, F.abs(left).cast("bigint")))
        .when(left > 0, F.format_string(fv.GOAL_MISSING, left.cast("bigint")))
        .otherwise(fv.DASH)
    )


def attainment_text(pct: Column) -> Column:
    """One decimal and a percent sign; a dash where there is no percentage."""
    return F.when(pct.isNotNull(), F.format_string("%.1f%%", round_even(pct, 1))).otherwise(fv.DASH)


def score_text(score: Column) -> Column:
    return F.when(score.isNull(), fv.DASH).otherwise(
        F.concat(F.format_string("%.1f", round_even(score, 1)), F.lit(fv.SCORE_UNIT))
    )
