"""Dates of the contract tables, months, cycles and periods."""

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide import fixed_values as fv

SENTINEL = date(1900, 1, 1)


def strict_date(c: Column) -> Column:
    """YYYYMMDD text; a bad value is an error."""
    return F.to_date(c, "yyyyMMdd")


def lenient_date(c: Column) -> Column:
    """YYYYMMDD text; blank or bad gives NULL."""
    return F.try_to_date(F.nullif(F.rtrim(c), F.lit("")), "yyyyMMdd")


def or_today(d: Column, as_of: date) -> Column:
    """NULL and the sentinel date stand for 'still running'."""
    return F.coalesce(F.nullif(d, F.lit(SENTINEL)), F.lit(as_of))


def months_crossed(start: Column, end: Column) -> Column:
    """Number of month boundaries between two dates."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def years_crossed(start: Column, end: Column) -> Column:
    """Number of year boundaries between two dates."""
    return F.year(end) - F.year(start)


def month_start(c: Column) -> Column:
    """First day of a month given as ISO or timestamp text, with month or day first in
    figures, or as 'jan/2024'."""
    text = F.lower(F.trim(c.cast("string")))
    known = [F.try_to_date(text), F.to_date(F.try_to_timestamp(text))]
    known += [F.try_to_date(text, layout) for layout in ("M/yyyy", "M/d/yyyy", "d/M/yyyy")]
    iso = F.trunc(F.coalesce(*known), "MM")
    number = F.array_position(F.array(*[F.lit(m) for m in fv.MONTHS]), text.substr(1, 3)).cast("int")
    year = F.regexp_extract(text, r"^[^/]*/\s*(\d{1,4})\s*$", 1).try_cast("int")
    named = F.when((number > 0) & (year > 0), F.make_date(year, number, F.lit(1)))
    return F.coalesce(iso, named)


def cycle_month(d: Column) -> Column:
    """Month of the 26th-to-25th cycle that holds a day."""
    return F.to_date(F.add_months(F.trunc(F.date_sub(d, 25), "MM"), 1))


def cycle_start(as_of: date) -> date:
    """The 26th that opened the running cycle."""
    if as_of.day >= 26:
        return as_of.replace(day=26)
    return (as_of.replace(day=1) - timedelta(days=1)).replace(day=26)


def parse_bound(text: str) -> date:
    """A report bound, 'dd/mm/yyyy' or 'yyyymmdd'."""
    layout = "%d/%m/%Y" if "/" in text else "%Y%m%d"
    if layout == "%Y%m%d" and len(text) != 8:
        raise ValueError(f"not a date of the form YYYYMMDD: {text!r}")
    return datetime.strptime(text, layout).date()


@dataclass(frozen=True)
class Period:
    start: date
    end: date
    label: str


def monthly_cycles(first: date, months: int) -> list[Period]:
    """`months` cycles from the 26th to the 25th; `first` is the first cycle's month."""
    out, start = [], cycle_start(first.replace(day=25))
    for _ in range(months):
        end = (start.replace(day=1) + timedelta(days=32)).replace(day=25)
        out.append(Period(start, end, f"{fv.MONTHS[end.month - 1].title()}-{end.year}"))
        start = end + timedelta(days=1)
    return out


def semesters(periods: list[Period]) -> list[Period]:
    """Join periods by the half-year of their label; first start, last end, order kept."""
    out: dict[str, Period] = {}
    for p in periods:
        month, year = p.label.split("-")
        label = f"S{1 if fv.MONTHS.index(month.lower()) < 6 else 2}-{year}"
        first = out.get(label, p)
        out[label] = Period(first.start, p.end, label)
    return list(out.values())
