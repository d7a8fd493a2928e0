"""Block events: the latest one of a member, in all or by period."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.dates import Period, lenient_date
from ebbtide.operators.joins import tag_periods
from ebbtide.operators.latest import latest
from ebbtide.plans.contracts import alive

BLOCKED = "0"
MEMBER_KEY = ["org", "company", "family", "member_type"]
# Widths of the parts of the joint family key; the family takes the rest.
ORG_CHARS, COMPANY_CHARS = 4, 4


def blocks_between(events: DataFrame, start: date, end: date) -> DataFrame:
    """Living block events of the days from start to end, keyed by the member's columns.

    Dates are compared as text, so that the filter can reach the scan.
    """
    key = F.col("family_key")
    rest = ORG_CHARS + COMPANY_CHARS + 1
    return (
        alive(events)
        .where(F.col("event_type") == BLOCKED)
        .where(F.col("event_date").between(f"{start:%Y%m%d}", f"{end:%Y%m%d}"))
        .select(
            key.substr(1, ORG_CHARS).alias("org"),
            key.substr(ORG_CHARS + 1, COMPANY_CHARS).alias("company"),
            key.substr(F.lit(rest), F.length(key)).alias("family"),
            "member_type",
            "row_id",
            "event_date",
            "reason_code",
            "user",
        )
    )


KEPT = ["row_id", "event_date", "reason_code", "user"]


def latest_blocks(events: DataFrame, start: date, end: date, keep: Sequence[str] = KEPT) -> DataFrame:
    """The block with the highest row id per member; its date does not matter."""
    return latest(blocks_between(events, start, end), MEMBER_KEY, ["row_id"], keep)


def latest_blocks_by_period(events: DataFrame, periods: list[Period], keep: Sequence[str] = KEPT) -> DataFrame:
    """The same within each period: a member blocked in two periods counts in both."""
    start, end = min(p.start for p in periods), max(p.end for p in periods)
    dated = blocks_between(events, start, end).withColumn("_day", lenient_date(F.col("event_date")))
    tagged = tag_periods(dated, "_day", periods)
    return latest(tagged, ["period_ord", "period", *MEMBER_KEY], ["row_id"], keep)
