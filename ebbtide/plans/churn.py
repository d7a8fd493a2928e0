"""Reversible churn: blocked members by tenure, age and class."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import bands, decode
from ebbtide.functions.dates import months_crossed, strict_date, years_crossed
from ebbtide.operators.counting import rollup_counts
from ebbtide.plans.blocks import MEMBER_KEY
from ebbtide.plans.contracts import DIALECT_A, Dialect, alive, prefixed


def churned(
    members: DataFrame,
    blocks: DataFrame,
    plans: DataFrame,
    reasons: DataFrame,
    reversible: Sequence[str],
    as_of: date,
    dialect: Dialect = DIALECT_A,
) -> DataFrame:
    """One row per blocked member (and period) whose reason can be reversed."""
    listed = alive(reasons).where(F.col("description").isin(list(reversible)))
    # Reasons thin the blocks and blocks the members, before their plans are looked up.
    stopped = blocks.join(prefixed(listed, "reason"), "reason_code")
    blocked = dialect.wanted_members(members).join(stopped, MEMBER_KEY)
    joined = dialect.date(F.col("joined"))
    born = dialect.date(F.col("birth"))
    return blocked.join(prefixed(dialect.wanted_plans(plans), "plan"), "plan_code").select(
        *[c for c in ("period_ord", "period") if c in blocks.columns],
        months_crossed(joined, strict_date(F.col("event_date"))).alias("months"),
        years_crossed(born, F.lit(as_of)).alias("age"),
        "class_code",
    )


def _labels(dialect: Dialect) -> dict:
    return {
        "tenure": bands.tenure_class(F.col("months")),
        "age": bands.age_class(F.col("age")),
        "class": decode.plan_class(F.col("class_code"), dialect.class_labels),
    }


def rollups(
    rows: DataFrame, reports: Sequence[str] = ("tenure", "age", "class"), dialect: Dialect = DIALECT_A
) -> DataFrame:
    """Counts with totals for the reports, per period where the rows have one."""
    by = [c for c in ("period_ord", "period") if c in rows.columns]
    return rollup_counts(rows, by, {r: c for r, c in _labels(dialect).items() if r in reports})
