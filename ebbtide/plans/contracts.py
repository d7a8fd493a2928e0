"""The contract tables as plans take them."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide import fixed_values as fv
from ebbtide.functions.dates import lenient_date, strict_date
from ebbtide.functions.text import is_blank


@dataclass(frozen=True)
class Dialect:
    """What differs between the branches' systems.

    Strict dates fail on bad text, and a blank is the sentinel date; otherwise bad
    and blank dates are NULL. An empty list or None means no such filter.
    """

    strict_dates: bool
    excluded_company: str | None = None
    companies: list[str] = field(default_factory=list)
    modalities: list[int] = field(default_factory=list)
    excluded_plans: list[str] = field(default_factory=list)
    class_labels: dict[str, str] = field(default_factory=dict)

    def date(self, c: Column) -> Column:
        if not self.strict_dates:
            return lenient_date(c)
        return F.when(is_blank(c), F.lit("1900-01-01").cast("date")).otherwise(strict_date(c))

    def wanted_members(self, members: DataFrame) -> DataFrame:
        out = alive(members)
        if self.excluded_company:
            out = out.where(F.col("company") != self.excluded_company)
        return out.where(F.col("company").isin(self.companies)) if self.companies else out

    def wanted_plans(self, plans: DataFrame) -> DataFrame:
        out = alive(plans)
        return out.where(F.col("modality").isin(self.modalities)) if self.modalities else out

    def wanted_families(self, families: DataFrame) -> DataFrame:
        out = alive(families)
        return out.where(~F.col("plan_code").isin(self.excluded_plans)) if self.excluded_plans else out


DIALECT_A = Dialect(
    strict_dates=True,
    excluded_company=fv.EXCLUDED_COMPANY_A,
    modalities=fv.MODALITIES_A,
    class_labels=fv.CLASS_LABELS_A,
)
DIALECT_B = Dialect(
    strict_dates=False,
    companies=fv.COMPANIES_B,
    excluded_plans=fv.EXCLUDED_PLANS_B,
    class_labels=fv.CLASS_LABELS_B,
)


def alive(df: DataFrame) -> DataFrame:
    """Rows without the deletion mark."""
    return df.where(is_blank(F.col("deleted")))


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in df.columns])
