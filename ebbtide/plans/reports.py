"""Cancellation and reactivation reports of all branches in one job."""

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide import fixed_values as fv
from ebbtide.functions import bands, decode, text
from ebbtide.functions.numbers import amount, floor_at_zero, money, to_number
from ebbtide.operators import sketch
from ebbtide.operators.counting import ALL, Section, entry, shares, top_labels, with_empty_bands
from ebbtide.operators.lineage import cut
from ebbtide.operators.stats import value_stats

BY = ["branch", "kind"]

SECTIONS = {
    s.name: s
    for s in (
        Section("age", "age", "bands", bands.AGE, total=True),
        Section("tenure", "tenure", "bands", bands.TENURE, total=True),
        Section("class", "plan_class", "count"),
        Section("reason", "reason", "label", total=True),
        Section("sellers", "seller", "count"),
        Section("plan", "plan", "count"),
        Section("payment", "payment_type", "count"),
    )
}
# Sections by kind of report, beside KPIs and value statistics.
CONTENT = {
    "cancelled": ["age", "tenure", "class", "reason", "sellers", "plan", "payment"],
    "reactivated": ["age", "tenure", "sellers", "plan", "payment"],
}
TOP_SELLERS = 10
COLUMNS = [*BY, "section", "ord", "label", "qty", "pct", "pct_text", "bar", "amount", "amount_text", "is_total"]


def clean(rows: DataFrame) -> DataFrame:
    """Trimmed names, ages from 0, tenure 0 where unknown, values that are amounts.

    Values that are none are NULL for every figure alike; `rejected` counts them.
    """
    return rows.select(
        *BY,
        text.strip(F.col("seller_name")).alias("seller"),
        floor_at_zero(F.col("age")).alias("age"),
        F.coalesce(amount(to_number(F.col("tenure_months"))), F.lit(0.0)).alias("tenure"),
        amount(to_number(F.col("monthly_value"))).alias("value"),
        "reason",
        "plan",
        "plan_class",
        "payment_type",
    )


def rejected(rows: DataFrame) -> DataFrame:
    """Values that are filled but no amount, by branch and kind."""
    given, kept = F.trim("monthly_value") != "", amount(to_number(F.col("monthly_value")))
    return rows.groupBy(*BY).agg(F.count_if(F.coalesce(given, F.lit(False)) & kept.isNull()).alias("rejected"))


def _counts(rows: DataFrame, names: Collection[str]) -> DataFrame:
    """Counts per branch, kind, section and label, with all rows under ALL."""
    entries = F.array(entry(ALL), *[entry(n, SECTIONS[n].label()) for n in names])
    cells = rows.select(*BY, F.inline(entries)).groupBy(*BY, "section", "label").agg(F.count("*").alias("n"))
    return with_empty_bands(cells, BY, [SECTIONS[n] for n in names])


def section(rows: DataFrame, name: str) -> DataFrame:
    """One grouped section of a report."""
    counts = _counts(clean(rows), [name])
    if name == "sellers":
        return top_labels(counts, BY, name, TOP_SELLERS)
    return shares(counts, BY, [SECTIONS[name]])


def band_totals(rows: DataFrame, name: str) -> DataFrame:
    """Counts with empty bands and a total row, without percentages."""
    return section(rows, name).select(*BY, "section", "ord", "label", "qty", "is_total")


def _kpi_measures() -> list:
    return [
        F.count("*").alias("qty"),
        F.avg("age").alias("mean_age"),
        (F.sum(money(F.col("tenure"))).cast("double") / F.count("*") / 12).alias("mean_years"),
        F.sum(money(F.col("value"))).cast("double").alias("revenue"),
    ]


def _kpi_texts(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        text.thousands(F.col("qty")).alias("qty_text"),
        text.whole_text(F.col("mean_age"), fv.YEARS).alias("age_text"),
        text.whole_text(F.col("mean_years"), fv.YEARS).alias("years_text"),
        text.money_text(F.coalesce(F.col("revenue"), F.lit(0.0))).alias("revenue_text"),
    )


def kpis(rows: DataFrame) -> DataFrame:
    """Row count, mean age, mean tenure in years and sum of all values, as numbers and texts."""
    return _kpi_texts(clean(rows).groupBy(*BY).agg(*_kpi_measures()))


def _stat_rows(stats: DataFrame) -> DataFrame:
    """Five rows per branch and kind from one row of statistics."""
    revenue = F.concat(decode.lookup(F.col("kind"), fv.REVENUE_LABELS), F.lit(fv.MONTHLY))
    labels = [*[F.lit(v) for v in fv.STAT_LABELS], revenue]
    columns = ["mean", "median", "lowest", "highest", "total"]
    rows = [
        F.struct(F.lit(n).alias("ord"), label.alias("label"), F.col(c).alias("amount"))
        for n, (label, c) in enumerate(zip(labels, columns, strict=True), 1)
    ]
    return stats.select(*BY, F.inline(F.array(*rows))).withColumn(
        "amount_text", text.plain_money_text(F.col("amount"))
    )


def stats(rows: DataFrame) -> DataFrame:
    """Value statistics over the positive values."""
    values = clean(rows).where(F.col("value") > 0).groupBy(*BY, "value").agg(F.count("*").alias("n"))
    return _stat_rows(value_stats(values, BY, "value", "n"))


def value_sketches(rows: DataFrame, by: Sequence[str], error: float = 0.01) -> DataFrame:
    """Sketches of the values of each group, for example by branch, kind and day."""
    return sketch.sketches(rows.withColumn("value", amount(to_number(F.col("monthly_value")))), by, "value", error)


def approximate_stats(parts: DataFrame, error: float = 0.01) -> DataFrame:
    """Value statistics of the merged sketches; the median is within `error` of the exact one."""
    return _stat_rows(sketch.statistics(sketch.merged(parts, BY), BY, error))


def report(rows: DataFrame, without: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """All sections of all branches and kinds as one long table.

    The rows are read once: each is turned into one entry per section, and the counts
    of all entries, the sums behind the KPIs and the counts per value come from a
    single aggregation. Only that result is used more than once.

    `without` lists (branch, section) pairs that a branch does not report.
    """
    nothing = {"value": F.lit(None).cast("double"), "age": F.lit(None).cast("int"), "tenure": F.lit(None).cast("double")}

    def in_report(name: str):
        kinds = [k for k, names in CONTENT.items() if name in names]
        branches = [b for b, s in without if s == name]
        return F.col("kind").isin(kinds) & ~F.coalesce(F.col("branch").isin(branches), F.lit(False))

    made = [entry(ALL, value=F.col("value"), age=F.col("age"), tenure=F.col("tenure"))]
    made += [entry(n, F.when(in_report(n), s.label()), **nothing) for n, s in SECTIONS.items()]
    cells = (
        clean(rows)
        .select(*BY, F.inline(F.array(*made)))
        .where((F.col("section") == ALL) | F.col("label").isNotNull())
        .groupBy(*BY, "section", "label", "value")
        .agg(
            F.count("*").alias("n"),
            F.sum("age").alias("age_sum"),
            F.count("age").alias("age_n"),
            F.sum(money(F.col("tenure"))).alias("tenure_sum"),
        )
    )
    cells = cut(cells)
    whole = cells.where(F.col("section") == ALL)

    counts = cells.groupBy(*BY, "section", "label").agg(F.sum("n").alias("n"))
    counts = with_empty_bands(counts, BY, [s for s in SECTIONS.values() if s.bands])
    listed = shares(counts, BY, [s for n, s in SECTIONS.items() if n != "sellers"])
    for branch, name in without:
        listed = listed.where(~(F.col("branch").eqNullSafe(branch) & (F.col("section") == name)))
    top = top_labels(counts, BY, "sellers", TOP_SELLERS)

    numbers = whole.groupBy(*BY).agg(
        F.sum("n").alias("qty"),
        (F.sum("age_sum").cast("double") / F.sum("age_n")).alias("mean_age"),
        (F.sum("tenure_sum").cast("double") / F.sum("n") / 12).alias("mean_years"),
        F.sum(money(F.col("value")) * F.col("n")).cast("double").alias("revenue"),
    )
    kpi = _kpi_texts(numbers)
    facts = [
        (decode.lookup(F.col("kind"), fv.KPI_LABELS), F.col("qty").cast("double"), "qty_text"),
        (F.lit(fv.KPI_AGE), F.col("mean_age"), "age_text"),
        (F.lit(fv.KPI_TENURE), F.col("mean_years"), "years_text"),
        (decode.lookup(F.col("kind"), fv.REVENUE_LABELS), F.col("revenue"), "revenue_text"),
    ]
    kpi = kpi.select(
        *BY,
        F.lit("kpi").alias("section"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("ord"), label.alias("label"), amount.alias("amount"), F.col(t).alias("amount_text"))
                    for i, (label, amount, t) in enumerate(facts, 1)
                ]
            )
        ),
    )
    values = whole.where(F.col("value") > 0).select(*BY, "value", "n")
    value = _stat_rows(value_stats(values, BY, "value", "n")).withColumn("section", F.lit("value"))

    parts = listed
    for other in (top, kpi, value):
        parts = parts.unionByName(other, allowMissingColumns=True)
    return parts.select(*[F.coalesce("is_total", F.lit(False)).alias(c) if c == "is_total" else c for c in COLUMNS])
