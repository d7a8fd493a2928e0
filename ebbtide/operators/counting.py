"""Counts by label for many report sections in one pass."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ebbtide import fixed_values as fv
from ebbtide.functions.bands import Bands
from ebbtide.functions.numbers import percent, percent_text
from ebbtide.functions.text import bar_width
from ebbtide.operators.joins import join_by

ALL = "*"


@dataclass(frozen=True)
class Section:
    """One grouping of a report.

    `order` is 'bands' (with empty bands), 'label' or 'count' (highest first).
    """

    name: str
    column: str
    order: str
    bands: Bands | None = None
    total: bool = False

    def label(self) -> Column:
        return self.bands.label(F.col(self.column)) if self.bands else F.col(self.column)


def entry(section: str, label: Column | None = None, **measures: Column) -> Column:
    """One exploded entry; entries of all sections share a type."""
    blank = F.lit(None).cast("string")
    fields = [F.lit(section).alias("section"), (blank if label is None else label).alias("label")]
    return F.struct(*fields, *[c.alias(n) for n, c in measures.items()])


def with_empty_bands(counts: DataFrame, by: Sequence[str], sections: Sequence[Section]) -> DataFrame:
    """Add a zero for every band of every group; the ALL row of a group brings them.

    Only sections with bands are added up again.
    """
    zeros = [
        F.struct(F.lit(s.name).alias("section"), F.lit(label).alias("label"), F.lit(0).cast("bigint").alias("n"))
        for s in sections
        if s.bands
        for label in s.bands.labels
    ]
    if not zeros:
        return counts
    own = F.struct("section", "label", "n")
    banded = F.col("section").isin([s.name for s in sections if s.bands])
    rows = F.when(F.col("section") == ALL, F.array(*zeros)).otherwise(F.array(own))
    filled = counts.where(banded | (F.col("section") == ALL)).select(*by, F.inline(rows))
    filled = filled.groupBy(*by, "section", "label").agg(F.sum("n").alias("n"))
    return counts.where(~banded).unionByName(filled)


def shares(counts: DataFrame, by: Sequence[str], sections: Sequence[Section]) -> DataFrame:
    """Order, percentage of the counted rows and total row per section.

    Works on counts, whose labels come from code tables: a group is small here.
    """
    band_ord = F.lit(None).cast("int")
    by_count = F.lit(False)
    totals = F.lit(False)
    for s in sections:
        mine = F.col("section") == s.name
        if s.bands:
            position = F.array_position(F.array(*[F.lit(v) for v in s.bands.labels]), F.col("label"))
            band_ord = F.when(mine, position.cast("int")).otherwise(band_ord)
        if s.order == "count":
            by_count = by_count | mine
        if s.total:
            totals = totals | mine
    rank = F.when(by_count, -F.col("n")).otherwise(F.coalesce(band_ord, F.lit(0)))
    ordered = W.partitionBy(*by, "section").orderBy("_rank", "label")
    group = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    counted = (
        counts.where(F.col("section").isin([s.name for s in sections]) & F.col("label").isNotNull())
        .withColumn("_rank", rank)
        .select(
            "*",
            F.sum("n").over(group).alias("whole"),
            F.count("*").over(group).alias("rows"),
            F.row_number().over(ordered).alias("ord"),
        )
    )
    pct = percent(F.col("n"), F.col("whole"))
    own = F.struct(
        F.col("ord"), F.col("label"), F.col("n").alias("qty"), pct.alias("pct"), F.lit(False).alias("is_total")
    )
    total = F.struct(
        (F.col("ord") + 1).alias("ord"),
        F.lit(fv.GRAND_TOTAL).alias("label"),
        F.col("whole").alias("qty"),
        F.lit(100.0).alias("pct"),
        F.lit(True).alias("is_total"),
    )
    last = totals & (F.col("ord") == F.col("rows"))
    return counted.select(*by, "section", F.inline(F.when(last, F.array(own, total)).otherwise(F.array(own)))).select(
        "*", percent_text(F.col("pct")).alias("pct_text"), bar_width(F.col("pct"), F.col("is_total")).alias("bar")
    )


def top_labels(counts: DataFrame, by: Sequence[str], section: str, n: int) -> DataFrame:
    """The n most frequent labels per group, with their share of all rows.

    Rows without a label count in the whole. The rank limit is applied before the
    shuffle as well, so a group with many labels sends n rows per task.
    """
    wholes = counts.where(F.col("section") == ALL).select(*by, F.col("n").alias("whole"))
    ordered = W.partitionBy(*by).orderBy(F.desc("n"), "label")
    named = counts.where((F.col("section") == section) & F.col("label").isNotNull())
    top = named.withColumn("ord", F.row_number().over(ordered)).where(F.col("ord") <= n)
    pct = percent(F.col("n"), F.col("whole"))
    return (
        join_by(top, wholes, by)
        .select(
            *by, F.lit(section).alias("section"), "ord", "label", F.col("n").alias("qty"), pct.alias("pct"),
            F.lit(False).alias("is_total"),
        )
        .select("*", percent_text(F.col("pct")).alias("pct_text"), bar_width(F.col("pct"), F.col("is_total")).alias("bar"))
    )


def rollup_counts(classes: DataFrame, by: Sequence[str], reports: dict[str, Column]) -> DataFrame:
    """Counts by class with a total row, for several reports in one pass.

    A NULL class is a row of its own, told apart from the total by `is_total`.
    """
    entries = F.array(*[entry(name, label) for name, label in reports.items()])
    cells = classes.select(*by, F.inline(entries)).groupBy(*by, "section", "label").agg(F.count("*").alias("n"))
    own = F.struct(F.col("label"), F.lit(False).alias("is_total"), F.col("n"))
    total = F.struct(F.lit(fv.ROLLUP_TOTAL).alias("label"), F.lit(True).alias("is_total"), F.col("n"))
    return (
        cells.select(*by, "section", F.inline(F.array(own, total)))
        .groupBy(*by, "section", "label", "is_total")
        .agg(F.sum("n").alias("qty"))
        .withColumnRenamed("section", "report")
    )
