"""Results to files."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parts(df: DataFrame, path: str, by: str | Sequence[str]) -> None:
    """One folder per report, branch or period of a long result.

    Parts that the rows belong to are replaced, the others stay: a job can be run again for one of them.
    """
    names = [by] if isinstance(by, str) else by
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*names).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int, by: Sequence[str] = ()) -> None:
    """A table dealt and sorted by its join keys once, so that joins and groups on them need no shuffle.

    Tables that are joined take the same number of buckets; a bucket should fit a task. `by` puts
    parts, a branch for example, into folders of their own.
    """
    laid = df.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys)
    (laid.partitionBy(*by) if by else laid).saveAsTable(table)


def plain_number(c: Column) -> Column:
    """The shortest decimal text of a double, without an exponent up to 38 digits before the point.

    Of numbers closer to 0 than 1e-20, digits behind the 37th are left out.
    """
    text = c.cast("string")
    size = F.abs(c)
    wide = F.when(size >= 1e19, text.try_cast("decimal(38,0)").cast("string"))
    wide = wide.when(size >= 1e-3, text.try_cast("decimal(38,18)").cast("string"))
    wide = wide.otherwise(text.try_cast("decimal(38,37)").cast("string"))
    # Zeros at the end go, but for one behind the point.
    short = F.regexp_replace(F.regexp_replace(wide, r"^(-?\d+)$", "$1.0"), r"(\.\d+?)0+$", "$1")
    return F.when(text.contains("E"), F.coalesce(short, text)).otherwise(text)


def write_csv(df: DataFrame, path: str, sep: str = ";", decimal_comma: bool = True) -> None:
    """CSV with a header; fractions in plain notation, with a decimal comma if wanted."""

    def shown(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.FractionalType):
            c = plain_number(c) if isinstance(field.dataType, (T.DoubleType, T.FloatType)) else c.cast("string")
            c = F.translate(c, ".", ",") if decimal_comma else c
        return c.alias(field.name)

    df.select(*[shown(f) for f in df.schema]).write.mode("overwrite").csv(path, header=True, sep=sep)


def ranked(scores: DataFrame) -> DataFrame:
    """Scores from high to low, for the export."""
    return scores.orderBy(F.desc("score"), "lead_id")
