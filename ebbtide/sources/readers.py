"""Files into typed tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide import schemas

DAY_FIRST = r"^\s*(\d{1,2}/\d{1,2}/\d{4})(?:\s+([01]?\d|2[0-3]):([0-5]\d)(?::([0-5]\d))?)?\s*$"


def parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table with exactly the columns of its schema."""
    return schemas.conform(spark.read.parquet(path), schema)


def first_columns(df: DataFrame, n: int) -> DataFrame:
    """The leading columns of a sheet."""
    return df.select(*df.columns[:n])


def dimension_csv(spark: SparkSession, path: str, columns: int | None = None, sep: str = ",") -> DataFrame:
    """A sheet exported as CSV with a header; all columns are text."""
    sheet = spark.read.csv(path, header=True, sep=sep)
    return sheet if columns is None else first_columns(sheet, columns)


def day_first(c: Column) -> Column:
    """Timestamp of a day-first text, with or without a time; bad text gives NULL.

    Day and time are read apart, so that no time zone shifts them.
    """

    def part(n: int) -> Column:
        return F.coalesce(F.regexp_extract(c, DAY_FIRST, n).try_cast("int"), F.lit(0))

    day = F.try_to_date(F.regexp_extract(c, DAY_FIRST, 1), "d/M/yyyy").cast("timestamp_ntz")
    return day + F.make_dt_interval(hours=part(2), mins=part(3), secs=part(4).cast("decimal(18,6)"))


def lead_csv(spark: SparkSession, path: str, names: dict[str, str] | None = None) -> DataFrame:
    """Leads from a ';' separated Latin-1 file with decimal commas and day-first dates.

    Every column is read as text and parsed here. `names` maps the file's column
    names to those of the lead schema. Lead ids are whole numbers of up to 64 bits and
    are read exactly; any other ends the job.
    """
    raw = spark.read.csv(path, header=True, sep=";", encoding="ISO-8859-1")
    for theirs, ours in (names or {}).items():
        raw = raw.withColumnRenamed(theirs, ours)
    # An id that is no whole number would put a lead into neither part of the split.
    digits = F.regexp_extract(F.col("lead_id"), r"^\s*([+-]?\d+)(?:[.,]0*)?\s*$", 1)
    number = digits.try_cast("bigint")
    bad = F.raise_error(F.concat(F.lit("no lead id: "), F.coalesce("lead_id", F.lit("(empty)")))).cast("bigint")
    dated = {f.name: day_first(F.col(f.name)) for f in schemas.LEAD if isinstance(f.dataType, T.TimestampNTZType)}
    return schemas.conform(raw.withColumns({**dated, "lead_id": F.coalesce(number, bad)}), schemas.LEAD)
