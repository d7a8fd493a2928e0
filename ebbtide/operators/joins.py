"""Joins that Spark's own choice does not cover."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.dates import Period

BROADCAST_ROWS = 100_000


def join_by(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same name, where NULL is a key like any other."""
    theirs = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(theirs, reduce(and_, same), how).drop(*[f"_r_{k}" for k in keys])


def left_join_sparse(left: DataFrame, right: DataFrame, left_key: str, right_key: str, slots: int | None = None) -> DataFrame:
    """Left join on a text key that is often NULL on the left.

    NULL matches nothing, so those rows may go anywhere: stand-in keys, which no code
    begins like, spread them over `slots` tasks instead of the one of hash(NULL); four for each
    shuffle partition unless given.
    """
    slots = slots or 4 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mark = "\x00"
    slot = F.pmod(F.xxhash64(*left.columns), F.lit(slots)).cast("string")
    spread = F.coalesce(F.col(left_key), F.concat(F.lit(mark), slot))
    codes = right.where(~F.col(right_key).startswith(mark))
    return left.withColumn("_key", spread).join(codes, F.col("_key") == F.col(right_key), "left").drop("_key")


def tag_periods(df: DataFrame, day: str, periods: list[Period]) -> DataFrame:
    """Each row once per period that holds its day, with `period_ord` and `period`.

    A period is listed under every calendar month it touches, which turns the range
    join into a hash join on the month with a range test behind it.
    """
    listed = []
    for n, p in enumerate(periods, 1):
        month = p.start.replace(day=1)
        while month <= p.end:
            listed.append((month, n, p.label, p.start, p.end))
            month = month.replace(year=month.year + month.month // 12, month=month.month % 12 + 1)
    schema = "_month date, period_ord int, period string, _start date, _end date"
    months = df.sparkSession.createDataFrame(listed, schema)
    if len(listed) <= BROADCAST_ROWS:
        months = F.broadcast(months)
    inside = F.col(day).between(F.col("_start"), F.col("_end"))
    return (
        df.withColumn("_m", F.trunc(day, "MM"))
        .join(months, (F.col("_m") == F.col("_month")) & inside)
        .drop("_m", "_month", "_start", "_end")
    )
