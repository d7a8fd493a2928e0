"""Look-up of intervals by key and point: one row per key, searched by bisection."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ebbtide.functions.binding import let


def interval_index(bands: DataFrame, keys: Sequence[str], low: str, high: str, keep: Sequence[str]) -> DataFrame:
    """One row per key with `_bands`: its intervals by lower end, each with the highest upper end so far.

    Both ends belong to an interval; one with a NULL or crossed end holds no point and is left out.
    A row holds all intervals of its key, some 30 bytes each.
    """
    so_far = W.partitionBy(*keys).orderBy(low, high).rowsBetween(W.unboundedPreceding, 0)
    held = bands.where(F.col(low) <= F.col(high)).withColumn("_reach", F.max(high).over(so_far))
    band = F.struct(F.col(low).alias("low"), F.col(high).alias("high"), F.col("_reach").alias("reach"), F.struct(*keep).alias("row"))
    return held.groupBy(*keys).agg(F.array_sort(F.collect_list(band)).alias("_bands"))


def leading(items: Column, holds: Callable[[Column], Column]) -> Column:
    """How many items at the front of an array satisfy a test that fails for good once it fails.

    Bisection: the count is put together from powers of two, the largest first.
    """
    size = F.size(items)
    powers = F.sequence(F.floor(F.log2(F.greatest(size, F.lit(1)))).cast("int"), F.lit(0), F.lit(-1))

    def longer(count: Column, power: Column) -> Column:
        more = count + F.pow(F.lit(2), power).cast("int")
        return F.when((more <= size) & holds(F.get(items, more - 1)), more).otherwise(count)

    return F.aggregate(powers, F.lit(0), longer)


def holding(bands: Column, point: Column) -> Column:
    """The rows of an index's intervals that hold the point; NULL or empty if there is none.

    Intervals that begin beyond the point end the search, those before the first that reaches it
    begin it; only what lies between is tested one by one.
    """

    def between(ends: Column) -> Column:
        first, last = F.get(ends, F.lit(0)), F.get(ends, F.lit(1))
        near = F.slice(bands, first + 1, F.greatest(last - first, F.lit(0)))
        return F.transform(F.filter(near, lambda b: b["high"] >= point), lambda b: b["row"])

    begun = leading(bands, lambda b: b["low"] <= point)
    passed = leading(bands, lambda b: b["reach"] < point)
    return let(F.array(passed, begun), between)


def left_join_holding(
    rows: DataFrame, bands: DataFrame, keys: Sequence[str], point: Column, low: str, high: str, keep: Sequence[str]
) -> DataFrame:
    """Left join of the intervals with equal keys that hold a point of the row.

    The join is on the keys and finds one row at most, so a key with many intervals multiplies
    nothing; a row comes once for each interval that holds its point, and once if none does.
    """
    index = interval_index(bands, keys, low, high, keep).select(*[F.col(k).alias(f"_i_{k}") for k in keys], "_bands")
    same = [F.col(k) == F.col(f"_i_{k}") for k in keys]
    joined = rows.join(index, same, "left")
    found = joined.select(*rows.columns, F.explode_outer(holding(F.col("_bands"), point)).alias("_row"))
    return found.select(*rows.columns, *[F.col(f"_row.{c}").alias(c) for c in keep])
