"""The latest row of a group, and the last rows of a group."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], by: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per key: the one that is highest by `by`.

    A single aggregation, combined before the shuffle: a key with very many rows
    sends one row per task.
    """
    row = F.max_by(F.struct(*keep), F.struct(*by) if len(by) > 1 else F.col(by[0]))
    return df.groupBy(*keys).agg(row.alias("_row")).select(*keys, "_row.*")


def last_n(df: DataFrame, group: str, seq: str, n: int, slots: int | None = None) -> DataFrame:
    """Rows with the `n` highest numbers of each group, NULL being a group of its own.

    A group is dealt by row hash into `slots` (as many as shuffle partitions unless given); the
    last n of each slot are found first, then the last n of these, so no task has more of a group
    than a slot's share, or n rows of each slot. Rows that share a number beyond n are settled by
    their hash; rows without a number come last.
    """
    slots = slots or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns)).withColumn("_slot", F.pmod("_hash", F.lit(slots)))
    order = [F.col(seq).cast("bigint").desc_nulls_last(), F.col("_hash")]
    for keys in ([group, "_slot"], [group]):
        hashed = hashed.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= n)
    return hashed.select(*df.columns)
