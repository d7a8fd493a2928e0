"""Where and how often work is cut: lineage and partitions."""

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Name of the setting that `spread` follows.
SPREAD = "spark.ebbtide.spread"


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir.

    Where none is set it is a folder in the warehouse, if all executors share that: on one machine,
    or where it is no local folder. Otherwise there is no place for it, which is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        warehouse = spark.conf.get("spark.sql.warehouse.dir", "")
        local_folder = "://" not in warehouse or warehouse.startswith("file:")
        if folder is None and local_folder and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir: the warehouse is a local folder, which executors do not share")
        context.setCheckpointDir(folder or f"{warehouse}/_checkpoints")
    return context.getCheckpointDir()


def importable(spark: SparkSession) -> None:
    """Lets Python workers on the driver's machine find this package where the driver found it.

    On a cluster it is installed, or on the PYTHONPATH of the executors.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder: computed once, safe from lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Rows over as many partitions as the session's spark.ebbtide.spread says; unset, as they are.

    For a caller with costly work per row on a single small file.
    """
    partitions = df.sparkSession.conf.get(SPREAD, None)
    return df.repartition(int(partitions)) if partitions else df
