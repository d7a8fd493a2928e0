"""Arrow batches in slices of bounded size, and frames written for more than one use."""

import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.lineage import checkpoint_dir

# What one slice of a batch holds: rows, and bytes unless a single row has more.
SLICE_ROWS, SLICE_BYTES = 2048, 1 << 20


def slices(batches: Iterable[pa.RecordBatch], by: str) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that column `by` holds about SLICE_BYTES in each."""
    for batch in batches:
        sizes = batch.column(batch.schema.get_field_index(by)).cast(pa.large_binary())
        start = held = 0
        for i, value in enumerate(sizes):
            held += len(value.as_buffer()) if value.is_valid else 0
            if held >= SLICE_BYTES or i + 1 - start >= SLICE_ROWS:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def mapped(df: DataFrame, schema: str, by: str, each: Callable[[pa.RecordBatch], dict | None]) -> DataFrame:
    """`each` over slices; it returns columns by name, or None for no rows."""
    target = pa_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, by):
            columns = each(part)
            if columns is not None:
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in target], schema=target)

    importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def importable(spark: SparkSession) -> None:
    """Lets Python workers on the driver's machine find this package where the driver found it.

    On a cluster it is installed, or on the PYTHONPATH of the executors.
    """
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def pa_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


# The lists of tables that `passing` has open, in each thread.
_OPEN = threading.local()


@contextmanager
def passing(spark: SparkSession) -> Iterator[list[str]]:
    """Tables that `written` makes inside, by this thread, are removed at the end.

    Their paths are in the list; one that is taken out of it stays.
    """
    made: list[str] = []
    outer = getattr(_OPEN, "made", None)
    _OPEN.made = made
    try:
        yield made
    finally:
        _OPEN.made = outer
        remove(spark, made)


def remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame) -> DataFrame:
    """The rows from a Parquet copy in the shared checkpoint folder.

    Computed once however often they are used, safe from lost executors, and with a size
    that the optimizer knows. The copy stays there, unless `passing` is open.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    made = getattr(_OPEN, "made", None)
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(id_col: str = "doc_id", text: str = "text") -> list[Column]:
    """Two columns that tell rows apart by content, also when the id is null.

    Rows equal in both are copies of one row, for which every operator here has one result.
    """
    return [
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("_id"),
        F.xxhash64(F.col(id_col).isNull(), F.col(text)).alias("_row"),
    ]


def keyed(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The row key, and all columns of `docs` in `_all`, where no name of theirs can clash."""
    return docs.select(*row_key(id_col, text), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all"))
