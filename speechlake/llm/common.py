"""What the operators here share: tables in the shared folder, measured broadcasts, Arrow batches."""

import atexit
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechlake.session import hadoop_path, scratch_path

_WRITTEN: list[tuple[SparkSession, str]] = []


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared scratch folder, deleted when the driver's Python ends."""
    path = scratch_path(spark, name)
    _WRITTEN.append((spark, path))
    return path


def written(df: DataFrame, name: str, group_rows: int | None = None) -> DataFrame:
    """``df`` as a parquet table in the shared folder: computed once, and it outlives executors.

    ``group_rows`` bounds the row groups where rows are large.
    """
    path = scratch(df.sparkSession, name)
    writer = df.write if group_rows is None else df.write.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def _clean() -> None:
    for spark, path in _WRITTEN:
        try:
            system, target = hadoop_path(spark, path)
            system.delete(target, True)
        except Exception:  # the session has ended; the folder's retention rule takes over
            return


def broadcast_within(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows; beyond that the join shuffles.

    ``df`` should be narrow and cheap or already written: it is counted first.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def batches_of(rows: Callable[[pa.RecordBatch], dict | None], schema: pa.Schema):
    """A function for ``mapInArrow``: ``rows`` turns one batch into columns by name, or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = rows(batch) if batch.num_rows else None
            if columns is not None:
                arrays = [pa.array(columns[field.name], field.type) for field in schema]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text, one at a time; null counts as empty."""
    view = column.cast(pa.large_binary())
    for value in view:
        yield value.as_py() or b""
