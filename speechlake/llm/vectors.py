"""Vector tables for the searches: which rows take part, and blocks of vectors for NumPy in tasks."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = "ids binary, vectors binary, extra binary"


def usable(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int, str]:
    """``id`` and ``v`` of the rows that take part, their length, and their NumPy type.

    Vectors that are null or hold null or non-finite components, and null keys, take no part. Vectors have to be of one
    length: that of most rows (the larger of two that are as frequent). Of rows with one key the least vector counts.
    """
    kind = np.float32 if isinstance(df.schema[vector].dataType.elementType, T.FloatType) else np.float64
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(F.col("id").isNotNull())
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = rows.filter(F.coalesce(finite, F.lit(False)))
    most = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    length = most["n"] if most else 0
    same = rows.filter(F.size("v") == length).groupBy("id").agg(F.min("v").alias("v"))
    wide = "array<float>" if kind == np.float32 else "array<double>"
    return same.select("id", F.col("v").cast(wide).alias("v")), length, np.dtype(kind).str


def matrix(column: pa.ChunkedArray | pa.Array, length: int, kind: str) -> np.ndarray:
    """The rows of a list column as one matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), length)


def to_block(ids: np.ndarray, vectors: np.ndarray, extra: np.ndarray) -> list[bytes]:
    return [ids.astype(np.int64).tobytes(), np.ascontiguousarray(vectors).tobytes(), extra.astype(np.int64).tobytes()]


def from_block(ids, vectors, extra, length: int, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids.as_py(), np.int64)
    return ids, np.frombuffer(vectors.as_py(), kind).reshape(len(ids), length), np.frombuffer(extra.as_py(), np.int64)


def packed(df: DataFrame, by: list[str], length: int, kind: str, extra: str | None = None) -> DataFrame:
    """One row per value of ``by`` (bounded groups) with its ids, vectors and numbers ``extra``, sorted by extra, id."""

    def run(group: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        more = table.column(extra).to_numpy() if extra else ids
        order = np.lexsort((ids, more))
        block = to_block(ids[order], matrix(table.column("v"), length, kind)[order], more[order])
        return pa.table([*[pa.array([g.as_py()], g.type) for g in group], *[pa.array([b], pa.binary()) for b in block]], names=[*by, *BLOCK_NAMES])

    keys = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in by)
    return df.groupBy(*by).applyInArrow(run, f"{keys}, {BLOCK}")


BLOCK_NAMES = ["ids", "vectors", "extra"]


def best(found: DataFrame, k: int, kind: str) -> DataFrame:
    """The ``k`` best of each query from (``query_id``, ``vec_id``, ``score``), ties to the smaller id, as ranks from 1."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.select("query_id", "rank", "vec_id", F.col("score").cast(kind).alias("score"))


def top_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]
