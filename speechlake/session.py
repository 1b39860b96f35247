"""Session defaults and the shared scratch folder."""

import atexit
import tempfile
import uuid
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# The partition values of the lake are codes ("swa", "train"); never read them as numbers.
# Clips are large rows: Arrow batches that go to Python workers are bounded by bytes.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SESSION_CONF.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "speechlake") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use ``configure`` on the given session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="speechlake-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_scratch()


_GIVEN: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared scratch folder; what is written there goes when the driver's Python ends."""
    path = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _GIVEN.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _GIVEN:
        try:
            system, target = hadoop_path(spark, path)
            system.delete(target, True)
        except Exception:  # the session is gone already
            return


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the storage that holds ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table in the shared scratch folder, for as long as the driver lives."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str = "stage", group_rows: int | None = None):
    """Write ``df`` once as parquet in the shared folder and read it back.

    For expensive rows (decoded audio) that several outputs need; survives the loss of executors. ``group_rows`` bounds
    the row groups, and so the memory of a writer, where rows are large.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write if group_rows is None else df.write.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        fs, target = hadoop_path(spark, path)
        fs.delete(target, True)


def local_copy(report: DataFrame) -> DataFrame:
    """A report of a few rows, kept after the tables it came from are gone."""
    return report.sparkSession.createDataFrame(report.toArrow(), schema=report.schema)
