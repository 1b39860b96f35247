"""Column types of parquet files, from their footers, and a catalogue of them that only new files are added to.

A catalogue is a folder beside a table with an entry per file, known by path, length and time, so an entry never speaks of
another file than the one it was read from. Files without an entry are opened by whoever reads; jobs that write the
table add entries. Every addition has a folder of its own: several jobs may add at a time, and one that dies adds nothing.
"""

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechlake.session import hadoop_path
from speechlake.sources.files import list_files, open_file

CATALOGUE = "_catalogue"  # below a table; readers of the table pass over it
_FILE = ["path", "length", "modified"]
_ENTRY = "path string, length bigint, modified timestamp, types map<string,string>, error string"
_NO_TYPE = "no type: "  # stands before the reason why a column has no type here


def read_footer(path: str) -> dict[str, str]:
    """Type of each column of a parquet file."""
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type

    def kind(field: pa.Field) -> str:
        try:
            return from_arrow_type(field.type).simpleString()
        except Exception as error:  # told to those who ask for the column
            return f"{_NO_TYPE}{type(error).__name__}: {error}"

    with open_file(path) as file:
        return {field.name: kind(field) for field in pq.read_schema(file)}


def _footers(files: DataFrame) -> DataFrame:
    """Entries of files, which are opened in tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            types, errors = [], []
            for path in batch.column(0).to_pylist():
                try:
                    types.append(list(read_footer(path).items()))
                    errors.append(None)
                except Exception as error:  # told as a row
                    types.append(None)
                    errors.append(f"{type(error).__name__}: {error}")
            columns = [*batch.columns, pa.array(types, pa.map_(pa.string(), pa.string())), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*_FILE, "types", "error"])

    return files.select(*_FILE).mapInArrow(run, _ENTRY)


def _entries(spark: SparkSession, root: str) -> DataFrame | None:
    system, path = hadoop_path(spark, f"{root.rstrip('/')}/{CATALOGUE}")
    if not system.exists(path):
        return None
    added = spark.read.schema(_ENTRY).option("recursiveFileLookup", "true").parquet(path.toString())
    return added.groupBy(*_FILE).agg(F.first(F.struct("types", "error")).alias("one")).select(*_FILE, "one.*")


def file_types(spark: SparkSession, root: str, columns: list[str], pattern: str = "*.parquet", within: str = "") -> DataFrame:
    """``path``, ``types`` (per column its type in the file, NULL if absent) and ``error`` of parquet files.

    Files of one table may hold a column in different types, which one scan can't read. Footers are read in tasks, and only
    those of files that the catalogue below ``root`` does not know. ``within`` is a folder (or pattern of folders) of it.
    """
    files = list_files(spark, f"{root.rstrip('/')}/{within}" if within else root, pattern)
    known = _entries(spark, root)
    if known is None:
        entries = _footers(files)
    else:
        entries = files.join(known, _FILE).unionByName(_footers(files.join(known, _FILE, "left_anti")))
    types = F.array(*[F.col("types")[c] for c in columns]).cast("array<string>")
    reason = F.filter("asked", lambda t: t.startswith(_NO_TYPE))
    found = entries.select("path", types.alias("asked"), "error").withColumn("error", F.coalesce("error", F.get(reason, F.lit(0))))
    return found.select("path", F.when(F.col("error").isNull(), F.col("asked")).alias("types"), "error")


def update_catalogue(spark: SparkSession, root: str, pattern: str = "*.parquet") -> None:
    """Add entries of the files below ``root`` that have none yet; only those are opened."""
    root = root.rstrip("/")
    files, known = list_files(spark, root, pattern), _entries(spark, root)
    fresh = files if known is None else files.join(known, _FILE, "left_anti")
    if not fresh.isEmpty():
        _footers(fresh).hint("rebalance").write.parquet(f"{root}/{CATALOGUE}/{uuid.uuid4().hex}")


def merge_catalogue(spark: SparkSession, root: str) -> None:
    """One addition in place of all present ones, without entries of files that are gone.

    Readers may see entries twice meanwhile, which changes nothing; a run that dies leaves more of them.
    """
    root = root.rstrip("/")
    known = _entries(spark, root)
    if known is None:
        return
    system, path = hadoop_path(spark, f"{root}/{CATALOGUE}")
    old = [status.getPath() for status in system.listStatus(path)]
    there = list_files(spark, root, "*.parquet").select(*_FILE)
    known.join(there, _FILE, "left_semi").hint("rebalance").write.parquet(f"{root}/{CATALOGUE}/{uuid.uuid4().hex}")
    for folder in old:
        system.delete(folder, True)
