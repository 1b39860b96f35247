"""Compaction of a lake's small files, with a ledger that tells readers which files count.

New files lie beside the old ones under a name with the run's id. They count once the ledger names the run, and from then
on the old files that its entry lists do not, whether or not they are deleted yet. A run that dies before that leaves the
old files in force, one that dies later leaves the new ones; the next run cleans up. One compaction runs at a time; files
that others append meanwhile are not touched.
"""

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from speechlake.operators.ranking import small_side
from speechlake.schemas import LAKE_PARTITIONS
from speechlake.session import hadoop_path
from speechlake.sources.catalogue import merge_catalogue, update_catalogue
from speechlake.sources.files import list_files, metadata_path, open_file

MIN_ROWS_PER_FILE = 1000
LEDGER, WORK, PREFIX = "_compactions", "_compacting", "compact-"
_PLACE = "(" + "/".join(f"{c}=[^/]*" for c in LAKE_PARTITIONS) + "/[^/]+)$"  # of a file below the lake


def place(path: str | Column) -> Column:
    """The path of a file from its partition folders on."""
    return F.regexp_extract(F.col(path) if isinstance(path, str) else path, _PLACE, 1)


def _names(spark: SparkSession, folder: str) -> list[str]:
    system, path = hadoop_path(spark, folder)
    return sorted(status.getPath().getName() for status in system.listStatus(path)) if system.exists(path) else []


def _lines(spark: SparkSession, path: str) -> list[str]:
    return [row.value for row in spark.read.text(path).collect()]


def _runs(spark: SparkSession, root: str) -> tuple[set[str], set[str]]:
    """(runs that count, those of them whose old files may still be there)."""
    names = _names(spark, f"{root}/{LEDGER}")
    listed = {n.removesuffix(".txt") for n in names if n.endswith(".txt")}
    return listed | {n.removesuffix(".done") for n in names if n.endswith(".done")}, listed


def hidden(spark: SparkSession, root: str) -> Column | None:
    """Condition on ``path``: files that do not count now; None if the lake was never compacted."""
    root = root.rstrip("/")
    system, path = hadoop_path(spark, f"{root}/{LEDGER}")
    if not system.exists(path):
        return None
    counted, listed = _runs(spark, root)
    run = F.regexp_extract("path", f"/{PREFIX}([0-9a-f]{{32}})-[^/]*$", 1)
    gone = (run != "") & ~run.isin(sorted(counted))
    for one in sorted(listed):
        gone = gone | place("path").isin(_lines(spark, f"{root}/{LEDGER}/{one}.txt"))
    return gone


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """``path``, ``rows`` and ``kind`` (columns and types) of the lake's files that count, from their footers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for batch in batches:
            rows, kinds = [], []
            for path in batch.column(0).to_pylist():
                try:
                    with open_file(path) as file:
                        footer = pq.read_metadata(file)
                    rows.append(footer.num_rows)
                    kinds.append(str(footer.schema.to_arrow_schema().remove_metadata()))
                except Exception:  # unreadable files stay where they are; ``unreadable_files`` tells them
                    rows.append(None)
                    kinds.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.int64()), pa.array(kinds, pa.string())], names=["path", "rows", "kind"])

    files = list_files(spark, root, "*.parquet").filter(place("path") != "")
    gone = hidden(spark, root)
    files = files if gone is None else files.filter(~gone)
    return files.mapInArrow(run, "path string, rows bigint, kind string").filter("rows is not null")


def pack_files(files: list[tuple[str, int]], least: int) -> list[list[str]]:
    """Files (path, rows) in groups of ``least`` rows or more; one group if all have fewer, none for a single file."""
    groups, rows = [], least
    for path, n in files:
        if rows >= least:
            groups.append([])
            rows = 0
        groups[-1].append(path)
        rows += n
    if len(groups) > 1 and rows < least:
        last = groups.pop()
        groups[-1] += last
    return [group for group in groups if len(group) > 1]


def _wanted(sizes: DataFrame, least: int) -> DataFrame:
    """Small files, and of a partition whose small files are too few rows together its smallest other one."""
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    small = F.col("rows") < least
    sums = sizes.groupBy(folder, "kind").agg(
        F.count_if(small).alias("small"), F.sum(F.when(small, F.col("rows"))).alias("sum"), F.min(F.when(~small, F.struct("rows", "path"))).alias("other")
    )
    files = sizes.filter(small).select(folder, "kind", "path", "rows")
    more = sums.filter((F.col("small") > 0) & (F.col("sum") < least) & F.col("other").isNotNull()).select("folder", "kind", "other.path", "other.rows")
    return files.unionByName(more)


def compact_lake(spark: SparkSession, root: str, min_rows: int = MIN_ROWS_PER_FILE) -> int:
    """Rewrite files of fewer than ``min_rows`` rows into files of ``min_rows`` or more; returns how many files are gone.

    Files are packed within their partition and with files of the same columns and types. A partition that has fewer rows
    in all ends with one file of each kind. Only names and row counts of small files come to the driver, which renames
    and deletes as Spark's own commits do; rows go from file to file in one shuffle, a group to a task.
    """
    from speechlake.sources.tables import MAX_ROWS_PER_FILE, ROW_GROUP_ROWS

    root = root.rstrip("/")
    clean_up(spark, root)
    packed: dict[tuple, list[tuple[str, int]]] = {}
    for row in _wanted(file_sizes(spark, root), min_rows).collect():
        packed.setdefault((row.kind, row.folder), []).append((row.path, row.rows))
    kinds: dict[str, list[list[str]]] = {}
    rows_of = {path: n for files in packed.values() for path, n in files}
    for (kind, _), files in sorted(packed.items()):
        kinds.setdefault(kind, []).extend(pack_files(sorted(files), min_rows))
    kinds = {kind: groups for kind, groups in kinds.items() if groups}
    if not kinds:
        return 0
    run, work = uuid.uuid4().hex, f"{root}/{WORK}"
    for groups in kinds.values():
        paths = [path for group in groups for path in group]
        of = [(path, i) for i, group in enumerate(groups) for path in group]
        places = spark.createDataFrame(of, "path string, at int").select(place("path").alias("_place"), "at")
        rows = spark.read.option("basePath", root).parquet(*paths).withColumn("_place", place(metadata_path()))
        counted = Observation("compacted")
        moved = rows.join(small_side(places), "_place").drop("_place").observe(counted, F.count(F.lit(1)).alias("rows"))
        moved = moved.repartitionById(len(groups), F.col("at")).drop("at")
        moved.write.mode("append").option("parquet.block.row.count.limit", ROW_GROUP_ROWS).option("maxRecordsPerFile", MAX_ROWS_PER_FILE).partitionBy(*LAKE_PARTITIONS).parquet(work)
        if counted.get["rows"] != sum(rows_of[path] for path in paths):
            raise RuntimeError("the files changed while they were compacted")
    _move(spark, root, run)
    old = [path for groups in kinds.values() for group in groups for path in group]
    _commit(spark, root, run, old)
    clean_up(spark, root)
    update_catalogue(spark, root)
    merge_catalogue(spark, root)
    return len(old) - sum(map(len, kinds.values()))


def _move(spark: SparkSession, root: str, run: str) -> None:
    """New files beside the old ones; they do not count yet."""
    _ledger(spark, root)
    new = [row.path for row in list_files(spark, f"{root}/{WORK}", "*.parquet").select(place("path").alias("path")).collect()]
    for i, name in enumerate(sorted(new)):
        system, source = hadoop_path(spark, f"{root}/{WORK}/{name}")
        _, target = hadoop_path(spark, f"{root}/{name.rpartition('/')[0]}/{PREFIX}{run}-{i:05d}.parquet")
        if not system.rename(source, target):
            raise OSError(f"can't rename {source} to {target}")


def _ledger(spark: SparkSession, root: str) -> None:
    system, path = hadoop_path(spark, f"{root}/{LEDGER}")
    system.mkdirs(path)


def _commit(spark: SparkSession, root: str, run: str, old: list[str]) -> None:
    """From here on the run's files count, and the old ones do not: one rename."""
    names = reduce(lambda text, path: text + path + "\n", [row.p for row in spark.createDataFrame([(p,) for p in old], "path string").select(place("path").alias("p")).collect()], "")
    system, draft = hadoop_path(spark, f"{root}/{LEDGER}/{run}.draft")
    stream = system.create(draft, True)
    stream.write(bytearray(names.encode()))
    stream.close()
    if not system.rename(draft, hadoop_path(spark, f"{root}/{LEDGER}/{run}.txt")[1]):
        raise OSError(f"can't commit compaction {run}")


def clean_up(spark: SparkSession, root: str) -> None:
    """Finish runs that count, and remove what runs that died have left."""
    root = root.rstrip("/")
    counted, listed = _runs(spark, root)
    for run in sorted(listed):
        for name in _lines(spark, f"{root}/{LEDGER}/{run}.txt"):
            system, path = hadoop_path(spark, f"{root}/{name}")
            system.delete(path, False)
        system, done = hadoop_path(spark, f"{root}/{LEDGER}/{run}.done")
        system.create(done, True).close()
        system.delete(hadoop_path(spark, f"{root}/{LEDGER}/{run}.txt")[1], False)
    system, pattern = hadoop_path(spark, f"{root}/{'/'.join(f'{c}=*' for c in LAKE_PARTITIONS)}/{PREFIX}*.parquet")
    for status in system.globStatus(pattern) or []:
        if status.getPath().getName()[len(PREFIX) : len(PREFIX) + 32] not in counted:
            system.delete(status.getPath(), False)
    system.delete(hadoop_path(spark, f"{root}/{WORK}")[1], True)
