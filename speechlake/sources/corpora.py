"""Source corpora: shard listings, manifests, archives and clip tables."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from speechlake.functions.text import basename, shard_index, strip
from speechlake.schemas import CLIP, MANIFEST_LINE
from speechlake.sources.archives import read_archives  # noqa: F401 (a corpus source like the others)
from speechlake.sources.files import folder, metadata_path, plain_path


def list_shards(
    spark: SparkSession, root: str, prefix: str = "manifest_", folders: list[str] | None = None, max_shards: int = 0,
    per_folder: bool = False,
) -> DataFrame:
    """Files under ``root`` whose name starts with ``prefix``: ``path``, ``length`` and ``folder``, sorted.

    Order is that of ``folders`` (all folders if none are given), then the path as text, so 10 comes before 2.
    ``max_shards`` counts over all folders, or within each one under ``per_folder``; 0 is no limit.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"{prefix}*")
        .load(root)
        .select("path", "length")
        .withColumn("folder", basename(folder("path")))
    )
    return first_paths(files, folders, max_shards, per_folder)


def first_paths(
    files: DataFrame, folders: list[str] | None = None, max_shards: int = 0, per_folder: bool = False
) -> DataFrame:
    """The ordering and the limit of ``list_shards`` on a listing."""
    order = [F.col("path")]
    if folders:
        files = files.filter(F.col("folder").isin(folders))
        order = [F.array_position(F.array(*[F.lit(f) for f in folders]), F.col("folder")), *order]
    if max_shards and per_folder:
        inside = Window.partitionBy("folder").orderBy("path")
        files = files.withColumn("_n", F.row_number().over(inside)).filter(F.col("_n") <= max_shards).drop("_n")
    ordered = files.orderBy(*order)
    return ordered.limit(max_shards) if max_shards and not per_folder else ordered


def parse_manifest(lines: DataFrame) -> DataFrame:
    """JSON lines (``value``, ``path`` and their position) -> manifest rows; a broken line gets an ``error``."""
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    parsed = F.from_json("value", MANIFEST_LINE, options).alias("_line")
    return (
        lines.filter(strip("value") != "")
        .select("path", "line_block", "line_id", parsed)
        .select(
            plain_path("path").alias("path"),
            F.concat_ws("/", folder(plain_path("path")), shard_index(basename("path"))).alias("shard"),
            "line_block",
            "line_id",
            F.col("_line.audio_filepath").alias("member"),
            F.col("_line.transcription").alias("transcription"),
            F.col("_line.locale").alias("locale"),
            F.when(F.col("_line._corrupt").isNotNull(), F.concat(F.lit("manifest: "), F.col("_line._corrupt"))).alias("error"),
        )
    )


def manifest_lines(text: DataFrame, line_id: Column | None = None) -> DataFrame:
    """Name the file and the place of each line of a text scan.

    Large manifests are read in splits: ``line_block`` is the start of the split in the file, ``line_id`` rises with
    the lines of a split. Together they give manifest order. A stream has no line numbers and passes another column.
    """
    return text.select(
        "value",
        metadata_path().alias("path"),
        F.col("_metadata.file_block_start").alias("line_block"),
        (F.monotonically_increasing_id() if line_id is None else line_id).alias("line_id"),
    )


def read_manifest(spark: SparkSession, paths: str | list[str], pattern: str = "manifest_*") -> DataFrame:
    """Manifest rows of JSON-lines files or of the folders that hold them; blank lines are skipped."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return parse_manifest(manifest_lines(reader.text(paths)))


def archive_listing(spark: SparkSession, root: str, pattern: str = "audio_*.tar*") -> DataFrame:
    """``path``, ``length`` and ``shard`` of the archives one folder below their manifest."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "length")
    )
    index = shard_index(basename("path"), "audio_")
    return files.withColumn("shard", F.concat_ws("/", folder(plain_path("path"), 2), index))


def missing_archives(archives: DataFrame, labeled: DataFrame) -> DataFrame:
    """Shards that have labeled lines but no archive, as error rows."""
    lost = labeled.select("shard").distinct().join(archives.select("shard"), "shard", "left_anti")
    return lost.select("shard", F.lit(None).cast("string").alias("member"), F.lit("archive: missing").alias("error"))


def read_clips(spark: SparkSession, root: str, split: str) -> DataFrame:
    """Clip table of one split folder, audio as it is, with a unique ``clip_key`` and its place in the source."""
    return (
        spark.read.schema(CLIP)
        .parquet(f"{root.rstrip('/')}/{split}")
        .select(
            "*",
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.row_index").alias("row"),
            F.concat_ws("#", F.col("_metadata.file_name"), F.col("_metadata.row_index")).alias("clip_key"),
        )
    )
