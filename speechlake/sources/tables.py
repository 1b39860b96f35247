"""The utterance lake, test sets, submissions, statistics and named datasets."""

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from speechlake.operators.audio import to_binary
from speechlake.operators.join import join_audio
from speechlake.operators.project import drop_unlabeled, to_submission
from speechlake.schemas import CLIP_KEY, LAKE_COLUMNS, LAKE_PARTITIONS, LANGUAGE_STATS, SUBMISSION, UTTERANCE
from speechlake.session import hadoop_path
from speechlake.sources.catalogue import file_types, update_catalogue
from speechlake.sources.compaction import hidden
from speechlake.sources.corpora import archive_listing, read_archives, read_manifest
from speechlake.sources.files import metadata_path

# Fixed values of the lake layout, and the storage and task modes a dataset can be opened in.
ROW_GROUP_ROWS = 100
MAX_ROWS_PER_FILE = 100_000
LINE_BREAK = "\r\n|[\n\r]"
STORAGE_MODES = ["MANIFEST", "MIXTURE_PARQUET"]
TASK_MODES = ["ASR"]


def has_data(spark: SparkSession, root: str) -> bool:
    """Whether a lake holds a committed file; what a write that died left behind does not count."""
    system, path = hadoop_path(spark, f"{root.rstrip('/')}/corpus=*/split=*/language=*/*.parquet")
    return bool(system.globStatus(path))


def read_typed(
    spark: SparkSession, root: str, columns: dict[str, str | None], pattern: str = "*.parquet", partitions: dict[str, str] | None = None,
    extra: dict[str, Column] | None = None, skip: Column | None = None, within: str = "",
) -> DataFrame:
    """``columns`` (name: type) of all readable parquet files below ``root``, in whatever type each file has them.

    Files of equal types are one scan; values are cast, and what a type can't hold is NULL, as is a column that a file
    lacks. Type None takes the type of the files, or fails if they differ. Files without a readable footer are left out
    with a warning (``unreadable_files`` lists them); an error further inside a file fails the read. ``skip`` is a condition
    on the ``path`` of files to leave out, ``within`` a pattern of folders below ``root``: no others are listed or opened.
    """
    names, partitions = list(columns), partitions or {}
    files = file_types(spark, root, names, pattern, within)
    kinds = (
        (files if skip is None else files.filter(~skip))
        .groupBy("types", F.col("error").isNotNull().alias("broken"))
        .agg(F.collect_list("path").alias("paths"))
        .collect()
    )
    broken = sum(len(row.paths) for row in kinds if row.broken)
    if broken:
        warnings.warn(f"{broken} unreadable files below {root}", stacklevel=3)
    good = [row for row in kinds if not row.broken] or [Row(types=[columns[n] or "binary" for n in names], paths=[])]
    wanted = {n: columns[n] or _one_type(n, {row.types[i] for row in good if row.types[i]}) for i, n in enumerate(names)}
    reader = spark.read.option("pathGlobFilter", pattern)
    reader = reader.option("basePath", root) if partitions else reader.option("recursiveFileLookup", "true")

    def scan(row: Row) -> DataFrame:
        # Of a struct only the wanted fields are read.
        found = {n: wanted[n] if wanted[n].startswith("struct<") else t for n, t in zip(names, row.types) if t}
        rows = reader.schema(", ".join(f"`{n}` {t}" for n, t in {**found, **partitions}.items()))
        rows = rows.parquet(*row.paths) if len(kinds) > 1 or skip is not None else rows.parquet(f"{root.rstrip('/')}/{within}" if within else root)
        rows = rows.select(*found, *partitions, *[c.alias(n) for n, c in (extra or {}).items()])
        for n, t in found.items():
            if (t, wanted[n]) == ("array<tinyint>", "binary"):
                rows = to_binary(rows, n)
            elif t != wanted[n]:
                rows = rows.withColumn(n, F.col(n).try_cast(wanted[n]))
        absent = {n: F.lit(None).cast(wanted[n]) for n in names if n not in found}
        return rows.withColumns(absent).select(*names, *partitions, *(extra or {}))

    return reduce(DataFrame.unionByName, map(scan, good))


def _one_type(name: str, types: set[str]) -> str:
    if types <= {"binary", "array<tinyint>"}:
        return types.pop() if len(types) == 1 else "binary"
    if len(types) > 1:
        raise ValueError(f"column {name} is stored as {sorted(types)}")
    return types.pop()


def unreadable_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """``path`` and ``error`` of the parquet files below ``root`` that have no readable footer."""
    return file_types(spark, root, [], pattern).filter(F.col("error").isNotNull()).select("path", "error")


def read_lake(spark: SparkSession, root: str, columns: list[str] = LAKE_COLUMNS) -> DataFrame:
    """Utterances with only the named columns read, over files of all types; see ``read_typed``.

    ``audio_bytes`` keeps the type it was written in (binary or array<tinyint>); if files differ in it, all is binary.
    """
    types = {f.name: f.dataType.simpleString() for f in UTTERANCE} | {"audio_bytes": None}
    partitions = {c: types[c] for c in LAKE_PARTITIONS}
    return read_typed(spark, root, {c: types[c] for c in columns if c not in partitions}, partitions=partitions, skip=hidden(spark, root)).select(*columns)


def write_lake(df: DataFrame, root: str, mode: str = "append", spread: bool = True) -> None:
    """Append utterances under ``corpus=/split=/language=``, with their ``clip_key`` if they have one.

    The rebalance hint gathers each partition into few files and lets the runtime split a partition that is much
    larger than the others, so one language may hold most rows. Without ``spread`` the rows are written where they are:
    for tasks that hold large rows of few partitions each. The new files get their entries in the lake's catalogue.
    """
    rows = df.select(*LAKE_COLUMNS, *[c for c in df.columns if c == CLIP_KEY])
    if spread:
        rows = rows.hint("rebalance", *[F.col(c) for c in LAKE_PARTITIONS])
    (
        rows.write.mode(mode)
        .option("parquet.block.row.count.limit", ROW_GROUP_ROWS)
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .partitionBy(*LAKE_PARTITIONS)
        .parquet(root)
    )
    update_catalogue(df.sparkSession, root)


def landed_keys(spark: SparkSession, root: str, corpus: str, language: str) -> DataFrame:
    """``clip_key`` of the clips of one source that are in the lake; only that column of its own folders is read."""
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    within = f"corpus={escaped(corpus)}/split=*/language={escaped(language)}"
    system, path = hadoop_path(spark, f"{root.rstrip('/')}/{within}/*.parquet")
    if not system.globStatus(path):
        return spark.createDataFrame([], f"{CLIP_KEY} string")
    types = {f.name: f.dataType.simpleString() for f in UTTERANCE}
    rows = read_typed(
        spark, root, {CLIP_KEY: "string"}, partitions={c: types[c] for c in LAKE_PARTITIONS}, skip=hidden(spark, root), within=within
    )
    return rows.filter(F.col(CLIP_KEY).isNotNull()).select(CLIP_KEY).distinct()


def quarantine_new(lost: DataFrame, path: str) -> None:
    """Append lost clips (``clip_key``, ``error`` and more) that the quarantine does not tell yet."""
    spark = lost.sparkSession
    system, target = hadoop_path(spark, path)
    if system.exists(target):
        told = spark.read.schema(lost.schema).parquet(path).select(CLIP_KEY, "error").distinct()
        lost = lost.join(told, [CLIP_KEY, "error"], "left_anti").select(*lost.columns)
    lost.write.mode("append").parquet(path)


def write_stats(stats: DataFrame, path: str) -> None:
    """Language statistics as one TSV with header; always replaced, so it never lags behind the lake."""
    # One row per (corpus, language): small enough for one file.
    stats.select(*LANGUAGE_STATS.names).coalesce(1).write.mode("overwrite").option("sep", "\t").option(
        "header", True
    ).csv(path)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANGUAGE_STATS).option("sep", "\t").option("header", True).csv(path)


_CSV = {"header": "true", "quote": '"', "escape": '"'}


def write_submission(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with header and exactly the submission columns; ``files=1`` for a single part file."""
    rows = to_submission(df)
    rows = rows.coalesce(files) if files else rows
    rows.write.mode("overwrite").options(
        **_CSV, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text: ``NA`` and ``null`` stay texts and ids keep their zeros; empty cells are NULL."""
    return spark.read.schema(SUBMISSION).options(**_CSV, multiLine="true", nullValue="").csv(path)


def _place() -> dict[str, Column]:
    return {"file": metadata_path(), "row": F.col("_metadata.row_index")}


def read_testset(spark: SparkSession, root: str, pattern: str = "test_*.parquet") -> DataFrame:
    """Test clips of all matching files below ``root`` with their place in the source (``file``, ``row``).

    Ids of any type become text.
    """
    clips = read_typed(spark, root, {"id": "string", "language": "string", "audio": "struct<bytes:binary>"}, pattern, extra=_place())
    return clips.select("id", "language", F.col("audio.bytes").alias("audio_bytes"), "file", "row")


def read_ids(spark: SparkSession, root: str, pattern: str = "test_*.parquet") -> DataFrame:
    """Ids and languages only, in source order columns; files that can't be read are left out (``unreadable_files``)."""
    return read_typed(spark, root, {"id": "string", "language": "string"}, pattern, extra=_place())


def write_transcripts(pairs: DataFrame, path: str, key: str = "utt_id") -> None:
    """References and hypotheses as two sets of text files with equal line order, and the pairs as parquet.

    The pairs are written once, sorted within each file; both texts are read from there. A line break inside a text
    becomes a space, so that lines stay paired; all else stays as it is.
    """
    spark = pairs.sparkSession
    pairs.select(key, "ref", "hyp").sortWithinPartitions(key).write.mode("overwrite").parquet(f"{path}/pairs")
    written = spark.read.parquet(f"{path}/pairs")
    for side in ("ref", "hyp"):
        text = F.regexp_replace(F.coalesce(side, F.lit("")), LINE_BREAK, " ")
        written.select(text.alias("value")).write.mode("overwrite").text(f"{path}/{side}")


def register_dataset(spark: SparkSession, name: str, root: str) -> None:
    """Give a lake a name in the session catalog."""
    spark.catalog.createTable(name, path=root, source="parquet", schema=UTTERANCE)


def open_dataset(
    spark: SparkSession, name: str, storage_mode: str = "MIXTURE_PARQUET", task_mode: str = "ASR",
) -> DataFrame:
    """A registered lake (MIXTURE_PARQUET) or the manifest files below the path ``name`` (MANIFEST)."""
    if storage_mode not in STORAGE_MODES or task_mode not in TASK_MODES:
        supported = [(s, t) for s in STORAGE_MODES for t in TASK_MODES]
        raise ValueError(f"unsupported combination {(storage_mode, task_mode)}; supported: {supported}")
    if storage_mode == "MIXTURE_PARQUET":
        about = spark.sql(f"describe formatted {name}").filter("col_name = 'Location'").first()
        return read_lake(spark, about.data_type)
    return open_manifests(spark, name)


def open_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Labeled lines of the manifests below ``root`` beside the bytes of their archive member (``raw``)."""
    good = read_manifest(spark, root).filter("error is null").drop("error")
    labeled = drop_unlabeled(good)
    return join_audio(labeled, read_archives(archive_listing(spark, root), labeled))
