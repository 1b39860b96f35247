"""Open files inside tasks, by the paths that Spark lists."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _located(path: str):
    """(file system, path in it) of a local path or URI."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    return fs.FileSystem.from_uri(path)


def open_stream(path: str):
    """A forward-only stream on a local path or URI."""
    system, inner = _located(path)
    return system.open_input_stream(inner)


def open_file(path: str):
    """A seekable file on a local path or URI."""
    system, inner = _located(path)
    return system.open_input_file(inner)


def read_bytes(path: str) -> bytes:
    with open_stream(path) as stream:
        return stream.read()


def metadata_path(path: str | Column = "_metadata.file_path") -> Column:
    """The path of a file as the listings spell it; readers tell it URL-encoded in their metadata column."""
    path = F.col(path) if isinstance(path, str) else path
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def plain_path(path: str | Column) -> Column:
    """One spelling for ``file:/a``, ``file:///a`` and the like, to compare paths of different readers."""
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(path, r"^(\w+):/+", "$1:/")


def folder(path: str | Column, up: int = 1) -> Column:
    """The path without its last ``up`` parts."""
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(path, f"(/[^/]*){{{up}}}$", "")


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``path``, ``length`` and ``modified`` of all files below ``root`` that match; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return reader.load(root).select("path", "length", F.col("modificationTime").alias("modified"))
