"""Members of tar archives, read inside tasks.

A plain tar is indexed by its headers and read in ranges by several tasks; a compressed one can only be read forward, in
one task, once if the members that are wanted fit in HOLD_BYTES.
"""

import os
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechlake.functions.text import basename, shard_index
from speechlake.schemas import ARCHIVE_MEMBER
from speechlake.sources.files import folder, open_file, open_stream, plain_path

HOLD_BYTES = 64 << 20  # members of a compressed archive that wait for its end, where the last of each name is known
_FLUSH_BYTES = 32 << 20  # members are handed on in small batches, never an archive at once
_PART = pa.schema(
    [
        ("path", pa.string()),
        ("part", pa.int32()),
        ("names", pa.list_(pa.string())),
        ("members", pa.list_(pa.struct([("member", pa.string()), ("start", pa.int64()), ("size", pa.int64())]))),
        ("error", pa.string()),
    ]
)
_PART_TYPE = "path string, part int, names array<string>, members array<struct<member:string,start:bigint,size:bigint>>, error string"
_Row = tuple[str | None, bytes | None, str | None]


def _told(error: Exception) -> str:
    return f"archive: {type(error).__name__}: {error}"


def index_archive(path: str, wanted: set[str] | None) -> tuple[list[tuple[str, int, int]] | None, str | None]:
    """((member, start, size) of the wanted members of a plain tar (None: all), the last of each name; error).

    Only headers are read. An archive that is not a plain tar, or stores a wanted member in pieces, has no members (None).
    Members that a cut-off archive does not hold to their end are left out; its error tells of them.
    """
    last: dict[str, tuple[str, int, int]] = {}
    failure = None
    with open_file(path) as file:
        try:
            tar = tarfile.open(fileobj=file, mode="r:")
        except tarfile.ReadError:
            return None, None
        with tar:
            try:
                for member in tar:
                    tar.members = []  # the headers of a large archive are not kept
                    name = os.path.basename(member.name)
                    if member.isfile() and (wanted is None or name in wanted):
                        if member.issparse():
                            return None, None
                        last.pop(name, None)
                        last[name] = (name, member.offset_data, member.size)
            except Exception as error:  # a cut-off archive: what was listed so far is still good
                failure = _told(error)
        length = file.size()
    whole = [m for m in last.values() if m[1] + m[2] <= length]
    if len(whole) < len(last):
        failure = failure or "archive: ends inside a member"
    return whole, failure


def archive_parts(path: str, names: list[str] | None, part_bytes: int) -> Iterator[tuple]:
    """What tasks read of an archive, and its error: ranges of a plain tar, or all of another one."""
    try:
        members, error = index_archive(path, None if names is None else set(names))
    except Exception as failure:
        members, error = [], _told(failure)
    if members is None:
        yield path, 0, names, None, None
        return
    if error:
        yield path, -1, None, None, error
    part, held, size = 0, [], 0
    for member in members:
        held.append(member)
        size += member[2]
        if size >= part_bytes:
            yield path, part, None, held, None
            part, held, size = part + 1, [], 0
    if held:
        yield path, part, None, held, None


def range_rows(path: str, members: list[tuple[str, int, int]]) -> Iterator[_Row]:
    """(member, bytes, error) of indexed members."""
    try:
        with open_file(path) as file:
            for name, start, size in members:
                file.seek(start)
                raw = file.read(size)
                if len(raw) < size:
                    raise EOFError(f"{name} ends after {len(raw)} of {size} bytes")
                yield name, raw, None
    except Exception as error:
        yield None, None, _told(error)


def stream_rows(path: str, wanted: set[str] | None, hold: int = HOLD_BYTES) -> Iterator[_Row]:
    """(member, bytes, error) of the wanted members of one archive (None: all), the last of each name.

    The archive is read forward. Members wait for its end, up to ``hold`` bytes of them; what does not fit is taken in a
    second pass. Whatever ends either pass is a row, too.
    """
    last: dict[str, int] = {}
    held: dict[str, bytes] = {}
    size, failure = 0, None
    try:
        with open_stream(path) as stream, tarfile.open(fileobj=stream, mode="r|*") as tar:
            for i, member in enumerate(tar):
                tar.members = []
                name = os.path.basename(member.name)
                if member.isfile() and (wanted is None or name in wanted):
                    last[name] = i
                    size -= len(held.pop(name, b""))
                    if size + member.size <= hold:
                        held[name] = tar.extractfile(member).read()
                        size += member.size
    except Exception as error:  # a cut-off archive: what was listed so far is still good
        failure = _told(error)
    missing = {i for name, i in last.items() if name not in held}
    while held:
        name = next(iter(held))
        yield name, held.pop(name), None
    try:
        if missing:
            with open_stream(path) as stream, tarfile.open(fileobj=stream, mode="r|*") as tar:
                for i, member in enumerate(tar):
                    tar.members = []
                    if i in missing:
                        yield os.path.basename(member.name), tar.extractfile(member).read(), None
                        missing.discard(i)
                        if not missing:
                            break
    except Exception as error:
        failure = failure or _told(error)
    if failure or missing:
        yield None, None, failure or f"archive: {len(missing)} members lost between two reads"


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [[row[k] for row in rows] for k in range(len(schema))]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _part_bytes(spark: SparkSession) -> int:
    """The bytes that scans of this session read in a task."""
    return spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def list_parts(archives: DataFrame, labeled: DataFrame | None = None) -> DataFrame:
    """What each task has to read of the archives: ``path``, ``part``, ``names``, ``members`` and ``error``; dealt out."""
    part_bytes = _part_bytes(archives.sparkSession)
    if labeled is None:
        listed = archives.select("path", F.lit(None).cast("array<string>").alias("names"))
    else:
        names = labeled.groupBy("shard").agg(F.collect_set("member").alias("names"))
        listed = archives.join(names, "shard").select("path", "names")
    plain = F.col("path").endswith(".tar")
    parts = F.when(plain, F.ceil(F.col("length") / part_bytes)).otherwise(1)
    count, tasks = archives.agg(F.count("*"), F.sum(F.greatest(parts, F.lit(1)))).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for row in archive_parts(path, names, part_bytes):
                    yield _as_batch([row], _PART)

    # A join may gather the few, small rows in few tasks; archives are dealt out anew, and so are their parts.
    found = listed.repartition(max(1, count), "path").mapInArrow(run, _PART_TYPE)
    return found.repartition(max(1, tasks or 0), "path", "part")


def read_archives(archives: DataFrame, labeled: DataFrame | None = None) -> DataFrame:
    """Members of tar archives (any compression): ``shard``, ``member`` (base name), ``raw``, ``archive_error``.

    ``archives`` is that of ``archive_listing``. With ``labeled`` lines only their shards are opened, and only the members
    they name leave the task. If two members share a base name, the last one wins. A plain tar is read in ranges of about
    ``spark.sql.files.maxPartitionBytes``, each by a task; a compressed archive is streamed by one. Names travel as one
    row per archive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema(zip(ARCHIVE_MEMBER.names, (pa.string(), pa.string(), pa.binary(), pa.string())))
        for batch in batches:
            for part in batch.to_pylist():
                path, names, rows, size = part["path"], part["names"], [], 0
                if part["error"] is not None:
                    found = iter([(None, None, part["error"])])
                elif part["members"] is not None:
                    found = range_rows(path, [tuple(m.values()) for m in part["members"]])
                else:
                    found = stream_rows(path, None if names is None else set(names))
                for row in found:
                    rows.append((path, *row))
                    size += len(row[1] or b"")
                    if size >= _FLUSH_BYTES:
                        yield _as_batch(rows, kinds)
                        rows, size = [], 0
                if rows:
                    yield _as_batch(rows, kinds)

    members = list_parts(archives, labeled).mapInArrow(run, ARCHIVE_MEMBER)
    index = shard_index(basename("path"), "audio_")
    shard = F.concat_ws("/", folder(plain_path("path"), 2), index)
    return members.select(shard.alias("shard"), "member", "raw", "archive_error")
