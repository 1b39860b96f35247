"""Incremental pickup of arriving manifests."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from speechlake.functions.codec import DEFAULT_DECODERS
from speechlake.operators.project import drop_unlabeled
from speechlake.operators.sample import SEED
from speechlake.plans.ingest import ingest_lines
from speechlake.session import hadoop_path
from speechlake.sources.corpora import archive_listing, manifest_lines, parse_manifest, read_manifest

_WAITING = "shard string, path string"


def stream_ingest(
    spark: SparkSession, root: str, out: str, checkpoint: str, language: str, corpus: str, split: Column | None = None,
    decoders=DEFAULT_DECODERS, quarantine: str | None = None, seed: int = SEED, max_files: int = 1000, max_bad: int | None = None,
) -> StreamingQuery:
    """Land the clips of all manifests that arrived since the last run, then stop.

    The file log in ``checkpoint`` names the new manifests. Clips land in the lake's own layout with their keys, so a
    micro-batch that runs again, another checkpoint folder or a batch job adds only what is missing, and several
    streams share a lake. Manifests whose archive is not there yet are noted in ``<checkpoint>-waiting`` and tried
    again by each later run.
    """
    waiting = f"{checkpoint.rstrip('/')}-waiting"

    def land_lines(session: SparkSession, lines: DataFrame) -> None:
        ingest_lines(session, root, lines, out, language, corpus, split, seed=seed, decoders=decoders, quarantine=quarantine, max_bad=max_bad)

    def land_batch(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        there = archive_listing(session, root).select("shard")
        early = drop_unlabeled(batch.filter("error is null")).select("shard", "path").distinct().join(there, "shard", "left_anti")
        early.withColumn("state", F.lit("waiting")).write.mode("append").partitionBy("state").parquet(waiting)
        land_lines(session, batch)

    late = _arrived(spark, root, waiting)
    if late is not None:
        paths = [row.path for row in late.select("path").distinct().collect()]
        if paths:
            land_lines(spark, read_manifest(spark, paths))
            done = spark.createDataFrame([(path,) for path in paths], "path string")
            done.select(F.lit(None).cast("string").alias("shard"), "path", F.lit("done").alias("state")).write.mode("append").partitionBy("state").parquet(waiting)

    text = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "manifest_*")
        .option("maxFilesPerTrigger", max_files)
        .load(root)
    )
    # A stream has no line numbers; the hash of a line stands in for its place.
    lines = parse_manifest(manifest_lines(text, line_id=F.xxhash64("value")))
    return (
        lines.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(land_batch).start()
    )


def _arrived(spark: SparkSession, root: str, waiting: str) -> DataFrame | None:
    """Noted manifests (``shard``, ``path``) whose archive is there by now and that were not taken up since."""
    system, path = hadoop_path(spark, waiting)
    if not system.exists(path):
        return None
    notes = spark.read.schema(f"{_WAITING}, state string").parquet(waiting)
    done = notes.filter("state = 'done'").select("path")
    open_notes = notes.filter("state = 'waiting'").select("shard", "path").distinct().join(done, "path", "left_anti")
    return open_notes.join(archive_listing(spark, root).select("shard"), "shard", "left_semi")
