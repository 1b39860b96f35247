"""Joins between manifests, archives, results and references."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechlake.functions.text import PLACEHOLDER
from speechlake.operators.aggregate import keep_first
from speechlake.operators.ranking import small_side


def join_audio(manifest: DataFrame, members: DataFrame) -> DataFrame:
    """Manifest lines with the bytes of their archive member; lines without a member are dropped.

    Rows that tell of a broken archive (``archive_error``) are kept, so that one read of the archives gives both. The
    member bytes stay where they were read if the manifest is small enough to broadcast.
    """
    keys = ["shard", "member"]
    if "archive_error" not in members.columns:
        return members.join(small_side(manifest, 50_000), keys)
    lines = small_side(manifest.withColumn("_listed", F.lit(True)), 50_000)
    return members.join(lines, keys, "left").filter("_listed or archive_error is not null").drop("_listed")


def backfill(results: DataFrame, ids: DataFrame, order: list[str]) -> DataFrame:
    """Add every known id that has no result, with the placeholder as its text and its first language by ``order``."""
    known = keep_first(ids.select("id", "language", *order), ["id"], order).select("id", "language")
    missing = known.join(results.select("id"), "id", "left_anti")
    return results.unionByName(missing.withColumn("transcription", F.lit(PLACEHOLDER)))


def _unique(df: DataFrame, key: str, text: str) -> DataFrame:
    one = F.assert_true(F.count("*") == 1, F.concat(F.lit(f"{key} is not unique: "), F.col(key).cast("string")))
    grouped = df.groupBy(key).agg(F.min(text).alias(text), one.alias("_one"))
    return grouped.filter(F.col("_one").isNull()).drop("_one")


def pair_transcripts(refs: DataFrame, hyps: DataFrame, key: str = "utt_id") -> DataFrame:
    """References and hypotheses side by side; fails if a key occurs twice on one side."""
    return _unique(refs, key, "ref").join(_unique(hyps, key, "hyp"), key)
