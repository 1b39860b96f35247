"""Aggregates over the utterance table, metric events and checkpoints."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechlake.functions.text import is_blank
from speechlake.operators.project import select_splits
from speechlake.schemas import SAMPLE_RATE


def language_hours(df: DataFrame, splits: str | None = None) -> DataFrame:
    """Hours of audio per (corpus, language), over all splits unless some are named."""
    if splits:
        df = select_splits(df, splits)
    return df.groupBy("corpus", "language").agg((F.sum("audio_size") / 3600 / SAMPLE_RATE).alias("hours"))


def lake_summary(df: DataFrame) -> DataFrame:
    """Row count and the sorted list of languages."""
    # Count per language first: one row per language reaches the last step.
    per_language = df.groupBy("language").agg(F.count("*").alias("rows"))
    return per_language.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.sort_array(F.collect_list("language")).alias("languages"),
    )


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of every key by ``order``; copies of a key are reduced before the shuffle."""
    others = [c for c in df.columns if c not in key]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("_first")
    return df.groupBy(*key).agg(first).select(*[c if c in key else F.col(f"_first.{c}") for c in df.columns])


def mean_loss_bits(df: DataFrame, by: list[str] = (), loss: str = "loss", batch_size: str = "batch_size") -> DataFrame:
    """Mean loss per example in bits: each batch's loss / size / ln 2, weighted by its size."""
    mean = F.try_divide(F.sum(F.col(loss) / math.log(2)), F.sum(batch_size))
    return df.groupBy(*by).agg(mean.alias("ctc_loss"))


def batch_stats(df: DataFrame, batch: list[str], length: str = "audio_size") -> DataFrame:
    """Examples, elements and padding (examples x longest - elements) per batch."""
    padding = F.count("*") * F.max(length) - F.sum(length)
    return df.groupBy(*batch).agg(
        F.count("*").alias("num_examples"), F.sum(length).alias("num_elements"), padding.alias("padding")
    )


def ingest_report(df: DataFrame, shard: str = "shard") -> DataFrame:
    """Rows per shard, and in total on the row without a shard."""
    per_shard = df.groupBy(F.coalesce(F.col(shard), F.lit("")).alias(shard)).agg(F.count("*").alias("_n"))
    return per_shard.rollup(shard).agg(F.sum("_n").alias("rows"))


def step_number(path: str | Column) -> Column:
    """The number in the last ``step_N`` of a path."""
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(path, r"step_(\d+)/?\z", 1).try_cast("bigint")


def best_step(df: DataFrame) -> DataFrame:
    """Path of the checkpoint with the lowest error rate; the earliest on ties."""
    return df.filter(F.col("wer").isNotNull()).agg(F.min_by("path", F.struct("wer", "step")).alias("path"))


def newest_step(df: DataFrame) -> DataFrame:
    """Path of the checkpoint with the highest step number."""
    return df.agg(F.max_by("path", "step").alias("path"))


def blank_report(df: DataFrame, text: str = "transcription") -> DataFrame:
    """Number of blank texts per language, and in total on the row without a language."""
    blank = df.filter(F.coalesce(is_blank(text), F.lit(True)))
    per_language = blank.groupBy(F.coalesce("language", F.lit("")).alias("language")).agg(F.count("*").alias("_n"))
    return per_language.rollup("language").agg(F.sum("_n").alias("blank"))
