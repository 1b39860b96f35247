"""Submission jobs: transcribe a test set, and clean a submission."""

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from speechlake.functions.codec import DEFAULT_DECODERS
from speechlake.operators.quality import (
    EXPECTED_LANGUAGES,
    EXPECTED_ROWS,
    complete_submission,
    loss_report,
    normalize_metrics,
    normalized,
    validate_submission,
)
from speechlake.operators.ranking import number_slice, take_ranks
from speechlake.operators.udf import MODEL_BATCH, transcribe_audio
from speechlake.session import local_copy, staged
from speechlake.sources.tables import read_ids, read_submission, read_testset, unreadable_files, write_submission


def transcribe_clips(
    clips: DataFrame, model_factory: Callable, decoders=DEFAULT_DECODERS, batch_size: int = MODEL_BATCH
) -> DataFrame:
    """``id, language, file, row, status, transcription`` of clips; status is transcribed or decode_failed.

    One pass from bytes to texts: no samples leave the task that decoded them, and nothing is shuffled.
    """
    wanted = clips.select("id", "language", "file", "row", "audio_bytes")
    texts = transcribe_audio(wanted, model_factory, decoders=decoders, batch_size=batch_size, text="transcription")
    status = F.when(F.col("error").isNull(), "transcribed").otherwise("decode_failed")
    return texts.select("id", "language", "file", "row", status.alias("status"), F.coalesce("transcription", F.lit("")).alias("transcription"))


def build_submission(
    spark: SparkSession, testset: str, out: str, model_factory: Callable, decoders=DEFAULT_DECODERS, limit: int = 0,
    batch_size: int = MODEL_BATCH, expected_rows: int = EXPECTED_ROWS, languages: list[str] = EXPECTED_LANGUAGES,
    files: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Transcribe a test set and write a complete submission; returns (checks, loss report, unreadable files), all small.

    ``limit`` transcribes only the first clips in source order; all other ids are backfilled. Of a repeated id, the
    first clip that could be decoded counts.
    """
    clips, ids = read_testset(spark, testset), read_ids(spark, testset)
    if limit:
        places = F.struct(F.col("file"), number_slice("row"))
        clips = take_ranks(clips, [], places, [F.col("file"), F.col("row")], 0, limit)
    with staged(transcribe_clips(clips, model_factory, decoders, batch_size), "transcribed") as texts:
        heard = texts.filter(F.col("status") == "transcribed")
        with staged(complete_submission(heard, ids, ["file", "row"]), "submission") as complete:
            write_submission(complete, out, files)
            checks = local_copy(validate_submission(complete, expected_rows, languages))
            missing = complete.select("id").join(heard.select("id"), "id", "left_anti")
            reported = texts.select("id", "status", "transcription").unionByName(
                missing.select("id", F.lit("backfilled").alias("status"), F.lit("").alias("transcription"))
            )
            return checks, local_copy(loss_report(reported)), local_copy(unreadable_files(spark, testset, "test_*.parquet"))


def clean_submission(spark: SparkSession, source: str, out: str, files: int | None = None) -> dict:
    """Clean the texts of a submission; the report is gathered while the file is written, in one pass."""
    report = Observation("normalize")
    cleaned = normalized(read_submission(spark, source))
    write_submission(cleaned.observe(report, *normalize_metrics()), out, files)
    return report.get
