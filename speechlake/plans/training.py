"""From the lake to statistics and batches, and from frames to error rates."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speechlake.operators.aggregate import language_hours
from speechlake.operators.project import MAX_AUDIO_LEN, MIN_AUDIO_LEN, drop_unlabeled, filter_length
from speechlake.operators.ranking import join_null_safe, small_side
from speechlake.operators.sample import BETA, SEED, mix_quotas, mix_weights, temperature_sample
from speechlake.operators.score import error_rates
from speechlake.operators.sequence import (
    BLANK,
    MAX_ELEMENTS,
    argmax_frames,
    collect_ordered,
    greedy_collapse,
    group_steps,
    pack_batches,
)
from speechlake.session import materialized
from speechlake.sources.tables import read_lake, write_stats


def labeled_hours(df: DataFrame, text: str = "text") -> DataFrame:
    """Hours of labeled audio of usable length per (corpus, language)."""
    return language_hours(filter_length(drop_unlabeled(df, text)))


def stats(spark: SparkSession, lake: str, out: str) -> None:
    """Recompute the language statistics of a lake."""
    write_stats(language_hours(read_lake(spark, lake, ["corpus", "language", "audio_size"])), out)


def batches(
    clips: DataFrame, hours: DataFrame, rows: int, key: str, beta_corpus: float = BETA, beta_language: float = BETA,
    low: int = MIN_AUDIO_LEN, high: int = MAX_AUDIO_LEN, budget: int = MAX_ELEMENTS, batches_per_step: int = 1, seed: int = SEED,
) -> DataFrame:
    """Batch table for the consumer: length filter, temperature mix of ``rows`` rows, batches within ``budget``, steps.

    Give it the key and size columns only; the audio is fetched by ``key`` when a batch is read.
    """
    usable = filter_length(clips, "audio_size", low, high)
    mixed = temperature_sample(usable, mix_quotas(mix_weights(hours, beta_corpus, beta_language), rows), key, seed)
    unique = mixed.withColumn("_copy_key", F.concat_ws("#", key, "copy"))
    packed = pack_batches(unique, "_copy_key", "audio_size", budget, seed=seed).drop("_copy_key")
    return group_steps(packed, batches_per_step)


def score(
    frames: DataFrame, references: DataFrame, vocab: DataFrame, coarse: Column, length: str | None = None, blank: int = BLANK
) -> DataFrame:
    """Greedy decoding of frame scores (``utt_id, frame_idx, scores``) against ``utt_id, ref, ref_tokens``.

    One row with ``wer`` and ``uer``. Utterances without frames count as empty hypotheses. The scores are read once: the
    best token of each frame is written as a narrow table, and one aggregate of it gives token arrays and texts.
    """
    by, order = ["utt_id"], ["frame_idx"]
    best = argmax_frames(frames, "scores", "frame_idx" if length else None, length).select("utt_id", "frame_idx", "token")
    tokens = greedy_collapse(materialized(best, "tokens"), by, order, coarse, blank=blank)
    pieces = vocab.filter(~F.col("special")).select(F.col("token_id").alias("token"), "piece")
    spoken = tokens.join(small_side(pieces), "token", "left").withColumn("heard", F.struct("token", "piece"))
    heard = collect_ordered(spoken, by, order, "heard", coarse, "heard")
    one = F.assert_true(F.count("*") == 1, F.concat(F.lit("utt_id is not unique: "), F.col("utt_id").cast("string"))).alias("_one")
    unique = references.groupBy("utt_id").agg(F.min("ref").alias("ref"), F.min("ref_tokens").alias("ref_tokens"), one).filter("_one is null")
    pairs = join_null_safe(unique.drop("_one"), heard, by, "left")
    empty = F.array().cast(dict(heard.dtypes)["heard"])
    pairs = pairs.withColumn("heard", F.coalesce("heard", empty))
    hyp = F.array_join(F.transform("heard", lambda h: h["piece"]), "")  # skips the pieces of special tokens, which are NULL
    return error_rates(pairs.select("ref", "ref_tokens", hyp.alias("hyp"), F.transform("heard", lambda h: h["token"]).alias("hyp_tokens")))
