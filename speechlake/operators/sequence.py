"""Frames, tokens, chunks and batches."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from speechlake.operators.ranking import (
    hash_slice,
    join_null_safe,
    order_hash,
    ranked,
    running_sums,
    small_side,
    with_previous,
)
from speechlake.operators.sample import SEED
from speechlake.schemas import SAMPLE_RATE

# Fixed values of inference and batching.
CHUNK_SAMPLES = 35 * SAMPLE_RATE
MIN_CHUNK_SAMPLES = SAMPLE_RATE // 4
MAX_ELEMENTS = 3_840_000
BLANK = 0


def argmax_frames(df: DataFrame, scores: str = "scores", frame: str | None = None, length: str | None = None) -> DataFrame:
    """Replace the scores of each frame by ``token``, the index of the highest (lowest index on ties).

    With ``frame`` and ``length`` given, frames from the valid length on are dropped.
    """
    if frame and length:
        df = df.filter(F.col(frame) < F.col(length))
    best = F.array_position(scores, F.array_max(scores)) - 1
    return df.withColumn("token", best.cast("int")).drop(scores)


def greedy_collapse(
    df: DataFrame, by: list[str], order: list[str], coarse: Column, token: str = "token", blank: int | str = BLANK
) -> DataFrame:
    """Drop frames that repeat the token before, then blanks; ``a, blank, a`` keeps both ``a``. One row per token."""
    seen = with_previous(df, by, coarse, order, token, "_previous")
    changed = ~F.col(token).eqNullSafe(F.col("_previous"))
    return seen.filter(changed & (F.col(token) != F.lit(blank))).drop("_previous")


def collect_ordered(df: DataFrame, by: list[str], order: list[str], value: str, coarse: Column, name: str) -> DataFrame:
    """One array per group in order, built from the arrays of its slices."""
    entry = F.struct(*order, F.col(value).alias("_value"))
    slices = (
        df.withColumn("_slice", coarse)
        .groupBy(*by, "_slice")
        .agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["_value"]).alias("_part"))
    )
    parts = F.array_sort(F.collect_list(F.struct("_slice", "_part")))
    return slices.groupBy(*by).agg(F.flatten(F.transform(parts, lambda p: p["_part"])).alias(name))


def collect_sequences(
    tokens: DataFrame, utterances: DataFrame, by: list[str], order: list[str], coarse: Column, token: str = "token"
) -> DataFrame:
    """Token arrays of all ``utterances``; those whose frames were all blank get an empty array."""
    arrays = collect_ordered(tokens, by, order, token, coarse, "tokens")
    element = dict(tokens.dtypes)[token]
    whole = join_null_safe(utterances.select(*by), arrays, by, "left")
    return whole.withColumn("tokens", F.coalesce("tokens", F.array().cast(f"array<{element}>")))


def concat_ordered(
    df: DataFrame, by: list[str], order: list[str], text: str, coarse: Column, separator: str, name: str
) -> DataFrame:
    filled = df.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    joined = collect_ordered(filled, by, order, text, coarse, name)
    return joined.withColumn(name, F.array_join(name, separator))


def join_chunks(
    df: DataFrame, by: list[str] = ("id", "language"), order: str = "chunk_idx", text: str = "text", name: str = "transcription"
) -> DataFrame:
    """Texts of the chunks of a clip, in chunk order, with one space between."""
    return concat_ordered(df, list(by), [order], text, F.floor(F.col(order) / 64), " ", name)


def decode_tokens(
    df: DataFrame, vocab: DataFrame, by: list[str], order: list[str], coarse: Column, token: str = "token"
) -> DataFrame:
    """Text of the tokens of each utterance; special tokens are skipped. Tokens come one per row."""
    pieces = vocab.filter(~F.col("special")).select(F.col("token_id").alias(token), "piece")
    spoken = df.join(small_side(pieces), token)
    texts = concat_ordered(spoken, by, order, "piece", coarse, "", "text")
    whole = join_null_safe(df.select(*by).distinct(), texts, by, "left")
    return whole.withColumn("text", F.coalesce("text", F.lit("")))


def pad_batch(df: DataFrame, batch: list[str], tokens: str = "tokens", pad: int = 0) -> DataFrame:
    """Pad the token arrays to the longest of their batch; ``length`` keeps the length before."""
    element = dict(df.dtypes)[tokens][len("array<") : -1]
    # A batch is what a consumer holds at once, so its rows may meet in one task.
    longest = F.max(F.size(tokens)).over(Window.partitionBy(*batch))
    filler = F.array_repeat(F.lit(pad).cast(element), F.col("_longest") - F.col("length"))
    return (
        df.withColumns({"_longest": longest, "length": F.size(tokens)})
        .withColumn(tokens, F.concat(F.col(tokens), filler))
        .drop("_longest")
    )


def _chunk_starts(size: Column, chunk: int, min_tail: int) -> Column:
    """Offsets of the chunks; a short last one is left out unless it is the only one."""
    starts = F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0)), F.lit(chunk))
    return F.filter(starts, lambda s: (s == 0) | (size - s >= min_tail))


def chunk_arrays(
    df: DataFrame, wave: str = "wave", chunk: int = CHUNK_SAMPLES, min_tail: int = MIN_CHUNK_SAMPLES, keep_empty: bool = False
) -> DataFrame:
    """Cut arrays into chunks of ``chunk`` elements, numbered by ``chunk_idx``.

    A last chunk under ``min_tail`` is dropped unless it is the only one. NULL and empty arrays are dropped,
    or kept as one row with a NULL chunk under ``keep_empty``.
    """
    size = F.size(wave)
    chunks = F.transform(_chunk_starts(size, chunk, min_tail), lambda s: F.slice(F.col(wave), s + 1, F.lit(chunk)))
    generator = F.posexplode_outer if keep_empty else F.posexplode
    others = [c for c in df.columns if c != wave]
    return df.select(*others, generator(F.when(size > 0, chunks)).alias("chunk_idx", wave))


def chunk_text(df: DataFrame, text: str, chunk: int, min_tail: int) -> DataFrame:
    """The same cut for strings, by characters."""
    size = F.length(text)
    chunks = F.transform(_chunk_starts(size, chunk, min_tail), lambda s: F.substr(F.col(text), s + 1, F.lit(chunk)))
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(F.when(size > 0, chunks)).alias("chunk_idx", text))


def pack_batches(
    df: DataFrame, key: str, length: str = "audio_size", budget: int = MAX_ELEMENTS, step: int = SAMPLE_RATE, seed: int = SEED
) -> DataFrame:
    """Batches of clips of similar length whose padded size (clips x longest) stays within ``budget``.

    ``bucket`` is the length rounded up to ``step``; a batch takes ``floor(budget / bucket)`` clips of one bucket in
    seeded order. A clip over the budget is a batch of its own.
    """
    bucketed = df.withColumn("bucket", (F.ceil(F.col(length) / step) * step).cast("bigint"))
    hashed = bucketed.withColumn("_hash", order_hash(key, seed))
    numbered = ranked(hashed, ["bucket"], hash_slice(F.col("_hash")), ["_hash", key], "_rank")
    capacity = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest("bucket", F.lit(1))))
    return numbered.withColumn("batch_no", F.floor((F.col("_rank") - 1) / capacity)).drop("_hash", "_rank")


def group_steps(df: DataFrame, batches_per_step: int, batch_no: str = "batch_no") -> DataFrame:
    """Every ``batches_per_step`` batches form one step."""
    return df.withColumn("step", F.floor(F.col(batch_no) / batches_per_step))


def running_totals(df: DataFrame, by: list[str], order: list[str], coarse: Column, columns: list[str]) -> DataFrame:
    """Running totals ``total_<column>`` per run in step order."""
    return running_sums(df, by, coarse, order, {f"total_{c}": F.col(c) for c in columns})
