"""Waveform expressions on ARRAY<FLOAT> columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from speechlake.schemas import SAMPLE_RATE


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return (total / F.size(values)).cast("float")


def to_mono(channels: str | Column) -> Column:
    """Mean over the shorter of the two dimensions of ARRAY<ARRAY<FLOAT>>; over the first one on ties."""
    channels = _column(channels)
    rows, columns = F.size(channels), F.size(F.get(channels, F.lit(0)))
    across = F.transform(
        F.sequence(F.lit(0), columns - 1), lambda i: _mean(F.transform(channels, lambda row: F.get(row, i)))
    )
    return (
        F.when((rows == 0) | (columns == 0), F.array().cast("array<float>"))
        .when(rows <= columns, across)
        .otherwise(F.transform(channels, _mean))
    )


def valid_wave(wave: str | Column, rate: str | Column) -> Column:
    """The wave, or NULL if the rate is missing or not positive, the wave is empty, or a sample is not finite."""
    wave, rate = _column(wave), _column(rate)
    infinite = [F.lit(float("inf")).cast("float"), F.lit(float("-inf")).cast("float")]
    finite = F.forall(wave, lambda x: ~F.isnan(x) & ~x.isin(*infinite) & x.isNotNull())
    return F.when((rate > 0) & (F.size(wave) > 0) & finite, wave)


def audio_size(wave: str | Column) -> Column:
    """Number of samples; NULL for a NULL wave."""
    wave = _column(wave)
    return F.when(wave.isNotNull(), F.size(wave).cast("bigint"))


def duration_s(size: str | Column) -> Column:
    return _column(size) / SAMPLE_RATE


def normalize_wave(wave: str | Column, epsilon: float = 1e-5) -> Column:
    """Zero mean and unit variance per clip: (x - mean) / sqrt(variance + epsilon)."""
    wave = _column(wave)
    count = F.greatest(F.size(wave), F.lit(1))
    sums = F.aggregate(
        wave,
        F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q")),
        lambda acc, x: F.struct(
            (acc["s"] + x.cast("double")).alias("s"), (acc["q"] + x.cast("double") * x.cast("double")).alias("q")
        ),
        lambda acc: F.struct(
            (acc["s"] / count).alias("mean"),
            (acc["q"] / count - F.pow(acc["s"] / count, F.lit(2))).alias("variance"),
        ),
    )
    # One-element array, so that the sums are taken once per clip and not once per sample.
    return F.get(
        F.transform(
            F.array(sums),
            lambda m: F.transform(
                wave, lambda x: ((x - m["mean"]) / F.sqrt(F.greatest(m["variance"], F.lit(0.0)) + epsilon)).cast("float")
            ),
        ),
        F.lit(0),
    )
