"""Audio jobs: decode, re-encode and byte views, each one pass of Arrow batches without a shuffle."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechlake.functions.codec import DEFAULT_DECODERS, Decoder, decode_clip, encode_wav
from speechlake.operators.blocks import BlockBudget
from speechlake.schemas import SAMPLE_RATE
from speechlake.sources.files import read_bytes

_FLUSH_BYTES = 64 << 20  # decoded clips are larger than their source: hand them on in small batches


def clip_reader(dtype: T.DataType):
    """How to get the bytes of a clip from an Arrow scalar of this column type."""
    if isinstance(dtype, T.StringType):
        return lambda value: read_bytes(value.as_py())
    if isinstance(dtype, T.BinaryType):
        return lambda value: value.as_py()
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.ByteType):
        return lambda value: value.values.to_numpy(zero_copy_only=False).tobytes()
    raise ValueError(f"unsupported type of audio column: {dtype.simpleString()}")


def read_clip(
    column: pa.Array, i: int, read, decoders: list[tuple[str, Decoder]], rate: int
) -> tuple[np.ndarray | None, str | None, str | None]:
    """Wave, decoder and error of a row of an audio column."""
    try:
        return decode_clip(read(column[i]) if column[i].is_valid else None, decoders, rate)
    except OSError as failure:
        return None, None, f"read: {failure}"


def _map_clips(
    df: DataFrame, audio: str, outputs: list[T.StructField], convert, decoders: list[tuple[str, Decoder]], rate: int,
    budget: BlockBudget | None = None,
) -> DataFrame:
    """Decode column ``audio`` of every row and append the columns that ``convert(wave, decoder, error)`` gives.

    Blocks without any decoded clip count against the ``budget``.
    """
    read = clip_reader(df.schema[audio].dataType)
    dropped = {audio, *[f.name for f in outputs]}
    others = [c for c in df.columns if c not in dropped]
    schema = T.StructType([df.schema[c] for c in others] + outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = [to_arrow_schema(T.StructType([f])).field(0).type for f in outputs]
        blocks = budget.task() if budget else None
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(audio))
            kept = batch.select(others)
            start, size, rows = 0, 0, []
            for i in range(len(column)):
                wave, name, error = read_clip(column, i, read, decoders, rate)
                rows.append(convert(wave, name, error))
                if blocks:
                    blocks.row(wave is None)
                size += 0 if wave is None else wave.nbytes
                if size >= _FLUSH_BYTES or i + 1 == len(column):
                    new = [pa.array([row[k] for row in rows], types[k]) for k in range(len(types))]
                    part = kept.slice(start, len(rows))
                    yield pa.RecordBatch.from_arrays([*part.columns, *new], names=schema.names)
                    start, size, rows = i + 1, 0, []
        if blocks:
            blocks.end()

    return df.select(*others, audio).mapInArrow(run, schema)


def decode_audio(
    df: DataFrame, audio: str = "audio_bytes", decoders: list[tuple[str, Decoder]] = DEFAULT_DECODERS,
    rate: int = SAMPLE_RATE,
) -> DataFrame:
    """Replace encoded audio by ``wave`` (mono floats at ``rate``), ``decoder`` and ``error``.

    ``decoders`` is an ordered list of (name, function); the first that succeeds wins. Failed clips keep their row
    with a NULL wave and the reason.
    """
    outputs = [
        T.StructField("wave", T.ArrayType(T.FloatType())),
        T.StructField("decoder", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
    return _map_clips(df, audio, outputs, lambda wave, name, error: (wave, name, error), decoders, rate)


def ingest_audio(
    df: DataFrame, audio: str = "audio_bytes", decoders: list[tuple[str, Decoder]] = DEFAULT_DECODERS,
    rate: int = SAMPLE_RATE, budget: BlockBudget | None = None,
) -> DataFrame:
    """Replace audio by ``audio_size`` (samples at ``rate``), ``audio_bytes`` (16-bit WAV) and ``error``.

    The column type decides how clips are read: a string is a file path, binary and array<tinyint> are the bytes
    themselves, anything else is an error. Rows with an ``error`` have NULL audio; a block of them counts against the
    ``budget``.
    """
    outputs = [
        T.StructField("audio_size", T.LongType()),
        T.StructField("audio_bytes", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]

    def convert(wave, _name, error):
        return (None, None, error) if wave is None else (len(wave), encode_wav(wave, rate), None)

    return _map_clips(df, audio, outputs, convert, decoders, rate, budget)


def encode_waves(df: DataFrame, wave: str = "wave", rate: str = "sample_rate", name: str = "audio_bytes") -> DataFrame:
    """Replace ``wave`` by 16-bit WAV bytes that state the rate in column ``rate``."""
    others = [c for c in df.columns if c != wave]
    schema = T.StructType([df.schema[c] for c in others] + [T.StructField(name, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waves = batch.column(batch.schema.get_field_index(wave))
            rates = batch.column(batch.schema.get_field_index(rate))
            clips = [
                encode_wav(w.values.to_numpy(zero_copy_only=False), r.as_py()) if w.is_valid and r.is_valid else None
                for w, r in zip(waves, rates)
            ]
            kept = batch.select(others)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(clips, pa.binary())], names=schema.names)

    return df.select(*others, F.col(wave)).mapInArrow(run, schema)


def _view(df: DataFrame, column: str, dtype: T.DataType, convert) -> DataFrame:
    schema = T.StructType([T.StructField(f.name, dtype if f.name == column else f.dataType) for f in df.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(column)
            columns = [convert(c) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)


def _offsets(array: pa.Array) -> np.ndarray:
    return np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1]


def to_int8_list(df: DataFrame, column: str = "audio_bytes") -> DataFrame:
    """BINARY -> ARRAY<TINYINT>: the same bytes seen as signed numbers; NULLs stay."""

    def convert(array: pa.Array) -> pa.Array:
        valid, offsets, data = array.cast(pa.binary()).buffers()
        numbers = pa.Array.from_buffers(pa.int8(), data.size if data else 0, [None, data or pa.py_buffer(b"")])
        # A binary array is a list of bytes: same validity, same offsets, another child.
        return pa.Array.from_buffers(pa.list_(pa.int8()), len(array), [valid, offsets], offset=array.offset, children=[numbers])

    return _view(df, column, T.ArrayType(T.ByteType()), convert)


def to_binary(df: DataFrame, column: str = "audio_bytes") -> DataFrame:
    """ARRAY<TINYINT> -> BINARY; binary columns pass unchanged."""
    if isinstance(df.schema[column].dataType, T.BinaryType):
        return df

    def convert(array: pa.Array) -> pa.Array:
        array = array.cast(pa.list_(pa.int8()))
        valid = pa.array(array.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)).cast(pa.bool_())
        values = array.values
        data = values.buffers()[1]
        if data is None or values.offset:
            data = pa.py_buffer(values.to_numpy(zero_copy_only=False).tobytes())
        offsets = pa.py_buffer(_offsets(array).tobytes())
        return pa.Array.from_buffers(pa.binary(), len(array), [valid.buffers()[1], offsets, data])

    return _view(df, column, T.BinaryType(), convert)
