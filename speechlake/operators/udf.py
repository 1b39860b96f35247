"""Batch functions over Arrow record batches, and inference with a caller-given model."""

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechlake.functions.codec import DEFAULT_DECODERS, Decoder
from speechlake.operators.audio import clip_reader, read_clip
from speechlake.operators.sequence import CHUNK_SAMPLES, MIN_CHUNK_SAMPLES
from speechlake.schemas import SAMPLE_RATE

# Fixed value: chunks per model call.
MODEL_BATCH = 16


def rechunk(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of exactly ``rows``; only the last one may have fewer."""
    held, n = [], 0

    def merged() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            held, n, batch = [*held, part], n + part.num_rows, batch.slice(part.num_rows)
            if n == rows:
                yield merged()
                held, n = [], 0
    if held:
        yield merged()


def map_batches(
    df: DataFrame, factory: Callable[..., Callable], schema: T.StructType | str, batch_size: int | None = None,
    profile: ResourceProfile | None = None, **kwargs,
) -> DataFrame:
    """Apply a stateful batch function: ``factory(**kwargs)`` is built once per task, then called per record batch.

    Batches have exactly ``batch_size`` rows but for the last of a task; without it they come as Spark cuts them. The
    stage runs on executors of ``profile``, whose tasks per executor bound the functions that live at once. Select the
    columns the function needs before calling this: nothing is pruned through it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = None
        for batch in rechunk(batches, batch_size) if batch_size else batches:
            function = function or factory(**kwargs)
            yield function(batch)

    return df.mapInArrow(run, schema, profile=profile)


class _Calls:
    """Model calls of ``size`` chunks each; every text goes to its place in a list."""

    def __init__(self, model: Callable[[list[np.ndarray]], list[str]], size: int):
        self.model, self.size = model, size
        self.waiting: list[tuple[list[str | None], int, np.ndarray]] = []

    def add(self, texts: list[str | None], samples: np.ndarray) -> None:
        """The text of ``samples`` becomes the next of ``texts``."""
        texts.append(None)
        self.waiting.append((texts, len(texts) - 1, samples))
        if len(self.waiting) == self.size:
            self.call()

    def call(self) -> None:
        now, self.waiting = self.waiting, []
        for (texts, i, _), text in zip(now, self.model([samples for *_, samples in now]) if now else [], strict=True):
            texts[i] = text

    def complete(self, texts: list[str | None]) -> bool:
        return not self.waiting or texts is not self.waiting[0][0]


def _with_calls(
    batches: Iterator[pa.RecordBatch], model_factory: Callable, size: int, hear: Callable[[pa.RecordBatch, _Calls, list], object],
    finish: Callable[[pa.RecordBatch, list, object], pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    """``hear`` hands the chunks of a batch to the calls, ``finish`` makes the result once all its texts are there."""
    calls, held = None, deque()
    for batch in batches:
        calls = calls or _Calls(model_factory(), size)
        texts: list[str | None] = []
        notes = hear(batch, calls, texts)
        held.append((batch, texts, notes))
        while held and calls.complete(held[0][1]):
            yield finish(*held.popleft())
    if calls:
        calls.call()
    for item in held:
        yield finish(*item)


def transcribe(
    chunks: DataFrame, model_factory: Callable[[], Callable[[list[np.ndarray]], list[str]]], wave: str = "wave",
    batch_size: int = MODEL_BATCH,
) -> DataFrame:
    """Replace ``wave`` by ``text``; the model is built once per task and sees ``batch_size`` chunks per call.

    Calls go on over the borders of Arrow batches, so only the last one of a task has fewer; a batch is held until the
    call that holds its last chunk. Chunks keep their place, so no shuffle moves the samples. NULL waves get a NULL text.
    """
    others = [c for c in chunks.columns if c != wave]
    schema = T.StructType([chunks.schema[c] for c in others] + [T.StructField("text", T.StringType())])

    def hear(batch: pa.RecordBatch, calls: _Calls, texts: list[str | None]) -> None:
        waves = batch.column(batch.schema.get_field_index(wave))
        for samples in waves:
            if samples.is_valid:
                calls.add(texts, samples.values.to_numpy(zero_copy_only=False))
            else:
                texts.append(None)

    def finish(batch: pa.RecordBatch, texts: list[str | None], _) -> pa.RecordBatch:
        kept = batch.select(others)
        return pa.RecordBatch.from_arrays([*kept.columns, pa.array(texts, pa.string())], names=[*others, "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _with_calls(batches, model_factory, batch_size, hear, finish)

    return chunks.select(*others, F.col(wave)).mapInArrow(run, schema)


def transcribe_audio(
    clips: DataFrame, model_factory: Callable[[], Callable[[list[np.ndarray]], list[str]]], audio: str = "audio_bytes",
    decoders: list[tuple[str, Decoder]] = DEFAULT_DECODERS, rate: int = SAMPLE_RATE, chunk: int = CHUNK_SAMPLES,
    min_tail: int = MIN_CHUNK_SAMPLES, batch_size: int = MODEL_BATCH, text: str = "text",
) -> DataFrame:
    """Replace encoded audio by ``text`` and ``error``: decode, cut and transcribe in one pass; samples stay in the task.

    Cuts and calls are those of ``chunk_arrays`` and ``transcribe``. The texts of the chunks of a clip are joined by one
    space; a clip without samples has an empty text, one that no decoder takes a NULL text and the reason. A task holds
    the waves whose chunks wait for a call, ``batch_size`` chunks at most.
    """
    read = clip_reader(clips.schema[audio].dataType)
    others = [c for c in clips.columns if c not in (audio, text, "error")]
    schema = T.StructType([clips.schema[c] for c in others] + [T.StructField(c, T.StringType()) for c in (text, "error")])

    def hear(batch: pa.RecordBatch, calls: _Calls, texts: list[str | None]) -> list[tuple[int, str | None]]:
        column, notes = batch.column(batch.schema.get_field_index(audio)), []
        for i in range(len(column)):
            wave, _, error = read_clip(column, i, read, decoders, rate)
            before, size = len(texts), 0 if wave is None else len(wave)
            for start in range(0, size, chunk):
                if not start or size - start >= min_tail:
                    calls.add(texts, wave[start : start + chunk])
            notes.append((len(texts) - before, None if wave is not None else error))
        return notes

    def finish(batch: pa.RecordBatch, texts: list[str | None], notes: list[tuple[int, str | None]]) -> pa.RecordBatch:
        at, joined = 0, []
        for count, error in notes:
            joined.append(" ".join(t or "" for t in texts[at : at + count]) if error is None else None)
            at += count
        kept, errors = batch.select(others), [error for _, error in notes]
        return pa.RecordBatch.from_arrays([*kept.columns, pa.array(joined, pa.string()), pa.array(errors, pa.string())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _with_calls(batches, model_factory, batch_size, hear, finish)

    return clips.select(*others, audio).mapInArrow(run, schema)
