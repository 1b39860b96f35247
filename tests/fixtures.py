"""Small files in the shapes of the sources."""

import io
import json
import lzma
import math
import tarfile
import wave
from contextlib import contextmanager


def wav(seconds=None, rate=16_000, channels=1, frames=None, hz=440.0, width=2):
    """A sine tone as PCM WAV bytes."""
    count = int(seconds * rate) if frames is None else frames
    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as clip:
        clip.setnchannels(channels)
        clip.setsampwidth(width)
        clip.setframerate(rate)
        top = 2 ** (8 * width - 1) - 1
        data = bytearray()
        for i in range(count):
            value = int(0.5 * top * math.sin(2 * math.pi * hz * i / rate))
            sample = (value + 128).to_bytes(1, "little") if width == 1 else value.to_bytes(width, "little", signed=True)
            data += sample * channels
        clip.writeframes(bytes(data))
    return buffer.getvalue()


def zero_rate(data):
    """The same WAV with a header that states rate 0."""
    return data[:24] + (0).to_bytes(4, "little") + data[28:]


def archive(path, members, cut=0):
    """A tar.xz, or a plain tar by its name, of (name, bytes) in order; ``cut`` drops bytes at the end."""
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w") as tar:
        folder = tarfile.TarInfo("clips")
        folder.type = tarfile.DIRTYPE
        tar.addfile(folder)
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    packed = raw.getvalue() if path.suffix == ".tar" else lzma.compress(raw.getvalue())
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(packed[: len(packed) - cut])


def manifest(path, entries):
    """JSON lines; strings are written as they are."""
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [e if isinstance(e, str) else json.dumps(e, ensure_ascii=False) for e in entries]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def entry(name, text, **more):
    return {"audio_filepath": name, "transcription": text, "locale": "x", **more}


@contextmanager
def small_batches(spark, rows):
    """Hold Arrow batches to a few rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
