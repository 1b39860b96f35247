"""Per-clip helpers that run inside Arrow batches: decode, downmix, resample, encode."""

import io
import math
import wave
from collections.abc import Callable

import numpy as np
from numpy.lib.stride_tricks import as_strided

from speechlake.schemas import SAMPLE_RATE

# A decoder takes encoded bytes and returns (samples, rate); samples are 1-D or 2-D floats in [-1, 1].
Decoder = Callable[[bytes], tuple[np.ndarray, int]]

# Fixed values of the windowed-sinc resampling filter: zero crossings kept per side, and its cut-off share.
_FILTER_WIDTH = 6
_ROLLOFF = 0.99
_BLOCK = 1 << 20  # inputs taken at a time
MAX_RATE = 1_000_000  # a header that states more is corrupt; filters grow with the rate


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """PCM WAV of 8, 16, 24 or 32 bits, as (frames, channels)."""
    with wave.open(io.BytesIO(data)) as clip:
        width, channels, rate = clip.getsampwidth(), clip.getnchannels(), clip.getframerate()
        raw = clip.readframes(clip.getnframes())
    raw = raw[: len(raw) // (width * channels) * width * channels]
    if width == 1:  # unsigned
        samples = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        parts = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        samples = ((parts[:, 0] << 8 | parts[:, 1] << 16 | parts[:, 2] << 24) / 2.0**31).astype(np.float32)
    else:
        samples = np.frombuffer(raw, f"<i{width}").astype(np.float32) / np.float32(2 ** (8 * width - 1))
    return samples.reshape(-1, channels), rate


def raw_pcm16(rate: int = SAMPLE_RATE) -> Decoder:
    """Decoder for headerless 16-bit mono samples of a known rate."""

    def decode(data: bytes) -> tuple[np.ndarray, int]:
        if not data or len(data) % 2:
            raise ValueError("not 16-bit samples")
        return np.frombuffer(data, "<i2").astype(np.float32) / np.float32(32768), rate

    return decode


def downmix(samples: np.ndarray) -> np.ndarray:
    """Mean over the shorter dimension."""
    samples = np.asarray(samples, np.float32)
    if samples.ndim > 1:
        samples = samples.mean(axis=int(np.argmin(samples.shape)), dtype=np.float64).astype(np.float32)
    return samples.reshape(-1)


def resample(samples: np.ndarray, rate: int, target: int = SAMPLE_RATE) -> np.ndarray:
    """Band-limited resampling with a Hann-windowed sinc; gives ceil(n * target / rate) samples.

    Outputs repeat in phases: ``steps`` outputs span ``source`` inputs. Every phase has its own weights for the inputs
    within reach, and long clips are worked off in blocks.
    """
    if rate == target:
        return samples
    common = math.gcd(rate, target)
    source, steps = rate // common, target // common
    cutoff = min(source, steps) * _ROLLOFF
    reach = math.ceil(_FILTER_WIDTH * source / cutoff)
    phases, taps = np.arange(steps), np.arange(2 * reach + 2)
    first = phases * source // steps - reach
    distance = ((first[:, None] + taps) / source - phases[:, None] / steps) * cutoff
    distance = np.clip(distance, -_FILTER_WIDTH, _FILTER_WIDTH)
    weights = np.sinc(distance) * np.cos(distance * np.pi / _FILTER_WIDTH / 2) ** 2 * (cutoff / source)

    length = math.ceil(len(samples) * steps / source)
    rounds = math.ceil(length / steps)
    padded = np.pad(np.asarray(samples, np.float32), (reach, reach + 2 * source + 4))
    output = np.empty((rounds, steps), np.float32)
    block = max(1, _BLOCK // len(taps))
    for start in range(0, rounds, block):
        size = min(block, rounds - start)
        for phase in phases:
            begin = padded[start * source + reach + first[phase] :]
            inputs = as_strided(begin, (size, len(taps)), (source * padded.itemsize, padded.itemsize))
            output[start : start + size, phase] = inputs.astype(np.float64) @ weights[phase]
    return output.reshape(-1)[:length]


def encode_wav(samples: np.ndarray, rate: int = SAMPLE_RATE) -> bytes:
    """Mono 16-bit PCM WAV."""
    pcm = np.clip(np.rint(np.asarray(samples, np.float64) * 32767), -32768, 32767).astype("<i2")
    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as clip:
        clip.setnchannels(1)
        clip.setsampwidth(2)
        clip.setframerate(rate)
        clip.writeframes(pcm.tobytes())
    return buffer.getvalue()


def decode_clip(
    data: bytes | None, decoders: list[tuple[str, Decoder]], rate: int = SAMPLE_RATE
) -> tuple[np.ndarray | None, str | None, str | None]:
    """(mono wave at ``rate``, decoder name, None) or (None, None, reason); never raises.

    Decoders are tried in order. A clip without a positive rate, without samples or with samples that are not
    finite counts as failed.
    """
    if data is None:
        return None, None, "no audio"
    reasons = []
    for name, decoder in decoders:
        try:
            samples, found = decoder(data)
            if samples is None or np.size(samples) == 0:
                return None, None, f"{name}: empty wave"
            if not found or not 0 < found:
                return None, None, f"{name}: no sample rate"
            if not found <= MAX_RATE:
                return None, None, f"{name}: no recording has {found} samples a second"
            mono = downmix(samples)
            if not np.isfinite(mono).all():
                return None, None, f"{name}: samples are not finite"
            return resample(mono, int(found), rate), name, None
        except Exception as error:  # a broken clip, or a decoder that gives odd arrays, must not end the job
            reasons.append(f"{name}: {type(error).__name__}: {error}")
    return None, None, "; ".join(reasons) or "no decoder"


DEFAULT_DECODERS: list[tuple[str, Decoder]] = [("wav", decode_wav)]
