import math

import numpy as np
import pytest
from fixtures import small_batches, wav, zero_rate
from pyspark.sql import functions as F

from speechlake.functions import codec
from speechlake.functions import wave as V
from speechlake.operators import audio as U
from speechlake.operators.udf import map_batches, transcribe


def clips():
    return {
        "mono": wav(0.5),
        "stereo8k": wav(0.5, rate=8_000, channels=2),
        "cd": wav(0.25, rate=44_100),
        "byte": wav(0.1, width=1),
        "three": wav(0.1, width=3),
        "empty": wav(frames=0),
        "norate": zero_rate(wav(0.1)),
        "garbage": b"not audio",
        "cut": wav(0.5)[:-1001],
        "none": None,
    }


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(list(clips().items()), "id string, audio_bytes binary")


def test_decode_audio(spark, table):
    with small_batches(spark, 3):
        got = {r.id: r for r in U.decode_audio(table.repartition(3)).collect()}
    sizes = {k: len(r.wave) for k, r in got.items() if r.wave is not None}
    assert sizes == {"mono": 8000, "stereo8k": 8000, "cd": 4000, "byte": 1600, "three": 1600, "cut": 8000 - 501}
    assert all(r.decoder == "wav" and r.error is None for k, r in got.items() if k in sizes)
    assert {k for k, r in got.items() if r.error} == {"empty", "norate", "garbage", "none"}
    for name in ("mono", "stereo8k", "cd"):  # the tone is still 440 Hz
        spectrum = np.abs(np.fft.rfft(got[name].wave))
        assert abs(np.argmax(spectrum) * 16_000 / sizes[name] - 440) < 16_000 / sizes[name]
        assert np.max(np.abs(got[name].wave[100:-100])) == pytest.approx(0.5, abs=0.02)


def test_decoders_are_tried_in_order(spark, table):
    def broken(data):
        raise ValueError("no")

    def constant(data):
        return np.ones((2, 7)), 16_000

    got = U.decode_audio(table.filter("id = 'garbage'"), decoders=[("a", broken), ("b", codec.decode_wav), ("c", constant)]).first()
    assert (got.wave, got.decoder, got.error) == ([1.0] * 7, "c", None)
    failed = U.decode_audio(table.filter("id = 'garbage'"), decoders=[("a", broken), ("b", codec.decode_wav)]).first()
    assert failed.error.startswith("a: ValueError: no; b: ")
    bad = U.decode_audio(table.filter("id = 'mono'"), decoders=[("nan", lambda b: (np.array([1.0, math.nan]), 16_000))]).first()
    assert bad.wave is None and "finite" in bad.error
    raw = U.decode_audio(table.filter("id = 'mono'"), decoders=[("raw", codec.raw_pcm16())]).first()
    assert len(raw.wave) == 8000 + 22


def test_ingest_audio_by_column_type(spark, table, tmp_path):
    want = {r.id: (r.audio_size, r.audio_bytes) for r in U.ingest_audio(table).collect()}
    assert want["mono"][0] == 8000 and want["mono"][1] == clips()["mono"]
    listed = U.to_int8_list(table)
    assert dict(listed.dtypes)["audio_bytes"] == "array<tinyint>"
    assert {r.id: (r.audio_size, r.audio_bytes) for r in U.ingest_audio(listed).collect()} == want

    rows = []
    for name, data in clips().items():
        if data is not None:
            (tmp_path / name).write_bytes(data)
        rows.append((name, str(tmp_path / name) if name != "cd" else f"file://{tmp_path / name}"))
    paths = spark.createDataFrame(rows, "id string, path string")
    got = U.ingest_audio(paths, "path")
    assert got.columns == ["id", "audio_size", "audio_bytes", "error"]
    assert {r.id: (r.audio_size, r.audio_bytes) for r in got.collect()} == want
    with pytest.raises(ValueError, match="unsupported type"):
        U.ingest_audio(table.withColumn("audio_bytes", F.lit(1)))


def test_byte_views_keep_nulls_and_offsets(spark):
    data = [(0, bytes(range(256))), (1, None), (2, b""), (3, b"\x00\x7f\x80\xff"), (4, None)]
    df = spark.createDataFrame(data, "k int, audio_bytes binary").coalesce(1)
    lists = U.to_int8_list(df)
    got = {r.k: r.audio_bytes for r in lists.collect()}
    assert got[3] == [0, 127, -128, -1] and got[1] is None and got[2] == []
    assert sorted(map(tuple, U.to_binary(lists).collect())) == data
    assert sorted(map(tuple, U.to_binary(lists.filter("k > 0")).collect())) == data[1:]


def test_resample_lengths():
    for rate in (8_000, 11_025, 22_050, 44_100, 48_000, 15_999):
        for n in (1, 7, 1000):
            assert len(codec.resample(np.ones(n, np.float32), rate)) == math.ceil(n * 16_000 / rate)
    flat = codec.resample(np.ones(4800, np.float32), 48_000)
    assert np.allclose(flat[50:-50], 1, atol=0.01)


def test_downmix_takes_the_shorter_dimension():
    a = np.array([[1.0, 3.0, 5.0], [3.0, 5.0, 7.0]])
    assert codec.downmix(a).tolist() == codec.downmix(a.T).tolist() == [2, 4, 6]
    square = np.array([[1.0, 2.0], [5.0, 6.0]])
    assert codec.downmix(square).tolist() == [3, 4]


def test_wave_expressions(spark):
    rows = [
        ("two", [[1.0, 3.0, 5.0], [3.0, 5.0, 7.0]], [2.0, 4.0, 6.0]),
        ("tall", [[1.0, 3.0], [3.0, 5.0], [5.0, 7.0]], [2.0, 4.0, 6.0]),
        ("square", [[1.0, 2.0], [5.0, 6.0]], [3.0, 4.0]),
        ("one", [[1.0, 2.0]], [1.0, 2.0]),
        ("none", [], []),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "id string, ch array<array<float>>")
    assert {r.id: r.m for r in df.select("id", V.to_mono("ch").alias("m")).collect()} == {r[0]: r[2] for r in rows}

    waves = [[0.0, 1.0, 2.0, 5.0], [3.0], [], [1.0, float("nan")], [float("inf")], None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(waves)], "i int, w array<float>")
    got = df.select("i", V.valid_wave("w", F.lit(8000)).isNotNull().alias("v"), V.valid_wave("w", F.lit(0)).alias("z"), V.audio_size("w").alias("s"))
    rows = got.orderBy("i").collect()
    assert [r.v for r in rows] == [True, True, False, False, False, False]
    assert all(r.z is None for r in rows) and [r.s for r in rows] == [4, 1, 0, 2, 1, None]
    norm = {r.i: r.n for r in df.filter("i < 3").select("i", V.normalize_wave("w").alias("n")).collect()}
    x = np.array(waves[0])
    assert np.allclose(norm[0], (x - x.mean()) / np.sqrt(x.var() + 1e-5), atol=1e-5)
    assert norm[1] == [0.0] and norm[2] == []


class CountingModel:
    def __init__(self):
        self.calls = 0

    def __call__(self, waves):
        self.calls += 1
        assert len(waves) <= 4
        return [f"{len(w)}@{self.calls}" for w in waves]


def test_transcribe_builds_one_model_per_task(spark):
    df = spark.range(20).select("id", F.when(F.col("id") != 3, F.array_repeat(F.lit(0.5).cast("float"), F.col("id").cast("int"))).alias("wave")).coalesce(1)
    with small_batches(spark, 10):
        got = {r.id: r.text for r in transcribe(df, CountingModel, batch_size=4).collect()}
    # 19 chunks in calls of 4 that go over the border of the batches
    assert got[3] is None and got[0] == "0@1" and got[10] == "10@3" and got[19] == "19@5"


def test_map_batches_passes_arguments(spark):
    def factory(column):
        return lambda batch: batch.select([column])

    df = spark.range(5).withColumn("b", F.col("id") * 2)
    assert sorted(r.b for r in map_batches(df, factory, "b bigint", column="b").collect()) == [0, 2, 4, 6, 8]


def test_a_corrupt_rate_is_an_error_row():
    from speechlake.functions.codec import decode_clip, decode_wav

    data = wav(0.1)
    broken = data[:24] + (2**31 - 1).to_bytes(4, "little") + data[28:]
    assert decode_clip(broken, [("wav", decode_wav)])[2].startswith("wav: no recording has")
    for odd in (lambda d: (np.zeros((2, 3, 4)), 16_000), lambda d: (np.ones(3), float("nan")), lambda d: ("text", 8000), lambda d: None):
        wave, _, error = decode_clip(b"x", [("odd", odd)])
        assert (wave is None) == (error is not None)
