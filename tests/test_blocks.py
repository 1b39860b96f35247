"""Budgets on blocks, exact batches and calls over the borders of Arrow batches."""

import pyarrow as pa
import pytest
from fixtures import wav
from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import functions as F

from speechlake.operators.audio import ingest_audio
from speechlake.operators.blocks import BlockBudget, block_report
from speechlake.operators.quality import BudgetExceeded
from speechlake.operators.udf import map_batches, rechunk, transcribe
from speechlake.plans import ingest as I

CLIPS = "transcription string, language string, split string, audio struct<bytes: binary, path: string>"


def source(spark, root, good, bad, parts):
    """Train clips in ``parts`` files of ``good`` clips each; every clip of the last ``bad`` files is broken."""
    for split in ("train", "validation", "test"):
        n = parts if split == "train" else 1
        rows = [(f"{split}{k}-{i}", "x", "own", (b"bad" if split == "train" and k >= parts - bad else wav(frames=100), f"{k}-{i}")) for k in range(n) for i in range(good)]
        spark.createDataFrame(rows, CLIPS).repartitionByRange(n, "transcription").write.parquet(f"{root}/{split}")


def test_blocks_within_the_budget(spark, tmp_path):
    source(spark, str(tmp_path / "src"), 50, 2, 6)
    with pytest.raises(BudgetExceeded):
        I.ingest_clips(spark, str(tmp_path / "src"), str(tmp_path / "lake"), "kik", "c", max_bad_blocks=0)
    assert not (tmp_path / "lake").exists()
    # Lost clips that are not a whole block do not count.
    landed = I.ingest_clips(spark, str(tmp_path / "src"), str(tmp_path / "lake"), "kik", "c", max_bad_blocks=6, quarantine=str(tmp_path / "q"))
    assert landed == 4 * 50 + 2 * 50 and spark.read.parquet(str(tmp_path / "q")).count() == 100
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def slow_decoder(data):
    import time

    time.sleep(0.02)
    raise ValueError("no clip")


def test_the_run_ends_early(spark):
    """Of 80 tasks whose blocks are all lost, few are run."""
    clips = spark.range(80 * 10, numPartitions=80).select("id", F.lit(b"x").alias("audio_bytes"))
    budget = BlockBudget(spark, 3, rows=10)
    with pytest.raises(BudgetExceeded), budget.watch():
        ingest_audio(clips, decoders=[("slow", slow_decoder)], budget=budget).write.format("noop").mode("overwrite").save()
    assert 3 < budget.lost() < 60
    one = BlockBudget(spark, 3, rows=10)
    with pytest.raises(BudgetExceeded), one.watch():  # a single task ends itself
        ingest_audio(clips.coalesce(1), decoders=[("slow", slow_decoder)], budget=one).count()
    fine = BlockBudget(spark, 80, rows=10)
    with fine.watch():
        ingest_audio(clips, decoders=[("none", slow_decoder)], budget=fine).write.format("noop").mode("overwrite").save()
    assert fine.lost() == 80
    with pytest.raises(ZeroDivisionError), BlockBudget(spark, 3).watch():  # other failures stay what they are
        1 / 0


def test_block_report(spark):
    rows = spark.createDataFrame([(1, None), (1, "e"), (2, "e"), (2, "e"), (None, "e")], "block int, error string")
    assert tuple(block_report(rows, max_bad=1).first()) == (3, 2, 4, False)
    assert tuple(block_report(rows.limit(0), max_bad=0).first()) == (0, 0, 0, True)


def test_rechunk():
    batches = [pa.record_batch({"x": pa.array(range(a, b))}) for a, b in ((0, 7), (7, 7), (7, 8), (8, 33), (33, 40))]
    got = list(rechunk(iter(batches), 10))
    assert [b.num_rows for b in got] == [10, 10, 10, 10] and [x for b in got for x in b.column(0).to_pylist()] == list(range(40))
    assert [b.num_rows for b in rechunk(iter(batches), 16)] == [16, 16, 8] and not list(rechunk(iter([]), 3))


def sizes_seen():
    return lambda batch: pa.record_batch({"n": pa.array([batch.num_rows] * batch.num_rows, pa.int64())})


def test_batches_have_the_size_asked_for(spark):
    rows = spark.range(0, 260, numPartitions=2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "33")
    try:
        got = [r.n for r in map_batches(rows, sizes_seen, "n bigint", batch_size=50).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(got) == [30] * 60 + [50] * 200


def test_profile_reaches_the_stage(spark):
    """Local mode knows no executors of a profile; the plan carries it."""
    profile = ResourceProfileBuilder().require(TaskResourceRequests().cpus(2)).build
    plan = map_batches(spark.range(4), sizes_seen, "n bigint", profile=profile)
    assert "MapInArrow" in plan._jdf.queryExecution().analyzed().toString() and plan._jdf.queryExecution().analyzed().profile().isDefined()


class Counting:
    """Names each chunk by its first sample and the size of the call it was in."""

    def __call__(self, waves):
        return [f"{int(w[0])}/{len(waves)}" for w in waves]


def test_calls_go_over_batches(spark):
    """40 chunks that come in batches of 15 are called 16, 16 and 8 at a time; chunks without samples take no place."""
    chunks = spark.range(0, 44, numPartitions=1).select("id", F.when(F.col("id") % 11 != 10, F.array(F.col("id").cast("float"))).alias("wave"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "15")
    try:
        got = transcribe(chunks, Counting).collect()
        none = transcribe(chunks.filter("wave is null"), Counting).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.id for r in got] == list(range(44))
    spoken = [r.text for r in got if r.id % 11 != 10]
    assert [t.split("/")[1] for t in spoken] == ["16"] * 32 + ["8"] * 8
    assert [int(t.split("/")[0]) for t in spoken] == [i for i in range(44) if i % 11 != 10]
    assert [r.text for r in none] == [None] * 4
