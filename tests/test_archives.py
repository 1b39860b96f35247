import os
import tarfile

import pytest
from fixtures import archive, entry, manifest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from speechlake.operators.join import join_audio
from speechlake.operators.project import drop_unlabeled
from speechlake.sources import archives as A
from speechlake.sources import corpora as C

MEMBERS = [("clips/a.wav", b"old"), ("b.wav", b"bb"), ("x/a.wav", b"new"), ("c.wav", b"")]


@pytest.fixture
def passes(monkeypatch):
    """The paths that were opened for a forward read."""
    opened, plain = [], A.open_stream
    monkeypatch.setattr(A, "open_stream", lambda path: opened.append(path) or plain(path))
    return opened


@pytest.fixture
def small_parts(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "20000")
    yield
    spark.conf.set(name, before)


def test_a_compressed_archive_is_read_once(tmp_path, passes):
    path = tmp_path / "audio_1.tar.xz"
    archive(path, MEMBERS)
    assert sorted(A.stream_rows(str(path), None)) == [("a.wav", b"new", None), ("b.wav", b"bb", None), ("c.wav", b"", None)]
    assert list(A.stream_rows(str(path), {"a.wav"})) == [("a.wav", b"new", None)]
    assert list(A.stream_rows(str(path), {"gone.wav"})) == []
    assert len(passes) == 3


@pytest.mark.parametrize("hold", [0, 2, 3, 5])
def test_what_is_not_held_takes_a_second_pass(tmp_path, passes, hold):
    path = tmp_path / "audio_1.tar.xz"
    archive(path, MEMBERS)
    assert sorted(A.stream_rows(str(path), None, hold)) == [("a.wav", b"new", None), ("b.wav", b"bb", None), ("c.wav", b"", None)]
    assert len(passes) == (1 if hold == 5 else 2)


def test_a_failing_second_read_is_told(tmp_path, monkeypatch):
    path = tmp_path / "audio_1.tar.xz"
    archive(path, [(f"{i}.wav", b"x" * 100) for i in range(5)])
    opened, plain = [], A.open_stream

    def once(name):
        opened.append(name)
        if len(opened) > 1:
            raise OSError("stream lost")
        return plain(name)

    monkeypatch.setattr(A, "open_stream", once)
    rows = list(A.stream_rows(str(path), None, hold=250))
    assert [r[0] for r in rows] == ["0.wav", "1.wav", None] and "stream lost" in rows[-1][2]


def test_index_of_a_plain_tar(tmp_path):
    path = tmp_path / "audio_1.tar"
    archive(path, MEMBERS)
    members, error = A.index_archive(str(path), None)
    assert error is None and [m[0] for m in members] == ["b.wav", "a.wav", "c.wav"]
    assert sorted(A.range_rows(str(path), members)) == [("a.wav", b"new", None), ("b.wav", b"bb", None), ("c.wav", b"", None)]
    assert [m[0] for m in A.index_archive(str(path), {"a.wav", "gone.wav"})[0]] == ["a.wav"]
    archive(tmp_path / "audio_2.tar.xz", MEMBERS)
    assert A.index_archive(str(tmp_path / "audio_2.tar.xz"), None) == (None, None)
    assert list(A.archive_parts(str(tmp_path / "gone.tar"), None, 10))[0][4].startswith("archive: ")


def test_a_plain_tar_without_an_end(tmp_path):
    whole = [(f"{i}.wav", os.urandom(3000)) for i in range(10)]
    archive(tmp_path / "audio_1.tar", whole)
    size = (tmp_path / "audio_1.tar").stat().st_size
    cut = tmp_path / "audio_2.tar"
    archive(cut, whole, cut=size - 512 - 4 * 3584 - 1000)  # within the fifth member
    parts = list(A.archive_parts(str(cut), None, 5000))
    assert [(p[1], len(p[3] or [])) for p in parts] == [(-1, 0), (0, 2), (1, 2)] and parts[0][4].startswith("archive: ")
    assert [r for p in parts[1:] for r in A.range_rows(str(cut), p[3])] == [(n, d, None) for n, d in whole[:4]]
    cut.write_bytes(b"")  # shorter than when it was indexed
    assert [r[0] for r in A.range_rows(str(cut), parts[1][3])] == [None]
    (tmp_path / "audio_3.tar").write_bytes(b"no archive")
    assert [p[3] for p in A.archive_parts(str(tmp_path / "audio_3.tar"), None, 10)] == [None]
    assert [r[0] for r in A.stream_rows(str(tmp_path / "audio_3.tar"), None)] == [None]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcde"), st.binary(max_size=700)), max_size=12), st.integers(0, 2000), st.integers(1, 2000))
def test_both_ways_agree(tmp_path_factory, members, hold, part_bytes):
    folder = tmp_path_factory.mktemp("a")
    expected = sorted({name: data for name, data in members}.items())
    for name in ("audio_1.tar", "audio_1.tar.xz"):
        path = folder / name
        archive(path, members)
        rows = []
        for _, _, names, found, error in A.archive_parts(str(path), None, part_bytes):
            assert error is None
            rows += A.stream_rows(str(path), names, hold) if found is None else A.range_rows(str(path), found)
        assert sorted((n, d) for n, d, _ in rows) == expected


def test_a_large_tar_gives_several_tasks(spark, tmp_path, small_parts):
    members = [(f"{i}.wav", os.urandom(1000)) for i in range(100)]
    archive(tmp_path / "s/audio/audio_1.tar", members)
    archive(tmp_path / "s/audio/audio_2.tar.xz", members[:7])
    manifest(tmp_path / "s/manifest_1.jsonl", [entry(name, "A") for name, _ in members[:80]] + [entry("gone.wav", "G")])
    manifest(tmp_path / "s/manifest_2.jsonl", [entry(name, "B") for name, _ in members[:5]])
    labeled = drop_unlabeled(C.read_manifest(spark, str(tmp_path)))
    listing = C.archive_listing(spark, str(tmp_path))
    parts = A.list_parts(listing, labeled)
    assert parts.groupBy(F.element_at(F.split("path", "/"), -1).alias("file")).count().orderBy("file").collect() == [("audio_1.tar", 4), ("audio_2.tar.xz", 1)]
    assert parts.select(F.spark_partition_id()).distinct().count() > 2
    joined = join_audio(labeled, A.read_archives(listing, labeled)).filter("archive_error is null").collect()
    assert sorted((r.transcription, r.member, bytes(r.raw)) for r in joined) == sorted([("A", *m) for m in members[:80]] + [("B", *m) for m in members[:5]])
    everything = A.read_archives(listing).collect()
    assert sorted((r.member, bytes(r.raw)) for r in everything) == sorted(members + members[:7])


def test_no_archives(spark, tmp_path):
    (tmp_path / "s").mkdir()
    listing = spark.createDataFrame([], "path string, length bigint, shard string")
    assert A.read_archives(listing).count() == 0
    assert A.read_archives(listing, spark.createDataFrame([], "shard string, member string")).count() == 0


def test_gzip_by_another_name(spark, tmp_path):
    """Archives are told apart by what they hold, not by their names."""
    path = tmp_path / "s/audio/audio_1.tar"
    path.parent.mkdir(parents=True)
    (tmp_path / "one.wav").write_bytes(b"11")
    with tarfile.open(path, "w:gz") as tar:
        tar.add(tmp_path / "one.wav", "clips/one.wav")
    rows = A.read_archives(C.archive_listing(spark, str(tmp_path))).collect()
    assert [(r.member, bytes(r.raw), r.archive_error) for r in rows] == [("one.wav", b"11", None)]
