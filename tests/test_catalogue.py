import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from speechlake.sources import catalogue as C
from speechlake.sources import tables as T

KIND = "text string, audio_bytes binary, language string, split string, corpus string, audio_size bigint, clip_key string"


def land(spark, root, language, keys, corpus="c"):
    rows = [(f"t{k}", b"x", language, "train", corpus, 1, k) for k in keys]
    T.write_lake(spark.createDataFrame(rows, KIND), root)


def keys(spark, root, language, corpus="c"):
    return sorted(r.clip_key for r in T.landed_keys(spark, root, corpus, language).collect())


def spoil(root, folder):
    """Keep names, lengths and times of the files in a folder, and nothing of what they hold."""
    for file in (root / folder).glob("*.parquet"):
        about = file.stat()
        file.write_bytes(b"z" * about.st_size)
        os.utime(file, ns=(about.st_atime_ns, about.st_mtime_ns))
        (root / folder / f".{file.name}.crc").unlink(missing_ok=True)


def test_one_language_opens_no_file_of_another(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, "swa", "ab")
    land(spark, root, "som", "cd")
    land(spark, root, "som", "e", corpus="other")
    spoil(tmp_path, "corpus=c/split=train/language=swa")
    spoil(tmp_path, "corpus=other/split=train/language=som")
    (tmp_path / "corpus=c/split=train/language=swa/part-new.parquet").write_bytes(b"never opened")
    assert keys(spark, root, "som") == ["c", "d"]
    assert keys(spark, root, "xho") == [] and keys(spark, str(tmp_path / "none"), "swa") == []


@pytest.mark.parametrize("language", ["a=b", "50%", "x*", "{s", "[q]", "s w", "a/b", "zh:TW"])
def test_partition_values_of_any_kind(spark, tmp_path, language):
    land(spark, str(tmp_path), language, "ab")
    land(spark, str(tmp_path), "xx", "c")
    assert keys(spark, str(tmp_path), language) == ["a", "b"]


def test_known_footers_are_not_opened(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, "swa", "ab")
    land(spark, root, "som", "cd")
    spoil(tmp_path, "corpus=c/split=train/language=swa")
    assert C.file_types(spark, root, ["clip_key"]).filter("error is not null").count() == 0
    assert {tuple(r.types) for r in C.file_types(spark, root, ["clip_key", "audio_size", "none"]).collect()} == {("string", "bigint", None)}
    (file,) = list((tmp_path / "corpus=c/split=train/language=swa").glob("*.parquet"))[:1]
    os.utime(file, (1, 1))  # another file by the same name
    assert [r.path.endswith(file.name) for r in C.file_types(spark, root, []).filter("error is not null").collect()] == [True]


def test_entries_are_added_once(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, "swa", "ab")
    entries = lambda: C._entries(spark, root).count()
    folders = lambda: len(list((tmp_path / C.CATALOGUE).iterdir()))
    files = entries()
    C.update_catalogue(spark, root)
    assert (entries(), folders()) == (files, 1)
    (tmp_path / C.CATALOGUE / "died/_temporary/0").mkdir(parents=True)
    land(spark, root, "som", "c")
    assert (entries(), folders()) == (files + 1, 3)
    before = T.read_lake(spark, root, ["text", "language"]).collect()
    again = next(p for p in (tmp_path / C.CATALOGUE).iterdir() if list(p.glob("*.parquet")))
    (tmp_path / C.CATALOGUE / "twice").mkdir()
    for part in again.glob("*.parquet"):  # two jobs that added the same files
        (tmp_path / C.CATALOGUE / "twice" / part.name).write_bytes(part.read_bytes())
    assert entries() == files + 1 and sorted(T.read_lake(spark, root, ["text", "language"]).collect()) == sorted(before)


def test_files_of_other_types_and_without_one(spark, tmp_path):
    root = tmp_path / "set"
    root.mkdir()
    pq.write_table(pa.table({"id": [1, 2], "odd": pa.array([b"1" * 4] * 2, pa.binary(4))}), root / "a.parquet")
    pq.write_table(pa.table({"id": ["x"]}), root / "b.parquet")
    pq.write_table(pa.table({"id": [1], "more": ["m"]}), root / "c.parquet")
    (root / "d.parquet").write_bytes(b"garbage")
    found = {r.path.rsplit("/", 1)[1]: (r.types, r.error is None) for r in C.file_types(spark, str(root), ["id"]).collect()}
    assert found == {"a.parquet": (["bigint"], True), "b.parquet": (["string"], True), "c.parquet": (["bigint"], True), "d.parquet": (None, False)}
    C.update_catalogue(spark, str(root))
    with pytest.warns(UserWarning, match="1 unreadable"):
        rows = T.read_typed(spark, str(root), {"id": "string"})
    assert sorted(r.id for r in rows.collect()) == ["1", "1", "2", "x"]
    assert rows.filter(F.col("id") == "x").count() == 1


def test_merging_keeps_what_is_there(spark, tmp_path):
    root = str(tmp_path)
    C.merge_catalogue(spark, root)
    for i, language in enumerate(("swa", "som", "som")):
        land(spark, root, language, str(i))
    (gone,) = (tmp_path / "corpus=c/split=train/language=swa").glob("*.parquet")
    gone.unlink()
    left = sorted(r.path for r in C._entries(spark, root).collect() if not r.path.endswith(gone.name))
    C.merge_catalogue(spark, root)
    assert sorted(r.path for r in C._entries(spark, root).collect()) == left and len(left) == 2
    assert len(list((tmp_path / C.CATALOGUE).iterdir())) == 1
