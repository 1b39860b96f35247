"""Compaction of small files: rows stay, files are large enough, and no reader sees a row twice or not at all."""

from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from speechlake.operators.audio import to_int8_list
from speechlake.sources import compaction as C
from speechlake.sources import tables as T

COLUMNS = ["text", "audio_bytes", "language", "split", "corpus", "audio_size"]


def rows(spark, start, end, parts):
    frame = spark.range(start, end, numPartitions=parts)
    return frame.select(
        F.concat(F.lit("t"), "id").alias("text"), F.col("id").cast("string").cast("binary").alias("audio_bytes"),
        F.when(F.col("id") % 10 > 0, "swa").otherwise("a b%").alias("language"), F.lit("train").alias("split"), F.lit("c").alias("corpus"),
        F.col("id").alias("audio_size"), F.concat(F.lit("k"), "id").alias("clip_key"),
    )


def lake(spark, tmp_path):
    """900 rows of one language and 100 of another in many small files, one large file, and a few rows of another type."""
    root = str(tmp_path / "lake")
    for start in (0, 300, 600):
        T.write_lake(rows(spark, start, start + 300, 6), root, spread=False)
    T.write_lake(rows(spark, 900, 1000, 1), root, spread=False)
    T.write_lake(to_int8_list(rows(spark, 1000, 1020, 2)), root, spread=False)
    return root


def seen(spark, root):
    found = T.read_lake(spark, root, COLUMNS)
    return Counter((r.text, bytes(r.audio_bytes), r.language, r.audio_size) for r in found.collect())


def sizes(root):
    out = {}
    for path in Path(root).glob("corpus=*/split=*/language=*/*.parquet"):
        out.setdefault(path.parent.name, []).append(pq.read_metadata(path).num_rows)
    return out


def test_pack_files():
    assert C.pack_files([("a", 4), ("b", 4), ("c", 4), ("d", 9), ("e", 3)], 8) == [["a", "b"], ["c", "d", "e"]]
    assert C.pack_files([("a", 4)], 8) == [] and C.pack_files([], 8) == []
    assert C.pack_files([("a", 1), ("b", 2)], 8) == [["a", "b"]]


def test_small_files_are_packed(spark, tmp_path):
    root = lake(spark, tmp_path)
    before, files = seen(spark, root), sizes(root)
    assert len(before) == 1020
    gone = C.compact_lake(spark, root, min_rows=200)
    assert seen(spark, root) == before
    after = sizes(root)
    # Binary files: 200 rows or more each; those of the other type are one file in each partition.
    assert sorted(len(v) for v in after.values()) == [2, 5]
    assert all(sum(n < 200 for n in v) <= 2 for v in after.values()) and gone == sum(map(len, files.values())) - 7
    assert max(pq.read_metadata(p).row_group(0).num_rows for p in Path(root).glob("*/*/*/*.parquet")) <= T.ROW_GROUP_ROWS
    assert T.landed_keys(spark, root, "c", "swa").count() == 918
    assert C.compact_lake(spark, root, min_rows=200) == 0 and sizes(root) == after
    T.write_lake(rows(spark, 2000, 2040, 4), root, spread=False)  # what comes later is packed later
    assert C.compact_lake(spark, root, min_rows=200) > 0
    assert sum(seen(spark, root).values()) == 1060


class Died(Exception):
    pass


@pytest.mark.parametrize("step", ["_move", "_commit", "clean_up", "half"])
def test_a_run_that_dies(spark, tmp_path, monkeypatch, step):
    """Wherever a run dies, readers see every row once, and the next run brings the lake in order."""
    root = lake(spark, tmp_path)
    before = seen(spark, root)
    real, calls = getattr(C, "clean_up" if step == "half" else step), []

    def dies(*args):
        calls.append(args)
        if step == "clean_up" and len(calls) == 1:  # the one at the start of the run
            return real(*args)
        if step == "half":
            if len(calls) == 1:
                return real(*args)
            old = sorted(Path(root).glob("corpus=*/split=*/language=*/part-*.parquet"))
            for path in old[: len(old) // 2]:
                path.unlink()
        raise Died

    with monkeypatch.context() as patch:
        patch.setattr(C, "clean_up" if step == "half" else step, dies)
        with pytest.raises(Died):
            C.compact_lake(spark, root, min_rows=200)
    assert seen(spark, root) == before
    assert T.landed_keys(spark, root, "c", "swa").count() == 918
    C.compact_lake(spark, root, min_rows=200)
    assert seen(spark, root) == before
    assert sorted(len(v) for v in sizes(root).values()) == [2, 5]
    assert not list(Path(root).glob(f"{C.LEDGER}/*.txt")) and not Path(root, C.WORK).exists()
