import os

import pytest
from fixtures import archive, entry, manifest
from pyspark.sql import functions as F

from speechlake.operators.join import join_audio
from speechlake.operators.project import drop_unlabeled, resolve_code
from speechlake.sources import corpora as C
from speechlake.sources import tables as T


def test_list_shards(spark, tmp_path):
    for name in ("b_dev/manifest_1.jsonl", "b_dev/manifest_10.jsonl", "b_dev/manifest_2.jsonl", "a_train/manifest_3.json", "a_train/other.json"):
        manifest(tmp_path / name, [])

    def names(**kw):
        return [r.path.split("/", 1)[1].removeprefix(str(tmp_path)[1:] + "/") for r in C.list_shards(spark, str(tmp_path), **kw).collect()]

    assert names() == ["a_train/manifest_3.json", "b_dev/manifest_1.jsonl", "b_dev/manifest_10.jsonl", "b_dev/manifest_2.jsonl"]
    assert names(folders=["b_dev", "a_train"], max_shards=2) == ["b_dev/manifest_1.jsonl", "b_dev/manifest_10.jsonl"]
    assert names(folders=["b_dev", "a_train"], max_shards=1, per_folder=True) == ["b_dev/manifest_1.jsonl", "a_train/manifest_3.json"]


def test_read_manifest(spark, tmp_path):
    manifest(tmp_path / "s/manifest_1.jsonl", [entry("a", "x", more=1), "", "   ", entry("b", None), entry("c", ""), entry("d", " "), "{broken", entry("e", "ñ\nq")])
    manifest(tmp_path / "s/manifest_2.json", [entry("a", "y")])
    df = C.read_manifest(spark, str(tmp_path))
    rows = df.orderBy("path", "line_block", "line_id").collect()
    assert [(r.shard.rsplit("/", 1)[1], r.member, r.transcription) for r in rows] == [
        ("1", "a", "x"), ("1", "b", None), ("1", "c", ""), ("1", "d", " "), ("1", None, None), ("1", "e", "ñ\nq"), ("2", "a", "y"),
    ]
    assert [r.member for r in rows if r.error] == [None]
    assert [r.member for r in drop_unlabeled(df).orderBy("path", "line_id").collect()] == ["a", "d", "e", "a"]


def test_manifest_order_holds_over_splits(spark, tmp_path):
    manifest(tmp_path / "manifest_1.jsonl", [entry(f"c{i:05d}", "x" * 50) for i in range(5000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    try:
        df = C.read_manifest(spark, str(tmp_path))
        assert df.select("line_block").distinct().count() > 3
        rows = df.orderBy("line_block", "line_id").select("member").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.member for r in rows] == [f"c{i:05d}" for i in range(5000)]


def test_archives(spark, tmp_path):
    archive(tmp_path / "s/audio/audio_1.tar.xz", [("clips/a.wav", b"old"), ("b.wav", b"bb"), ("x/a.wav", b"new"), ("c.wav", b"cc")])
    archive(tmp_path / "s/audio/audio_2.tar.xz", [("a.wav", b"2a")])
    archive(tmp_path / "s/audio/audio_3.tar.xz", [(f"{i}.wav", os.urandom(5000)) for i in range(50)], cut=20_000)
    manifest(tmp_path / "s/manifest_1.jsonl", [entry("a.wav", "A"), entry("b.wav", None), entry("gone.wav", "G")])
    manifest(tmp_path / "s/manifest_2.jsonl", [entry("a.wav", None)])
    labeled = drop_unlabeled(C.read_manifest(spark, str(tmp_path)))
    listing = C.archive_listing(spark, str(tmp_path))
    members = C.read_archives(listing, labeled)
    assert {r.shard.rsplit("/", 1)[1] for r in members.collect()} == {"1"}  # nothing labeled in 2 and 3
    joined = join_audio(labeled, members).collect()
    assert [(r.member, r.transcription, bytes(r.raw)) for r in joined] == [("a.wav", "A", b"new")]
    everything = C.read_archives(listing)
    assert everything.filter("archive_error is not null").select("shard").collect()[0].shard.endswith("/3")
    assert everything.filter("archive_error is null and shard like '%/1'").count() == 3
    assert 30 < everything.filter("archive_error is null and shard like '%/3'").count() < 50


def test_lake(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = [(f"t{i}", bytes([i % 256]) * 3, "swa" if i % 2 else "som", "train", "c", i) for i in range(1500)]
    df = spark.createDataFrame(rows, "text string, audio_bytes binary, language string, split string, corpus string, audio_size bigint")
    T.write_lake(df, root)
    T.write_lake(df.filter("audio_size < 10").withColumn("split", F.lit("007")), root)
    (tmp_path / "lake/corpus=c/split=train/language=swa/part-bad.parquet").write_bytes(b"garbage")
    lake = T.read_lake(spark, root, ["text", "audio_size", "split", "language", "corpus"])
    assert lake.count() == 1510
    assert {r.split for r in lake.select("split").distinct().collect()} == {"train", "007"}
    plan = lake.filter("split = 'train'").select("language", "audio_size")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<audio_size:bigint>" in plan and "PartitionFilters: [isnotnull(split" in plan

    import pyarrow.parquet as pq

    part = next(p for p in (tmp_path / "lake/corpus=c/split=train/language=som").glob("*.parquet"))
    meta = pq.ParquetFile(part).metadata
    assert max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= 100

    T.register_dataset(spark, "speech_test", root)
    try:
        assert T.open_dataset(spark, "speech_test").count() == 1510
    finally:
        spark.sql("drop table speech_test")
    with pytest.raises(ValueError, match="MIXTURE_PARQUET"):
        T.open_dataset(spark, "speech_test", "CSV")
    manifest(tmp_path / "m/manifest_1.jsonl", [entry("a", "x"), entry("b", None)])
    archive(tmp_path / "m/audio/audio_1.tar.xz", [("a", b"aa"), ("b", b"bb")])
    assert [(r.transcription, bytes(r.raw)) for r in T.open_dataset(spark, str(tmp_path / "m"), "MANIFEST").collect()] == [("x", b"aa")]


def test_lake_written_as_int8_lists(spark, tmp_path):
    from speechlake.operators.audio import to_binary, to_int8_list

    df = spark.createDataFrame([("t", b"\x01\xff", "swa")], "text string, audio_bytes binary, language string")
    to_int8_list(df).write.parquet(str(tmp_path / "l"))
    back = spark.read.parquet(str(tmp_path / "l"))
    assert dict(back.dtypes)["audio_bytes"] == "array<tinyint>"
    assert bytes(to_binary(back).first().audio_bytes) == b"\x01\xff"


def test_testset(spark, tmp_path):
    schema = "id string, language string, audio struct<bytes: binary>"
    for name, rows in {"swa/a/test_0.parquet": [("007", "swa", (b"x",)), ("8", "swa", (b"y",))], "kik/test_1.parquet": [("8", "kik", (b"z",))], "kik/train_1.parquet": [("9", "kik", (b"q",))]}.items():
        out = tmp_path / "w"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(str(out))
        target = tmp_path / "set" / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(next(out.glob("*.parquet")).read_bytes())
    (tmp_path / "set/swa/test_bad.parquet").write_bytes(b"garbage")
    root = str(tmp_path / "set")
    clips = T.read_testset(spark, root).orderBy("file", "row").collect()
    assert [(r.id, bytes(r.audio_bytes)) for r in clips] == [("8", b"z"), ("007", b"x"), ("8", b"y")]
    ids = T.read_ids(spark, root)
    assert "audio" not in ids._jdf.queryExecution().executedPlan().toString()
    skipped = T.unreadable_files(spark, root, "test_*.parquet").collect()
    assert [r.path.rsplit("/", 1)[1] for r in skipped] == ["test_bad.parquet"]


def test_csv_and_tsv(spark, tmp_path):
    rows = [("001", "swa", "..."), ("2", "som", "NA"), ("3", "som", ' a "quoted", x\ny '), ("4", "kik", "null")]
    df = spark.createDataFrame(rows, "id string, language string, transcription string")
    T.write_submission(df.select("transcription", "id", "language"), str(tmp_path / "s"), files=1)
    assert next((tmp_path / "s").glob("*.csv")).read_text().splitlines()[0] == "id,language,transcription"
    assert sorted(T.read_submission(spark, str(tmp_path / "s")).collect()) == sorted(rows)
    stats = spark.createDataFrame([("c", "swa", 1.5), ("c", "som", 0.0)], "corpus string, language string, hours double")
    for _ in range(2):
        T.write_stats(stats, str(tmp_path / "t"))
    assert next((tmp_path / "t").glob("*.csv")).read_text().splitlines()[0] == "corpus\tlanguage\thours"
    assert sorted(T.read_stats(spark, str(tmp_path / "t")).collect()) == sorted(stats.collect())


def test_transcripts_keep_lines_paired(spark, tmp_path):
    pairs = spark.range(5000).select(
        F.col("id").cast("string").alias("utt_id"), F.concat(F.lit("r\n"), "id").alias("ref"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("h "), "id")).alias("hyp")
    ).repartition(5)
    T.write_transcripts(pairs, str(tmp_path / "t"))

    def lines(side):
        return [line for p in sorted((tmp_path / "t" / side).glob("part-*")) for line in p.read_text().splitlines()]

    refs, hyps = lines("ref"), lines("hyp")
    assert len(refs) == len(hyps) == 5000
    assert all(h == ("" if int(r[2:]) % 7 == 0 else "h " + r[2:]) for r, h in zip(refs, hyps))


def test_resolve_code():
    mapping = {"org/Kiswahili": "swa", "org/Dho": "luo"}
    assert resolve_code("ORG/kiswahili", mapping) == resolve_code("KISWAHILI", mapping) == "swa"
    with pytest.raises(ValueError, match="choose from"):
        resolve_code("nope", mapping)
    with pytest.raises(ValueError, match="several"):
        resolve_code("x", {"a/x": "1", "b/x": "2"})


def test_lake_of_mixed_types(spark, tmp_path):
    from speechlake.operators.audio import to_int8_list

    root = str(tmp_path / "lake")
    one = spark.createDataFrame([("a", b"\x01", "swa", "train", "c", 5)], "text string, audio_bytes binary, language string, split string, corpus string, audio_size bigint")
    T.write_lake(one, root)
    T.write_lake(to_int8_list(one.withColumns({"text": F.lit("b"), "audio_size": F.lit(7.0)})), root)
    T.write_lake(one.withColumns({"text": F.lit("c"), "audio_size": F.lit(float("nan"))}), root)
    rows = T.read_lake(spark, root, ["corpus", "language", "text", "audio_size"]).collect()
    assert sorted((r.text, r.audio_size) for r in rows if r.text != "c") == [("a", 5), ("b", 7)] and len(rows) == 3
    assert sorted((r.text, bytes(r.audio_bytes)) for r in T.read_lake(spark, root).collect()) == [("a", b"\x01"), ("b", b"\x01"), ("c", b"\x01")]


def test_ids_of_any_type(spark, tmp_path):
    audio = F.struct(F.lit(b"x").alias("bytes"), F.lit("p").alias("path")).alias("audio")
    for folder, ids in (("number", F.col("id")), ("text", F.lpad(F.col("id").cast("string"), 3, "0"))):
        spark.range(3).select(ids.alias("id"), F.lit("swa").alias("language"), audio).write.parquet(str(tmp_path / "s p" / folder))
    ids = T.read_ids(spark, str(tmp_path / "s p"), "part-*.parquet")
    assert sorted(r.id for r in ids.collect()) == ["0", "000", "001", "002", "1", "2"] and ids.count() == 6
    clips = T.read_testset(spark, str(tmp_path / "s p"), "part-*.parquet").collect()
    assert len(clips) == 6 and all(bytes(r.audio_bytes) == b"x" and "/s p/" in r.file for r in clips)


@pytest.mark.parametrize("name", ["with space", "100%", "a+b", "plain", "a%20b"])
def test_any_folder_name(spark, tmp_path, name):
    manifest(tmp_path / name / "manifest_1.jsonl", [entry("a.wav", "A")])
    archive(tmp_path / name / "audio/audio_1.tar.xz", [("a.wav", b"aa")])
    labeled = C.read_manifest(spark, str(tmp_path))
    joined = join_audio(labeled, C.read_archives(C.archive_listing(spark, str(tmp_path)), labeled)).collect()
    assert [(r.member, r.transcription, bytes(r.raw)) for r in joined] == [("a.wav", "A", b"aa")]
    assert C.missing_archives(C.archive_listing(spark, str(tmp_path)), labeled).count() == 0


def test_unlisted_members_do_not_leave_the_task(spark, tmp_path):
    archive(tmp_path / "s/audio/audio_1.tar.xz", [(f"{i}.wav", b"x") for i in range(50)])
    manifest(tmp_path / "s/manifest_1.jsonl", [entry("7.wav", "A"), entry("8.wav", None), entry("gone.wav", "G")])
    members = C.read_archives(C.archive_listing(spark, str(tmp_path)), drop_unlabeled(C.read_manifest(spark, str(tmp_path))))
    assert [r.member for r in members.collect()] == ["7.wav"]
