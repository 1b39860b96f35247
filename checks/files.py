"""Sinks and sources: the given tables written to the shared scratch folder and read back."""

import io
import tarfile

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import functions as F

from checks.registry import check, table
from checks.text import _normalize_sql
from speechlake.functions.text import normalize_text
from speechlake.operators.aggregate import language_hours
from speechlake.operators.audio import encode_waves, to_int8_list
from speechlake.operators.join import join_audio
from speechlake.operators.project import drop_unlabeled
from speechlake.plans.ingest import ingest_clips, ingest_manifests, ingest_once
from speechlake.session import hadoop_path, scratch_path
from speechlake.sources import tables as T
from speechlake.sources.compaction import compact_lake
from speechlake.sources.corpora import archive_listing, missing_archives, read_archives, read_clips, read_manifest
from speechlake.sources.files import folder, plain_path
from speechlake.streaming.pickup import stream_ingest

ARCHIVE_BYTES = 16 << 20


def _lake(spark, sf, small_files=1):
    """The documents as a lake in two appends; each leaves up to ``small_files`` files in a partition."""
    root = scratch_path(spark, "lake")
    docs = table(spark, sf, "documents").select(
        "text",
        F.col("text").cast("binary").alias("audio_bytes"),
        F.col("n_chars").alias("audio_size"),
        F.col("lang").alias("language"),
        F.when(F.col("lang") == "en", "train").otherwise("dev").alias("split"),
        F.lit("corpus_a").alias("corpus"),
    )
    for part in (docs.filter("audio_size < 1000"), docs.filter("audio_size >= 1000")):
        if small_files == 1:
            T.write_lake(part, root)
        else:
            T.write_lake(part.repartition(small_files), root, spread=False)
    return root


@check(
    "k1_s6_lake",
    """select text, md5(text) as audio_md5, lang as language, case when lang = 'en' then 'train' else 'dev' end as split,
    'corpus_a' as corpus, n_chars as audio_size from documents""",
)
def lake(spark, sf):
    return T.read_lake(spark, _lake(spark, sf)).withColumn("audio_md5", F.md5("audio_bytes")).drop("audio_bytes")


@check(
    "k1_compacted_lake",
    """select text, md5(text) as audio_md5, lang as language, case when lang = 'en' then 'train' else 'dev' end as split,
    'corpus_a' as corpus, n_chars as audio_size from documents""",
)
def compacted(spark, sf):
    """The lake in many small files, packed into files of 200 rows and more."""
    root = _lake(spark, sf, small_files=8)
    compact_lake(spark, root, min_rows=200)
    return T.read_lake(spark, root).withColumn("audio_md5", F.md5("audio_bytes")).drop("audio_bytes")


@check(
    "k2_s11_stats",
    "select 'corpus_a' as corpus, lang as language, round(sum(n_chars) / 3600 / 16000, 9) as hours from documents group by lang",
)
def stats(spark, sf):
    path = scratch_path(spark, "stats")
    T.write_stats(language_hours(T.read_lake(spark, _lake(spark, sf), ["corpus", "language", "audio_size"])), path)
    return T.read_stats(spark, path).withColumn("hours", F.round("hours", 9))


@check(
    "k3_s9_submission",
    f"select doc_id::varchar as id, lang as language, {_normalize_sql('text')} as transcription from documents",
)
def submission(spark, sf):
    path = scratch_path(spark, "submission")
    docs = table(spark, sf, "documents")
    T.write_submission(
        docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("language"), normalize_text("text").alias("transcription")), path
    )
    return T.read_submission(spark, path)


@check(
    "k3_s9_raw_texts",
    "select doc_id::varchar as id, lang as language, '\" ' || text || chr(10) || ' , \"\"x' as transcription from documents",
)
def raw_texts(spark, sf):
    path = scratch_path(spark, "submission")
    text = F.concat(F.lit('" '), "text", F.lit('\n , ""x'))
    docs = table(spark, sf, "documents")
    T.write_submission(docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("language"), text.alias("transcription")), path)
    return T.read_submission(spark, path)


@check(
    "s1_read_manifest",
    "select doc_id::varchar as member, text as transcription, lang as locale from documents join labels using (doc_id) where quality = 1",
)
def manifest(spark, sf):
    path = scratch_path(spark, "manifest")
    text = F.when(F.col("quality") == 1, F.col("text")).when(F.col("quality") == 0, "")
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    line = F.to_json(F.struct(F.col("doc_id").cast("string").alias("audio_filepath"), text.alias("transcription"), F.col("lang").alias("locale")))
    docs.select(line.alias("value"), "source").write.partitionBy("source").text(path)
    return drop_unlabeled(read_manifest(spark, path, "*.txt")).select("member", "transcription", "locale")


@check(
    "s5_read_clips",
    """select split, text as transcription, lang as language, md5(text) as audio_md5
    from (select *, case when lang = 'en' then 'train' else 'validation' end as split from documents)""",
)
def clips(spark, sf):
    path = scratch_path(spark, "clips")
    audio = F.struct(F.col("text").cast("binary").alias("bytes"), F.lit(None).cast("string").alias("path"))
    docs = table(spark, sf, "documents").select(
        F.col("text").alias("transcription"), F.col("lang").alias("language"), F.lit("own").alias("split"), audio.alias("audio")
    )
    docs.filter("language = 'en'").write.parquet(f"{path}/train")
    docs.filter("language <> 'en'").write.parquet(f"{path}/validation")
    parts = [read_clips(spark, path, split).withColumn("split", F.lit(split)) for split in ("train", "validation")]
    return parts[0].unionByName(parts[1]).select("split", "transcription", "language", F.md5("audio.bytes").alias("audio_md5"))


def _testset(spark, sf):
    """The embeddings as WAV clips in nested folders."""
    path = scratch_path(spark, "testset")
    waves = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), F.concat(F.lit("l"), "label").alias("language"), "label",
        F.col("embedding").alias("wave"), F.lit(16_000).alias("sample_rate"),
    )
    encoded = encode_waves(waves).select("id", "language", F.struct(F.col("audio_bytes").alias("bytes")).alias("audio"), "label")
    encoded.write.partitionBy("label").parquet(f"{path}/nested")
    return path


@check("s7_read_testset", "select vec_id::varchar as id, 'l' || label as language, (44 + 2 * 64)::bigint as bytes from embeddings")
def testset(spark, sf):
    clips = T.read_testset(spark, _testset(spark, sf), "part-*.parquet")
    return clips.select("id", "language", F.length("audio_bytes").cast("bigint").alias("bytes"))


@check("s8_read_ids", "select vec_id::varchar as id, 'l' || label as language from embeddings")
def ids(spark, sf):
    return T.read_ids(spark, _testset(spark, sf), "part-*.parquet").select("id", "language")


_LAKE_TYPES_SQL = """select text, md5(text) as audio_md5, lang as language, 'train' as split, 'corpus_a' as corpus, n_chars as audio_size from documents"""


@check("s6_mixed_types", _LAKE_TYPES_SQL)
def mixed_types(spark, sf):
    """A lake whose files hold sizes as bigint or double, and audio as bytes or signed numbers."""
    root = scratch_path(spark, "lake of 100% types")
    docs = table(spark, sf, "documents").select(
        "text", F.col("text").cast("binary").alias("audio_bytes"), F.col("n_chars").alias("audio_size"), F.col("lang").alias("language"),
        F.lit("train").alias("split"), F.lit("corpus_a").alias("corpus"), "doc_id",
    )
    T.write_lake(docs.filter("doc_id % 3 = 0"), root)
    T.write_lake(docs.filter("doc_id % 3 = 1").withColumn("audio_size", F.col("audio_size").cast("double")), root)
    T.write_lake(to_int8_list(docs.filter("doc_id % 3 = 2")), root)
    return T.read_lake(spark, root).withColumn("audio_md5", F.md5("audio_bytes")).drop("audio_bytes")


@check("s7_s8_bigint_ids", "select vec_id::varchar as id, 'l' || label as language, (44 + 2 * 64)::bigint as bytes from embeddings")
def bigint_ids(spark, sf):
    """Test files that hold ids as numbers or as text, below a folder with a space and a per cent sign."""
    path = scratch_path(spark, "my testset 100%")
    waves = table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("wave"), F.lit(16_000).alias("sample_rate"))
    encoded = encode_waves(waves).select(
        F.col("vec_id").alias("id"), F.concat(F.lit("l"), "label").alias("language"), F.struct(F.col("audio_bytes").alias("bytes")).alias("audio"), "label"
    )
    encoded.filter("label < 5").write.partitionBy("label").parquet(f"{path}/numbers")
    encoded.filter("label >= 5").withColumn("id", F.col("id").cast("string")).write.partitionBy("label").parquet(f"{path}/texts")
    ids = T.read_ids(spark, path, "part-*.parquet")
    clips = T.read_testset(spark, path, "part-*.parquet").select("id", F.length("audio_bytes").cast("bigint").alias("bytes"))
    return ids.select("id", "language").join(clips, "id")


def _wave_clips(spark, sf):
    """The vectors as WAV clips; those of label 0 are cut off, and those of label 1 state a rate no recording has."""
    waves = table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("wave"), F.lit(16_000).alias("sample_rate"))
    data = F.hex("audio_bytes")
    rate = F.concat(F.substring(data, 1, 48), F.lit("FFFFFF7F"), F.expr("substring(hex(audio_bytes), 57)"))
    broken = F.when(F.col("label") == 0, F.substring("audio_bytes", 1, 20)).when(F.col("label") == 1, F.unhex(rate)).otherwise(F.col("audio_bytes"))
    return encode_waves(waves).select(F.col("vec_id").cast("string").alias("transcription"), "label", broken.alias("audio_bytes"))


def _clip_source(spark, sf):
    path = scratch_path(spark, "clips")
    clips = _wave_clips(spark, sf).select(
        "transcription", F.lit("own").alias("language"), F.lit("own").alias("split"), F.struct(F.col("audio_bytes").alias("bytes"), F.lit("p").alias("path")).alias("audio")
    )
    for split in ("train", "validation", "test"):
        clips.filter(F.lit(split == "train")).write.parquet(f"{path}/{split}")
    return path


@check("v2_failed_clips_do_not_stop_a_run", "select vec_id::varchar as text, 64::bigint as audio_size, label > 1 as landed from embeddings")
def many_failures(spark, sf):
    source, out, bad = _clip_source(spark, sf), scratch_path(spark, "lake"), scratch_path(spark, "lost")
    ingest_clips(spark, source, out, "swa", "c", quarantine=bad)
    landed = T.read_lake(spark, out, ["text", "audio_size"])
    keys = read_clips(spark, source, "train").select(F.col("transcription").alias("text"), F.concat(F.lit("train#"), "clip_key").alias("clip_key"))
    lost = spark.read.parquet(bad).join(keys, "clip_key").select("text", F.lit(64).cast("bigint").alias("audio_size"))
    return landed.withColumn("landed", F.lit(True)).unionByName(lost.withColumn("landed", F.lit(False)))


@check("i2_rounds_land_once", "select vec_id::varchar as text, 1::bigint as copies from embeddings where label > 1")
def rounds_land_once(spark, sf):
    """A round that runs twice, an overlapping one, and the rest."""
    source, out = _clip_source(spark, sf), scratch_path(spark, "lake")
    for skip, take in ((0, 100), (0, 100), (50, 100), (100, 0)):
        ingest_clips(spark, source, out, "swa", "c", skip, take)
    return T.read_lake(spark, out, ["text"]).groupBy("text").agg(F.count("*").alias("copies"))


def _manifest_source(spark, sf):
    """Manifests and archives of the vectors, in a folder with a space; half of the lines have no text."""
    system, path = hadoop_path(spark, scratch_path(spark, "my manifests"))
    root = system.makeQualified(path).toString()
    clips = _wave_clips(spark, sf).withColumn("member", F.concat("transcription", F.lit(".wav"))).filter("label > 1")
    packed = clips.select("member", "audio_bytes", "transcription").repartition(3)
    packed.mapInArrow(archive_writer(root, "train/audio"), "path string, member string, transcription string").write.parquet(f"{root}/_lines")
    line = F.to_json(F.struct(F.col("member").alias("audio_filepath"), F.when(F.substring("member", -5, 1).isin(*"02468"), F.col("transcription")).alias("transcription")))
    lines = spark.read.parquet(f"{root}/_lines").select(F.regexp_extract("path", r"audio_(\d+)", 1).alias("shard"), line.alias("value"))
    lines.write.partitionBy("shard").text(f"{root}/_texts")
    for shard in [row.shard for row in lines.select("shard").distinct().collect()]:  # one per archive
        text = hadoop_path(spark, f"{root}/_texts/shard={shard}/part-*")[1]
        for n, status in enumerate(system.globStatus(text)):
            system.rename(status.getPath(), hadoop_path(spark, f"{root}/train/manifest_{shard}.{n}.jsonl")[1])
    return root


_EVEN_SQL = "from embeddings where label > 1 and vec_id % 2 = 0"


@check("s10_open_manifest", f"select vec_id::varchar as transcription, (44 + 2 * 64)::bigint as bytes {_EVEN_SQL}")
def open_manifest(spark, sf):
    clips = T.open_dataset(spark, _manifest_source(spark, sf), "MANIFEST")
    return clips.select("transcription", F.length("raw").cast("bigint").alias("bytes"))


@check(
    "i3_stream_ingest",
    f"select vec_id::varchar as text, language, 64::bigint as audio_size {_EVEN_SQL.replace('from embeddings', "from embeddings, (select unnest(['kik', 'som', 'swa']) as language)")}",
)
def stream_lands_once(spark, sf):
    """Two streams, one of them twice and once more from the start, and a batch job, into one lake."""
    root, out = _manifest_source(spark, sf), scratch_path(spark, "lake")
    for language, checkpoint in (("swa", "a"), ("som", "b"), ("swa", "a"), ("swa", "c")):
        stream_ingest(spark, root, out, f"{out}-{checkpoint}", language, "c", F.lit("train")).awaitTermination()
    ingest_manifests(spark, root, out, "kik", "c", F.lit("train"))
    return T.read_lake(spark, out, ["text", "language", "audio_size"])


@check("i1_v4_ingest_all", f"select source, rows, rerun from (values ('bad', 0, 0), ('clips', (select count(*) from embeddings where label > 1), 0), ('lines', (select count(*) {_EVEN_SQL}), 0)) t(source, rows, rerun)")
def all_sources(spark, sf):
    """Three sources at a time, one of which fails; the lake then has data, so a second call adds nothing."""
    out, clips, lines = scratch_path(spark, "lake"), _clip_source(spark, sf), _manifest_source(spark, sf)
    sources = {
        "clips": lambda: ingest_clips(spark, clips, out, "swa", "c"),
        "lines": lambda: ingest_manifests(spark, lines, out, "som", "c", F.lit("train")),
        "bad": lambda: ingest_manifests(spark, f"{out}-nowhere", out, "kik", "c"),
    }
    first = ingest_once(spark, out, sources, parallel=3).select("source", "rows")
    return first.join(ingest_once(spark, out, sources).select("source", F.col("rows").alias("rerun")), "source")


@check(
    "k4_write_transcripts",
    """select 'ref' as side, regexp_replace(a.text, '\\r\\n|[\\n\\r]', ' ', 'g') as line from benchmark a join benchmark b on b.item_id = a.item_id + 1
    union all select 'hyp', regexp_replace(b.text, '\\r\\n|[\\n\\r]', ' ', 'g') from benchmark a join benchmark b on b.item_id = a.item_id + 1""",
)
def transcripts(spark, sf):
    path = scratch_path(spark, "transcripts")
    items = table(spark, sf, "benchmark")
    refs = items.select(F.col("item_id").alias("utt_id"), F.col("text").alias("ref"))
    hyps = items.select((F.col("item_id") - 1).alias("utt_id"), F.col("text").alias("hyp"))
    T.write_transcripts(refs.join(hyps, "utt_id"), path)
    sides = [spark.read.text(f"{path}/{side}").select(F.lit(side).alias("side"), F.col("value").alias("line")) for side in ("ref", "hyp")]
    return sides[0].unionByName(sides[1])


def archive_writer(root, folder="audio"):
    """Batch function that packs its rows (member, bytes, transcription) into one archive per task and names it in each row.

    Archives are compressed and plain by turns.
    """

    def run(batches):
        task = TaskContext.get().partitionId()
        local = root.startswith("file:")
        system, path = (fs.LocalFileSystem(), "/" + root[5:].lstrip("/")) if local else fs.FileSystem.from_uri(root)
        system.create_dir(f"{path}/{folder}")
        name, mode = (f"{folder}/audio_{task}.tar", "w|") if task % 2 else (f"{folder}/audio_{task}.tar.xz", "w|xz")
        target = f"{root}/{name}"
        with system.open_output_stream(f"{path}/{name}") as stream, tarfile.open(fileobj=stream, mode=mode) as tar:
            for batch in batches:
                for member, last in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for data in (b"earlier copy", last):
                        info = tarfile.TarInfo(f"clips/{member}")
                        info.size = len(data)
                        tar.addfile(info, io.BytesIO(data))
                rows = [pa.array([target] * len(batch)), batch.column(0), batch.column(2)]
                yield pa.RecordBatch.from_arrays(rows, names=["path", "member", "transcription"])

    return run


@check(
    "s3_j1_j2_archives",
    """select doc_id::varchar as member, lang as transcription, md5(text) as audio_md5
    from documents join labels using (doc_id) where quality = 1""",
)
def archives(spark, sf):
    """Documents packed into archives, two members per name; the labeled ones are joined back to their manifest lines."""
    system, path = hadoop_path(spark, scratch_path(spark, "archives"))
    root = system.makeQualified(path).toString()
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("member"), F.col("text").cast("binary"), "lang")
    size = table(spark, sf, "documents").agg(F.sum("n_chars")).first()[0] or 0
    docs = docs.repartition(max(2, size // ARCHIVE_BYTES))
    docs.mapInArrow(archive_writer(root), "path string, member string, transcription string").write.parquet(f"{root}/lines")
    lines = spark.read.parquet(f"{root}/lines").withColumn(
        "shard", F.concat_ws("/", folder(plain_path("path"), 2), F.regexp_extract("path", r"audio_(\d+)", 1))
    )
    labeled = lines.join(
        table(spark, sf, "labels").filter("quality = 1").select(F.col("doc_id").cast("string").alias("member")), "member"
    )
    listing = archive_listing(spark, root)
    clips = join_audio(labeled.drop("path"), read_archives(listing, labeled)).filter("archive_error is null")
    lost = missing_archives(listing, labeled).select("member", F.col("error").alias("transcription"), F.col("error").alias("audio_md5"))
    return clips.select("member", "transcription", F.md5("raw").alias("audio_md5")).unionByName(lost)
