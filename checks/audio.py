"""Waveforms and audio jobs, on the embedding vectors as short waves."""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from checks.registry import check, table
from speechlake.functions import wave as V
from speechlake.operators import audio as U
from speechlake.operators.project import drop_failed
from speechlake.operators.quality import complete_submission
from speechlake.operators.udf import map_batches, transcribe
from speechlake.plans.submission import transcribe_clips


def _waves(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("wave"))


def _samples(df, wave="wave", digits=6, name="value"):
    return df.select("vec_id", F.posexplode(wave).alias("i", "_x")).select(
        "vec_id", F.col("i").cast("bigint").alias("i"), F.round(F.col("_x").cast("double"), digits).alias(name)
    )


@check(
    "u2_to_mono",
    """with i as (select vec_id, embedding as e, unnest(generate_series(0, 31)) as i from embeddings)
    select vec_id, i, round(((e[i + 1]::double + e[i + 33]::double) / 2)::float::double, 5) as wide,
    round(((e[i + 1]::double + e[i + 33]::double) / 2)::float::double, 5) as tall from i""",
)
def to_mono(spark, sf):
    e = F.col("wave")
    wide = F.array(F.slice(e, 1, 32), F.slice(e, 33, 32))
    tall = F.transform(F.sequence(F.lit(1), F.lit(32)), lambda i: F.array(F.element_at(e, i), F.element_at(e, i + 32)))
    both = _waves(spark, sf).select("vec_id", F.arrays_zip(V.to_mono(wide).alias("w"), V.to_mono(tall).alias("t")).alias("z"))
    rows = both.select("vec_id", F.posexplode("z").alias("i", "z"))
    return rows.select(
        "vec_id",
        F.col("i").cast("bigint").alias("i"),
        F.round(F.col("z.w").cast("double"), 5).alias("wide"),
        F.round(F.col("z.t").cast("double"), 5).alias("tall"),
    )


@check("u4_valid_wave", "select vec_id, label > 3 as valid from embeddings")
def valid_wave(spark, sf):
    odd = (
        F.when(F.col("label") == 1, F.slice("wave", 1, 0))
        .when(F.col("label") == 2, F.concat("wave", F.array(F.lit(float("nan")).cast("float"))))
        .when(F.col("label") == 3, F.concat("wave", F.array(F.lit(float("-inf")).cast("float"))))
        .otherwise(F.col("wave"))
    )
    # The label is the rate too, so label 0 has none.
    waves = _waves(spark, sf).withColumn("wave", odd)
    return waves.select("vec_id", V.valid_wave("wave", "label").isNotNull().alias("valid"))


@check("u6_audio_size", "select vec_id, len(embedding) as audio_size, len(embedding) / 16000 as seconds from embeddings")
def audio_size(spark, sf):
    sized = _waves(spark, sf).select("vec_id", V.audio_size("wave").alias("audio_size"))
    return sized.withColumn("seconds", V.duration_s("audio_size"))


@check(
    "u8_normalize_wave",
    """with x as (select vec_id, unnest(generate_series(0, 63)) as i, unnest(embedding)::double as x from embeddings),
    m as (select vec_id, avg(x) as mean, var_pop(x) as variance from x group by vec_id)
    select vec_id, i, round(((x - mean) / sqrt(variance + 1e-5))::float::double, 3) as value from x join m using (vec_id)""",
)
def normalize_wave(spark, sf):
    return _samples(_waves(spark, sf).withColumn("wave", V.normalize_wave("wave")), digits=3)


# 16-bit samples of a wave, as they come back from a WAV file.
_PCM = """pcm as (select vec_id, label, list_transform(embedding,
    lambda x: greatest(least(round_even(x::double * 32767, 0), 32767), -32768) / 32768) as wave from embeddings)"""


@check(
    "u1_u5_wav_round_trip",
    f"with {_PCM} select vec_id, unnest(generate_series(0, 63)) as i, round(unnest(wave)::float::double, 6) as value from pcm",
)
def round_trip(spark, sf):
    clips = U.encode_waves(_waves(spark, sf).select("vec_id", "wave", F.lit(16_000).alias("sample_rate")))
    return _samples(U.decode_audio(clips))


@check(
    "u3_resample",
    f"""with {_PCM}, k as (select unnest(generate_series(0, 27)) as k),
    t as (select k, greatest(least((k - 13) / 2 * 0.99, 6), -6) as t from k),
    w as (select k, case when t = 0 then 1 else sin(pi() * t) / (pi() * t) end * pow(cos(t * pi() / 12), 2) * 0.99 / 2 as w from t),
    j as (select vec_id, wave, unnest(generate_series(0, 31)) as i from pcm)
    select vec_id, i, round(sum(w * wave[2 * i + k - 12])::float::double, 4) as value
    from j join w on 2 * i + k - 12 between 1 and 64 group by vec_id, i""",
)
def resample(spark, sf):
    clips = U.encode_waves(_waves(spark, sf).select("vec_id", "wave", F.lit(32_000).alias("sample_rate")))
    return _samples(U.decode_audio(clips), digits=4)


def _mixed_clips(spark, sf):
    """WAV bytes, but label 0 has none and label 1 has noise."""
    clips = U.encode_waves(_waves(spark, sf).select("vec_id", "label", "wave", F.lit(16_000).alias("sample_rate")))
    audio = F.when(F.col("label") > 1, F.col("audio_bytes")).when(F.col("label") == 1, F.lit("noise").cast("binary"))
    return clips.withColumn("audio_bytes", audio)


@check("u9_ingest_audio", "select vec_id, 64::bigint as audio_size, (64 * 2 + 44)::bigint as bytes from embeddings where label > 1")
def ingest_audio(spark, sf):
    good = drop_failed(U.ingest_audio(U.to_int8_list(_mixed_clips(spark, sf))))
    return good.select("vec_id", "audio_size", F.length("audio_bytes").cast("bigint").alias("bytes"))


@check("u9_ingest_resampled", "select vec_id, 32000::bigint as audio_size, (32000 * 2 + 44)::bigint as bytes from embeddings")
def ingest_resampled(spark, sf):
    """Clips of two seconds at 48 kHz: each vector over and over."""
    long = F.flatten(F.array_repeat("wave", 1500))
    spread = _waves(spark, sf).repartition(spark.sparkContext.defaultParallelism)  # the vectors fit one task, the clips do not
    clips = U.encode_waves(spread.select("vec_id", long.alias("wave"), F.lit(48_000).alias("sample_rate")))
    good = drop_failed(U.ingest_audio(clips))
    return good.select("vec_id", "audio_size", F.length("audio_bytes").cast("bigint").alias("bytes"))


@check(
    "u9_failed_clips",
    """select vec_id, case label when 0 then 'no audio' else 'wav' end as reason from embeddings where label <= 1""",
)
def failed_clips(spark, sf):
    failed = U.ingest_audio(_mixed_clips(spark, sf)).filter(F.col("error").isNotNull())
    return failed.select("vec_id", F.substring_index("error", ":", 1).alias("reason"))


@check(
    "u7_byte_views",
    """select doc_id, octet_length(encode(text)) as size,
    octet_length(encode(text)) - length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) as negative, md5(text) as back_md5 from documents""",
)
def byte_views(spark, sf):
    clips = table(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("audio_bytes"))
    # Bytes that are not ASCII are negative numbers in the signed view.
    lists = U.to_int8_list(clips).withColumns(
        {
            "size": F.size("audio_bytes").cast("bigint"),
            "negative": F.size(F.filter("audio_bytes", lambda x: x < 0)).cast("bigint"),
        }
    )
    return U.to_binary(lists).select("doc_id", "size", "negative", F.md5("audio_bytes").alias("back_md5"))


def text_lengths(factor):
    """A batch function that is built once per task."""

    def run(batch):
        lengths = pc.multiply(pc.cast(pc.utf8_length(batch.column(1)), pa.int64()), factor)
        return pa.RecordBatch.from_arrays([batch.column(0), lengths], names=["doc_id", "samples"])

    return run


@check("f1_map_batches", "select doc_id, length(text) * 160 as samples from documents")
def batches(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return map_batches(docs, text_lengths, "doc_id bigint, samples bigint", factor=160)


def peak_model():
    """Stands in for a speech model: names the place of the highest sample."""
    return lambda waves: [f"peak {w.argmax()}" for w in waves]


@check(
    "f4_transcribe",
    "select vec_id, 'peak ' || (list_position(embedding, list_max(embedding)) - 1) as text from embeddings",
)
def transcribed(spark, sf):
    return transcribe(_waves(spark, sf).select("vec_id", "wave"), peak_model)


@check(
    "f5_build_submission",
    f"""with {_PCM} select vec_id::varchar as id, 'swa' as language,
    case when label > 1 then 'peak ' || (list_position(wave, list_max(wave)) - 1) else '...' end as transcription from pcm""",
)
def build_submission(spark, sf):
    clips = _mixed_clips(spark, sf).select(
        F.col("vec_id").cast("string").alias("id"), F.lit("swa").alias("language"), F.lit("f").alias("file"),
        F.col("vec_id").alias("row"), "audio_bytes",
    )
    texts = transcribe_clips(clips, peak_model).filter(F.col("status") == "transcribed")
    return complete_submission(texts, clips.select("id", "language", "file", "row"), ["file", "row"])
