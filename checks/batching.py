"""Chunks, batches and their counters."""

from pyspark.sql import functions as F

from checks.registry import check, hash_sql, table
from checks.sampling import _WEIGHTS
from speechlake.operators import sequence as W
from speechlake.operators.aggregate import batch_stats, language_hours
from speechlake.plans.training import batches


def _clips(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.col("n_chars").alias("audio_size"))


@check(
    "w4_chunk_arrays",
    """with c as (select vec_id, unnest(generate_series(0, 63, 10)) as s, embedding from embeddings)
    select vec_id, s // 10 as chunk_idx, least(10, 64 - s) as size, embedding[s + 1]::double as first_value,
    embedding[least(s + 10, 64)]::double as last_value from c where s = 0 or 64 - s >= 5""",
)
def chunk_arrays(spark, sf):
    chunks = W.chunk_arrays(table(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding", 10, 5)
    return chunks.select(
        "vec_id",
        F.col("chunk_idx").cast("bigint").alias("chunk_idx"),
        F.size("embedding").cast("bigint").alias("size"),
        F.element_at("embedding", 1).cast("double").alias("first_value"),
        F.element_at("embedding", -1).cast("double").alias("last_value"),
    )


@check(
    "w4_chunk_text",
    """with c as (select doc_id, text, unnest(generate_series(0, length(text) - 1, 500)) as s from documents where text <> '')
    select doc_id, s // 500 as chunk_idx, substring(text, (s + 1)::int, 500) as text from c where s = 0 or length(text) - s >= 100""",
)
def chunk_text(spark, sf):
    chunks = W.chunk_text(table(spark, sf, "documents").select("doc_id", "text"), "text", 500, 100)
    return chunks.withColumn("chunk_idx", F.col("chunk_idx").cast("bigint"))


_PACKED = f"""packed as (select doc_id, n_chars as audio_size, bucket,
    ((row_number() over (partition by bucket order by {hash_sql('doc_id', 123)}, doc_id) - 1)
        // greatest(1, 40000 // greatest(bucket, 1)))::bigint as batch_no
    from (select *, (ceil(n_chars / 500) * 500)::bigint as bucket from documents))"""


def _packed(spark, sf):
    return W.pack_batches(_clips(spark, sf), "doc_id", budget=40_000, step=500)


@check("w5_pack_batches", f"with {_PACKED} select doc_id, audio_size, bucket, batch_no from packed")
def pack_batches(spark, sf):
    return _packed(spark, sf)


@check("w6_group_steps", f"with {_PACKED} select doc_id, batch_no // 4 as step from packed")
def group_steps(spark, sf):
    return W.group_steps(_packed(spark, sf), 4).select("doc_id", "step")


@check(
    "a11_batch_stats",
    f"""with {_PACKED} select bucket, batch_no, count(*) as num_examples, sum(audio_size)::bigint as num_elements,
    (count(*) * max(audio_size) - sum(audio_size))::bigint as padding from packed group by all""",
)
def stats(spark, sf):
    return batch_stats(_packed(spark, sf), ["bucket", "batch_no"])


@check(
    "training_batches",
    f"""with {_WEIGHTS}, parts as (select *, floor(weight * 2000) as f, weight * 2000 - floor(weight * 2000) as rest from weights),
    quotas as (select corpus, language, (f + case when row_number() over (order by round(rest, 9) desc, corpus, language)
        <= 2000 - (select sum(f) from parts) then 1 else 0 end)::bigint as quota from parts),
    usable as (select doc_id, source as corpus, lang as language, n_chars as audio_size from documents where n_chars between 300 and 20000),
    ranked as (select *, row_number() over (partition by corpus, language order by {hash_sql('doc_id', 123)}, doc_id) as r,
        count(*) over (partition by corpus, language) as n from usable),
    mixed as (select *, unnest(generate_series(1, c)) as copy
        from (select *, quota // n + case when r <= quota % n then 1 else 0 end as c from ranked join quotas using (corpus, language)) where c > 0),
    bucketed as (select *, (ceil(audio_size / 16000) * 16000)::bigint as bucket, doc_id || '#' || copy as k from mixed),
    packed as (select *, (row_number() over (partition by bucket order by {hash_sql('k', 123)}, k) - 1)
        // greatest(1, 200000 // bucket) as batch_no from bucketed)
    select doc_id, copy, bucket, batch_no, batch_no // 8 as step from packed""",
)
def training_batches(spark, sf):
    clips = table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("corpus"), F.col("lang").alias("language"), F.col("n_chars").alias("audio_size")
    )
    table_of = batches(clips, language_hours(clips), 2000, "doc_id", low=300, high=20_000, budget=200_000, batches_per_step=8)
    return table_of.select("doc_id", "copy", "bucket", "batch_no", "step")
