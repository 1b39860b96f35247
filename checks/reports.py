"""Aggregates, result tables and checks on them."""

from pyspark.sql import functions as F

from checks.registry import check, table
from checks.text import _SCRUB, SUBMISSION_SQL, _strip_sql, submission
from speechlake.operators import aggregate as A
from speechlake.operators import join as J
from speechlake.operators import quality as Q
from speechlake.operators.audio import encode_waves, ingest_audio
from speechlake.operators.blocks import block_report
from speechlake.operators.sequence import join_chunks, running_totals
from speechlake.operators.ranking import number_slice
from speechlake.plans.training import labeled_hours


def lake(spark, sf):
    return table(spark, sf, "documents").select(
        "text", F.col("n_chars").alias("audio_size"), F.col("lang").alias("language"), F.col("source").alias("corpus")
    )


@check(
    "labeled_hours",
    """select source as corpus, lang as language, round(sum(n_chars * 160) / 3600 / 16000, 9) as hours
    from documents where text <> '' and n_chars * 160 between 32000 and 960000 group by all""",
)
def hours_of_labeled(spark, sf):
    clips = lake(spark, sf).withColumn("audio_size", F.col("audio_size") * 160)
    return labeled_hours(clips).withColumn("hours", F.round("hours", 9))


@check(
    "a1_language_hours",
    "select source as corpus, lang as language, round(sum(n_chars) / 3600 / 16000, 9) as hours from documents group by all",
)
def language_hours(spark, sf):
    return A.language_hours(lake(spark, sf)).withColumn("hours", F.round("hours", 9))


@check(
    "a2_o3_lake_summary",
    "select count(*) as rows, array_to_string(list_sort(list(distinct lang)), ',') as languages from documents",
)
def lake_summary(spark, sf):
    return A.lake_summary(lake(spark, sf)).withColumn("languages", F.array_join("languages", ","))


@check(
    "a3_keep_first",
    "select text, doc_id, lang from documents qualify row_number() over (partition by text order by doc_id) = 1",
)
def keep_first(spark, sf):
    docs = table(spark, sf, "documents").select("text", "doc_id", "lang")
    return A.keep_first(docs, ["text"], ["doc_id"])


@check(
    "a4_blank_report",
    f"""with s as ({SUBMISSION_SQL}), b as (select language from s where coalesce({_strip_sql('transcription')}, '') = '')
    select language, count(*) as blank from b group by rollup (language)""",
)
def blank_report(spark, sf):
    return A.blank_report(submission(spark, sf))




_STATUS = f"""(select id, language, transcription, case language when 'fr' then 'decode_failed' when 'de' then 'backfilled'
    else 'transcribed' end as status from ({SUBMISSION_SQL}))"""


@check(
    "a5_loss_report",
    f"""select count(*) filter (status = 'decode_failed') as decode_failed,
    count(*) filter (status = 'transcribed' and coalesce({_strip_sql('transcription')}, '') = '') as model_blank,
    count(*) filter (status = 'backfilled') as backfilled from {_STATUS}""",
)
def loss_report(spark, sf):
    status = F.when(F.col("language") == "fr", "decode_failed").when(F.col("language") == "de", "backfilled").otherwise("transcribed")
    return Q.loss_report(submission(spark, sf).withColumn("status", status))


@check(
    "a6_join_chunks",
    """select conv_id::varchar as id, 'en' as language, string_agg(text, ' ' order by turn) as transcription
    from conversations group by conv_id""",
)
def chunks(spark, sf):
    rows = table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("id"), F.lit("en").alias("language"), F.col("turn").alias("chunk_idx"), "text"
    )
    return join_chunks(rows)


@check(
    "a10_mean_loss_bits",
    """select l_returnflag as split, round(sum(l_extendedprice / ln(2)) / sum(l_quantity), 6) as ctc_loss
    from lineitem group by l_returnflag""",
)
def mean_loss_bits(spark, sf):
    events = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("split"), F.col("l_extendedprice").alias("loss"), F.col("l_quantity").alias("batch_size")
    )
    return A.mean_loss_bits(events, ["split"]).withColumn("ctc_loss", F.round("ctc_loss", 6))


@check(
    "a12_running_totals",
    """select o_orderkey as step, (sum(o_custkey) over w)::bigint as total_num_elements, count(*) over w as total_num_examples
    from orders window w as (partition by o_orderstatus order by o_orderkey rows unbounded preceding)""",
)
def totals(spark, sf):
    events = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("run"),
        F.col("o_orderkey").alias("step"),
        F.col("o_custkey").alias("num_elements"),
        F.lit(1).cast("bigint").alias("num_examples"),
    )
    out = running_totals(events, ["run"], ["step"], number_slice("step"), ["num_elements", "num_examples"])
    return out.select("step", "total_num_elements", "total_num_examples")


@check("a13_ingest_report", "select source as shard, count(*) as rows from documents group by rollup (source)")
def ingest_report(spark, sf):
    return A.ingest_report(lake(spark, sf).withColumnRenamed("corpus", "shard"))


def _checkpoints(spark, sf):
    path = F.concat(F.lit("/runs/ws_1/checkpoints/step_"), F.col("o_orderkey"))
    rows = table(spark, sf, "orders").select(
        path.alias("path"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("wer")
    )
    return rows.withColumn("step", A.step_number("path"))


@check(
    "a14_best_step",
    """select '/runs/ws_1/checkpoints/step_' || o_orderkey as path from orders where o_orderstatus <> 'P'
    order by o_totalprice, o_orderkey limit 1""",
)
def best_step(spark, sf):
    return A.best_step(_checkpoints(spark, sf))


@check("a14_newest_step", "select '/runs/ws_1/checkpoints/step_' || max(o_orderkey) as path from orders")
def newest_step(spark, sf):
    return A.newest_step(_checkpoints(spark, sf))


def _results(spark, sf):
    return submission(spark, sf).join(
        table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id")), "id", "left_semi"
    )


_RESULTS = f"(select * from ({SUBMISSION_SQL}) where id in (select doc_id::varchar from labels))"


@check(
    "j3_x2_backfill",
    f"""select id, language, transcription from {_RESULTS} union all
    select doc_id::varchar, lang, '...' from documents where doc_id not in (select doc_id from labels)""",
)
def backfill(spark, sf):
    ids = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("language"), "doc_id"
    )
    return J.backfill(_results(spark, sf), ids, ["doc_id"])


@check(
    "v5_complete_submission",
    f"""with r as (select id, language, {_SCRUB} as transcription from {_RESULTS})
    select id, language, transcription from r union all
    select doc_id::varchar, lang, '...' from documents where doc_id not in (select doc_id from labels)""",
)
def complete(spark, sf):
    ids = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("language"), F.col("doc_id").alias("row")
    )
    results = _results(spark, sf).withColumn("row", F.col("id").cast("bigint"))
    # Every id and every result twice, later on: the first of each must win.
    again = F.col("row") + 1_000_000_000
    ids = ids.unionByName(ids.withColumns({"row": again, "language": F.lit("zz")}))
    results = results.unionByName(results.withColumns({"row": again, "transcription": F.lit("late")}))
    return Q.complete_submission(results, ids, ["row"])


@check(
    "v1_validate_submission",
    f"""with s as ({SUBMISSION_SQL}),
    c as (select count(*) as n, count(*) filter (coalesce({_strip_sql('transcription')}, '') = '') as blank,
        coalesce(array_to_string(list_sort(list(distinct language) filter (language not in ('en', 'fr'))), ','), '') as bad from s)
    select 'row_count' as "check", n = 1000 as ok, n::varchar as detail from c
    union all select 'languages', bad = '', bad from c union all select 'blank_cells', blank = 0, blank::varchar from c""",
)
def validate(spark, sf):
    return Q.validate_submission(submission(spark, sf), 1000, ["en", "fr"])


def _with_errors(spark, sf):
    """Documents that the labels call toxic count as failed clips."""
    joined = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return joined.select("doc_id", "lang", F.when(F.col("toxic") == 1, "toxic").alias("error"))


@check(
    "v2_error_budget",
    """select count(*) as units, count(*) filter (toxic = 1) as bad, count(*) filter (toxic = 1) <= 50 as ok
    from documents left join labels using (doc_id)""",
)
def budget(spark, sf):
    return Q.budget_report(_with_errors(spark, sf), max_bad=50)


@check(
    "v2_block_budget",
    """with vectors as (select vec_id // 50 as block, vec_id // 50 % 9 = 4 or vec_id % 11 = 0 as lost from embeddings),
    blocks as (select block, count(*) as n, count(*) filter (lost) as lost from vectors group by block)
    select count(*) as blocks, count(*) filter (lost = n) as bad_blocks, sum(lost)::bigint as rows_lost, count(*) filter (lost = n) <= 50 as ok from blocks""",
)
def block_budget(spark, sf):
    """Vectors are decoded as clips; those of some whole blocks, and others here and there, are no audio."""
    block, own = F.floor(F.col("vec_id") / 50).cast("bigint"), F.transform("embedding", lambda x: x.cast("float"))
    vectors = table(spark, sf, "embeddings").select("vec_id", block.alias("block"), own.alias("wave"), F.lit(16_000).alias("rate"))
    clips = encode_waves(vectors, "wave", "rate")
    lost = (F.col("block") % 9 == 4) | (F.col("vec_id") % 11 == 0)
    broken = clips.withColumn("audio_bytes", F.when(lost, F.lit(b"no audio")).otherwise(F.col("audio_bytes")))
    return block_report(ingest_audio(broken), max_bad=50)


@check("v3_quarantine", "select doc_id, lang, 'toxic' as error from documents join labels using (doc_id) where toxic = 1")
def quarantine(spark, sf):
    return Q.split_good_bad(_with_errors(spark, sf))[1]


@check(
    "v3_good_rows",
    "select doc_id, lang from documents left join labels using (doc_id) where coalesce(toxic, 0) <> 1",
)
def good_rows(spark, sf):
    return Q.split_good_bad(_with_errors(spark, sf))[0]


@check(
    "j1_join_audio",
    """select source as shard, doc_id::varchar as member, n_chars as size, md5(text) as audio_md5
    from documents join labels using (doc_id) where quality = 1""",
)
def join_audio(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    member = F.col("doc_id").cast("string").alias("member")
    manifest = docs.join(labels.filter("quality = 1"), "doc_id").select(F.col("source").alias("shard"), member, F.col("n_chars").alias("size"))
    members = docs.select(F.col("source").alias("shard"), member, F.col("text").cast("binary").alias("raw"))
    return J.join_audio(manifest, members).select("shard", "member", "size", F.md5("raw").alias("audio_md5"))
