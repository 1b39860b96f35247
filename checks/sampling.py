"""Sampling, rounds, sorting and set operations."""

from pyspark.sql import functions as F

from checks.registry import check, hash_sql, table
from speechlake.operators import sample as S
from speechlake.operators.aggregate import language_hours
from speechlake.operators.quality import unexpected_languages
from speechlake.operators.ranking import attach, number_slice
from speechlake.plans.ingest import ingest_round, union_sources
from speechlake.sources.corpora import first_paths

_H = hash_sql("doc_id", 123)


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")


def _clips(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("corpus"), F.col("lang").alias("language"), F.col("n_chars").alias("audio_size")
    )


@check("m1_seeded_shuffle", f"select doc_id, row_number() over (order by {_H}, doc_id) as position from documents")
def seeded_shuffle(spark, sf):
    return S.shuffle_position(_docs(spark, sf).select("doc_id"), "doc_id")


@check("o4_hash_sort", f"select doc_id, {_H} as h from documents order by h, doc_id")
def hash_sort(spark, sf):
    return S.seeded_shuffle(_docs(spark, sf), "doc_id").select("doc_id", S.order_hash("doc_id", 123).alias("h"))


@check(
    "m2_skip_take",
    f"""select doc_id, lang, source, n_chars from documents
    qualify row_number() over (partition by source order by {_H}, doc_id) between 6 and 15""",
)
def skip_take(spark, sf):
    return S.skip_take(_docs(spark, sf), "doc_id", 5, 10, by=["source"])


@check(
    "m2_skip_take_whole",
    f"select doc_id, lang, source, n_chars from documents qualify row_number() over (order by {_H}, doc_id) between 101 and 150",
)
def skip_take_whole(spark, sf):
    return S.skip_take(_docs(spark, sf), "doc_id", 100, 50)


@check(
    "m3_eval_head",
    "select doc_id, lang from documents qualify row_number() over (partition by lang order by doc_id) <= 500",
)
def eval_head(spark, sf):
    return S.eval_head(_docs(spark, sf), ["lang"], ["doc_id"], number_slice("doc_id"), 0, 2000).select("doc_id", "lang")


@check(
    "m4_carve_splits",
    f"""with r as (select doc_id, ('0x' || substr({_H}, 1, 8))::bigint / 4294967296.0::double as r from documents)
    select doc_id, case when r < 0.05 then 'test' when r < 0.1 then 'dev' else 'train' end as split from r""",
)
def carve_splits(spark, sf):
    return S.carve_splits(_docs(spark, sf), "doc_id").select("doc_id", "split")


@check(
    "m5_cap_per_group",
    """select doc_id, source from documents join labels using (doc_id)
    qualify row_number() over (partition by source order by doc_id) <= 8""",
)
def cap_per_group(spark, sf):
    usable = _docs(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left_semi")
    return S.cap_per_group(usable, ["source"], ["doc_id"], number_slice("doc_id"), 8).select("doc_id", "source")


_WEIGHTS = """stats as (select source as corpus, lang as language, sum(n_chars) / 3600 / 16000 as hours from documents group by all),
    corpora as (select corpus, pow(sum(hours), 0.5) as c, sum(pow(hours, 0.5)) as l from stats group by corpus),
    weights as (select corpus, language, hours, c / (select sum(c) from corpora) * pow(hours, 0.5) / l as weight
        from stats join corpora using (corpus))"""


@check(
    "m6_mix_weights",
    f"with {_WEIGHTS} select corpus, language, round(hours, 9) as hours, round(weight, 9) as weight from weights",
)
def mix_weights(spark, sf):
    weights = S.mix_weights(language_hours(_clips(spark, sf)))
    return weights.select("corpus", "language", F.round("hours", 9).alias("hours"), F.round("weight", 9).alias("weight"))


_QUOTAS = _WEIGHTS + """, parts as (select *, floor(weight * 1500) as f, weight * 1500 - floor(weight * 1500) as rest from weights),
    quotas as (select corpus, language, (f + case when row_number() over (order by round(rest, 9) desc, corpus, language)
        <= 1500 - (select sum(f) from parts) then 1 else 0 end)::bigint as quota from parts)"""


@check("m6_mix_quotas", f"with {_QUOTAS} select corpus, language, quota from quotas")
def mix_quotas(spark, sf):
    weights = S.mix_weights(language_hours(_clips(spark, sf)))
    return S.mix_quotas(weights, 1500).select("corpus", "language", "quota")


@check(
    "m6_temperature_sample",
    f"""with {_QUOTAS}, ranked as (select doc_id, source as corpus, lang as language,
        row_number() over (partition by source, lang order by {_H}, doc_id) as r,
        count(*) over (partition by source, lang) as n from documents),
    copies as (select doc_id, corpus, language, (quota // n + case when r <= quota % n then 1 else 0 end) as c
        from ranked join quotas using (corpus, language))
    select doc_id, corpus, language, unnest(generate_series(1, c)) as copy from copies where c > 0""",
)
def temperature_sample(spark, sf):
    clips = _clips(spark, sf)
    quotas = S.mix_quotas(S.mix_weights(language_hours(clips)), 1500)
    return S.temperature_sample(clips.select("doc_id", "corpus", "language"), quotas, "doc_id")


@check(
    "j5_stats_join",
    f"""with {_WEIGHTS} select doc_id, round(weight, 9) as weight
    from documents join weights on source = corpus and lang = language""",
)
def stats_join(spark, sf):
    clips = _clips(spark, sf)
    weights = S.mix_weights(language_hours(clips)).select("corpus", "language", "weight")
    return attach(clips, weights, ["corpus", "language"]).select("doc_id", F.round("weight", 9).alias("weight"))


@check(
    "m7_windowed_shuffle",
    f"""with n as (select doc_id, row_number() over (order by doc_id) as rn from documents), b as (select doc_id, (rn - 1) // 16 as b from n)
    select doc_id, (b * 16 + row_number() over (partition by b order by {_H}, doc_id))::bigint as position from b""",
)
def windowed_shuffle(spark, sf):
    return S.windowed_shuffle(_docs(spark, sf).select("doc_id"), "doc_id", "doc_id", 16)


_SPARSE_SQL = "('0x' || substr(md5(doc_id::varchar), 1, 15))::bigint"


@check("m7_sparse_order", f"select doc_id, row_number() over (order by {_SPARSE_SQL}) as position from documents")
def sparse_order(spark, sf):
    """An order whose values are far apart."""
    place = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 15), 16, 10).cast("bigint")
    return S.windowed_shuffle(_docs(spark, sf).select("doc_id", place.alias("place")), "place", "doc_id", 1).drop("place")


@check("m7_window_one", "select doc_id, row_number() over (order by doc_id) as position from documents")
def window_one(spark, sf):
    return S.windowed_shuffle(_docs(spark, sf).select("doc_id"), "doc_id", "doc_id", 1)


@check("m8_first_rows", "select doc_id, lang, source, n_chars from documents order by doc_id limit 40")
def first_rows(spark, sf):
    return S.first_rows(_docs(spark, sf), ["doc_id"], 40)


@check(
    "i2_ingest_round",
    f"""select doc_id, (row_number() over (partition by source order by {_H}, doc_id) - 1) // 7 as round from documents
    qualify round in (1, 2)""",
)
def rounds(spark, sf):
    docs = _docs(spark, sf).select("doc_id", "source")
    parts = [ingest_round(docs, k, 7, "doc_id", ["source"]).withColumn("round", F.lit(k).cast("bigint")) for k in (1, 2)]
    return parts[0].unionByName(parts[1]).select("doc_id", "round")


@check(
    "i2_rerun_round",
    f"""select doc_id from (select doc_id from documents qualify row_number() over (partition by source order by {_H}, doc_id) between 8 and 14)
    where doc_id not in (select doc_id from labels)""",
)
def rerun_round(spark, sf):
    docs = _docs(spark, sf).select("doc_id", "source")
    return ingest_round(docs, 1, 7, "doc_id", ["source"], done=table(spark, sf, "labels")).select("doc_id")


@check(
    "s4_o1_first_shards",
    """select url as path, string_split(url, '/')[4] as folder from pages
    where string_split(url, '/')[4] in ('fr', 'en') order by case string_split(url, '/')[4] when 'fr' then 1 else 2 end, url, page_id limit 60""",
)
def first_shards(spark, sf):
    pages = table(spark, sf, "pages").select(
        F.col("url").alias("path"), F.element_at(F.split("url", "/"), 4).alias("folder")
    )
    return first_paths(pages, ["fr", "en"], 60)


@check("o2_preview", "select doc_id, lang from documents order by doc_id limit 10")
def preview(spark, sf):
    return _docs(spark, sf).select("doc_id", "lang").orderBy("doc_id").limit(10)


@check(
    "x1_union_sources",
    """select text, lang as language, case when lang = 'en' then 'train' else 'dev' end as split, source as corpus,
    n_chars as audio_size from documents""",
)
def union_of_sources(spark, sf):
    docs = table(spark, sf, "documents").select(
        "text", F.lit(None).cast("binary").alias("audio_bytes"), F.col("lang").alias("language"), F.col("source").alias("corpus"), F.col("n_chars").alias("audio_size")
    )
    train = docs.filter("language = 'en'").withColumn("split", F.lit("train"))
    dev = docs.filter("language <> 'en'").withColumn("split", F.lit("dev")).select("split", *docs.columns)
    return union_sources([train, dev]).drop("audio_bytes")


@check("x3_unexpected_languages", "select distinct lang as language from documents where lang not in ('en', 'fr')")
def unexpected(spark, sf):
    return unexpected_languages(_docs(spark, sf).withColumnRenamed("lang", "language"), ["en", "fr"])


@check("x4_not_in", "select doc_id from documents where doc_id not in (select doc_id from labels)")
def not_in(spark, sf):
    return _docs(spark, sf).select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left_anti")
