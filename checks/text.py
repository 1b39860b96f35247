"""Text functions, projections and filters."""

from pyspark.sql import functions as F

from checks.registry import check, table
from speechlake.functions import text as X
from speechlake.operators import project as P
from speechlake.operators import quality as Q

_C = X.character_classes()
_SPACE = _C["space"]

# Foreign letters, marks, digits and spaces that the documents lack, added to every text on both sides.
_ODD = "\u0436 i\u0303 u\u0303 \u00b2 \u02bc \u2019 \u8a9e ng'ombe-\u00aa \u0905\u093e x"
_E_ACUTE = "e\u0301"  # decomposed
_EM_SPACE = "\u2003"
_ODD_IN_SQL = _ODD.replace("'", "''")


def _odd(df):
    """The text with decomposed accents and the odd characters."""
    return df.withColumn("text", F.concat(F.replace("text", F.lit("e"), F.lit(_E_ACUTE)), F.lit(" " + _ODD)))


_ODD_SQL = f"(replace(text, 'e', '{_E_ACUTE}') || ' {_ODD_IN_SQL}')"


def _strip_sql(value: str) -> str:
    return f"regexp_replace({value}, '\\A[{_SPACE}]+|[{_SPACE}]+\\z', '', 'g')"


def _normalize_sql(value: str) -> str:
    value = f"coalesce({value}, '')"
    kept = _C["kept"].replace("'", "''")
    cleaned = f"trim(regexp_replace(regexp_replace(nfc_normalize({value}), '[^{kept}]', '', 'g'), '[{_SPACE}]+', ' ', 'g'))"
    return f"case when {_strip_sql(value)} = '...' or {cleaned} = '' then '...' else {cleaned} end"


@check("t1_nfc", f"select doc_id, nfc_normalize({_ODD_SQL}) as text from documents")
def nfc(spark, sf):
    return _odd(table(spark, sf, "documents")).select("doc_id", X.nfc("text").alias("text"))


@check("t2_keep_latin", f"select doc_id, regexp_replace({_ODD_SQL}, '[^{_C['kept']}]', '', 'g') as text from documents")
def keep_latin(spark, sf):
    return _odd(table(spark, sf, "documents")).select("doc_id", X.keep_latin("text").alias("text"))


@check(
    "t3_squash_spaces",
    f"""select doc_id, trim(regexp_replace(chr(28) || replace(text, ' ', chr(8195) || ' ') || chr(31), '[{_SPACE}]+', ' ', 'g')) as text
    from documents""",
)
def squash_spaces(spark, sf):
    spaced = F.concat(F.lit("\x1c"), F.replace("text", F.lit(" "), F.lit(_EM_SPACE + " ")), F.lit("\x1f"))
    return table(spark, sf, "documents").select("doc_id", X.squash_spaces(spaced).alias("text"))


def submission(spark, sf):
    """Documents as a submission: unlabeled ones have no text, some sources give placeholders or noise."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    raw = (
        F.when(F.col("source") == "src1", F.lit(" ..." + _EM_SPACE))
        .when(F.col("source") == "src2", F.lit("\u0436\u0905 ...."))
        .when(F.col("source") == "src3", F.lit(" N/A\x1f"))
        .when(F.col("source") == "src4", F.lit("   "))
        .when(F.col("source") == "src5", F.concat("text", F.lit(" " + _ODD)))
        .when(F.col("quality").isNotNull(), F.col("text"))
    )
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("language"), raw.alias("transcription")
    )


SUBMISSION_SQL = f"""select d.doc_id::varchar as id, lang as language, case source
    when 'src1' then ' ...' || chr(8195) when 'src2' then '\u0436\u0905 ....' when 'src3' then ' N/A' || chr(31)
    when 'src4' then '   ' when 'src5' then text || ' {_ODD_IN_SQL}'
    else case when quality is not null then text end end as transcription
    from documents d left join labels l on d.doc_id = l.doc_id"""


@check(
    "t4_normalize_text",
    f"with s as ({SUBMISSION_SQL}) select id, {_normalize_sql('transcription')} as transcription from s",
)
def normalize_text(spark, sf):
    return submission(spark, sf).select("id", X.normalize_text("transcription").alias("transcription"))


@check(
    "t5_has_foreign",
    f"""with s as ({SUBMISSION_SQL})
    select id, regexp_matches(nfc_normalize(coalesce(transcription, '')), '[{_C['foreign']}]') as has_foreign from s""",
)
def has_foreign(spark, sf):
    return submission(spark, sf).select("id", X.has_foreign("transcription").alias("has_foreign"))


_SCRUB = f"""case when transcription is null or lower({_strip_sql('transcription')}) in ('','nan','null','none','na','n/a','<na>')
    then '...' else transcription end"""


@check("t6_scrub", f"with s as ({SUBMISSION_SQL}) select id, {_SCRUB} as transcription from s")
def scrub(spark, sf):
    return submission(spark, sf).select("id", X.scrub("transcription").alias("transcription"))


@check("t7_is_blank", f"with s as ({SUBMISSION_SQL}) select id, {_strip_sql('transcription')} = '' as blank from s")
def is_blank(spark, sf):
    return submission(spark, sf).select("id", X.is_blank("transcription").alias("blank"))


@check(
    "t8_path_pieces",
    """select page_id, regexp_extract(url, '([^/]*)$', 1) as base,
    split_part(list_last(string_split(url, 'page=')), '/', 1) as page from pages""",
)
def path_pieces(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", X.basename("url").alias("base"), X.path_value("url", "page").alias("page")
    )


@check("s2_shard_index", "select page_id, regexp_extract(url, 'example\\.([^.]*)', 1) as shard from pages")
def shard_index(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.shard_index("url", "example.").alias("shard"))


@check(
    "p1_to_lake_schema",
    """select text, md5(text) as audio_md5, lang as language, 'train' as split, 'corpus_a' as corpus, n_chars as audio_size
    from documents""",
)
def to_lake_schema(spark, sf):
    clips = table(spark, sf, "documents").select(
        F.col("text").alias("transcription"),
        F.col("lang").alias("language"),
        F.col("n_chars").alias("audio_size"),
        F.col("text").cast("binary").alias("audio_bytes"),
    )
    lake = P.to_lake_schema(clips, "train", "corpus_a")
    return lake.select("text", F.md5("audio_bytes").alias("audio_md5"), "language", "split", "corpus", "audio_size")


@check("p2_set_language", "select doc_id, text, n_chars, 'swa' as language from documents")
def set_language(spark, sf):
    named = table(spark, sf, "documents").withColumnsRenamed({"lang": "language", "source": "split"})
    return P.set_language(named, "swa")


@check(
    "p3_flatten_structs",
    "select c_custkey, c_name as profile_name, c_acctbal as profile_balance, c_nationkey from customer",
)
def flatten_structs(spark, sf):
    nested = table(spark, sf, "customer").select(
        "c_custkey", F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).alias("profile"), "c_nationkey"
    )
    flat = P.flatten_structs(nested)
    return flat.toDF(*[c.replace(".", "_") for c in flat.columns])


@check(
    "p4_rename_values",
    "select doc_id, case lang when 'en' then 'eng' when 'fr' then 'fra' else lang end as lang from documents",
)
def rename_values(spark, sf):
    return P.rename_values(table(spark, sf, "documents").select("doc_id", "lang"), "lang", {"en": "eng", "fr": "fra"})


def _labeled(spark, sf):
    """Texts are there for quality 1, empty for quality 0 and missing without a label."""
    text = F.when(F.col("quality") == 1, F.col("text")).when(F.col("quality") == 0, "")
    size = F.when(F.col("quality").isNotNull(), F.col("n_chars"))
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id", text.alias("transcription"), size.alias("audio_size")
    )


@check(
    "p5_drop_unlabeled",
    "select doc_id, text as transcription from documents join labels using (doc_id) where quality = 1 and text <> ''",
)
def drop_unlabeled(spark, sf):
    return P.drop_unlabeled(_labeled(spark, sf)).select("doc_id", "transcription")


@check("p6_drop_failed", "select doc_id, n_chars as audio_size from documents join labels using (doc_id)")
def drop_failed(spark, sf):
    return P.drop_failed(_labeled(spark, sf)).select("doc_id", "audio_size")


@check(
    "p7_filter_length",
    "select doc_id, n_chars * 160 as audio_size from documents where n_chars * 160 between 32000 and 960000",
)
def filter_length(spark, sf):
    clips = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") * 160).alias("audio_size"))
    return P.filter_length(clips)


_SOURCES = {"org/africa": "afr", "org/America": "ame", "org/ASIA": "asi"}
_SOURCES_SQL = """(values ('org/africa', 'afr'), ('africa', 'afr'), ('org/america', 'ame'), ('america', 'ame'),
    ('org/asia', 'asi'), ('asia', 'asi')) m(name, code)"""


@check(
    "p8_map_codes",
    f"""select n_name, r_name, code from nation join region on n_regionkey = r_regionkey
    left join {_SOURCES_SQL} on lower(r_name) = name""",
)
def map_codes(spark, sf):
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return P.map_codes(nations.select("n_name", "r_name"), "r_name", _SOURCES, "code")


@check(
    "p8_unknown_codes",
    f"select distinct r_name from region where lower(r_name) not in (select name from {_SOURCES_SQL})",
)
def unknown_codes(spark, sf):
    return P.unknown_codes(table(spark, sf, "region"), "r_name", _SOURCES)


@check("p9_select_splits", "select doc_id, source as split from documents where source in ('src1', 'src7')")
def select_splits(spark, sf):
    return P.select_splits(table(spark, sf, "documents").select("doc_id", F.col("source").alias("split")), "src1,src7")


@check("p10_to_submission", f"select id, language, transcription from ({SUBMISSION_SQL})")
def to_submission(spark, sf):
    return P.to_submission(submission(spark, sf).withColumn("extra", F.lit(1)))


_CLEAN = _normalize_sql("transcription")


@check(
    "a15_normalize_report",
    f"""with s as ({SUBMISSION_SQL}), c as (select language, {_CLEAN} as after, nfc_normalize(coalesce(transcription, '')) as before from s)
    select count(*) as rows, array_to_string(list_sort(list(distinct language)), ',') as languages,
    count(*) filter (before <> after) as changed, count(*) filter (regexp_matches(before, '[{_C['foreign']}]')) as "foreign",
    count(*) filter (after is null) as nulls, count(*) filter (trim(after) = '') as blank from c""",
)
def normalize_report(spark, sf):
    return Q.normalize_report(submission(spark, sf)).withColumn("languages", F.array_join("languages", ","))


@check("f5_clean_submission", f"with s as ({SUBMISSION_SQL}) select id, language, {_CLEAN} as transcription from s")
def clean_rows(spark, sf):
    return P.to_submission(Q.normalized(submission(spark, sf)))
