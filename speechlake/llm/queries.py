"""The registered queries of the operators here; SQL where it can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechlake.llm.align import align_documents
from speechlake.llm.ann import nearest
from speechlake.llm.common import read
from speechlake.llm.katz import score_documents
from speechlake.llm.license_scan import scan_licenses
from speechlake.llm.merkle import build_manifest, fold, leaf_digest, proof_digest
from speechlake.llm.minhash import fingerprint_documents
from speechlake.llm.mixing import mix_sources
from speechlake.llm.packing import pack_documents
from speechlake.llm.quality import classify_quality
from speechlake.llm.simhash import near_duplicates
from speechlake.llm.suffix_dedup import remove_repeats
from speechlake.llm.token_counts import count_tokens
from speechlake.llm.topk import exact_top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(query: Callable[[SparkSession, str], DataFrame]):
    QUERIES[query.__name__] = query
    return query


@register
def op1_hash_prefix_forest(spark, sf_dir):
    return nearest(read(spark, sf_dir, "embeddings"))


@register
def op2_token_counts(spark, sf_dir):
    import public_tokenizers

    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register
def op3_no_random_access(spark, sf_dir):
    return exact_top_k(read(spark, sf_dir, "embeddings"))


@register
def op4_simhash_near_dedup(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"))


@register
def op5_best_fit_packing(spark, sf_dir):
    return pack_documents(read(spark, sf_dir, "documents"))


@register
def op6_license_scan(spark, sf_dir):
    return scan_licenses(read(spark, sf_dir, "documents")).drop("places")


@register
def op7_quality_classifier(spark, sf_dir):
    scored = classify_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "p_text", "p_meta", "p_quality", "keep")


@register
def op8_poisson_mixing(spark, sf_dir):
    mixed = mix_sources(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "copy", F.round("shuffle_key", 12).alias("shuffle_key"), F.md5("text").alias("text_md5"))


@register
def op9_katz_backoff(spark, sf_dir):
    return score_documents(read(spark, sf_dir, "documents"))


@register
def op10_suffix_array_dedup(spark, sf_dir):
    cut = remove_repeats(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register
def op11_token_alignment(spark, sf_dir):
    import public_tokenizers

    return align_documents(read(spark, sf_dir, "documents"), *map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))[0]


@register
def op12_minhash(spark, sf_dir):
    return fingerprint_documents(read(spark, sf_dir, "documents"))


@register
def op13_merkle_manifest(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    n_chars = F.col("n_chars").cast("decimal(20,0)")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    own = F.when(tampered, n_chars + 1).otherwise(n_chars)
    manifest = build_manifest(docs, claimed=leaf_digest("doc_id", "source", "lang", own, "text"))
    folded = manifest.select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), fold("claimed").alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


SQL["op3_no_random_access"] = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
    where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
    from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id)
select query_id, rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored) where rank <= 5
"""
SQL["op8_poisson_mixing"] = """
with docs as (select doc_id, source, text, ('0x' || substr(md5('17|' || coalesce(doc_id::varchar, 'null') || '|' || md5(coalesce(text, ''))), 1, 13))::bigint::double / 4503599627370496.0 as u from documents),
totals as (select source, sum(coalesce(length(text), 0))::double as total from docs group by source),
shares as (select source, total, sqrt(total) / sum(sqrt(total)) over () as share, sum(total) over () as whole from totals where total > 0),
rates as (select source, whole * share / total as rate from shares),
terms as (select source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::bigint + 1)) as k from rates),
cdf as (select source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) over (partition by source order by k) as p from terms),
counts as (select d.doc_id, d.source, d.text, d.u, count(*) filter (c.p <= d.u) as n from docs d join cdf c on d.source is not distinct from c.source group by all),
copies as (select doc_id, source, text, unnest(range(1, n + 1)) as copy from counts where n > 0)
select doc_id, source, copy::int as copy,
round(('0x' || substr(md5('18|' || coalesce(doc_id::varchar, 'null') || '|' || md5(coalesce(text, '')) || '|' || copy::varchar), 1, 13))::bigint::double / 4503599627370496.0, 12) as shuffle_key, md5(text) as text_md5
from copies
"""
SQL["op13_merkle_manifest"] = """
with recursive fields as (select doc_id, lang, source, n_chars, text,
    list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, len(doc_id::varchar) + 1), lambda i: ascii((doc_id::varchar)[i])::bigint)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) as crc
    from documents),
leaves as (select doc_id, lang, sha256(head || mid || tail) as leaf, sha256(head || case when coalesce(xor(crc, 4294967295) % 7 = 0, false)
        then case when n_chars is null then '-' else len((n_chars + 1)::varchar) || ':' || (n_chars + 1) end else mid end || tail) as claimed
    from (select *, case when doc_id is null then '-' else len(doc_id::varchar) || ':' || doc_id end
        || case when source is null then '-' else strlen(source) || ':' || source end || case when lang is null then '-' else strlen(lang) || ':' || lang end as head,
        case when n_chars is null then '-' else len(n_chars::varchar) || ':' || n_chars end as mid,
        case when text is null then '-' else strlen(text) || ':' || text end as tail from fields)),
placed as (select *, dense_rank() over (order by lang nulls first) - 1 as tree, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
    count(*) over (partition by lang) as n from leaves),
below as (select tree, 0 as level, pos, n, leaf as digest from placed
    union all select tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by pos)) from below where n > 1 group by tree, level, pos // 2, n),
heights as (select tree, max(level) as height, max_by(digest, level) as subroot from below group by tree),
above as (select 0 as level, tree as pos, count(*) over () as n, subroot as digest from heights
    union all select level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by pos)) from above where n > 1 group by level, pos // 2, n),
steps as (select p.doc_id, p.lang, p.pos as leaf_pos, p.claimed, b.level as step, (p.pos >> b.level) & 1 as side, b2.digest as sibling
    from placed p join heights h using (tree) join (select distinct tree, level, n from below) b on b.tree = p.tree and b.level < h.height
    left join below b2 on b2.tree = p.tree and b2.level = b.level and b2.pos = xor(p.pos >> b.level, 1)
    union all select p.doc_id, p.lang, p.pos, p.claimed, h.height + a.level, (p.tree >> a.level) & 1, a2.digest
    from placed p join heights h using (tree) join (select distinct level, n from above) a on a.n > 1
    left join above a2 on a2.level = a.level and a2.pos = xor(p.tree >> a.level, 1)),
proofs as (select lang, leaf_pos as pos, sha256(string_agg(coalesce(sibling, ''), '' order by step)) as proof_sha256,
    list({'side': side, 'sibling': sibling} order by step) as proof from steps group by all),
folds as (select lang, pos, claimed as digest, 1::bigint as step from placed
    union all select f.lang, f.pos, sha256(case when proof[step].sibling is null then digest when proof[step].side = 1 then proof[step].sibling || digest else digest || proof[step].sibling end), step + 1
    from folds f join proofs p on p.lang is not distinct from f.lang and p.pos = f.pos and step <= len(proof)),
folded as (select lang, pos, max_by(digest, step) as folded_root from folds group by all)
select p.doc_id, p.leaf, h.subroot, r.digest as root, coalesce(f.proof_sha256, sha256('')) as proof_sha256, folded_root, folded_root = r.digest as verified
from placed p join heights h using (tree) join (select digest from above where n = 1) r on true
left join proofs f on f.lang is not distinct from p.lang and f.pos = p.pos join folded d on d.lang is not distinct from p.lang and d.pos = p.pos
"""
