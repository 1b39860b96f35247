"""Token counts through a digest cache.

A text is known by the digest of its normalised content (runs of ASCII white space are one space, none at the ends, if
the tokenizer drops white space) and the digest of the tokenizer file and library version. Digests are joined to the stored counts; of the texts that
are missing there, one per digest is encoded, and its count is appended to the cache.
"""

import hashlib
import importlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechlake.llm.common import scratch, written
from speechlake.session import hadoop_path

CACHE = "version string, content string, n_tokens bigint"
MEMO_ROWS = 400_000  # words a worker remembers; it starts anew beyond that
# White space cuts a text into parts that the tokenizers counted here encode on their own.
_PARTS = re.compile(rb"[^\x20\x09-\x0D]+")
_WORD_AND_MARKS = re.compile(rb"([A-Za-z]+)([.,!?;:|$%&*#()]*)")


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and of the version of the library that reads it."""
    library = "tokenizers" if path.endswith(".json") else "sentencepiece"
    version = importlib.import_module(library).__version__
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + f"|{library}|{version}".encode()).hexdigest()


def content_digest(text: str, up_to_space: bool) -> Column:
    """Digest of a text; with ``up_to_space`` the same for texts that differ in ASCII white space only."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return F.sha2(F.trim(F.regexp_replace(whole, r"[ \t\n\x0B\f\r]+", " ")) if up_to_space else whole, 256)


def whole_counter(path: str, model: bytes):
    """texts -> token counts by the library, without added special tokens."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(model.decode())
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return lambda texts: [len(x.ids) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    return lambda texts: [len(x) for x in processor.encode(texts, num_threads=1)]


def splits_at_space(path: str, model: bytes) -> bool:
    """Whether the tokenizer drops white space before it cuts words, so that counts add up over the parts of a text."""
    if not path.endswith(".json"):
        return False
    import json

    spec = json.loads(model)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    removed = any(s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] and r"\s" in str(s["pattern"]) for s in steps)
    lowers = "Lowercase" in json.dumps(spec.get("normalizer") or {})
    # ``part_keys`` needs lower case and letters apart from marks.
    apart = any(s["type"] == "Split" and r"\\p{L}" in json.dumps(s["pattern"]) for s in steps)
    return removed and lowers and apart and not any(" " in str(t["content"]) or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])


def part_keys(part: bytes) -> tuple[bytes, ...]:
    """What to look up for one part: lower-cased ASCII word and the marks behind it, or the part as it is."""
    match = _WORD_AND_MARKS.fullmatch(part)
    if match is None:
        return (part,)
    return (match[1].lower(), match[2]) if match[2] else (match[1].lower(),)


def _encoder(path: str, model: bytes):
    """Batches of (content, text) -> batches of (content, n_tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        count, by_part = whole_counter(path, model), splits_at_space(path, model)
        keys: dict[bytes, tuple[bytes, ...]] = {}
        memo: dict[bytes, int] = {}
        done: set[str] = set()

        def count_parts(text: bytes) -> int:
            parts = _PARTS.findall(text)
            fresh = {p for p in parts if p not in memo}
            if fresh:
                pieces = {p: part_keys(p) for p in fresh}
                wanted = [k for k in {k for ks in pieces.values() for k in ks} if k not in keys]
                keys.update(zip(wanted, count([k.decode() for k in wanted])))
                memo.update((p, sum(map(keys.__getitem__, ks))) for p, ks in pieces.items())
            total = sum(map(memo.__getitem__, parts))
            if len(memo) > MEMO_ROWS:
                memo.clear()
            if len(keys) > MEMO_ROWS:
                keys.clear()
            return total

        for batch in batches:
            # Equal rows come to one task; one of them is encoded.
            contents = batch.column(0).to_pylist()
            fresh = [i for i, c in enumerate(contents) if c not in done and not done.add(c)]
            texts = (batch.column(1)[i].as_py() or "" for i in fresh)
            counts = [count_parts(t.encode()) for t in texts] if by_part else count(list(texts))
            if len(done) > MEMO_ROWS:
                done.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(fresh, pa.int64())), pa.array(counts, pa.int64())], names=["content", "n_tokens"])

    return run


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row per digest; none if the cache does not exist yet."""
    system, path = hadoop_path(spark, cache)
    stored = spark.read.schema(CACHE).parquet(cache) if system.exists(path) else spark.createDataFrame([], CACHE)
    return stored.filter(F.col("version") == version).dropDuplicates(["content"]).select("content", "n_tokens")


def count_tokens(
    docs: DataFrame, path: str, cache: str | None = None, key: str = "doc_id", text: str = "text", limit: int = 2048
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``path`` is a ``tokenizers`` (.json) or ``sentencepiece`` (.model) file on the driver; its content travels with the
    tasks. ``cache`` is a folder of stored counts, which is filled here; None takes a new one. A null text is empty
    and has 0 tokens; texts of any length are encoded whole; repeated rows are all returned, also under a null or
    repeated key; an empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    cache = cache or scratch(spark, "token-cache")
    version = tokenizer_version(path)
    with open(path, "rb") as file:
        model = file.read()
    rows = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), content_digest(text, splits_at_space(path, model)).alias("content"),
        F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint").alias("n_bytes"),
    )
    # One document per missing digest; the texts of the others do not travel to Python.
    missing = (
        rows.groupBy("content").agg(F.min("key").alias("first_key"))
        .join(read_cache(spark, cache, version), "content", "left_anti")
        .withColumnRenamed("content", "digest")
    )
    same = rows["key"].eqNullSafe(missing["first_key"]) & (rows["content"] == missing["digest"])
    misses = rows.join(missing.hint("shuffle_hash"), same, "left_semi").select("content", "text")
    schema = T.StructType([T.StructField("content", T.StringType()), T.StructField("n_tokens", T.LongType())])
    encoded = misses.mapInArrow(_encoder(path, model), schema)
    encoded.select(F.lit(version).alias("version"), "content", "n_tokens").write.mode("append").parquet(cache)
    # Written once more without repeats, so that the runtime can split the rows of a very frequent text in the join.
    counts = written(read_cache(spark, cache, version), "token-counts")
    return rows.select("key", "n_bytes", "content").join(counts, "content").select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
