"""From documents to packed training sequences, stage by stage.

Every stage takes the documents its predecessor kept and returns those it keeps, in the columns of ``documents``; the
last returns the places of all their pieces in training sequences.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechlake.llm.common import read, scratch
from speechlake.llm.mixing import mix_sources
from speechlake.llm.packing import pack_documents
from speechlake.llm.quality import classify_quality
from speechlake.llm.simhash import keep_one
from speechlake.llm.suffix_dedup import remove_repeats


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    scored = classify_quality(docs, read(spark, sf_dir, "labels"))
    return scored.filter("keep").select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (4-word shingles, up to 4 differing bits), the one of the least id."""
    return keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that occur anywhere else, too; those of which nothing is left go.

    ``n_chars`` is that of the new text; a text that lost nothing stays as it is.
    """
    cut = remove_repeats(docs).filter("n_removed = 0 or kept <> ''")
    new = {"text": F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))}
    new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast("bigint")).otherwise(F.col("n_chars"))
    return cut.withColumns(new).select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards the target shares of their sources, in random order."""
    return mix_sources(docs).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in training sequences of the permitted lengths."""
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

# A trained classifier and chains of near-duplicates have no SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each written as parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
