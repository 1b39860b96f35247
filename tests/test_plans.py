"""The plans that matter at scale: what is read, what moves, and what never leaves the JVM."""

import os

import pytest
from compare import TESTDATA
from pyspark.sql import functions as F

import __spark_entry__ as entry
import checks
from speechlake.operators import ranking as R
from speechlake.operators import sample as S
from speechlake.operators.aggregate import keep_first, language_hours
from speechlake.operators.quality import normalized
from speechlake.sources import tables as T

SF_DIR = os.path.join(TESTDATA, "sf0.001")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    rows = [(f"t{i}", b"x" * 100, "swa" if i % 3 else "som", "train" if i % 2 else "dev", "c", i) for i in range(400)]
    T.write_lake(spark.createDataFrame(rows, "text string, audio_bytes binary, language string, split string, corpus string, audio_size bigint"), root)
    return T.read_lake(spark, root)


def test_hours_read_one_column_and_aggregate_before_the_shuffle(lake):
    text = plan(language_hours(lake, "dev,test"))
    assert "ReadSchema: struct<audio_size:bigint>" in text
    assert "PartitionFilters: [split" in text
    assert "partial_sum" in text


def test_wide_rows_of_a_sample_are_not_shuffled(lake):
    keyed = lake.withColumn("k", F.col("text"))
    text = plan(S.skip_take(keyed, "k", 5, 50, by=["language"]))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text and "Sort" not in text


def test_ends_of_a_range_reach_the_scan(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    text = plan(S.eval_head(docs, [], ["doc_id"], R.number_slice("doc_id"), 0, 30))
    assert "LessThanOrEqual(doc_id,29)" in text
    assert S.eval_head(docs, [], ["doc_id"], R.number_slice("doc_id"), 0, 30).count() == 30


def test_ranks_cut_hot_groups_into_slices(lake):
    text = plan(R.ranked(lake.select("language", "audio_size"), ["language"], R.number_slice("audio_size", 50), ["audio_size"]))
    windows = [line for line in text.split("\n") if "Window [" in line and "audio_size" in line]
    assert windows and all("[_key#" in line for line in windows)  # the group and the slice together
    assert "hashpartitioning(_key#" in text and "hashpartitioning(language" not in text


def test_text_cleaning_stays_in_the_jvm(lake):
    df = lake.select("language", F.col("text").alias("transcription"))
    text = plan(normalized(df))
    assert "Python" not in text and "Exchange" not in text


def test_first_rows_are_reduced_before_the_shuffle(lake):
    text = plan(keep_first(lake.select("language", "text", "audio_size"), ["language"], ["audio_size"]))
    assert "partial_min_by" in text


def test_lake_writes_are_rebalanced(lake):
    text = plan(lake.hint("rebalance", F.col("language")))
    assert "REBALANCE_PARTITIONS_BY_COL" in text


def test_no_query_runs_row_at_a_time_python_or_a_cross_join(spark):
    for name in checks.QUERIES:
        query = entry.queries()[name]
        text = plan(query(spark, SF_DIR))
        assert "BatchEvalPython" not in text, name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
