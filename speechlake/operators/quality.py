"""Checks, reports and guarantees on results."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechlake.functions.text import PLACEHOLDER, has_foreign, is_blank, nfc, normalize_text, scrub
from speechlake.operators.aggregate import keep_first
from speechlake.operators.project import to_submission

# Fixed values of the submission format.
EXPECTED_ROWS = 41_733
EXPECTED_LANGUAGES = ["swa", "kik", "luo", "som", "mas", "kln"]


class BudgetExceeded(RuntimeError):
    """More units failed than the run may lose."""


def split_good_bad(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(rows without an error, rows with one)."""
    return df.filter(F.col(error).isNull()).drop(error), df.filter(F.col(error).isNotNull())


def budget_report(df: DataFrame, error: str = "error", max_bad: int | None = None) -> DataFrame:
    """One row: units, bad units and whether the bad ones are within the budget; None is no limit."""
    bad = F.count_if(F.col(error).isNotNull())
    return df.agg(F.count("*").alias("units"), bad.alias("bad"), (bad <= max_bad if max_bad is not None else F.lit(True)).alias("ok"))


def enforce_budget(df: DataFrame, error: str = "error", max_bad: int | None = None) -> DataFrame:
    """``df`` unchanged, unless more than ``max_bad`` rows have an error; None is no limit."""
    if max_bad is None:
        return df
    if df.filter(F.col(error).isNotNull()).limit(max_bad + 1).count() > max_bad:
        raise BudgetExceeded(f"more than {max_bad} units failed")
    return df


def unexpected_languages(df: DataFrame, languages: list[str] = EXPECTED_LANGUAGES) -> DataFrame:
    return df.filter(~F.col("language").isin(languages) | F.col("language").isNull()).select("language").distinct()


def validate_submission(
    df: DataFrame, rows: int = EXPECTED_ROWS, languages: list[str] = EXPECTED_LANGUAGES
) -> DataFrame:
    """One row per check (``check``, ``ok``, ``detail``), all of them whether they pass or not."""
    blank = F.coalesce(is_blank("transcription"), F.lit(True))
    # Reduced to one row per language first.
    per_language = df.groupBy("language").agg(F.count("*").alias("n"), F.count_if(blank).alias("blank"))
    bad = F.col("language").isNull() | ~F.col("language").isin(languages)
    named = F.when(bad, F.coalesce("language", F.lit("NULL")))
    seen = per_language.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("blank"), F.lit(0)).alias("blank"),
        F.array_join(F.sort_array(F.collect_set(named)), ",").alias("bad"),
    )

    def check(name: str, ok: Column, detail: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), ok.alias("ok"), detail.cast("string").alias("detail"))

    checks = F.array(
        check("row_count", F.col("n") == rows, F.col("n")),
        check("languages", F.col("bad") == "", F.col("bad")),
        check("blank_cells", F.col("blank") == 0, F.col("blank")),
    )
    return seen.select(F.inline(checks))


def loss_report(df: DataFrame) -> DataFrame:
    """Where placeholder rows come from; ``status`` is decode_failed, backfilled or transcribed."""
    blank = F.coalesce(is_blank("transcription"), F.lit(True))
    return df.agg(
        F.count_if(F.col("status") == "decode_failed").alias("decode_failed"),
        F.count_if((F.col("status") == "transcribed") & blank).alias("model_blank"),
        F.count_if(F.col("status") == "backfilled").alias("backfilled"),
    )


def normalize_metrics(text: str = "transcription") -> list[Column]:
    """Aggregates of the clean-up report, over the columns ``text`` and ``_before``."""
    after = F.col(text)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sort_array(F.collect_set("language")).alias("languages"),
        F.count_if(F.col("_changed")).alias("changed"),
        F.count_if(F.col("_foreign")).alias("foreign"),
        F.count_if(after.isNull()).alias("nulls"),
        F.count_if(is_blank(after)).alias("blank"),
    ]


def normalized(df: DataFrame, text: str = "transcription") -> DataFrame:
    """Clean ``text`` and mark rows that changed beyond composition and rows that had foreign letters."""
    composed = df.withColumn("_composed", nfc(F.coalesce(F.col(text), F.lit(""))))
    cleaned = composed.withColumns(
        {"_foreign": has_foreign(text, "_composed"), text: normalize_text(text, "_composed")}
    )
    return cleaned.withColumn("_changed", F.col("_composed") != F.col(text)).drop("_composed")


def normalize_report(df: DataFrame, text: str = "transcription") -> DataFrame:
    return normalized(df, text).agg(*normalize_metrics(text))


def complete_submission(results: DataFrame, ids: DataFrame, order: list[str]) -> DataFrame:
    """Every id of ``results`` and ``ids`` exactly once, never NULL or blank.

    The first result of an id wins by ``order`` (columns of ``results``); ids without a result take the language of
    their lowest ``order`` in ``ids``. One shuffle does both, and copies of an id are reduced before it.
    """
    done = results.select("id", "language", "transcription", F.lit(0).alias("_late"), *order)
    open_ids = ids.select("id", "language", F.lit(PLACEHOLDER).alias("transcription"), F.lit(1).alias("_late"), *order)
    first = keep_first(done.unionByName(open_ids), ["id"], ["_late", *order])
    return to_submission(first.withColumn("transcription", scrub("transcription")))
