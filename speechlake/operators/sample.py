"""Deterministic sampling.

All orders are hash orders of (seed, row key), so they do not depend on partitioning, file order or the size
of the sample: chunks cut with the same seed are disjoint whatever their sizes.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from speechlake.operators.ranking import attach, even_slice, hash_slice, join_null_safe, order_hash, rank_cutoffs, ranked, take_ranks

# Default seed, size of the eval head, split fractions and temperature exponents.
SEED = 123
EVAL_HEAD = 500
TEST_FRACTION = 0.05
DEV_FRACTION = 0.05
BETA = 0.5


def _hash_order(key: str, seed: int) -> tuple[Column, list[Column]]:
    hashed = order_hash(key, seed)
    return hash_slice(hashed), [hashed.alias("hash"), F.col(key).alias("key")]


def seeded_shuffle(df: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """All rows in seeded order (a range-partitioned sort)."""
    return df.orderBy(order_hash(key, seed), key)


def shuffle_position(df: DataFrame, key: str, seed: int = SEED, by: list[str] = (), name: str = "position") -> DataFrame:
    """Number the rows in seeded order, from 1, without sorting them globally."""
    hashed = df.withColumn("_hash", order_hash(key, seed))
    return ranked(hashed, list(by), hash_slice(F.col("_hash")), ["_hash", key], name).drop("_hash")


def skip_take(
    df: DataFrame, key: str, skip: int = 0, take: int = 0, seed: int = SEED, by: list[str] = ()
) -> DataFrame:
    """Rows ``skip + 1 .. skip + take`` of each source in seeded order; ``take=0`` is all of the rest."""
    coarse, order = _hash_order(key, seed)
    return take_ranks(df, list(by), coarse, order, skip, take)


def eval_head(
    df: DataFrame, by: list[str], order: list[str], coarse: Column, skip: int = 0, take: int = 0, cap: int = EVAL_HEAD
) -> DataFrame:
    """The fixed evaluation rows: the first ``min(take, cap)`` in source order, all for ``take=0``.

    Later rounds (``skip > 0``) add none.
    """
    if skip:
        return df.filter(F.lit(False))
    return take_ranks(df, list(by), coarse, [F.col(c) for c in order], 0, min(take, cap))


def hash_fraction(key: str | Column, seed: int) -> Column:
    """A number in [0, 1) from the first 32 bits of the order hash."""
    return F.conv(F.substring(order_hash(key, seed), 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def carve_splits(
    df: DataFrame, key: str, test_frac: float = TEST_FRACTION, dev_frac: float = DEV_FRACTION, seed: int = SEED
) -> DataFrame:
    """Add ``split``: test, dev or train by the hash fraction of the row key."""
    r = hash_fraction(key, seed)
    split = F.when(r < test_frac, "test").when(r < test_frac + dev_frac, "dev").otherwise("train")
    return df.withColumn("split", split)


def cap_per_group(df: DataFrame, by: list[str], order: list[str], coarse: Column, cap: int) -> DataFrame:
    """The first ``cap`` rows of each group in ``order``; 0 keeps all."""
    return take_ranks(df, list(by), coarse, [F.col(c) for c in order], 0, cap)


def mix_weights(stats: DataFrame, beta_corpus: float = BETA, beta_language: float = BETA) -> DataFrame:
    """Sampling weight per (corpus, language), summing to 1.

    A corpus weighs its hours to the power ``beta_corpus``, a language within its corpus its hours to the power
    ``beta_language``, each as a share of the total. ``stats`` has one row per (corpus, language).
    """
    corpora = (
        stats.groupBy("corpus")
        .agg(
            F.pow(F.sum("hours"), F.lit(beta_corpus)).alias("_corpus"),
            F.sum(F.pow("hours", F.lit(beta_language))).alias("_languages"),
        )
        .withColumn("_corpora", F.sum("_corpus").over(Window.partitionBy()))  # over one row per corpus
    )
    shares = join_null_safe(stats, corpora, ["corpus"])
    language = F.when(F.col("_languages") > 0, F.pow("hours", F.lit(beta_language)) / F.col("_languages")).otherwise(0.0)
    corpus = F.when(F.col("_corpora") > 0, F.col("_corpus") / F.col("_corpora")).otherwise(0.0)
    return shares.select("corpus", "language", "hours", (corpus * language).alias("weight"))


def mix_quotas(weights: DataFrame, rows: int) -> DataFrame:
    """Whole-number quotas that sum to ``rows``: floors, the rest by largest remainder, ties by name."""
    exact = F.col("weight") * F.lit(rows)
    floors = weights.withColumns({"_floor": F.floor(exact), "_rest": exact - F.floor(exact)})
    # One row per (corpus, language): this window sees the stats table, never the utterances.
    order = Window.orderBy(F.round("_rest", 9).desc(), "corpus", "language")
    left = F.lit(rows) - F.sum("_floor").over(Window.partitionBy())
    quota = F.col("_floor") + F.when(F.row_number().over(order) <= left, 1).otherwise(0)
    return floors.withColumn("quota", quota.cast("bigint")).drop("_floor", "_rest")


def temperature_sample(df: DataFrame, quotas: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """Exactly ``quota`` rows of every (corpus, language); small groups are repeated, ``copy`` counts from 1.

    A group of n rows gets ``quota div n`` copies of each row and one more of the first ``quota mod n`` in seeded
    order. Groups without rows stay empty.
    """
    by = ["corpus", "language"]
    coarse, order = _hash_order(key, seed)
    extra = F.pmod(F.col("quota"), F.col("_total"))
    cutoffs = rank_cutoffs(df, by, coarse, order, {"_cut": extra}, quotas.select(*by, "quota"))
    marked = attach(df, cutoffs, by)
    one_more = F.coalesce(F.struct(*order) <= F.col("_cut"), F.lit(False)).cast("bigint")
    copies = F.floor(F.col("quota") / F.col("_total")) + one_more
    return (
        marked.withColumn("_n", copies)
        .filter(F.col("_n") > 0)
        .select(*df.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("copy"))
    )


def windowed_shuffle(
    df: DataFrame, order: str, key: str, window: int, seed: int = SEED, coarse: Column | None = None
) -> DataFrame:
    """Add ``position``: source order with rows shuffled inside blocks of ``window``; 1 leaves the order as it is."""
    numbered = ranked(df, [], even_slice(df, order) if coarse is None else coarse, [order], "position")
    if window == 1:
        return numbered
    block = F.floor((F.col("position") - 1) / window)
    inside = Window.partitionBy("_block").orderBy(order_hash(key, seed), key)
    return (
        numbered.withColumn("_block", block)
        .withColumn("position", F.col("_block") * window + F.row_number().over(inside))
        .drop("_block")
    )


def first_rows(df: DataFrame, order: list[str], count: int) -> DataFrame:
    """Smoke run: only the first ``count`` rows in source order; 0 keeps all."""
    return df.orderBy(*order).limit(count) if count else df
