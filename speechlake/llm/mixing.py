"""Mixing sources to target weights by Poisson replication, with DataFrame functions only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechlake.llm.common import broadcast_within

TEMPERATURE = 0.5
SOURCES_BROADCAST = 10_000  # sources up to which the table of rates is broadcast


def uniform(seed: int, *keys: str | Column) -> Column:
    """A number in [0, 1) with 52 bits from the hash of a seed and keys, the same on every engine that has md5."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    hashed = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.conv(F.substring(hashed, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... up to where the rest is below the last bit of a double, for any rate of 0 or more."""
    last = F.ceil(rate + F.lit(12.0) * F.sqrt(rate) + F.lit(30.0)).cast("int")
    # Terms from their logarithms, so that a large rate does not start at an underflow.
    start = F.struct(F.lit(0.0).alias("log_k"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("cdf"))

    def add(state: Column, k: Column) -> Column:
        log_k = state["log_k"] + F.when(k > 0, F.ln(F.greatest(k, F.lit(1)).cast("double"))).otherwise(0.0)
        total = state["sum"] + F.exp(k * F.ln(rate) - rate - log_k)
        return F.struct(log_k.alias("log_k"), total.alias("sum"), F.concat(state["cdf"], F.array(total)).alias("cdf"))

    filled = F.aggregate(F.sequence(F.lit(0), last), start, add, lambda state: state["cdf"])
    return F.when(rate > 0, filled).otherwise(F.array(F.lit(1.0)))


def source_rates(
    docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, source: str = "source",
    size: Column | None = None, temperature: float = TEMPERATURE,
) -> DataFrame:
    """One row per source: ``source``, its ``total`` size, target ``share`` and mean repetition ``rate``.

    A source's rate is its share of ``epochs`` times the whole size, over its own size. Without ``weights`` the shares
    follow size to the power ``temperature``; with them, sources that are not named get none.
    """
    size = F.length("text") if size is None else size
    sources = docs.select(F.col(source).alias("source"), F.coalesce(size, F.lit(0)).cast("double").alias("size"))
    totals = sources.groupBy("source").agg(F.sum("size").alias("total"))
    if weights is None:
        wanted = F.pow(F.col("total"), F.lit(temperature))
    else:
        pairs = [F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))]
        wanted = F.coalesce(F.try_element_at(F.create_map(*pairs), F.coalesce("source", F.lit(""))), F.lit(0.0)) if pairs else F.lit(0.0)
    weighed = totals.withColumn("weight", F.when(F.col("total") > 0, wanted).otherwise(0.0))
    whole, all_weight = (x or 0.0 for x in weighed.agg(F.sum("total"), F.sum("weight")).first())
    share = F.col("weight") / all_weight if all_weight else F.lit(0.0)
    rate = F.when(F.col("total") > 0, F.lit(epochs * whole) * F.col("share") / F.col("total")).otherwise(0.0)
    return weighed.withColumn("share", share).withColumn("rate", rate).select("source", "total", "share", "rate")


def mix_sources(
    docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, seed: int = 17, key: str = "doc_id",
    source: str = "source", size: Column | None = None, temperature: float = TEMPERATURE, text: str = "text",
) -> DataFrame:
    """``docs`` with each row repeated so that the sources have their target shares, in global random order.

    A row occurs as often as the inverted Poisson distribution of its source's rate says at the hash of the row's key and
    text, so counts do not depend on partitions or retries. Adds ``copy`` (from 1), ``rate`` and ``shuffle_key`` (uniform in [0, 1)). Rows
    are dealt out by the shuffle key and sorted by it in each partition, so their order has nothing of the source's.
    A null source is a source of its own without ``weights`` and gets no share with them; equal rows get equal counts
    and keep all their copies; null keys hash as "null", and different texts of one key draw apart; sources of size 0
    are left out; an empty table stays empty.
    Columns of ``docs`` named like the added ones are replaced.
    """
    rates = source_rates(docs, weights, epochs, source, size, temperature).withColumn("_cdf", poisson_cdf(F.col("rate")))
    rates = broadcast_within(rates.select(F.col("source").alias("_source"), F.col("rate").alias("_rate"), "_cdf"), SOURCES_BROADCAST)
    digest = F.md5(F.coalesce(F.col(text), F.lit("")))
    u = uniform(seed, key, digest)
    count = F.size(F.filter("_cdf", lambda c: c <= u))
    added = ["copy", "rate", "shuffle_key"]
    kept = [c for c in docs.columns if c not in added]
    replicated = (
        docs.select(*[F.col(f"`{c}`") for c in kept])
        .join(rates, F.col(f"`{source}`").eqNullSafe(F.col("_source")))
        .withColumn("_count", count)
        .filter("_count > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_count"))))
        .withColumn("shuffle_key", uniform(seed + 1, key, digest, F.col("copy")))
        .select(*[F.col(f"`{c}`") for c in kept], "copy", F.col("_rate").alias("rate"), "shuffle_key")
    )
    return replicated.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
