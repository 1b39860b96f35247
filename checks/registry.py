from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query ``(spark, sf_dir) -> DataFrame`` and its SQL, if it has one."""

    def register(query):
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_sql(key: str, seed: int) -> str:
    return f"md5('{seed}|' || ({key})::varchar)"
