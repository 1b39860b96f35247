"""Projections and row filters."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechlake.operators.ranking import BROADCAST_MAX_ROWS
from speechlake.schemas import LAKE_COLUMNS, SUBMISSION

# Split names of the sources that differ from ours, and the clip length bounds in samples.
SPLIT_NAMES = {"validation": "dev"}
MIN_AUDIO_LEN = 32_000
MAX_AUDIO_LEN = 960_000


def to_lake_schema(df: DataFrame, split: str | Column, corpus: str, keep: list[str] = ()) -> DataFrame:
    """The six columns of the utterance table, in order, and those to ``keep``; ``split`` is a constant or a column."""
    split = F.lit(split) if isinstance(split, str) else split
    return (
        df.withColumnRenamed("transcription", "text")
        .withColumns({"split": split, "corpus": F.lit(corpus)})
        .select(*LAKE_COLUMNS, *keep)
    )


def set_language(df: DataFrame, code: str) -> DataFrame:
    """Replace the source's own ``language`` by ``code`` and drop its ``split``, if there are any."""
    return df.drop("language", "split").withColumn("language", F.lit(code))


def flatten_structs(df: DataFrame) -> DataFrame:
    """Struct columns become one ``parent.child`` column per child, one level deep."""
    flat = []
    for field in df.schema:
        if isinstance(field.dataType, T.StructType):
            for child in field.dataType.names:
                flat.append(F.col(f"`{field.name}`.`{child}`").alias(f"{field.name}.{child}"))
        else:
            flat.append(F.col(f"`{field.name}`"))
    return df.select(*flat)


def rename_values(df: DataFrame, column: str, mapping: dict[str, str] = SPLIT_NAMES) -> DataFrame:
    """Replace the listed values of a column; all others stay."""
    return df.replace(mapping, subset=[column])


def drop_unlabeled(df: DataFrame, column: str = "transcription") -> DataFrame:
    """Drop NULL and empty texts. A text of white space counts as labeled."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def drop_failed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("audio_size").isNotNull())


def filter_length(
    df: DataFrame, column: str = "audio_size", low: int = MIN_AUDIO_LEN, high: int = MAX_AUDIO_LEN
) -> DataFrame:
    """Keep clips of ``low`` to ``high`` samples, both ends included."""
    return df.filter(F.col(column).between(low, high))


def _code_names(mapping: dict[str, str]) -> dict[str, str]:
    """Lower-case full and short names -> code."""
    names: dict[str, str] = {}
    for source, code in mapping.items():
        for name in {source.lower(), source.rsplit("/", 1)[-1].lower()}:
            if names.setdefault(name, code) != code:
                raise ValueError(f"the short name {name!r} stands for several sources")
    return names


def resolve_code(source: str, mapping: dict[str, str]) -> str:
    """Code of one source, named in full or by the part after ``/``, in any case."""
    names = _code_names(mapping)
    if source.lower() not in names:
        raise ValueError(f"unknown source {source!r}; choose from {list(mapping)}")
    return names[source.lower()]


def _code_table(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    names = _code_names(mapping)
    table = df.sparkSession.createDataFrame(list(names.items()), "_name string, _code string")
    return F.broadcast(table) if len(names) <= BROADCAST_MAX_ROWS else table


def map_codes(df: DataFrame, column: str, mapping: dict[str, str], name: str = "language") -> DataFrame:
    """``resolve_code`` for a column; rows of unknown sources get NULL (see ``unknown_codes``)."""
    table = _code_table(df, mapping)
    return (
        df.join(table, F.lower(F.col(column)) == F.col("_name"), "left").withColumn(name, F.col("_code")).drop("_name", "_code")
    )


def unknown_codes(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    """The distinct sources that ``map_codes`` cannot resolve."""
    table = _code_table(df, mapping)
    return df.select(column).distinct().join(table, F.lower(F.col(column)) == F.col("_name"), "left_anti")


def select_splits(df: DataFrame, splits: str) -> DataFrame:
    """Rows of the comma-separated splits; prunes partitions when ``df`` is the lake."""
    return df.filter(F.col("split").isin(splits.split(",")))


def to_submission(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SUBMISSION])
