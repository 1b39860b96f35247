"""Exact ranks and running sums in which no task ever holds a whole group.

A group (language, source, shard) may own a third of all rows, so a window over the group alone would
put that third into one task. Every function here takes ``coarse``: a column that cuts a group's order
into slices of bounded size (rows of a lower slice come first). Slices are counted with a map-side
aggregate, and only the small table of slice totals is summed up per group.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only after it was seen to be within both bounds; otherwise the join shuffles.
BROADCAST_MAX_ROWS = 250_000
BROADCAST_MAX_BYTES = 32 << 20
SLICE_DIGITS = 3  # hex digits of the order hash: 4096 slices per group


def order_hash(key: str | Column, seed: int) -> Column:
    """Seeded order of a key, equal on every engine that has md5."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))


def hash_slice(hashed: Column) -> Column:
    return F.substring(hashed, 1, SLICE_DIGITS)


def number_slice(order: str | Column, rows: int = 1 << 16) -> Column:
    """Slices of ``rows`` consecutive values of a whole-number order column."""
    order = F.col(order) if isinstance(order, str) else order
    return F.floor(order / rows)


def even_slice(df: DataFrame, order: str, rows: int = 1 << 16) -> Column:
    """Slices of about ``rows`` rows of any whole-number order column, however far apart its values are.

    One aggregate finds the range and the count; a dense order gets the slices of ``number_slice``.
    """
    low, high, count = df.agg(F.min(order), F.max(order), F.count(order)).first()
    if not count:
        return F.lit(0)
    # Doubles round, but never put a later value into an earlier slice.
    width = max(1.0, (float(high) - float(low) + 1) / -(-count // rows))
    return F.floor((F.col(order).cast("double") - float(low)) / width)


def small_side(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``df`` as a broadcast table if it is within the bounds, else ``df`` unchanged.

    Reads at most the bound plus one row to the driver; give a lower bound for rows that hold texts.
    """
    max_rows = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    df = df.select(*[F.col(f"`{f.name}`").cast(_nullable(f.dataType)).alias(f.name) for f in df.schema])
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows or head.nbytes > BROADCAST_MAX_BYTES:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(head))


def _nullable(dtype: T.DataType) -> T.DataType:
    """The type with all struct fields nullable: Arrow tables with NULL structs are read back only so."""
    if not isinstance(dtype, T.StructType):
        return dtype
    return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in dtype])


def join_null_safe(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Equi-join that pairs NULL keys too; the key columns of ``left`` are kept."""
    renamed = right.withColumnsRenamed({name: f"_key_{name}" for name in by})
    condition = reduce(and_, [left[name].eqNullSafe(renamed[f"_key_{name}"]) for name in by])
    return left.join(renamed, condition, how).drop(*[f"_key_{name}" for name in by])


def attach(df: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """Add the columns of ``groups`` (one row per value of ``by``) to every row of ``df``."""
    if by:
        return join_null_safe(df, small_side(groups), by)
    (row,) = groups.collect()  # a global aggregate: exactly one row
    return df.withColumns({field.name: _literal(row[field.name], field.dataType) for field in groups.schema})


def _literal(value, dtype) -> Column:
    if value is None or not hasattr(dtype, "fields"):
        return F.lit(value).cast(dtype)
    return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in dtype.fields])


def _sliced(df: DataFrame, by: list[str], coarse: Column) -> tuple[DataFrame, Window]:
    """``df`` with ``_key``, its group and slice as one value that is never NULL, and the window over one slice.

    Windows and joins on ``_key`` share one shuffle: rows of NULL groups meet without a null-safe comparison.
    """
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(by)], coarse.alias("slice"))
    return df.withColumn("_key", key), Window.partitionBy("_key")


def _earlier_slices(by: list[str]) -> Window:
    return Window.partitionBy(*[F.col(f"_key.k{i}") for i in range(len(by))]).orderBy("_key.slice")


def _with_slice_values(rows: DataFrame, values: DataFrame) -> DataFrame:
    """``values`` (one row per ``_key``) beside the rows, which stay where the window over their slice left them."""
    return rows.join(values.hint("merge"), "_key").drop("_key")


def running_sums(
    df: DataFrame, by: list[str], coarse: Column, order: list[str], sums: dict[str, Column]
) -> DataFrame:
    """Add inclusive running sums of ``sums`` within ``by`` in ``order``.

    Rows are shuffled once, to their slice. The totals of the slices come from the same rows.
    """
    sliced, slices = _sliced(df.withColumns({f"_of_{name}": value for name, value in sums.items()}), by, coarse)
    before = _earlier_slices(by).rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy("_key").agg(*[F.sum(f"_of_{name}").alias(f"_all_{name}") for name in sums])
    offsets = totals.select(
        "_key", *[F.coalesce(F.sum(f"_all_{name}").over(before), F.lit(0)).alias(f"_before_{name}") for name in sums]
    )
    within = slices.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = sliced.select(*df.columns, "_key", *[F.sum(f"_of_{name}").over(within).alias(f"_in_{name}") for name in sums])
    joined = _with_slice_values(summed, offsets)
    return joined.select(*df.columns, *[(F.col(f"_in_{name}") + F.col(f"_before_{name}")).alias(name) for name in sums])


def ranked(df: DataFrame, by: list[str], coarse: Column, order: list[str], name: str = "rank") -> DataFrame:
    """Add the 1-based rank of each row within ``by``; ``order`` must be unique there."""
    return running_sums(df, by, coarse, order, {name: F.lit(1).cast("bigint")})


def rank_cutoffs(
    df: DataFrame,
    by: list[str],
    coarse: Column,
    order: list[Column],
    ranks: dict[str, Column | int],
    targets: DataFrame | None = None,
) -> DataFrame:
    """One row per group: its row count ``_total`` and, per name in ``ranks``, the order values found at that rank.

    A rank below 1 or above ``_total`` gives NULL. ``ranks`` may use ``_total`` and the columns of ``targets`` (one row
    per group, groups without one are left out), which are passed on. Only key columns are read, and only the one slice
    per group and name that holds the rank is sorted.
    """
    keys = df.select(*by, coarse.alias("_slice"), F.struct(*order).alias("_order"))
    group = Window.partitionBy(*by)
    upto = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = (
        keys.groupBy(*by, "_slice")
        .agg(F.count("*").alias("_n"))
        .withColumns({"_upto": F.sum("_n").over(upto), "_total": F.sum("_n").over(group)})
    )
    passed = []
    if targets is not None:
        passed = [c for c in targets.columns if c not in by]
        spans = join_null_safe(spans, targets, by)
    before = F.col("_upto") - F.col("_n")
    found = []
    for name, rank in ranks.items():
        rank = F.lit(rank) if isinstance(rank, int) else rank
        inside = (rank > before) & (rank <= F.col("_upto"))
        need = F.struct(F.col("_slice").alias("slice"), (rank - before).cast("bigint").alias("need"))
        found.append(F.max(F.when(inside, need)).alias(f"_edge_{name}"))
    edges = spans.groupBy(*by).agg(*[F.max(c).alias(c) for c in ["_total", *passed]], *found)
    edges = small_side(edges) if by else edges

    in_edge = reduce(lambda a, b: a | b, [F.col("_slice") == F.col(f"_edge_{n}.slice") for n in ranks])
    within = Window.partitionBy(*by, "_slice").orderBy("_order")
    located = join_null_safe(keys, edges, by) if by else attach(keys, edges, by)
    hits = located.filter(in_edge).withColumn("_rank", F.row_number().over(within))
    at = [
        F.max(
            F.when(
                (F.col("_slice") == F.col(f"_edge_{n}.slice")) & (F.col("_rank") == F.col(f"_edge_{n}.need")),
                F.col("_order"),
            )
        ).alias(n)
        for n in ranks
    ]
    marks = hits.groupBy(*by).agg(*at)
    totals = edges.select(*by, "_total", *passed)
    if not by:
        return attach(totals, marks, by)
    return join_null_safe(totals, marks, by, "left")


def take_ranks(
    df: DataFrame, by: list[str], coarse: Column, order: list[Column], skip: int = 0, take: int = 0
) -> DataFrame:
    """Rows ranked in ``(skip, skip + take]`` of their group; ``take=0`` means all after ``skip``.

    The wide rows are filtered in place by the order values at the two ends; they are never shuffled or sorted.
    """
    ranks = {}
    if skip:
        ranks["_low"] = skip
    if take:
        ranks["_high"] = skip + take
    if not ranks:
        return df
    cutoffs = rank_cutoffs(df, by, coarse, order, ranks)
    if not by:
        return _between(df, cutoffs.first(), order, skip, take)
    position = F.struct(*order)
    keep = F.lit(True)
    if skip:
        keep = keep & F.coalesce(position > F.col("_low"), F.lit(False))
    if take:
        keep = keep & ((F.col("_total") <= skip + take) | F.coalesce(position <= F.col("_high"), F.lit(False)))
    return attach(df, cutoffs, by).filter(keep).select(*df.columns)


def _between(df: DataFrame, ends, order: list[Column], skip: int, take: int) -> DataFrame:
    """``take_ranks`` of a table without groups: both ends are constants.

    The bounds on the first order column are stated on their own, so that the scan can skip files and row groups.
    """
    types = df.select(F.struct(*order).alias("o")).schema["o"].dataType
    if skip:
        if ends["_low"] is None:
            return df.filter(F.lit(False))
        df = df.filter((order[0] >= F.lit(ends["_low"][0])) & (F.struct(*order) > _literal(ends["_low"], types)))
    if take and (ends["_total"] or 0) > skip + take:
        df = df.filter((order[0] <= F.lit(ends["_high"][0])) & (F.struct(*order) <= _literal(ends["_high"], types)))
    return df


def with_previous(df: DataFrame, by: list[str], coarse: Column, order: list[str], value: str, name: str) -> DataFrame:
    """Add ``value`` of the row before in ``by`` by ``order`` (NULL for the first), slice by slice.

    The first row of a slice takes the last value of the nearest earlier slice.
    """
    sliced, slices = _sliced(df, by, coarse)
    last = F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_end")
    carried = sliced.groupBy("_key").agg(last).select("_key", F.lag("_end").over(_earlier_slices(by)).alias("_carry"))
    before = F.lag(F.struct(F.col(value).alias("v"))).over(slices.orderBy(*order)).alias("_before")
    joined = _with_slice_values(sliced.select(*df.columns, "_key", before), carried)
    return joined.select(*df.columns, F.coalesce("_before", "_carry")["v"].alias(name))
