"""Approximate nearest neighbours by inner product with a hash-prefix forest.

Each tree gives every vector a long hash string: signs on random hyperplanes, after one more component has made all
vectors equally long, so that the angle orders them as the inner product does. A tree is its strings in sorted order, cut
into slices by their first bits. A query descends every tree to the rows that share the longest prefix with it; then all
trees ascend together, one bit at a time, until the rows that share a prefix of that length with the query, over all
trees, are as many as asked for. Those rows are scored on their original vectors.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechlake.llm.common import written
from speechlake.llm.vectors import best, from_block, matrix, packed, top_rows, usable

TREES, BITS, SEED = 16, 32, 5
SLICE_ROWS, QUERY_ROWS = 4096, 512
CANDIDATES = 0.9  # rows asked for, as a share of the table and counted once per tree (see ``nearest``)
FEWEST = 2000  # but no fewer than that


def planes(length: int, trees: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((trees * BITS, length + 1))


def hash_strings(vectors: np.ndarray, extra: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(rows, trees) of BITS-bit strings, the first bit highest."""
    signs = np.column_stack([vectors, extra]) @ planes.T > 0
    whole = np.packbits(signs.reshape(len(vectors), -1, BITS), axis=2).view(">u4")[:, :, 0]
    return whole.astype(np.int64)


def strings(rows: DataFrame, length: int, kind: str, longest: float, trees: int, is_query: bool) -> DataFrame:
    """``tree``, ``code``, ``id``, ``v`` for every tree. Rows are lifted to length ``longest``; queries are not."""
    wide = rows.schema["v"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = planes(length, trees)
        for batch in batches:
            vectors = matrix(batch.column(1), length, kind).astype(np.float64)
            squares = (vectors * vectors).sum(axis=1)
            extra = np.zeros(len(vectors)) if is_query else np.sqrt(np.maximum(longest**2 - squares, 0))
            codes = hash_strings(vectors, extra, own)
            for tree in range(trees):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(vectors), tree, np.int32)), pa.array(codes[:, tree]), *batch.columns], names=["tree", "code", "id", "v"]
                )

    return rows.mapInArrow(run, f"tree int, code bigint, id bigint, v {wide}")


def prefix_ranges(codes: np.ndarray, asked: np.ndarray, depth: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 place in sorted ``codes`` of those that share the first ``depth`` bits with each asked code."""
    rest = BITS - depth
    low = (asked >> rest) << rest
    return np.searchsorted(codes, low), np.searchsorted(codes, low + (1 << rest))


def _counts(first: int, length: int, kind: str):
    """Rows of a slice that share prefixes of ``first`` .. BITS bits with each query of that slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, _, asked = from_block(*[batch.column(f"q_{c}")[i] for c in _NAMES], length, kind)
                _, _, codes = from_block(*[batch.column(c)[i] for c in _NAMES], length, kind)
                counts = []
                for depth in range(first, BITS + 1):
                    low, high = prefix_ranges(codes, asked, depth)
                    counts.append(high - low)
                per_query = pa.array(list(np.stack(counts, axis=1)), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(own), per_query], names=["query_id", "counts"])

    return run


def _visit(length: int, kind: str, k: int):
    """The ``k`` best rows of a slice for each query among those that share its prefix; depths come with the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, queries, asked = from_block(*[batch.column(f"q_{c}")[i] for c in _NAMES], length, kind)
                ids, vectors, codes = from_block(*[batch.column(c)[i] for c in _NAMES], length, kind)
                low, high = prefix_ranges(codes, asked >> 6, asked & 63)
                queries, vectors = queries.astype(np.float64), vectors.astype(np.float64)
                rough = queries @ vectors.T
                found = []
                for q in np.flatnonzero(high > low):
                    at = np.arange(low[q], high[q])
                    at = at[ids[at] != own[q]]
                    if len(at) > k:  # the product rounds as it likes; leave room for that
                        part = rough[q, at]
                        edge = np.partition(part, len(at) - k)[len(at) - k]
                        at = at[part >= edge - 1e-9 * (1 + abs(edge))]
                    scores = (vectors[at] * queries[q]).sum(axis=1)
                    top = top_rows(scores, ids[at], k)
                    found.append((np.full(len(top), own[q]), ids[at[top]], scores[top]))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["query_id", "vec_id", "score"])

    return run


_NAMES = ["ids", "vectors", "extra"]


def nearest(
    df: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vector: str = "embedding", trees: int = TREES,
    candidates: float = CANDIDATES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest rows found per query, ties to the smaller id.

    Queries are the rows whose key is divisible by ``every``, candidates all rows but the query's own; every row is in
    the index. All trees ascend until they hold ``candidates`` x rows, at least FEWEST, for a query. Vectors without
    direction (isotropic, as many random ones are) need about one visit per row and tree set for a recall over 0.9;
    clustered ones need a small part of that. Zero vectors take no part; for the rest see ``usable``. With fewer than
    ``k`` candidates all are returned; rows of the query's key are its own; an empty table gives no rows.
    """
    rows, length, kind = usable(df, key, vector)
    rows = written(rows.filter(F.exists("v", lambda x: x != 0)), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    total, longest = rows.agg(F.count("*"), F.coalesce(F.max(F.sqrt(square)), F.lit(0.0))).first()
    first = min(max(0, int(np.ceil(np.log2(max(total, 1) / SLICE_ROWS)))), BITS - 2)  # bits that name a slice
    top = F.shiftright("code", BITS - first)

    coded = strings(rows, length, kind, longest, trees, False).withColumn("top", top)
    slices = written(coded.groupBy("tree", "top").agg(F.count("*").alias("n")), "slices")
    parts = slices.select(F.col("tree").alias("_tree"), F.col("top").alias("_top"), F.ceil(F.col("n") / SLICE_ROWS).alias("parts"))
    dealt = coded.join(parts, (F.col("tree") == F.col("_tree")) & (F.col("top") == F.col("_top"))).withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
    forest = written(packed(dealt.select("tree", "top", "part", "code", "id", "v"), ["tree", "top", "part"], length, kind, "code"), "forest")

    asked = strings(rows.filter(F.col("id") % every == 0), length, kind, longest, trees, True).withColumn("top", top)
    asked = written(asked, "asked")
    blocks = max(1, -(-total // (every * QUERY_ROWS)))
    blocked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    at_home = _met(packed(blocked, ["tree", "top", "block"], length, kind, "code"), forest)
    deep = at_home.mapInArrow(_counts(first, length, kind), "query_id bigint, counts array<bigint>")
    deep = deep.select("query_id", F.posexplode("counts").alias("x", "n")).withColumn("x", F.col("x") + first)
    prefix = F.expr(f"shiftright(top, {first} - x)")
    levels = F.explode(F.sequence(F.lit(0), F.lit(max(first - 1, 0)))).alias("x")
    shared = slices.select("tree", "top", "n", levels).groupBy("tree", "x", prefix.alias("prefix")).agg(F.sum("n").alias("n"))
    shallow = asked.select(F.col("id").alias("query_id"), "tree", "top", levels).withColumn("prefix", prefix).join(shared, ["tree", "x", "prefix"])
    counts = deep if first == 0 else deep.unionByName(shallow.select("query_id", "x", "n"))
    want = max(int(candidates * total), FEWEST)
    per_level = counts.groupBy("query_id", "x").agg(F.sum("n").alias("n"))
    depths = per_level.groupBy("query_id").agg(F.coalesce(F.max(F.when(F.col("n") >= want, F.col("x"))), F.lit(0)).alias("depth"))

    # A prefix shorter than a slice's name covers a run of slices.
    run = F.greatest(F.lit(first) - F.col("depth"), F.lit(0))
    lowest = F.expr(f"shiftleft(shiftright(top, greatest({first} - depth, 0)), greatest({first} - depth, 0))")
    going = asked.join(depths, F.col("id") == F.col("query_id")).select(
        "tree", "id", "v", (F.shiftleft("code", 6) + F.col("depth")).alias("code_depth"),
        F.explode(F.sequence(lowest, lowest + F.pow(F.lit(2), run).cast("bigint") - 1)).alias("top"),
    )
    going = going.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    visits = _met(packed(going, ["tree", "top", "block"], length, kind, "code_depth"), forest)
    found = visits.mapInArrow(_visit(length, kind, k), "query_id bigint, vec_id bigint, score double")
    return best(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), k, "double")


def _met(queries: DataFrame, forest: DataFrame) -> DataFrame:
    """Blocks of queries beside the slices they are in."""
    queries = queries.select("tree", "top", *[F.col(c).alias(f"q_{c}") for c in _NAMES])
    return queries.join(forest.select("tree", "top", *_NAMES), ["tree", "top"]).drop("tree", "top")
