"""Best-fit packing of documents into sequences of several permitted lengths."""

from bisect import bisect_left, insort
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZES = (2048, 4096, 8192, 16384, 32768)
SHARD_LENGTH = 512 * max(SIZES)  # summed length of what one task packs, about


def sequence_cost(size: int) -> float:
    """Cost of training on one sequence: linear layers, attention over pairs, and a fixed part per sequence."""
    return size + size * size / 65536 + 64


def pack(lengths: list[int], sizes=SIZES, cost: Callable[[int], float] = sequence_cost) -> tuple[list[tuple[int, int]], list[int]]:
    """(bin, start in the bin) of each length, and the size of each bin; every length is at most the largest size.

    Lengths go in decreasing order into the bin that they leave least room in. If none has room, a bin opens with the
    size of the least cost per unit among those the length fits into and that are at least as large as the plan says.
    All permitted sizes are tried as that plan; the cheapest outcome after every bin has shrunk to the least size that
    holds its contents is kept.
    """
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    best = None
    for floor in sizes:
        places: list[tuple[int, int]] = [(0, 0)] * len(lengths)
        used: list[int] = []
        room: list[tuple[int, int]] = []  # (free, bin), sorted
        for i in order:
            n = lengths[i]
            at = bisect_left(room, (n, -1))
            if at < len(room):
                free, bin_no = room.pop(at)
            else:
                fitting = [s for s in sizes if s >= n]
                free = min([s for s in fitting if s >= floor] or fitting, key=lambda s: (cost(s) / s, s))
                bin_no = len(used)
                used.append(0)
            places[i] = (bin_no, used[bin_no])
            used[bin_no] += n
            if free > n:
                insort(room, (free - n, bin_no))
        shrunk = [min(s for s in sizes if s >= u) for u in used]
        total = sum(map(cost, shrunk))
        if best is None or total < best[0]:
            best = (total, places, shrunk)
    return best[1], best[2]


def pack_documents(
    docs: DataFrame, key: str = "doc_id", length: Column | None = None, sizes=SIZES,
    cost: Callable[[int], float] = sequence_cost, shard_length: int = SHARD_LENGTH,
) -> DataFrame:
    """Places of all documents in training sequences, one row per piece of a document.

    ``key``, ``piece`` (from 0), ``start`` (in the document), ``length``, ``bin_id``, ``bin_size`` (a permitted size)
    and ``bin_start``. ``length`` is the length of a document in tokens (default: UTF-8 bytes of ``text``, the tokens
    of a byte model). Documents longer than the largest size are cut into pieces of that size and a rest, so nothing
    is dropped. Documents of length 0 or null take no room: they have one piece without a bin. Pieces are dealt by a
    hash into shards of about ``shard_length``, which are packed on their own: no source or large document decides the
    size of a task. Repeated rows are packed each; an empty table gives no rows; further columns are not read.
    """
    sizes = tuple(sorted(sizes))
    largest = sizes[-1]
    length = F.octet_length("text") if length is None else length
    whole = docs.select(F.col(key).alias("key"), F.coalesce(length, F.lit(0)).cast("bigint").alias("n"))
    # Equal rows are counted and numbered, so that they do not share a shard.
    rows = whole.filter("n > 0").groupBy("key", "n").agg(F.count("*").alias("m")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "m")))
    total = whole.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // shard_length))
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("n") / largest) - 1, F.lit(0)).cast("bigint"))))
    pieces = pieces.select("key", "copy", "piece", (F.col("piece") * largest).alias("start"), F.least(F.col("n") - F.col("piece") * largest, F.lit(largest)).alias("length"))
    spread = F.xxhash64("key", "piece", "length", "copy")
    dealt = pieces.withColumn("shard", F.pmod(spread, F.lit(shards))).drop("copy")
    kind = rows.schema["key"].dataType.simpleString()

    def run(group: tuple, table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_pylist()
        places, bins = pack(lengths, sizes, cost)
        shard = group[0].as_py() << 32
        added = [pa.array(column, pa.int64()) for column in zip(*[(shard + bin_no, bins[bin_no], start) for bin_no, start in places])]
        return pa.Table.from_arrays([*[table.column(c) for c in ("key", "piece", "start", "length")], *added], names=["key", "piece", "start", "length", "bin_id", "bin_size", "bin_start"])

    schema = f"key {kind}, piece bigint, start bigint, length bigint, bin_id bigint, bin_size bigint, bin_start bigint"
    none = [F.lit(None).cast("bigint").alias(c) for c in ("bin_id", "bin_size", "bin_start")]
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("piece", "start", "length")]
    placed = dealt.groupBy("shard").applyInArrow(run, schema)
    return placed.unionByName(whole.filter("n <= 0").select("key", *zero, *none)).withColumnRenamed("key", key)
