"""Merkle manifest of a table by time-forward processing.

A node is known by its label: the tree, the level, the place in the level. A sweep in the order of labels sends each
node's digest forward to its parent; a sweep back sends each node's rest of the proof to its children. What is sent waits
in an external priority queue ordered by label: the sorting shuffle between tiers of LEVELS levels, and a heap for the
levels of one block of a tier. No task holds more than a block, whatever the size of a tree.
"""

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from speechlake.llm.common import broadcast_within, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 10  # of one tier; a block has 2 ** LEVELS nodes
OFFSETS_BROADCAST = 100_000
_OUT_ROWS = 1024
LEFT, RIGHT = "<", ">"


def leaf_digest(*values: str | Column) -> Column:
    """SHA-256 (hex) of values as text: ``-`` for null, else UTF-8 bytes, ``:`` and the value."""
    texts = [(F.col(v) if isinstance(v, str) else v).cast("string") for v in values]
    parts = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def parent_digest(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def forward(digests: list[str], levels: int) -> tuple[str, list[tuple[tuple[int, int], list[str]]]]:
    """Digest at the top of a block, and the children's digests of every inner node in the order of labels."""
    if not levels:
        return digests[0], []
    queue = [((1, i >> 1), i, digest) for i, digest in enumerate(digests)]  # in order, so a heap
    nodes = []
    while queue:
        label, children = queue[0][0], []
        while queue and queue[0][0] == label:
            children.append(heapq.heappop(queue)[2])
        nodes.append((label, children))
        top = parent_digest(children)
        if label[0] < levels:
            heapq.heappush(queue, ((label[0] + 1, label[1] >> 1), label[1], top))
    return top, nodes


def backward(nodes: list[tuple[tuple[int, int], list[str]]], levels: int, rest: list[str]) -> list[list[str]]:
    """Proof of every leaf of a block: its siblings up to the top of the block, then ``rest``.

    A step is LEFT or RIGHT and the digest of the sibling on that side, or empty for a node without one.
    """
    proofs = {(levels, 0): (None, None)}  # linked from the top, so that nodes share what they have in common
    for (level, place), children in reversed(nodes):
        above = proofs.pop((level, place))
        steps = [RIGHT + children[1], LEFT + children[0]] if len(children) == 2 else [""]
        for i, step in enumerate(steps):
            proofs[(level - 1, 2 * place + i)] = (step, above)
    out = []
    for _, link in sorted(proofs.items()):
        own = []
        while link[1] is not None:
            own.append(link[0])
            link = link[1]
        out.append(own + rest)
    return out


def fold(leaf: str, proof: str = "proof") -> Column:
    """The root that a leaf's digest and a proof lead to."""
    sibling = lambda step: F.substring(step, 2, 64)

    def up(digest: Column, step: Column) -> Column:
        joined = F.when(step.startswith(LEFT), F.concat(sibling(step), digest)).otherwise(F.concat(digest, sibling(step)))
        return F.sha2(joined, 256)

    return F.aggregate(proof, F.col(leaf), up)


def proof_digest(proof: str = "proof") -> Column:
    """SHA-256 (hex) of a proof's siblings, from the leaf to the root."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.substring(step, 2, 64)), ""), 256)


def _levels(n: int) -> int:
    """Levels that a block of a tree of ``n`` nodes climbs: to the root, or to the next tier."""
    return min((n - 1).bit_length(), LEVELS)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == _OUT_ROWS:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def _mapped(df: DataFrame, of, schema: T.StructType) -> DataFrame:
    """``of`` applied to the rows of each partition, as tuples."""
    arrow = to_arrow_schema(schema)
    return df.mapInArrow(lambda batches: _batches(of(_rows(batches)), arrow), schema)


def _more(schema: T.StructType, fields: str) -> T.StructType:
    return T.StructType([*schema.fields, *T._parse_datatype_string(fields).fields])


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (``tree``, ``key``, ``digest``, ``claimed``) with ``at``, the place in the tree, and its size ``n``.

    Leaves are in the order of key and digest. They are dealt into ranges, counted where they lie, and only the counts per
    range and tree are summed up. Equal rows are told apart by their number, so that they do not share a range.
    """
    order = ["tree", "key", "digest", "number"]
    ranged = written(rows, "leaves").withColumn("number", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)

    def count(rows: Iterator[tuple]) -> Iterator[tuple]:
        part, tree, place = TaskContext.get().partitionId(), None, -1
        for row in rows:
            place, tree = (place + 1 if row[0] == tree else 0), row[0]
            yield *row, part, place

    placed = written(_mapped(ranged.drop("number"), count, _more(rows.schema, "part int, place bigint")), "placed")
    sizes = placed.groupBy("tree", "part").agg(F.count("*").alias("size"))
    trees = Window.partitionBy("tree")
    before = trees.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("tree").alias("_tree"), F.col("part").alias("_part"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_before"), F.sum("size").over(trees).alias("n")
    )
    offsets = broadcast_within(written(offsets, "offsets"), OFFSETS_BROADCAST)
    joined = placed.join(offsets, placed["tree"].eqNullSafe(offsets["_tree"]) & (placed["part"] == offsets["_part"]))
    return joined.select(*rows.columns, (F.col("_before") + F.col("place")).alias("at"), "n")


def _queued(messages: DataFrame) -> DataFrame:
    """Messages of a block in one place, in the order of their labels."""
    return messages.repartition("tree", "block").sortWithinPartitions("tree", "block", "at")


def _block() -> Column:
    return F.shiftright("at", LEVELS).alias("block")


def _up(tier: DataFrame) -> DataFrame:
    """The nodes above the blocks of a tier."""

    def climb(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (tree, block), members in groupby(rows, key=lambda row: row[:2]):
            members = list(members)
            n = members[0][3]
            yield tree, None, forward([digest for *_, digest in members], _levels(n))[0], None, block, -(-n >> LEVELS)

    messages = _queued(tier.filter("n > 1").select("tree", _block(), "at", "n", "digest"))
    return _mapped(messages, climb, tier.schema)


def _down(tier: DataFrame, above: DataFrame) -> DataFrame:
    """The nodes of a tier's blocks with ``subroot`` and ``proof``, sent by the nodes ``above`` them."""

    def deliver(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (tree, _), messages in groupby(rows, key=lambda row: row[:2]):
            (*_, subroot, rest), *members = messages  # what comes from above has the least label
            levels = _levels(members[0][3])
            proofs = backward(forward([m[4] for m in members], levels)[1], levels, rest)
            for (_, _, at, n, digest, key, claimed, _, _), proof in zip(members, proofs):
                yield tree, key, digest, claimed, at, n, subroot, proof

    own = tier.filter("n > 1")
    sent = above.select(
        "tree", F.col("at").alias("block"), F.lit(-1).cast("bigint").alias("at"), *[F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("n", "digest", "key", "claimed")], "subroot", "proof"
    )
    members = own.select("tree", _block(), "at", "n", "digest", "key", "claimed", F.lit(None).cast("string").alias("subroot"), F.lit(None).cast("array<string>").alias("proof"))
    return _mapped(_queued(sent.unionByName(members)), deliver, _more(tier.schema, "subroot string, proof array<string>"))


def _tiers(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and the tiers above them, up to one with roots only."""
    tiers, n = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while n > 1:
        tiers.append(written(_up(tiers[-1]), "tier"))
        n = -(-n >> LEVELS)
    return tiers


def _roots(tiers: list[DataFrame]) -> DataFrame:
    roots = tiers[0].filter("n = 1").select("tree", "digest")
    for tier in tiers[1:]:
        roots = roots.unionAll(tier.filter("n = 1").select("tree", "digest"))
    return roots


def _proofs(tiers: list[DataFrame], roots: DataFrame) -> DataFrame:
    """The lowest tier with ``subroot`` and ``proof``; ``roots`` has ``tree``, ``subroot`` and the proof of each root."""
    roots = roots.withColumnRenamed("tree", "_tree")
    above = None
    for tier in reversed(tiers):
        of_roots = tier.filter("n = 1").join(roots, tier["tree"].eqNullSafe(roots["_tree"])).select(*tier.columns, "subroot", "proof")
        # Few messages come from above; the leaves' own are not sent twice.
        above = of_roots if above is None else of_roots.unionByName(_down(tier, written(above, "proofs")))
    return above


def build_manifest(
    docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS, claimed: Column | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``leaf``, ``claimed``, ``subroot`` of its group, ``root`` and ``proof``.

    Leaves are digests of ``fields``; those of a group form a binary tree in the order of ``key`` (null first; rows of one
    key by their digest), a node without sibling is hashed alone, and the groups' roots form the upper tree, null first
    and bytewise. ``proof`` holds the siblings up to the root (see ``backward``); ``fold`` leads a digest up to the root
    it stands for. ``claimed`` is the digest to verify, the leaf unless given. Nulls and texts of any length are hashed
    like all values; repeated rows have a leaf each; a null group is a group; an empty table gives no rows. Other columns
    are not read.
    """
    leaf = leaf_digest(*fields)
    rows = docs.select(F.col(group).alias("tree"), F.col(key).alias("key"), leaf.alias("digest"), (leaf if claimed is None else claimed).alias("claimed"))
    tiers = _tiers(written(numbered(rows), "nodes"))
    none = F.lit(None).cast("string")
    subroots = _roots(tiers).select(F.lit(0).alias("tree"), F.col("tree").alias("key"), "digest", none.alias("claimed"))
    upper = _tiers(written(numbered(subroots), "nodes"))
    root = _roots(upper).first()
    root = F.lit(root.digest if root else None).cast("string")
    top = docs.sparkSession.createDataFrame([(0, "", [])], "tree int, subroot string, proof array<string>")
    groups = written(_proofs(upper, top).select(F.col("key").alias("tree"), F.col("digest").alias("subroot"), "proof"), "groups")
    leaves = _proofs(tiers, groups)
    return leaves.select(F.col("key").alias(key), F.col("digest").alias("leaf"), "claimed", "subroot", root.alias("root"), "proof")
