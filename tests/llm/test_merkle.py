"""The Merkle manifest against trees built in memory."""

import hashlib
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from compare import difference
from pyspark.sql import functions as F

from speechlake.llm import merkle
from speechlake.llm import queries as registered

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS])


def tree(digests):
    """(root, siblings of each leaf, from below, '' where there is none)."""
    proofs, groups = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, joined = [], []
        for i in range(0, len(digests), 2):
            pair = digests[i : i + 2]
            for j in range(len(pair)):
                for member in groups[i + j]:
                    proofs[member].append("".join(pair[:j] + pair[j + 1 :]))
            above.append(sha(*pair))
            joined.append(sum(groups[i : i + 2], []))
        digests, groups = above, joined
    return digests[0], proofs


def manifest(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append((row["doc_id"], leaf(row)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1]))
        trees[g] = tree([d for _, d in groups[g]])
    root, upper = tree([trees[g][0] for g in order])
    return [(key, digest, trees[g][0], root, sha(*proof, *top)) for g, top in zip(order, upper) for (key, digest), proof in zip(groups[g], trees[g][1])]


def found(docs, **more):
    rows = merkle.build_manifest(docs, **more)
    return rows.withColumn("folded", merkle.fold("claimed")).withColumn("hash", merkle.proof_digest()).collect()


def check(docs):
    got = found(docs)
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, r.hash) for r in got) == Counter(manifest(docs.collect()))
    assert all(r.folded == r.root and r.claimed == r.leaf for r in got)


def test_messy_rows(spark):
    docs = brute.messy(spark, [(100 + i, f"text {i}", "en", "a", i) for i in range(7)])
    check(docs)
    check(docs.repartition(5))
    check(docs.filter("doc_id = 1"))
    check(docs.filter("lang = 'fr'"))
    assert found(brute.empty(spark)) == []


def test_several_tiers(spark):
    """Trees of more than one block, with a last block of one leaf; a third of all rows is one row under a null key."""
    docs = spark.range(3073).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") < 2000, "en").alias("lang"),
        F.lit(1).alias("n_chars"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).otherwise("same").alias("text"),
    )
    check(docs)
    check(docs.withColumn("lang", F.lit("de")))


def test_claims(spark):
    """Another version of a row leads to another root; the original one to the root."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    claimed = F.when(F.col("doc_id") == 5, F.lit(sha("other"))).otherwise(merkle.leaf_digest(*FIELDS))
    got = found(docs, claimed=claimed)
    assert [r.doc_id for r in got if r.folded != r.root] == [5]


def test_tampering_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = registered.QUERIES["op13_merkle_manifest"](spark, sf).collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(manifest(rows))
    changed = {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.n_chars is not None}
    assert {r.doc_id for r in got if not r.verified} == changed and all(r.verified == (r.folded_root == r.root) for r in got)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_sql(spark, size):
    name = "op13_merkle_manifest"
    assert difference(registered.QUERIES[name], registered.SQL[name], spark, f"/root/testdata/{size}") is None
