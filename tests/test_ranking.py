"""Ranks, samples and running sums: equal to a plain sort, and the same for any partitioning."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from speechlake.operators import ranking as R
from speechlake.operators import sample as S
from speechlake.operators import sequence as W
from speechlake.operators.aggregate import keep_first


def hashed(key, seed=123):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


@pytest.fixture(scope="module")
def data(spark):
    """One group holds most rows, one group has no name."""
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot"] * 8 + ["cold", "rare", None]), rng.randint(1, 60)) for i in range(3000)]
    return rows


def frames(spark, rows):
    for parts in (1, 4, 16):
        shuffled = rows[:]
        random.Random(parts).shuffle(shuffled)
        yield spark.createDataFrame(shuffled, "k bigint, g string, n bigint").repartition(parts)


def by_group(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    return groups


def test_skip_take(spark, data):
    want = set()
    for rows in by_group(data).values():
        want |= {r[0] for r in sorted(rows, key=lambda r: (hashed(r[0]), r[0]))[40:240]}
    for df in frames(spark, data):
        got = [r.k for r in S.skip_take(df, "k", 40, 200, by=["g"]).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_rounds_are_disjoint_and_whole(spark, data):
    df = next(frames(spark, data))
    sizes = [(0, 700), (700, 20), (720, 0)]
    parts = [{r.k for r in S.skip_take(df, "k", skip, take).collect()} for skip, take in sizes]
    assert sum(map(len, parts)) == len(set.union(*parts)) == len(data)
    assert len(parts[0]) == 700 and len(parts[1]) == 20
    assert S.skip_take(df, "k", 5000, 10).count() == 0
    assert S.skip_take(df, "k", 0, 5000).count() == len(data)


def test_ranked_and_running_sums(spark, data):
    want = {}
    for rows in by_group(data).values():
        total = 0
        for rank, row in enumerate(sorted(rows), 1):
            total += row[2]
            want[row[0]] = (rank, total)
    for df in frames(spark, data):
        slices = R.number_slice("k", 64)
        ranks = R.ranked(df, ["g"], slices, ["k"]).select("k", "rank")
        sums = W.running_totals(df, ["g"], ["k"], slices, ["n"]).select("k", "total_n")
        assert {r.k: (r.rank, r.total_n) for r in ranks.join(sums, "k").collect()} == want


def test_windowed_shuffle(spark, data):
    for df in frames(spark, data):
        got = {r.k: r.position for r in S.windowed_shuffle(df, "k", "k", 7).collect()}
        assert sorted(got.values()) == list(range(1, len(data) + 1))
        assert all((p - 1) // 7 == k // 7 for k, p in got.items())
        assert {r.k: r.position for r in S.windowed_shuffle(df, "k", "k", 1).collect()} == {r[0]: r[0] + 1 for r in data}


def test_eval_head_and_cap(spark, data):
    slices = R.number_slice("k", 64)
    want = set()
    for rows in by_group(data).values():
        want |= {r[0] for r in sorted(rows)[:100]}
    for df in frames(spark, data):
        assert {r.k for r in S.eval_head(df, ["g"], ["k"], slices, 0, 100).collect()} == want
        assert {r.k for r in S.cap_per_group(df, ["g"], ["k"], slices, 100).collect()} == want
    assert S.eval_head(df, ["g"], ["k"], slices, 20, 100).count() == 0
    assert S.eval_head(df, ["g"], ["k"], slices, 0, 0).count() == len(data)


def test_temperature_sample_meets_quotas(spark, data):
    rows = [(r[0], "c1" if r[0] % 3 else "c2", r[1] or "none", r[2]) for r in data]
    df = spark.createDataFrame(rows, "k bigint, corpus string, language string, n bigint")
    hours = df.groupBy("corpus", "language").agg((F.sum("n") / 3600).alias("hours"))
    weights = S.mix_weights(hours, 0.5, 0.5)
    assert weights.agg(F.sum("weight")).first()[0] == pytest.approx(1)
    quotas = S.mix_quotas(weights, 5000)
    assert quotas.agg(F.sum("quota")).first()[0] == 5000
    runs = [S.temperature_sample(df.repartition(p), quotas, "k").collect() for p in (1, 16)]
    assert sorted(map(tuple, runs[0])) == sorted(map(tuple, runs[1]))
    got = {}
    for r in runs[0]:
        got.setdefault((r.corpus, r.language), []).append((r.copy, r.k))
    assert {k: len(v) for k, v in got.items()} == {(r.corpus, r.language): r.quota for r in quotas.collect()}
    for picked in got.values():  # copies of a row differ by at most one
        copies = [sum(1 for _, k in picked if k == key) for key in {k for _, k in picked}]
        assert max(copies) - min(copies) <= 1


def test_carve_splits(spark, data):
    for df in frames(spark, data):
        for r in S.carve_splits(df, "k").collect():
            x = int(hashed(r.k)[:8], 16) / 2**32
            assert r.split == ("test" if x < 0.05 else "dev" if x < 0.1 else "train")


def test_greedy_collapse(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for utt in range(60):
        tokens = [rng.choice([0, 0, 1, 2]) for _ in range(rng.randint(1, 80))]
        if utt == 0:
            tokens = [1, 0, 1, 1, 0, 0, 2]
        if utt == 1:
            tokens = [0] * 30
        rows += [(utt, i, t) for i, t in enumerate(tokens)]
        want[utt] = [t for i, t in enumerate(tokens) if t != 0 and (i == 0 or tokens[i - 1] != t)]
    assert want[0] == [1, 1, 2] and want[1] == []
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "u bigint, f bigint, token int").repartition(parts)
        slices = R.number_slice("f", 8)
        kept = W.greedy_collapse(df, ["u"], ["f"], slices)
        got = W.collect_sequences(kept, df.select("u").distinct(), ["u"], ["f"], slices)
        assert {r.u: r.tokens for r in got.collect()} == want


def test_join_chunks(spark):
    rows = [("a", "swa", i, f"w{i}") for i in range(200)] + [("b", "swa", 0, ""), ("b", "swa", 1, "x"), ("a", "som", 0, "y")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "id string, language string, chunk_idx int, text string").repartition(9)
    got = {(r.id, r.language): r.transcription for r in W.join_chunks(df).collect()}
    assert got == {("a", "swa"): " ".join(f"w{i}" for i in range(200)), ("b", "swa"): " x", ("a", "som"): "y"}


def test_keep_first_takes_the_lowest_order(spark):
    rows = [(1, 9, "c"), (1, 2, "a"), (1, 5, "b"), (2, 1, None), (2, 3, "z")]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    for parts in (1, 5):
        got = {r.k: (r.o, r.v) for r in keep_first(df.repartition(parts), ["k"], ["o"]).collect()}
        assert got == {1: (2, "a"), 2: (1, None)}


def test_chunks(spark):
    sizes = [0, 1, 3, 10, 12, 13, 20, 25]
    df = spark.createDataFrame([(n, [float(i) for i in range(n)]) for n in sizes], "n int, wave array<float>")
    got = {}
    for r in W.chunk_arrays(df, chunk=10, min_tail=3).orderBy("n", "chunk_idx").collect():
        got.setdefault(r.n, []).append(len(r.wave))
    assert got == {1: [1], 3: [3], 10: [10], 12: [10], 13: [10, 3], 20: [10, 10], 25: [10, 10, 5]}
    kept = W.chunk_arrays(df, chunk=10, min_tail=3, keep_empty=True)
    assert kept.filter("wave is null").collect() == [(0, None, None)]


def test_batches_stay_within_budget(spark, data):
    df = spark.createDataFrame(data, "k bigint, g string, audio_size bigint")
    for parts in (1, 16):
        packed = W.pack_batches(df.repartition(parts), "k", budget=200, step=10)
        stats = packed.groupBy("bucket", "batch_no").agg(F.count("*").alias("n"), F.max("audio_size").alias("longest"))
        assert stats.filter("n * longest > 200").count() == 0
        assert packed.count() == len(data)
        full = stats.groupBy("bucket").agg(F.count("*").alias("b"), F.sum("n").alias("n")).collect()
        assert all(r.b == -(-r.n // (200 // r.bucket)) for r in full)


def test_wide_joins_take_the_shuffle_when_groups_are_many(spark, data, monkeypatch):
    """Past the broadcast bounds the same rows come out."""
    monkeypatch.setattr(R, "BROADCAST_MAX_ROWS", 1)
    df = next(frames(spark, data))
    want = set()
    for rows in by_group(data).values():
        want |= {r[0] for r in sorted(rows, key=lambda r: (hashed(r[0]), r[0]))[5:50]}
    got = S.skip_take(df, "k", 5, 45, by=["g"])
    assert {r.k for r in got.collect()} == want
    ranks = R.ranked(df, ["g"], R.number_slice("k", 64), ["k"])
    assert ranks.groupBy("g").agg(F.max("rank").alias("m"), F.countDistinct("rank").alias("d")).filter("m <> d").count() == 0
