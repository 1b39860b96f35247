"""Searches, packing, mixing, the classifier and the pipeline."""

import math
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from speechlake.llm import ann, mixing, packing, quality, simhash, suffix_dedup, topk
from speechlake.llm import queries as registered
from speechlake.llm.vectors import usable

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<float>, ids int, v string, tree int, code int, shard int, block int, score double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3, 4, 5, 6.0) for i, v in rows], VECTORS)


def messy_vectors(rng, n=400, d=8):
    rows = [(i, [float(x) for x in rng.standard_normal(d) * (1 + i % 3)]) for i in range(n)]
    hot = rows[3][1]
    rows += [(n + i, hot) for i in range(150)]  # a very common vector
    odd = [(5000, None), (5020, [None] * d), (5040, [math.nan] * d), (5060, [math.inf] * d), (5080, [1.0]), (None, hot), (5100, [0.0] * d)]
    return rows + odd + [rows[0], rows[20]]


def by_query(got):
    out = {}
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def full_search(rows, every, k, measure):
    usable_rows = {i: v for i, v in rows if i is not None and v is not None and len(v) > 1 and None not in v and all(map(math.isfinite, v))}
    ids = np.array(sorted(usable_rows))
    x = np.array([usable_rows[i] for i in ids], np.float32).astype(np.float64)
    out = {}
    for at in np.flatnonzero(ids % every == 0):
        scores = measure(x, x[at])
        order = [i for i in np.lexsort((ids, -scores)) if i != at][:k]
        out[int(ids[at])] = [(rank, int(ids[i]), scores[i]) for rank, i in enumerate(order, 1)]
    return out


def whole_product(x, q):
    return np.floor(256 * x) @ np.floor(256 * q)


def test_exact_top_k(spark, monkeypatch):
    rows = messy_vectors(np.random.default_rng(2))
    want = full_search(rows, 50, 5, whole_product)
    for shard, block in ((4096, 256), (60, 3)):
        monkeypatch.setattr(topk, "SHARD_ROWS", shard)
        monkeypatch.setattr(topk, "QUERY_ROWS", block)
        assert by_query(topk.exact_top_k(vectors(spark, rows))) == want
    few = vectors(spark, rows[:3] + [(100, rows[0][1])])
    assert {q: len(found) for q, found in by_query(topk.exact_top_k(few)).items()} == {0: 3, 100: 3}
    assert topk.exact_top_k(vectors(spark, [])).count() == 0
    assert topk.exact_top_k(vectors(spark, [(0, None)])).count() == 0


def test_large_numbers_stay_exact():
    rng = np.random.default_rng(4)
    rows = np.floor(rng.standard_normal((50, 3)) * 2**29)
    ids = np.arange(50)
    q, at, scores = topk.no_random_access(rows[:2], ids[:2], rows, ids, 3)
    for i in range(2):
        exact = sorted(((-sum(int(a) * int(b) for a, b in zip(rows[i], row)), j) for j, row in enumerate(rows) if j != i))[:3]
        assert [(-int(s), int(j)) for s, j in zip(scores[q == i], at[q == i])] == exact


def test_reading_stops_early():
    """With one strong component the lists settle the best rows long before their ends."""
    rng = np.random.default_rng(6)
    rows = np.floor(rng.standard_normal((2000, 6)) * np.array([100, 1, 1, 1, 1, 1]) * 256)
    seen = []
    partition = np.partition
    try:
        np.partition = lambda a, *more, **named: (seen.append(a.shape), partition(a, *more, **named))[1]
        topk.no_random_access(np.abs(rows[:1]), np.arange(1), rows, np.arange(2000), 5)
    finally:
        np.partition = partition
    assert sum(shape == (1, 2000) for shape in seen) < topk.BLOCKS / 2


def test_thresholds_from_elsewhere():
    """With and without known scores, over blocks of queries, ties and repeated ids."""
    rng = np.random.default_rng(7)
    for t, size in enumerate([3, 256, 1e6, 2**29] * 3):
        rows = np.floor(rng.standard_normal((250, 5)) * size)
        rows[:: 2 + t] = rows[0]
        ids = rng.permutation(500)[:250] if t % 3 else rng.integers(0, 200, 250)
        at = rng.integers(0, 250, 40)
        scores = [[(-sum(int(a) * int(b) for a, b in zip(rows[q], row)), int(i)) for row, i in zip(rows, ids) if i != ids[q]] for q in at]
        want = [sorted(s)[:4] for s in scores]
        for least in (None, np.array([-w[-1][0] for w in want], float)):
            q, r, found = topk.no_random_access(rows[at], ids[at], rows, ids, 4, least, block=7)
            assert [[(-int(s), int(i)) for s, i in zip(found[q == i], ids[r[q == i]])] for i in range(40)] == want
    best = topk.Best(2, 2, None)
    for query, i, score in (([0, 0, 0], [9, 8, 7], [5, 5, 4]), ([1, 0], [3, 2], [-1, 5])):
        best.add(np.array(query), np.array(i), np.array(score))
    assert [c.tolist() for c in best.held(np.arange(2))] == [[0, 0, 1], [2, 8, 3], [5, 5, -1]] and best.least.tolist() == [5, -math.inf]


def test_exact_top_k_in_rounds(spark, monkeypatch):
    rows = messy_vectors(np.random.default_rng(3))
    tables = []
    monkeypatch.setattr(topk, "written", lambda df, name, f=topk.written: (tables.append(name), f(df, name))[1])
    monkeypatch.setattr(topk, "ROUND_VALUES", 8 * 5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files, so several tasks
    try:
        assert by_query(topk.exact_top_k(vectors(spark, rows))) == full_search(rows, 50, 5, whole_product)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tables.count("lead") > 1


def test_top_k_stores_no_pairs(spark, monkeypatch):
    """What goes to disk grows with the rows, not with the pairs of query blocks and shards."""

    def on_disk():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).length() for i in range(files.size()))

    monkeypatch.setattr(topk, "SHARD_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 512)
    numbers = [F.rand(i).cast("float") for i in range(16)]
    rows = spark.range(8000).select(F.col("id").alias("vec_id"), F.array(*numbers).alias("embedding"))
    before, broadcast = on_disk(), "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(broadcast, "-1")  # as with tables too large for it
    try:
        topk.exact_top_k(rows, every=2).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset(broadcast)
    assert on_disk() - before < 8 * 8000 * (8 + 16 * 4)


def test_nearest(spark, monkeypatch):
    rows = messy_vectors(np.random.default_rng(8), n=1200, d=16)
    product = lambda x, q: (x * q).sum(axis=1)
    rows = [r for r in rows if r[0] != 5100]
    want = full_search(rows, 20, 20, product)
    monkeypatch.setattr(ann, "SLICE_ROWS", 64)
    monkeypatch.setattr(ann, "QUERY_ROWS", 7)
    monkeypatch.setattr(ann, "FEWEST", 100)
    got = by_query(ann.nearest(vectors(spark, [*rows, (5100, [0.0] * 16)])))
    assert got.keys() == want.keys()
    recall = [len({i for _, i, _ in got[q]} & {i for _, i, _ in want[q]}) / 20 for q in want]
    assert np.mean(recall) >= 0.9
    for q, found in got.items():
        assert [rank for rank, _, _ in found] == list(range(1, 21)) and q not in {i for _, i, _ in found}
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
    exact = by_query(ann.nearest(vectors(spark, rows), candidates=100.0))  # all of every tree
    assert {q: [(r, i) for r, i, _ in f] for q, f in exact.items()} == {q: [(r, i) for r, i, _ in f] for q, f in want.items()}
    assert all(abs(a[2] - b[2]) < 1e-9 for q in want for a, b in zip(exact[q], want[q]))


def test_nearest_edges(spark):
    assert ann.nearest(vectors(spark, [])).count() == 0
    few = vectors(spark, [(20, [1.0, 2.0]), (21, [3.0, 1.0]), (40, [0.0, 0.0]), (22, [-1.0, -2.0])])
    assert by_query(ann.nearest(few)) == {20: [(1, 21, 5.0), (2, 22, -5.0)]}


def test_usable(spark):
    rows, length, kind = usable(vectors(spark, messy_vectors(np.random.default_rng(1))))
    assert (rows.count(), length, kind) == (551, 8, "<f4")


# --- packing


@pytest.mark.parametrize("seed", range(4))
def test_pack(seed):
    rng = np.random.default_rng(seed)
    lengths = [int(x) for x in np.clip(rng.lognormal(5, 1.5, 800), 1, 1024)]
    sizes = (128, 256, 512, 1024)
    places, bins = packing.pack(lengths, sizes)
    used = Counter()
    for (b, start), n in sorted(zip(places, lengths)):
        assert start == used[b]
        used[b] += n
    assert all(bins[b] == min(s for s in sizes if s >= used[b]) for b in used) and len(used) == len(bins)
    cost = sum(map(packing.sequence_cost, bins))
    for size in sizes[:-1]:  # one size at a time is never cheaper than all of them
        own = [n for n in lengths if n <= size]
        if len(own) == len(lengths):
            assert cost <= sum(map(packing.sequence_cost, packing.pack(lengths, (size,))[1]))
    assert cost <= sum(map(packing.sequence_cost, packing.pack(lengths, (1024,))[1]))
    assert sum(bins) < 1.1 * sum(lengths)


def check_packed(docs, got, largest):
    rows = [(r.doc_id, len((r.text or "").encode())) for r in docs.select("doc_id", "text").collect()]
    pieces = Counter()
    for key, n in rows:
        for piece in range(max(1, -(-n // largest))):
            pieces[(key, piece, piece * largest, min(n - piece * largest, largest))] += 1
    got = got.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in got) == pieces
    bins = {}
    for r in got:
        assert (r.bin_id is None) == (r.length == 0)
        if r.length:
            bins.setdefault((r.bin_id, r.bin_size), []).append((r.bin_start, r.length))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, size), parts in bins.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at <= size and size == min(s for s in packing.SIZES if s >= at)


def test_pack_documents(spark):
    docs = brute.messy(spark)
    check_packed(docs, packing.pack_documents(docs), 32768)
    check_packed(docs, packing.pack_documents(docs, shard_length=40_000), 32768)
    assert packing.pack_documents(brute.empty(spark)).count() == 0


# --- mixing


@pytest.mark.parametrize("name", sorted(registered.SQL))
def test_sql(spark, name):
    from compare import difference

    assert difference(registered.QUERIES[name], registered.SQL[name], spark, SF) is None


def test_mixing_meets_its_shares(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 4000, "big").when(F.col("id") < 5900, "mid").otherwise("small").alias("source"), F.lit("xxxx").alias("text"), F.lit(9).alias("copy")
    )
    mixed = mixing.mix_sources(docs, {"big": 1, "mid": 1, "small": 2}, epochs=2.0)
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert all(abs(counts[s] - n) < 4 * math.sqrt(n * 60) for s, n in {"big": 3000, "mid": 3000, "small": 6000}.items())
    per_doc = [r["count"] for r in mixed.filter("source = 'small'").groupBy("doc_id").count().collect()]
    assert abs(np.mean(per_doc) - 60) < 4 and 30 < np.var(per_doc) < 110  # a Poisson of rate 60
    again = mixing.mix_sources(docs.repartition(7), {"big": 1, "mid": 1, "small": 2}, epochs=2.0)
    assert again.exceptAll(mixed).count() == mixed.exceptAll(again).count() == 0
    order = [r.source for r in mixed.collect()]
    assert 0.3 < sum(s == "small" for s in order[: len(order) // 2]) / (len(order) // 2) < 0.7
    assert mixing.mix_sources(docs, {}).count() == 0


def test_mixing_edges(spark):
    docs = brute.messy(spark)
    mixed = mixing.mix_sources(docs, epochs=30.0)
    assert [c for c in mixed.columns if c not in ("copy", "rate", "shuffle_key")] == [c for c in docs.columns if c not in ("copy", "rate")]
    assert {r.source for r in mixed.select("source").distinct().collect()} == {"a", "b", "c"}  # the null source has no text
    same = mixed.filter("doc_id = 7 and text = 'one two'").groupBy("copy").count().collect()
    assert all(r["count"] == 2 for r in same)  # repeated rows repeat alike
    assert mixing.mix_sources(brute.empty(spark)).count() == 0
    assert mixing.mix_sources(docs, {"c": 1}).select("source").distinct().collect()[0].source == "c"


@pytest.mark.parametrize("rate", [0.0, 0.3, 5.0, 900.0])
def test_poisson_cdf(spark, rate):
    (cdf,) = spark.range(1).select(mixing.poisson_cdf(F.lit(rate))).first()
    want = np.cumsum([math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) for k in range(len(cdf))]) if rate else [1.0]
    assert np.allclose(cdf, want, atol=1e-9) and cdf[-1] > 1 - 1e-9


# --- quality


def labelled(spark, n=400):
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        text = f"A calm sentence number {i} about rivers and stones. " * 4 if good else f"BUY!! {i}!! NOW!! " * 12
        rows.append((i, text, "en", "site" if good else f"shop{i % 2}", len(text)))
        if i % 2:
            labels.append((i, int(good), 0))
    return rows, spark.createDataFrame([*labels, (7777, 1, 0), (None, 1, 0), (3, None, 1), (5, 7, 0)], "doc_id bigint, quality int, toxic int")


def test_quality(spark):
    rows, labels = labelled(spark)
    docs = brute.messy(spark, rows)
    got = quality.classify_quality(docs, labels)
    assert [c for c in got.columns if c not in ("p_text", "p_meta", "p_quality", "keep")] == [c for c in docs.columns if c != "keep"]
    found = got.collect()
    assert len(found) == docs.count()
    verdicts = {r.text: r.keep for r in found}
    assert all(verdicts[text] == (i % 3 > 0) for i, text, *_ in rows)
    assert all(0 <= r.p_quality <= 1 for r in found)


def test_quality_without_labels(spark):
    docs = brute.messy(spark)
    for rows in ([], [(1, 1, 0)]):
        got = quality.classify_quality(docs, spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")).collect()
        assert len(got) == docs.count() and all(r.keep and r.p_quality is None for r in got)
    two = spark.createDataFrame([(1, 1, 0), (10, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert quality.classify_quality(docs, two).count() == docs.count()
    assert quality.classify_quality(brute.empty(spark), two).count() == 0


def test_views_teach_each_other():
    """Few labels, many unlabelled rows: the pool makes the text view better than its labels alone."""
    rng = np.random.default_rng(0)
    y = (rng.random(600) < 0.5).astype(float)
    xt = np.column_stack([rng.standard_normal((600, 30)) + 0.15 * (2 * y - 1)[:, None], np.ones(600)])
    xm = np.column_stack([(2 * y - 1) + 0.3 * rng.standard_normal(600), np.ones(600)])
    few, fold = np.arange(48), np.arange(48) % 3 == 0
    both = quality.co_train(xt[few], xm[few], y[few], fold, xt[48:], xm[48:], confident=0.8)
    alone = quality.fit(xt[few][~fold], y[few][~fold])
    hits = lambda w: ((xt[48:] @ w > 0) == (y[48:] > 0)).mean()
    assert hits(both.text) > hits(alone) + 0.02


def test_held_out_accuracy(spark):
    """On documents whose labels the classifier never sees."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    unseen = F.xxhash64("doc_id") % 3 == 0
    got = quality.classify_quality(docs, labels.filter(~unseen)).join(labels.filter(unseen), "doc_id")
    right = got.agg(F.avg((F.col("keep") == (F.col("quality") == 1)).cast("double"))).first()[0]
    assert right > 0.95


# --- many rows of one key


def hot(spark, n=6000):
    """A third of all rows is one row under a null key, a third a null key with texts of its own, a few are empty."""
    long_text = "A passage that is long enough to be found again by whoever looks for it, in every copy. " * 40
    one = F.when(F.col("id") % 3 == 0, F.lit(long_text)).when(F.col("id") % 30 == 1, "").otherwise(F.concat(F.lit("own text "), F.col("id").cast("string")))
    return spark.range(n).select(F.when(F.col("id") % 3 == 2, F.col("id")).alias("doc_id"), one.alias("text"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"))


def test_many_rows_of_one_key(spark, tmp_path):
    docs = hot(spark)
    mixed = mixing.mix_sources(docs, epochs=1.0).filter("doc_id is null and text like 'own%'")
    assert abs(mixed.count() - 1800) < 5 * math.sqrt(1800) and mixed.select("shuffle_key").distinct().count() == mixed.count()
    packed = packing.pack_documents(docs, shard_length=1 << 18)
    check_packed(docs, packed, 32768)
    per_shard = [r["count"] for r in packed.filter("bin_id is not null").groupBy(F.shiftright("bin_id", 32)).count().collect()]
    assert len(per_shard) > 20 and max(per_shard) < 4 * sum(per_shard) / len(per_shard)
    assert simhash.keep_one(docs.filter("doc_id is null and length(text) > 99")).count() == 1
    cut = suffix_dedup.remove_repeats(docs).groupBy("n_removed", "n_spans").count().collect()
    assert {(r.n_removed > 0, r.n_spans): r["count"] for r in cut} == {(True, 1): 2000, (False, 0): 4000}


# --- pipeline


def test_pipeline_stages(spark, tmp_path):
    """Every stage against a plain version, on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit("e"))
    stages = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "suffix_array_dedup", "source_mixing", "best_fit_packing"]

    def step(name, docs):
        out = stages[name](spark, docs, SF)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    kept = step("quality_classifier", docs)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train_quality(docs, labels)
    text = lambda r: quality.text_features((r.text or "").encode()) @ model.text.astype(np.float32)
    meta = lambda r: quality.meta_features((r.lang, r.source, r.n_chars)) @ model.meta.astype(np.float32)
    good = [r for r in docs.collect() if 1 / (1 + math.exp(-model.odds(text(r), meta(r))[2])) >= 0.5]
    assert sorted(kept.collect()) == sorted(good)

    one = step("simhash_near_dedup", kept)
    groups = brute.near_groups([(r.doc_id, r.text) for r in good])
    good = [r for r, (_, least) in zip(good, groups) if r.doc_id == least]
    assert sorted(one.collect()) == sorted(good)

    cut = step("suffix_array_dedup", one)
    want = [(r, found) for r, found in zip(good, brute.removed([r.text for r in good], 200)) if not found[1] or found[4].decode(errors="ignore")]
    rest = [(r.doc_id, found[4].decode(errors="ignore")) for r, found in want]
    assert sorted((r.doc_id, r.text) for r in cut.collect()) == sorted(rest)
    assert all(r.n_chars == len(r.text) for r in cut.collect() if r.text != {g.doc_id: g.text for g in good}[r.doc_id])

    mixed = step("source_mixing", cut)
    copies = Counter(r.doc_id for r in mixing.mix_sources(cut).select("doc_id").collect())
    assert Counter(r.doc_id for r in mixed.collect()) == copies
    check_packed(mixed, step("best_fit_packing", mixed), 32768)


def test_pipeline_on_messy_rows(spark, tmp_path):
    extra = [(60 + i, f"Some good prose, number {i}, which says little. " * 9, "en", "a", 1) for i in range(9)]
    for name, docs in (("messy", brute.messy(spark, extra)), ("empty", brute.empty(spark))):
        for stage, function in corpus_pipeline.STAGES:
            path = str(tmp_path / name / stage)
            function(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() > 0) == (name == "messy")


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns[:2] == ["doc_id", "piece"] and got.count() > 0
