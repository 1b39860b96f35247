"""Token counts, licence scans, SimHash, repeats and language models against plain versions."""

import brute
import numpy as np
import public_tokenizers
import pytest

from speechlake.llm import katz, license_scan, simhash, suffix_dedup, token_counts
from speechlake.llm.components import components


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def same(got, want):
    order = lambda rows: sorted(rows, key=repr)
    assert order(got) == order(want)


# --- token counts


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, name):
    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    else:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(processor.encode(t))
    docs = brute.messy(spark).filter("n_chars < 1000 or n_chars is null")
    got = token_counts.count_tokens(docs, path, limit=8)
    want = [(key, len((t or "").encode()), n := count(t or ""), n > 8) for key, t in pairs(docs)]
    same([tuple(r) for r in got.collect()], want)


def test_token_cache(spark, tmp_path):
    path, cache = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "cache")
    docs = brute.messy(spark)
    first = token_counts.count_tokens(docs.filter("doc_id < 6"), path, cache).collect()
    stored = spark.read.parquet(cache).count()
    assert stored == len({t if (t or "").strip() else "" for _, t in pairs(docs.filter("doc_id < 6"))})
    assert len(token_counts.count_tokens(docs, path, cache).collect()) == docs.count()
    more = spark.read.parquet(cache).count()
    again = token_counts.count_tokens(docs.filter("doc_id < 6"), path, cache).collect()
    same([tuple(r) for r in again], [tuple(r) for r in first])
    assert spark.read.parquet(cache).count() == more > stored
    assert token_counts.count_tokens(brute.empty(spark), path).count() == 0


# --- licence scans

BASE = [(t.label, t.words) for t in license_scan.BASE]


def test_license_scan(spark):
    far = "x " * 50_000
    extra = [
        (20, f"{far}THE MIT-License (cc by nc) {far} the mit license", "en", "a", 1),
        (21, "themit license, mit license the; apache license version 2apache license version 2 ", "en", "a", 1),
        (22, "Permission is hereby granted, free of charge, to any person obtaining a copy of this program", "en", "a", 1),
        (23, "permission is granted to any person obtaining a copy of this software", "en", "a", 1),
    ]
    docs = brute.messy(spark, extra)
    rows = license_scan.scan_licenses(docs).collect()
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows]
    same(got, [(key, *brute.license_places(text, BASE)) for key, text in pairs(docs)])
    by_id = {r.doc_id: r for r in rows}
    assert by_id[22].labels == "mit" and 0.75 <= by_id[22].score < 1 and by_id[22].base_labels == ""
    assert (by_id[23].labels, by_id[23].score) == ("", 0.0)  # the mandatory phrase is missing
    assert (by_id[20].labels, by_id[20].score) == ("cc-by-nc,mit", 1.0)
    assert license_scan.scan_licenses(brute.empty(spark)).count() == 0


def test_license_contract(spark):
    """The base phrases of the query's contract; a phrase of the method adds a label, but no base place."""
    docs = spark.createDataFrame(
        [(1, "Under the MIT-license, and under the mit license"), (2, "see the MIT License"), (3, "under mit license"), (4, "CC BY.NC; apache license, version 2.0")],
        "doc_id bigint, text string",
    )
    rows = license_scan.scan_licenses(docs).orderBy("doc_id").collect()
    assert [tuple(r)[:-1] for r in rows] == [
        (1, 9, 2, 0, 5, "mit", "mit", 1.0),
        (2, 4, 0, None, None, "", "mit", 1.0),
        (3, 3, 0, None, None, "", "", 0.0),
        (4, 8, 2, 0, 3, "apache-2,cc-by-nc", "apache-2,cc-by-nc", 1.0),
    ]


# --- SimHash


def test_near_duplicates(spark):
    base = " ".join(f"w{i}" for i in range(300))
    extra = [(30 + i, base.replace(f"w{7 * i} ", f"v{i} "), "en", "a", 1) for i in range(25)]
    docs = brute.messy(spark, extra)
    got = simhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    rows = pairs(docs)
    same([tuple(r) for r in got.collect()], [(key, *group) for (key, _), group in zip(rows, brute.near_groups(rows))])
    assert simhash.near_duplicates(brute.empty(spark)).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 3, 4, 6])
def test_no_link_is_lost(spark, distance):
    rng = np.random.default_rng(distance)
    seeds = rng.integers(0, 2**63, 60, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in rng.integers(0, distance + 3, 600)]
    fps = sorted({int(s) ^ f for s, f in zip(np.repeat(seeds, 10), flips)} | {0, 1, 2**64 - 1})
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    table = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    plan = simhash.make_plan(table, distance)
    assert sorted(b for part in plan.parts for b in part) == list(range(64))
    assert sum(plan.thresholds) == distance - len(plan.parts) + 1 and min(plan.thresholds) >= -1
    got = {(r.a, r.b) for r in simhash.near_links(table, plan, distance).collect()}
    order = sorted(signed)
    assert got == {(a, b) for i, a in enumerate(order) for b in order[i + 1 :] if ((a ^ b) % 2**64).bit_count() <= distance}


def test_allocation_is_the_best():
    work = [[0, 5, 20, 90], [0, 1, 50, 60], [0, 9, 10, 11]]
    cost, chosen = simhash.allocate(work, 2)
    tries = [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 2]
    assert cost == min(sum(w[t + 1] for w, t in zip(work, x)) for x in tries) and sum(chosen) == 2


def test_keep_one(spark):
    docs = brute.messy(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = pairs(docs)
    groups = brute.near_groups(rows)
    assert kept.count() == len({fp for fp, _ in groups})  # here groups are equal fingerprints
    assert simhash.keep_one(brute.empty(spark)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 50 + i) for i in range(20)] + [(7, 7), (1, 2), (2, 1), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a int, b int")).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, **{50 + i: 50 for i in range(1, 20)}, 100: 50}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


# --- repeats


def check_repeats(spark, docs, length, token, **more):
    got = suffix_dedup.remove_repeats(docs, length=length, token=token, **more)
    assert [c for c in got.columns if c not in suffix_dedup.ADDED] == [c for c in docs.columns if c not in suffix_dedup.ADDED]
    rows = pairs(docs)
    want = [(key, *found[:4], found[4].decode(errors="ignore")) for (key, _), found in zip(rows, brute.removed([t for _, t in rows], length))]
    same([tuple(r) for r in got.select("doc_id", *suffix_dedup.ADDED).collect()], want)


def test_remove_repeats(spark):
    docs = brute.messy(spark, [(40, "periodic " * 90, "en", "a", 1), (41, "x" * 400, "en", "a", 1), (42, "é" * 150, "en", "a", 1)])
    check_repeats(spark, docs, 200, 48)
    assert suffix_dedup.remove_repeats(brute.empty(spark)).count() == 0


@pytest.mark.parametrize("group_rows", [20_000, 2])
def test_repeats_at_random_places(spark, group_rows):
    rng = np.random.default_rng(3)
    line = "".join(rng.choice(list("abcd é"), 400))
    texts = []
    for _ in range(60):  # one line cut at random places, between random text: few bytes before or behind are alike
        a, n = rng.integers(0, 300), rng.integers(5, 90)
        texts.append("".join(rng.choice(list("abcd é"), rng.integers(0, 60))) + line[a : a + n] + "".join(rng.choice(list("abcd é"), rng.integers(0, 60))))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    check_repeats(spark, docs, 40, 12, group_rows=group_rows)


def join_rows(node):
    """Output rows of every join of an executed plan."""
    own = []
    if "Join" in node.nodeName():
        own.append(node.metrics().get("numOutputRows").get().value())
    below = [node.children().apply(i) for i in range(node.children().size())]
    if node.nodeName().startswith("AdaptiveSparkPlan"):
        below = [node.executedPlan()]
    elif "QueryStage" in node.nodeName():
        below = [node.plan()]
    return own + [rows for child in below for rows in join_rows(child)]


@pytest.mark.parametrize("group_rows", [20_000, 2])
def test_places_of_a_common_passage_are_not_joined(spark, group_rows):
    """The passage stands six times in each text; some texts have parts of it, so its tokens have contexts that differ."""
    rng = np.random.default_rng(5)
    line, other = ("".join(rng.choice(list("abcdefgh"), 150)) for _ in range(2))
    own = lambda n: "".join(rng.choice(list("ijklmnop"), n))
    texts = ["".join(own(9) + line for _ in range(6)) for _ in range(40)]
    texts += [own(9) + line[a : a + 60] + own(9) for a in range(0, 90, 3)]
    texts += [own(30) + other[:30] + own(30), own(30) + other[:30] + own(30)]  # a common token without a repeated string
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string").cache()
    check_repeats(spark, docs, 40, 12, group_rows=group_rows)
    if group_rows > 2:  # below, strings are joined with their counts
        cut = suffix_dedup.remove_repeats(docs, length=40, token=12)
        cut.collect()
        joins = join_rows(cut._jdf.queryExecution().executedPlan())
        assert joins and max(joins) <= len(texts)
    docs.unpersist()


def test_tokens_do_not_depend_on_chunks(monkeypatch):
    text = np.random.default_rng(0).integers(97, 103, 5000).astype(np.uint8).tobytes()
    whole = suffix_dedup.tokens(text)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    parts = suffix_dedup.tokens(text)
    assert set(zip(whole[0], whole[1])) == set(zip(parts[0], parts[1]))
    covered = sorted(s for a, b in zip(parts[2], parts[3]) for s in range(a, b + 1))
    assert covered == list(range(len(text) - 199))


def test_multikey_order():
    rng = np.random.default_rng(1)
    rows = [bytes(rng.integers(0, 3, rng.integers(0, 21)).astype(np.uint8)) for _ in range(500)]
    groups = rng.integers(0, 4, 500)
    table = np.frombuffer(b"".join(r.ljust(20, b"\0") for r in rows), np.uint8).reshape(-1, 20)
    order, common = suffix_dedup.multikey_order(table, np.array([len(r) for r in rows]), groups)
    got = [(groups[i], rows[i].ljust(20, b"\0"), len(rows[i])) for i in order]
    assert got == sorted(got)
    for (a, b), n in zip(zip(order, order[1:]), common[1:]):
        shared = next((i for i, (x, y) in enumerate(zip(rows[a], rows[b])) if x != y), min(len(rows[a]), len(rows[b])))
        assert n == (shared if groups[a] == groups[b] else 0)


# --- language model


@pytest.mark.parametrize("pack, bucket, sampled", [(3_000_000, 16 << 20, 16), (50, 2000, 16), (300, 300, 1)])
def test_katz(spark, monkeypatch, pack, bucket, sampled):
    monkeypatch.setattr(katz, "PACK_TOKENS", pack)
    monkeypatch.setattr(katz, "SAMPLED", sampled)
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.4, rng.integers(1, 60)) if x < 500) for _ in range(120)]
    extra = [(100 + i, t, "en", "a", 1) for i, t in enumerate(texts)]
    docs = brute.messy(spark, extra).filter("doc_id not in (5, 6) or doc_id is null")
    got = katz.score_documents(docs, bucket_bytes=bucket).collect()
    if sampled == 1:
        hot = katz.hot_words(docs, "text", 40)
        assert int(katz.START) in hot and len(hot) > 2  # short texts: the start mark is hot, too
    rows = pairs(docs)
    want, chance, count = brute.katz(rows, katz.discounts)
    key = lambda r: (repr(r[0]), r[1:5], round(r[5], 4))
    got, want = sorted(map(tuple, got), key=key), sorted([(k, *w) for (k, _), w in zip(rows, want)], key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], atol=1e-8)
    for first in ["w1", "w2", "\0start", "never seen"]:
        assert abs(sum(chance(w, first) for w in [*count, "\0unknown"]) - 1) < 1e-9


def test_katz_edges(spark):
    assert katz.score_documents(brute.empty(spark)).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id int, text string")
    from pyspark.sql import functions as F

    rows = katz.score_documents(docs, held=F.lit(True)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows) == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]


def test_discounts():
    factors = katz.discounts([1000, 400, 200, 120, 80, 55])
    n = [1000, 400, 200, 120, 80, 55]
    cut = 6 * n[5] / n[0]
    assert np.allclose(factors[1:], [((r + 1) * n[r] / (r * n[r - 1]) - cut) / (1 - cut) for r in range(1, 6)])
    for odd in ([10, 40, 5, 60, 2, 30], [0] * 6, [5, 0, 0, 0, 0, 0], [1, 1, 1, 1, 1, 1]):
        assert ((katz.discounts(odd)[1:] > 0) & (katz.discounts(odd)[1:] <= 1)).all()
