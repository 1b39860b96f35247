"""MinHash fingerprints, the documents that follow, and classes of near copies against plain versions."""

import hashlib
from collections import Counter
from fractions import Fraction

import brute
import numpy as np
import pytest

from speechlake.llm import minhash
from speechlake.llm import queries as registered


def shingle_set(text):
    w = brute.words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


def jaccard(x, y):
    return Fraction(len(x & y), len(x | y)) if x | y else Fraction(1)


def classes(rows):
    """Least key of the class of every (key, text), by all pairs."""
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= Fraction(4, 5):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [least.get(find(i)) for i in range(len(rows))]


def expected(rows, order):
    """(key, n_chars, sha of the edited text, fingerprints, likenesses, class) per (key, text) of ``rows`` in ``order``."""
    rows = sorted([(key, text or "", same) for (key, text), same in zip(rows, classes(rows))], key=lambda r: order(*r[:2]))
    print_of = lambda text: minhash.fingerprint(minhash.shingles(text.encode()))
    out = []
    for (key, text, same), (_, after, _) in zip(rows, [*rows[1:], *rows[:1]]):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        own, other, follows = print_of(text), print_of(edited), print_of(after)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((key, len(text), sha, own.tobytes().hex(), other.tobytes().hex(), (own == other).mean(), (own == follows).mean(), same if same is not None else key))
    return out


def check(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    hashes = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(text) as h").collect()}
    order = lambda key, text: (key is not None, key or 0, hashes[text] if text in hashes else hashes[None])
    want = expected(rows, order)
    got = minhash.fingerprint_documents(docs)
    assert Counter(map(tuple, got.collect())) == Counter(want)


def edited(rng, n, edits, name="w"):
    """A text of ``n`` words with ``edits`` of them changed, far from one another: 5 shingles each."""
    words = [f"{name}{i}" for i in range(n)]
    for at in rng.choice(n // 10, edits, replace=False) * 10 + 5:
        words[at] = f"e{rng.integers(1 << 40)}"
    return " ".join(words)


def near_copies(seed=9):
    rng = np.random.default_rng(seed)
    texts = [edited(rng, 300, int(e), f"g{g}w") for g in range(8) for e in rng.integers(0, 8, 4)]
    texts += [edited(rng, 300, int(e)) for e in rng.integers(0, 4, 40)]  # one large group
    common = edited(rng, 150, 0, "p")
    return texts + [common + " " + edited(rng, 200, 0, f"t{i}x") for i in range(20)]  # a passage of many texts


@pytest.mark.parametrize("bound", [500_000, 0])
def test_messy_rows(spark, monkeypatch, bound):
    monkeypatch.setattr(minhash, "WANTED_BROADCAST", bound)
    # The empty text and null have the same hash order only if they are one; keep their keys apart.
    docs = brute.messy(spark, [(100 + i, t, "en", "a", 1) for i, t in enumerate(near_copies())]).filter("doc_id is not null or text is not null")
    check(spark, docs)
    check(spark, docs.filter("doc_id = 1"))
    assert minhash.fingerprint_documents(brute.empty(spark)).count() == 0


def families(n, seed=4):
    """``n`` pairs of linked texts; all share a passage, so many meet in a band, but no two pairs are linked."""
    rng = np.random.default_rng(seed)
    passage = edited(rng, 250, 0, "p")
    texts = [passage + " " + edited(np.random.default_rng(seed + f), 90, edits, f"f{f}x") for f in range(n) for edits in (1, 2)]
    return [(int(i), texts[i]) for i in rng.permutation(len(texts))]


@pytest.mark.parametrize(("n", "small", "block"), [(12, 32, 512), (60, 32, 512), (60, 0, 9)])
def test_links_within_a_band(spark, monkeypatch, n, small, block):
    """Sets that are linked to each other, but to neither end of a band they share, are one class."""
    monkeypatch.setattr(minhash, "SMALL_BAND", small)
    monkeypatch.setattr(minhash, "BLOCK_SETS", block)
    rows = families(n)
    got = minhash.fingerprint_documents(spark.createDataFrame(rows, "doc_id bigint, text string"))
    want = {key: same for (key, _), same in zip(rows, classes(rows))}
    assert len(set(want.values())) == n
    assert {r.doc_id: r.class_id for r in got.collect()} == want


@pytest.mark.parametrize("seed", range(3))
def test_head_and_end(seed):
    """A front that was hashed by itself gives, with any end, the shingles and the fingerprint of the whole text."""
    rng = np.random.default_rng(seed)
    odd = lambda n: "".join(rng.choice(list("aB é\n\t\x0b\x1c\x85 "), n)).encode()
    fronts = [b"", b"  ", b"a", b"A b c d", b"a b c d ", b"a b c d e", b"a b c d e ", b"x" * 300, *(odd(int(n)) for n in rng.integers(0, 80, 200))]
    for front in fronts:
        head = minhash.Head(front)
        for end in (b"", b" ", b"Q", b"q r", b" q r s t u v", odd(30)):
            found, print_ = head.followed_by(end)
            whole = minhash.shingles(front + end)
            assert minhash.distinct(np.concatenate([head.found, found])).tolist() == whole.tolist()
            assert print_.tolist() == minhash.fingerprint(whole).tolist()


def test_edited_texts_hash_their_end_only(monkeypatch):
    hashed, word_hashes = [], minhash.word_hashes
    monkeypatch.setattr(minhash, "word_hashes", lambda words: (hashed.append(len(words)), word_hashes(words))[1])
    head = minhash.Head(b" ".join(b"w%d" % i for i in range(750)))
    for end in (b" of its own" * 80, b" of the next" * 80):
        head.followed_by(end)
    assert hashed == [749, 241, 241]


def test_shared_counts(monkeypatch):
    monkeypatch.setattr(minhash, "_COLUMNS", 7)
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, int(n)).astype(np.uint64)) for n in (0, 1, 5, 30, 40, 80)]
    both = minhash.shared_counts(sets)
    assert all(both[i, j] == len(np.intersect1d(x, y)) for i, x in enumerate(sets) for j, y in enumerate(sets) if i != j)
    assert minhash.shared_counts(sets[:1]).tolist() == [[0]]
    assert minhash._told_apart(np.array([1, 1, 1, 4], np.uint16)).tolist() == [1, 1 | 1 << 16, 1 | 2 << 16, 4]


def test_repeated_rows(spark):
    """A third of all rows is one row under a null key, another third a null key with different texts."""
    rows = [(None, "the same text again and again, here")] * 200 + [(None, f"text {i} of no key") for i in range(200)] + [(i, f"{i} other") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    check(spark, docs)
    check(spark, docs.repartition(13))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = registered.QUERIES["op12_minhash"](spark, sf)
    assert got.columns[:8] == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "class_id"]
    assert sorted(map(tuple, got.collect())) == sorted(expected(rows, lambda key, _: key))


def test_classes_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r.class_id for r in minhash.fingerprint_documents(docs).collect()}
    assert got == {key: same for (key, _), same in zip(rows, classes(rows))}


def test_likeness():
    """Fingerprints agree as often as the sets are similar."""
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        x = rng.integers(0, 1 << 64, 400, np.uint64)
        shared = int(rng.integers(0, 400))
        y = np.concatenate([x[:shared], rng.integers(0, 1 << 64, 400 - shared, np.uint64)])
        errors.append(minhash.likeness(minhash.fingerprint(x), minhash.fingerprint(y)) - shared / (800 - shared))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.06
    assert minhash.likeness(minhash.fingerprint(x[:0]), minhash.fingerprint(x[:0])) == 1.0
