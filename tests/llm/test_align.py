"""Token alignment against whole texts aligned one by one."""

import hashlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from speechlake.llm import align
from speechlake.llm import queries as registered

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def models():
    tokenizer = Tokenizer.from_file(PATHS[0])
    tokenizer.encode_special_tokens = True
    return tokenizer, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def tokens(models, text):
    """((id, bytes) of each token) of both, by the libraries' own ways to name a token."""
    a, b = models
    letters = align.byte_letters()
    first = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
    return first, [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]


def groups_of(models, text):
    """Groups of a text as pairs of id lists, and the numbers of tokens."""
    if not text:
        return [], 0, 0
    sides = tokens(models, text)
    if any(b"".join(x for _, x in side) != (" " + text).encode() for side in sides):
        return [], 0, 0
    ends = []
    for side in sides:
        at, own = 0, []
        for i, raw in side:
            at += len(raw)
            own.append((at, i))
        ends.append(own)
    shared = sorted({at for at, _ in ends[0]} & {at for at, _ in ends[1]})
    starts = [0, *shared]
    groups = [[[i for at, i in own if low < at <= high] for own in ends] for low, high in zip(starts, shared)] if len(text) < 5000 else _long(ends, shared)
    return groups, len(ends[0]), len(ends[1])


def _long(ends, shared):
    groups = [[[], []] for _ in shared]
    for k, own in enumerate(ends):
        for (_, i), g in zip(own, np.searchsorted(shared, [at for at, _ in own])):
            groups[g][k].append(i)
    return groups


def aligned(models, rows):
    """The operator's rows and pairs for (key, text)s."""
    all_links, documents = [], Counter()
    found = [(key, *groups_of(models, text)) for key, text in rows]
    for _, groups, *_ in found:
        links = Counter()
        for own, other in groups:
            for x, n in Counter(own).items():
                for y, more in Counter(other).items():
                    links[x, y] += n * more
        all_links.append(links)
        documents.update(links.keys())
    most = defaultdict(int)
    for (x, _), n in documents.items():
        most[x] = max(most[x], n)
    out = []
    for (key, groups, n_a, n_b), links in zip(found, all_links):
        text = ";".join(",".join(map(str, own)) + "|" + ",".join(map(str, other)) for own, other in groups)
        n_best = sum(n for (x, y), n in links.items() if documents[x, y] == most[x])
        count_sum = sum(n * documents[pair] for pair, n in links.items())
        out.append((key, n_a, n_b, len(groups), sum(links.values()), n_best, count_sum, hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out, {(x, y): (n, n == most[x]) for (x, y), n in documents.items()}


ODD = [
    "  two spaces", "a trailing space ", " ", "   ", "\n\n", "tab\tand\nline \n end", "x  y   z", "‹quotes› — dashes… and such\u0085here", "▁ a mark ▁of its own",
    "中文字符 and ひらがな", "don't we'll I'VE", "<|endoftext|> <s> </s> <unk> <0x41>", "\x00\x01 \x1c \x1f x", "a​b ﻿c", "👩‍👩‍👧 😀😀", "naïve café", "=" * 700 + " " * 700 + "=" * 99,
    "اللغة العربية", "0 12 345 6789", "́ word", "ab ́ c", "é è ê", "x" * 3000,
]


def test_messy_rows(spark, models):
    docs = brute.messy(spark, [(100 + i, t, "en", "a", 1) for i, t in enumerate(ODD)])
    want, pairs = aligned(models, [(r.doc_id, r.text) for r in docs.collect()])
    for frame in (docs, docs.repartition(7)):
        rows, found = align.align_documents(frame, *PATHS)
        assert Counter(map(tuple, rows.collect())) == Counter(want)
        assert {(r.id_a, r.id_b): (r.documents, r.best) for r in found.collect()} == pairs
    rows, found = align.align_documents(brute.empty(spark), *PATHS)
    assert rows.count() == found.count() == 0
    none, found = align.align_documents(docs.filter("text is null or text = ''"), *PATHS)
    assert {tuple(r)[1:] for r in none.collect()} == {(0, 0, 0, 0, 0, 0, "")} and found.count() == 0


@pytest.mark.parametrize("size", ["sf0.001"])
def test_query(spark, models, size):
    sf = f"/root/testdata/{size}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = registered.QUERIES["op11_token_alignment"](spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(aligned(models, rows)[0])


def packed(texts, encoder):
    pack = align.Pack(*encoder.sides)
    for key, ids in enumerate(encoder.encode(texts)):
        pack.add(key, ids)
    return pack.row(0)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab éÉß.,'\n\t▁-1٣中 ­́s😀 "), max_size=40), min_size=1, max_size=5))
def test_chunks_and_windows_leave_no_trace(texts):
    """Ids by chunk, windows and groups of any text are those of the whole text."""
    models = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    encoder = _encoder()
    _, _, n_a, n_b, groups, links, digests, *_, codes, documents = packed(texts, encoder)
    want, pairs = aligned(models, list(enumerate(texts)))
    assert list(zip(n_a, n_b, groups, links, digests)) == [(r[1], r[2], r[3], r[4], r[7]) for r in want]
    assert dict(zip(codes.tolist(), documents.tolist())) == {x << 32 | y: n for (x, y), (n, _) in pairs.items()}


def _encoder():
    with open(PATHS[0], "rb") as a, open(PATHS[1], "rb") as b:
        return align._encoder(a.read(), b.read())


def test_memory_is_bounded(monkeypatch):
    """Forgotten chunks and large groups change nothing."""
    texts = [f"word{i} and " * 3 + "–" * (i % 40) for i in range(120)]
    encoder = _encoder()
    want = packed(texts, encoder)
    monkeypatch.setattr(align, "MEMO_CHUNKS", 10)
    monkeypatch.setattr(align, "LARGE_GROUP", 1)
    for memo in encoder.memo:
        memo.clear()
    for one, other in zip(packed(texts, encoder), want):
        assert np.array_equal(one, other)
    assert not encoder.memo[0] and not encoder.memo[1]


def test_windows_of_one_kind(monkeypatch):
    encoder = _encoder()
    texts = ["one text of words", "one other text of words", "one text of words", "", "words of text"]
    ids = tuple(np.concatenate(side) for side in zip(*[x or (align._NONE, align._NONE) for x in encoder.encode(texts)]))
    cuts = align.cut_windows(*encoder.sides, *ids)
    first, kind = align.same_windows(ids, cuts)
    assert len(kind) == 16 and len(first) == 5
    monkeypatch.setattr(align, "_FACTORS", np.zeros(2, np.uint64))  # all hashes meet
    again, of = align.same_windows(ids, cuts)
    assert len(again) == 5 and len(set(zip(kind.tolist(), of.tolist()))) == 5


def test_numbers_in_few_bytes():
    """The numbers of a pack travel in the width they need, and come back as they were."""
    rng = np.random.default_rng(6)
    arrays = [rng.integers(0, high, n) for high, n in ((2, 5000), (300, 5000), (1 << 20, 5000), (1 << 40, 3), (2, 0))]
    packed = align.pack_numbers(arrays)
    assert len(packed) < 5000 * (1 + 2 + 3) + 200
    for got, want in zip(align.unpack_numbers(packed, len(arrays)), arrays):
        assert got.dtype == np.int64 and got.tolist() == want.tolist()
    assert [x.tolist() for x in align.unpack_numbers(align.pack_numbers([np.zeros(0, np.int64)] * 6), 6)] == [[]] * 6
