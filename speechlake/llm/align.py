"""Alignment of the tokens of two tokenizers, and how often aligned ids meet in the corpus.

Every text is tokenised whole by both. Where both streams have a token end at the same byte and go on with a token that
is marked by a space, the text is cut: these anchors leave windows of few ids, whose alignment depends on the ids alone
and is remembered by them. Documents travel in packs of bounded size: the windows of a pack and their id pairs are kept
once, pairs are counted per pack before they are shuffled, and each pack asks for the counts of its own pairs.
"""

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from speechlake.llm.common import written

PACK_TOKENS, PACK_ROWS = 1 << 18, 4096  # a pack ends with the document that reaches either
TEXTS_AT_ONCE = 64
GROUP_PACKS = 4  # packs of a parquet row group, which readers hold at once
MEMO_CHUNKS, MEMO_LETTERS = 400_000, 64  # chunks whose ids a worker remembers, and the length of one
LARGE_GROUP = 4096  # links of a group beyond which its pairs are counted by id
SPACE = "\u2581"
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)
_NONE = np.zeros(0, np.int32)
# Letters that no tokenizer takes for white space; text is cut into chunks at spaces between two of them.
_LETTER = r"[!-~\u00A1-\u052F]"
_WORD = re.compile(f"{_LETTER}(.*{_LETTER})?", re.DOTALL)
_CUT, _UNUSUAL = re.compile(f"(?<={_LETTER})(?= {_LETTER})"), re.compile(f"^ |[^!-~\u00A1-\u052F] | $")


def byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level vocabularies: printable bytes stand for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A ``tokenizers`` file with a byte-level vocabulary."""

    def __init__(self, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True  # their strings inside texts are plain text
        spec, letters = json.loads(model), byte_letters()
        added = {t["id"]: t["content"] for t in spec["added_tokens"]}
        entries = {i: piece for piece, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.bytes = [b""] * (max(entries) + 1)
        for i, piece in entries.items():
            self.bytes[i] = added[i].encode() if i in added else bytes(letters[c] for c in piece)
        before = spec.get("pre_tokenizer") or {}
        # Its pretokens, encoded one by one, never go on from a letter to a space.
        self.by_chunk = spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """A ``sentencepiece`` model, which puts a space before every text itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.processor = p = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [p.id_to_piece(i) for i in range(len(p))]
        self.bytes = [bytes([int(x[3:-1], 16)]) if p.is_byte(i) else x.replace(SPACE, " ").encode() for i, x in enumerate(pieces)]
        # Merges make pieces only: if none goes on from a letter to a space, no merge does.
        self.by_chunk = not any(SPACE in x.lstrip(SPACE) for x in pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode([t[1:] for t in texts], num_threads=1)


class Side:
    """A tokenizer with its tokens' lengths, which of them a space marks, and the ids as text with what follows them."""

    def __init__(self, tokenizer, last: str):
        self.tokenizer = tokenizer
        self.lengths = np.array([len(b) for b in tokenizer.bytes], np.int64)
        self.marked = np.array([b.startswith(b" ") for b in tokenizer.bytes])
        self.inner, self.last = (np.array([f"{i}{mark}" for i in range(len(self.lengths))], object) for mark in (",", last))

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return self.lengths[ids].cumsum()

    def spells(self, ids: list[int], text: bytes) -> bool:
        return b"".join(map(self.tokenizer.bytes.__getitem__, ids)) == text


class Encoder:
    """Ids of a space and a text by both tokenizers; chunks that neither joins to the next are remembered."""

    def __init__(self, a: Side, b: Side):
        self.sides = (a, b)
        self.by_chunk = all(side.tokenizer.by_chunk for side in self.sides)
        self.memo: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.misspelt: set[str] = set()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """None for a text that is empty or not spelt by both."""
        if self.by_chunk:
            cut = [[c[1:] for c in _CUT.split(" " + t)] if _UNUSUAL.search(t) else t.split(" ") for t in texts]
        else:
            cut = [[t] for t in texts]
        fresh = list(set().union(*cut).difference(self.memo[0]))
        words = [c for c in fresh if _WORD.fullmatch(c)] if self.by_chunk else []
        rest = [" " + c for c in (set(fresh).difference(words) if words else fresh)]
        for side, memo in zip(self.sides, self.memo):
            alone = rest if not words or self._learn(side, memo, words) else [" " + c for c in fresh]
            for spaced, ids in zip(alone, side.tokenizer.encode(alone)):
                memo[spaced[1:]] = array("i", ids).tobytes()
                if not side.spells(ids, spaced.encode()):
                    self.misspelt.add(spaced[1:])
        out = [self._ids(text, chunks) for text, chunks in zip(texts, cut)]
        crowded = len(self.memo[0]) > MEMO_CHUNKS
        for memo in self.memo:
            if crowded:
                memo.clear()
            for chunk in fresh:
                if len(chunk) > MEMO_LETTERS:
                    memo.pop(chunk, None)
        if crowded:
            self.misspelt.clear()
        return out

    def _learn(self, side: Side, memo: dict[str, bytes], words: list[str]) -> bool:
        """Encode words in one text, at whose spaces no token goes on; False if their bytes are others."""
        spaced = [" " + word for word in words]
        (ids,) = side.tokenizer.encode(["".join(spaced)])
        if not side.spells(ids, "".join(spaced).encode()):
            return False
        ids = np.array(ids, np.int32)
        raw, ends = ids.tobytes(), np.cumsum([len(word.encode()) for word in spaced])
        stops = ((np.searchsorted(side.ends(ids), ends) + 1) * ids.itemsize).tolist()
        memo.update(zip(words, [raw[i:j] for i, j in zip([0, *stops], stops)]))
        return True

    def _ids(self, text: str, chunks: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        both = tuple(np.frombuffer(b"".join(map(memo.__getitem__, chunks)), np.int32) for memo in self.memo)
        right = bool(text)
        if self.misspelt and not self.misspelt.isdisjoint(chunks):
            right = all(side.spells(ids.tolist(), (" " + text).encode()) for side, ids in zip(self.sides, both))
        return both if right else None


@lru_cache(maxsize=2)
def _encoder(model_a: bytes, model_b: bytes) -> Encoder:
    return Encoder(Side(ByteLevel(model_a), "|"), Side(Pieces(model_b), ";"))


def cut_windows(a: Side, b: Side, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where windows end in both id sequences: at shared ends before space-marked tokens, and at the end.

    The sequences may be those of several texts, one behind the other: their first tokens are marked by the space.
    """
    ends_a, ends_b = a.ends(ids_a), b.ends(ids_b)
    before_a, before_b = (ends[:-1][side.marked[ids[1:]]] for side, ids, ends in ((a, ids_a, ends_a), (b, ids_b, ends_b)))
    shared = np.append(np.intersect1d(before_a, before_b, assume_unique=True), ends_a[-1:])
    return np.searchsorted(ends_a, shared) + 1, np.searchsorted(ends_b, shared) + 1


def same_windows(ids: tuple[np.ndarray, np.ndarray], cuts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(first window of each kind, kind of each window): windows of one kind have the same ids on both sides.

    Windows are known by a hash of their ids, which are then compared with those of the first window of the kind.
    """
    sides = [(x, cut, np.diff(cut, prepend=0)) for x, cut in zip(ids, cuts)]
    hashes = np.zeros(len(cuts[0]), np.uint64)
    for (x, cut, sizes), factor in zip(sides, _FACTORS):
        powers = np.full(sizes.max(initial=0), factor, np.uint64).cumprod()
        nth = np.arange(len(x)) - np.repeat(cut - sizes, sizes)
        mixed = np.add.reduceat((x.astype(np.uint64) + np.uint64(1)) * powers[nth], cut - sizes) if len(x) else hashes
        hashes = (hashes ^ (hashes >> np.uint64(31))) * factor + mixed
    _, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
    for x, cut, sizes in sides:
        own, other = sizes, sizes[first[kind]]
        if not np.array_equal(own, other) or not np.array_equal(x, x[_spread((cut - sizes)[first[kind]], sizes)]):
            known: dict = {}
            raws = [x.tobytes() for x in ids]
            starts = [((cut - sizes) * 4, cut * 4) for _, cut, sizes in sides]
            kind = np.array([known.setdefault(tuple(raw[i[w] : j[w]] for raw, (i, j) in zip(raws, starts)), len(known)) for w in range(len(kind))])
            return np.unique(kind, return_index=True)[1], kind
    return first, kind


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs of the given starts and sizes, one behind the other."""
    return np.repeat(starts - (sizes.cumsum() - sizes), sizes) + np.arange(sizes.sum())


def _joined(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values`` of the given sizes."""
    sums = np.concatenate(([0], values.cumsum()))
    ends = sizes.cumsum()
    return sums[ends] - sums[ends - sizes]


def pack_numbers(arrays: list[np.ndarray]) -> bytes:
    """Arrays of numbers from 0 on in few bytes: the narrowest types, bytes of one significance together, compressed."""
    kinds = [np.min_scalar_type(int(x.max(initial=0))) for x in arrays]
    raw = b"".join(x.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T.tobytes() for x, kind in zip(arrays, kinds))
    head = np.array([[len(x), kind.itemsize] for x, kind in zip(arrays, kinds)], np.int64)
    return head.tobytes() + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unpack_numbers(packed: bytes, n: int) -> list[np.ndarray]:
    """The ``n`` arrays of ``pack_numbers`` as bigints."""
    head = np.frombuffer(packed, np.int64, 2 * n).reshape(n, 2)
    raw = pa.Codec("zstd").decompress(packed[head.nbytes :], int(head.prod(axis=1).sum()), asbytes=True)
    out, at = [], 0
    for size, width in head.tolist():
        part = np.frombuffer(raw, np.uint8, size * width, at).reshape(width, size).T
        out.append(np.ascontiguousarray(part).view(f"u{width}").ravel().astype(np.int64))
        at += size * width
    return out


@dataclass
class Aligned:
    """Windows: groups as text (each with a mark behind it), their number, the links; and the linked pairs of each."""

    texts: list[str]
    groups: np.ndarray
    links: np.ndarray
    n_pairs: np.ndarray
    pairs: np.ndarray  # numbers in ``codes``
    times: np.ndarray  # links of the pair in the window
    codes: np.ndarray  # distinct pairs, packed


def align_windows(a: Side, b: Side, ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> Aligned:
    """Windows one behind the other, which end at ``cut_a`` and ``cut_b``, all aligned at once.

    Groups end where tokens of both sides end; in a group every token of one side is linked to all of the other. Both
    sides of a window have the same bytes, so the ends of the windows are ends of groups.
    """
    ends_a, ends_b = a.ends(ids_a), b.ends(ids_b)
    shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
    stop_a, stop_b = np.searchsorted(ends_a, shared) + 1, np.searchsorted(ends_b, shared) + 1
    n_a, n_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
    start_a, start_b = stop_a - n_a, stop_b - n_b
    window, links = np.searchsorted(cut_a, stop_a), n_a * n_b
    groups = np.bincount(window, minlength=len(cut_a))
    # The ids as text: those of a group's first side before those of its second.
    text = np.empty(len(ids_a) + len(ids_b), object)
    for side, ids, stop, n, place in ((a, ids_a, stop_a, n_a, start_b), (b, ids_b, stop_b, n_b, stop_a)):
        own = side.inner[ids]
        own[stop - 1] = side.last[ids[stop - 1]]
        text[np.arange(len(ids)) + np.repeat(place, n)] = own
    text, at = text.tolist(), [0, *(cut_a + cut_b).tolist()]
    texts = ["".join(text[i:j]) for i, j in zip(at, at[1:])]
    # Links of usual groups one by one, those of large ones by the ids that occur in them.
    usual = np.flatnonzero(links <= LARGE_GROUP)
    of = np.repeat(usual, links[usual])
    nth = np.arange(len(of)) - np.repeat(links[usual].cumsum() - links[usual], links[usual])
    first, second = ids_a[start_a[of] + nth // n_b[of]], ids_b[start_b[of] + nth % n_b[of]]
    found = [(window[of], first.astype(np.int64) << 32 | second, np.ones(len(of), np.int64))]
    for g in np.flatnonzero(links > LARGE_GROUP):
        (x, more_x), (y, more_y) = (np.unique(ids[i:j], return_counts=True) for ids, i, j in ((ids_a, start_a[g], stop_a[g]), (ids_b, start_b[g], stop_b[g])))
        codes = (x.astype(np.int64)[:, None] << 32 | y[None, :]).ravel()
        found.append((np.full(len(codes), window[g]), codes, np.outer(more_x, more_y).ravel()))
    window, codes, times = (np.concatenate(c) for c in zip(*found))
    distinct, pair = np.unique(codes, return_inverse=True)
    keys, which = np.unique(window * max(len(distinct), 1) + pair, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, which, times)
    of_window, pair = np.divmod(keys, max(len(distinct), 1))
    return Aligned(texts, groups, _joined(links, groups), np.bincount(of_window, minlength=len(cut_a)), pair, total, distinct)


class Pack:
    """Documents of bounded size in sum; windows of the same ids are aligned once."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self.keys: list = []
        self.ids: list[tuple[np.ndarray, np.ndarray]] = []
        self.tokens = 0

    def add(self, key, ids: tuple[np.ndarray, np.ndarray] | None) -> None:
        self.keys.append(key)
        self.ids.append(ids or (_NONE, _NONE))
        self.tokens += len(self.ids[-1][0])

    def row(self, number: int) -> tuple:
        """Rows, their windows and how often, the windows' pairs and links (NUMBERS), the distinct pairs and their documents."""
        ids = tuple(np.concatenate(side) for side in zip(*self.ids))
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in zip(*self.ids))
        cuts = cut_windows(self.a, self.b, *ids)
        first, found = same_windows(ids, cuts)
        own = [(cut, np.diff(cut, prepend=0)) for cut in cuts]
        kinds = [x[_spread((cut - sizes)[first], sizes[first])] for x, (cut, sizes) in zip(ids, own)]
        aligned = align_windows(self.a, self.b, *kinds, *[sizes[first].cumsum() for _, sizes in own])
        lengths = np.diff(np.searchsorted(cuts[0], n_a.cumsum(), "right"), prepend=0)
        texts, ends = np.array(aligned.texts, object)[found].tolist() if len(found) else [], lengths.cumsum().tolist()
        digests = ["".join(texts[i:j])[:-1] for i, j in zip([0, *ends], ends)]
        digests = [hashlib.sha256(d.encode()).hexdigest() if d else "" for d in digests]
        sums = [_joined(values[found], lengths) for values in (aligned.groups, aligned.links)]
        width = max(len(first), 1)
        held, times = np.unique(np.repeat(np.arange(len(lengths)), lengths) * width + found, return_counts=True)
        row, windows = np.divmod(held, width)
        # A document counts once for each pair, however many of its windows have it.
        sizes = aligned.n_pairs[windows]
        pairs = max(len(aligned.codes), 1)
        at = _spread((aligned.n_pairs.cumsum() - aligned.n_pairs)[windows], sizes)
        seen = np.unique(np.repeat(row, sizes) * pairs + aligned.pairs[at])
        documents = np.bincount(seen % pairs, minlength=len(aligned.codes))
        per_row = np.bincount(row, minlength=len(lengths))
        numbers = pack_numbers([per_row, windows, times, aligned.n_pairs, aligned.pairs, aligned.times])
        return number, self.keys, n_a, n_b, *sums, digests, numbers, aligned.codes, documents


NUMBERS = ["n_windows", "windows", "times", "n_pairs", "pairs", "links"]


def _pack_schema(key: T.DataType) -> T.StructType:
    lists = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, codes bigint, documents bigint"
    fields = [T.StructField(f.name, T.ArrayType(f.dataType)) for f in T._parse_datatype_string(lists)]
    return T.StructType([T.StructField("pack", T.LongType()), T.StructField("keys", T.ArrayType(key)), *fields[:5], T.StructField("numbers", T.BinaryType()), *fields[5:]])


def _packs(docs: DataFrame, model_a: bytes, model_b: bytes) -> DataFrame:
    """(key, text) -> packs."""
    schema = _pack_schema(docs.schema["key"].dataType)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model_a, model_b)
        number, pack = TaskContext.get().partitionId() << 32, Pack(*encoder.sides)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([value], field.type) for value, field in zip(pack.row(number), arrow)], schema=arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                keys, texts = (column.slice(at, TEXTS_AT_ONCE).to_pylist() for column in batch.columns)
                for key, ids in zip(keys, encoder.encode([t or "" for t in texts])):
                    pack.add(key, ids)
                    if pack.tokens >= PACK_TOKENS or len(pack.keys) >= PACK_ROWS:
                        yield done()
                        number, pack = number + 1, Pack(*encoder.sides)
        if pack.keys:
            yield done()

    return docs.mapInArrow(run, schema)


def _totals(pack: dict, counts: np.ndarray, best: np.ndarray) -> list[np.ndarray]:
    """Per document of a pack: links whose pair is its first id's most frequent one, and the sum of the links' counts."""
    out = []
    for values in (best.astype(np.int64), counts):
        of_windows = _joined(values[pack["pairs"]] * pack["links"], pack["n_pairs"])
        out.append(_joined(of_windows[pack["windows"]] * pack["times"], pack["n_windows"]))
    return out


def align_documents(
    docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(one row per row of ``docs``, the corpus' id pairs).

    Rows have ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose pair is in as many documents
    as any pair of its first id), ``count_sum`` (the documents of each link's pair, summed) and ``groups_sha256`` (of
    ``a1,a2|b1;a3|b2,b3``). Pairs have ``id_a``, ``id_b``, ``documents`` that hold it linked, and ``best``.

    ``path_a`` is a byte-level ``tokenizers`` file, run on a space and the text, ``path_b`` a ``sentencepiece`` model, run
    on the text; neither adds special tokens. A text that is null, empty, or not spelt by both (say, with U+2581 in it) has
    no tokens: zeros and an empty digest. Texts of any length are aligned whole; repeated rows are documents of their own,
    also under a null key; an empty table gives no rows and no pairs. Other columns are not read.
    """
    with open(path_a, "rb") as file_a, open(path_b, "rb") as file_b:
        model_a, model_b = file_a.read(), file_b.read()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    packs = written(_packs(rows, model_a, model_b), "packs", group_rows=GROUP_PACKS)
    counted = packs.select(F.explode(F.arrays_zip("codes", "documents")).alias("one")).groupBy(F.col("one.codes").alias("code")).agg(F.sum("one.documents").alias("documents"))
    counted = written(counted.withColumn("id_a", F.shiftright("code", 32).cast("int")), "pairs")
    most = counted.groupBy("id_a").agg(F.max("documents").alias("most"))  # no more rows than ids of the first tokenizer
    pairs = counted.join(F.broadcast(most), "id_a").withColumn("best", F.col("documents") == F.col("most"))
    asked = packs.select(F.col("pack").alias("asker"), F.posexplode("codes").alias("at", "code")).join(pairs, "code").select("asker", "at", "documents", "best")
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), *T._parse_datatype_string("n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")])
    arrow = to_arrow_schema(schema)

    def total(_, own: pa.Table, known: pa.Table) -> pa.Table:
        order = np.argsort(known.column("at").to_numpy())
        counts, best = (known.column(c).to_numpy()[order] for c in ("documents", "best"))
        first = own.combine_chunks().to_batches()[0]
        row = {name: column[0].values for name, column in zip(own.column_names, first.columns) if name not in ("pack", "numbers")}
        numbers = unpack_numbers(first.column("numbers")[0].as_py(), len(NUMBERS))
        n_best, count_sum = _totals(dict(zip(NUMBERS, numbers)), counts, best)
        columns = [row["keys"], *[row[c] for c in ("n_a", "n_b", "n_groups", "n_links")], pa.array(n_best), pa.array(count_sum), row["groups_sha256"]]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    parts = packs.drop("codes", "documents").groupBy("pack").cogroup(asked.groupBy("asker"))
    aligned = parts.applyInArrow(total, schema).withColumnRenamed("key", key)
    return aligned, pairs.select("id_a", F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("id_b"), "documents", "best")
