"""Removal of long repeated byte strings with a sampled suffix array.

A string of LENGTH bytes that starts at two places has, at both, the same leading token: the byte run of TOKEN bytes with
the least hash among all runs in it (the leftmost of equals). So only suffixes at such tokens are looked at, about one
in 75 bytes, and none of the strings is missed. Each token has a context: all strings of LENGTH bytes it leads.

1. Tokens are counted. Those that occur once lead no repeated string.
2. A context that occurs at more than one place is repeated whole, at each of them.
3. The different contexts of a token are compared, for those of one place. Sampled splitters range-partition the
   suffixes by their leading token, so that a bucket's border never cuts through the suffixes of a token. Buckets sort
   their suffixes, and the reversed bytes in front of them, by multikey quicksort; neighbours' common lengths then tell
   which strings are the same.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from speechlake.llm.common import written

LENGTH, TOKEN = 200, 48
REST = LENGTH - TOKEN  # a token has at most so many bytes of a string before or behind it
CHUNK = 1 << 22  # strings whose tokens are found at once
BUCKET_ROWS = 40_000
GROUP_ROWS = 20_000  # more different contexts of one token than that are compared by hashes of their strings
_PLACE = 24  # bits of a place in a chunk
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)


def token_hashes(raw: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes at each place, by doubling: H(a + b) = H(a) * P^|b| + H(b)."""
    power, size = 0x100000001B3, 1
    part, whole, done = raw.astype(np.uint64) + np.uint64(1), None, 0
    while True:
        if length & size:
            if whole is None:
                whole = part
            else:
                n = min(len(whole), len(part) - done)
                whole = whole[:n] * np.uint64(power) + part[done : done + n]
            done += size
        if size * 2 > length:
            break
        part = part[: len(part) - size] * np.uint64(power) + part[size:]
        power, size = power * power % (1 << 64), size * 2
    mixed = whole * np.uint64(_MIX[0])
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(_MIX[1])
    return mixed ^ (mixed >> np.uint64(32))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    least = values
    while size * 2 <= width:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    rest = width - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def tokens(text: bytes, length: int = LENGTH, token: int = TOKEN):
    """(hash, place of the token, first and last start of the strings it leads) as arrays, in text order."""
    out = []
    for at in range(0, len(text) - length + 1, CHUNK):
        raw = np.frombuffer(text[at : at + CHUNK + length - 1], np.uint8)
        hashes = token_hashes(raw, token)
        ranked = (hashes >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(hashes), dtype=np.uint64)
        place = (sliding_least(ranked, length - token + 1) & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.append(first[1:], len(place)) - 1
        out.append((hashes[place[first]].view(np.int64), place[first] + at, first + at, last + at))
    if not out:
        return [np.zeros(0, np.int64)] * 4
    return [np.concatenate(c) for c in zip(*out)]


def _token_rows(length: int, token: int):
    """(k, r, text) -> one row per token: k, r, packed place, token hash, context hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        names = ["k", "r", "place", "token", "context"]
        for batch in batches:
            out = []
            for k, r, value in zip(batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)):
                text = value.as_py().encode()
                hashes, place, first, last = tokens(text, length, token)
                if len(hashes):
                    context = np.fromiter((xxh64_intdigest(text[a:b]) for a, b in zip(first.tolist(), (last + length).tolist())), np.uint64, len(hashes))
                    packed = first << 16 | (last - first) << 8 | (place - first)
                    out.append((np.full(len(hashes), k), np.full(len(hashes), r), packed, hashes, context.view(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=names)

    return run


def multikey_order(rows: np.ndarray, sizes: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows (padded to one width) within ``groups``, and the common length of each with the one before it.

    Multikey quicksort with eight bytes as one character: NumPy's sort puts the members of a group in order of one
    character, and groups that are equal in it are sorted on by the next one.
    """
    n, width = rows.shape
    characters = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, -width % 8)))).view(">u8").astype(np.uint64)
    order = np.lexsort((sizes, groups))  # of equal padded rows the shorter comes first
    first = np.concatenate(([True], np.diff(groups[order]) != 0))
    starts = np.flatnonzero(first)
    size = np.diff(np.append(starts, n))
    group, active = np.repeat(starts, size), np.flatnonzero(np.repeat(size > 1, size))
    common = np.where(first, 0, width)
    for depth in range(characters.shape[1]):
        if not len(active):
            break
        own, char = group[active], characters[order[active], depth]
        turn = np.lexsort((char, own))
        order[active], char = order[active][turn], char[turn]
        fresh = np.concatenate(([True], own[1:] != own[:-1]))  # groups stay where they are
        differ = np.concatenate(([False], (char[1:] != char[:-1]) & ~fresh[1:]))
        apart = np.concatenate((char[:1], char[1:] ^ char[:-1]))[differ]
        common[active[differ]] = 8 * depth + sum((apart < np.uint64(1 << bits)).astype(np.int64) for bits in range(8, 64, 8))
        starts = np.flatnonzero(fresh | differ)
        size = np.diff(np.append(starts, len(active)))
        group[active] = np.repeat(active[starts], size)
        active = active[np.repeat(size > 1, size)]
    return order, np.minimum(common, np.minimum(sizes[order], np.concatenate(([0], sizes[order][:-1]))))


def repeated_strings(
    groups: np.ndarray, before: list[bytes], behind: list[bytes], first: np.ndarray, last: np.ndarray, rest: int
) -> np.ndarray:
    """Which strings of each context occur in another one of its group: a table context x bytes before the token.

    ``before`` are the bytes in front of the token, backwards, ``behind`` those after it. A string with b bytes before
    the token is led by it for ``first`` <= b <= ``last``.
    """
    n = len(before)
    sorted_sides = []
    for side in (before, behind):
        sizes = np.array([min(len(s), rest) for s in side], np.int64)
        rows = np.frombuffer(b"".join(s[:rest].ljust(rest, b"\0") for s in side), np.uint8).reshape(n, rest)
        sorted_sides.append(multikey_order(rows, sizes, groups))
    found = np.zeros((n, rest + 1), bool)
    for b in range(rest + 1):
        use = np.flatnonzero((first <= b) & (b <= last))
        if len(use) < 2:
            continue
        classes = []
        for (order, common), need in zip(sorted_sides, (b, rest - b)):
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(common < need) if need else groups[order]
            classes.append(rank[use])
        key = classes[0] * (n + 1) + classes[1]
        turn = np.argsort(key, kind="stable")
        same = np.diff(key[turn]) == 0
        found[use[turn[1:][same]], b] = True
        found[use[turn[:-1][same]], b] = True
    return found


def _runs(found: np.ndarray, places: np.ndarray, length: int) -> list[list[int]]:
    """Covered bytes of each context, from its start, as packed (start, size)."""
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    spans: list[list[int]] = [[] for _ in found]
    for row, low, high in zip(np.nonzero(edge == 1)[0].tolist(), np.nonzero(edge == 1)[1].tolist(), np.nonzero(edge == -1)[1].tolist()):
        start = int(places[row]) - (high - 1)
        spans[row].append(start << 10 | (high - 1 - low + length))
    return spans


def _compare(length: int, token: int):
    """Contexts of a bucket, whole tokens: the covered bytes of those that occur once, with their place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [batch for batch in batches if batch.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        pairs = np.stack([table.column(c).to_numpy() for c in ("token", "context")], axis=1)
        table = table.take(np.unique(pairs, axis=0, return_index=True)[1])  # copies of a whole row come here twice
        texts, leads, shape = table.column("bytes").to_pylist(), table.column("lead").to_pylist(), table.column("place").to_numpy()
        at, span = shape & 255, shape >> 8
        numbers = {lead: i for i, lead in enumerate(sorted(set(leads)))}
        groups = np.array([numbers[lead] for lead in leads])
        before = [t[:a][::-1] for t, a in zip(texts, at)]
        behind = [t[a + token :] for t, a in zip(texts, at)]
        found = repeated_strings(groups, before, behind, at - span, at, length - token)
        once = np.flatnonzero(table.column("n").to_numpy() == 1)
        spans = pa.array(_runs(found[once], at[once], length), pa.list_(pa.int64()))
        own = table.select(["k", "r", "first"]).take(once)
        yield pa.RecordBatch.from_arrays([*[column.combine_chunks() for column in own.columns], spans], names=[*own.column_names, "spans"])

    return run


def _cut(text_column: str, token: int, length: int):
    """Documents with the places of wanted contexts -> those places, their bytes and leading tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, names = None, ["k", "r", "first", "token", "context", "n", "place", "lead", "bytes"]
        kinds = [pa.int64()] * 7 + [pa.binary()] * 2
        for batch in batches:
            for own, value, wanted in zip(zip(*(batch.column(c).to_pylist() for c in ("_k", "_r"))), batch.column(text_column), batch.column("_wanted")):
                if own == last:  # copies of a whole row lie side by side
                    continue
                raw, last, rows = (value.as_py() or "").encode(), own, []
                for one in wanted.as_py():
                    first, span, at = one["place"] >> 16, one["place"] >> 8 & 255, one["place"] & 255
                    rows.append((*own, first, one["token"], one["context"], one["n"], span << 8 | at, raw[first + at : first + at + token], raw[first : first + span + length]))
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=names)

    return run


def merge_spans(spans: list[int]) -> list[tuple[int, int]]:
    """Packed (start, size) as merged (start, end) runs."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted((s >> 10, (s >> 10) + (s & 1023)) for s in spans):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs


def _covered(spans: list[int], own: list) -> list[int]:
    """Packed spans of a text: those of its places, but for places with spans of their own only these."""
    apart = {one["first"] for one in own}
    return [s for s in spans if s >> 10 not in apart] + [(one["first"] << 10) + s for one in own for s in one["spans"]]


ADDED = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]


def _removed(columns: list[str], text_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value, spans, own in zip(batch.column(text_column), batch.column("_spans"), batch.column("_own")):
                runs = merge_spans(_covered(spans.as_py() or [], own.as_py() or []))
                raw, at, kept = (value.as_py() or "").encode(), 0, []
                for start, end in runs:
                    kept.append(raw[at:start])
                    at = end
                rest = b"".join([*kept, raw[at:]])
                rows.append((len(raw), len(raw) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore")))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            added = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], *added], names=[*columns, *ADDED])

    return run


def _by_hashes(contexts: DataFrame, length: int) -> DataFrame:
    """As ``_compare``, for contexts of very frequent tokens: every string of theirs is a row with a 128-bit hash.

    Each context that occurs once has a row without spans and one for each of its strings that is repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            for *own, shape, raw in zip(*(batch.column(c) for c in ("k", "r", "first", "n", "place", "bytes"))):
                raw, span = raw.as_py(), shape.as_py() >> 8
                hashes = [xxh3_128_digest(raw[i : i + length]) for i in range(span + 1)]
                columns = [pa.array([v.as_py()] * (span + 1), pa.int64()) for v in own]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(range(span + 1), pa.int64()), pa.array(hashes, pa.binary())], names=["k", "r", "first", "n", "start", "string"])

    strings = contexts.mapInArrow(run, "k bigint, r bigint, first bigint, n bigint, start bigint, string binary")
    often = written(strings.groupBy("string").agg(F.sum("n").alias("total")).filter("total > 1"), "strings")
    hits = strings.filter("n = 1").join(often, "string").select("k", "r", "first", F.array(F.shiftleft("start", 10) + length).alias("spans"))
    return contexts.filter("n = 1").select("k", "r", "first", F.array().cast("array<bigint>").alias("spans")).unionAll(hits)


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, token: int = TOKEN, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept`` of every row.

    Each byte of a text (UTF-8) that a string of ``length`` bytes covers which starts anywhere else too is removed, in
    the same row or another; strings are judged on the input. ``kept`` is what is left as text, without bytes of a
    character that was cut in two; ``kept_sha256`` is of the bytes themselves. A null text is empty; repeated rows are
    copies of each other, so they lose all from ``length`` bytes on; the key only spreads the work and may be null; an
    empty table gives no rows. Columns of ``docs`` named like the added ones are replaced. ``length`` - ``token`` must
    be below 256.
    """
    columns = [c for c in docs.columns if c not in ADDED]
    whole = F.coalesce(F.col(text), F.lit(""))
    # Never null, so the joins below add no filter and share one exchange of the texts.
    marked = docs.select(*[F.col(f"`{c}`") for c in columns], F.xxhash64(key).alias("_k"), F.xxhash64(whole).alias("_r"))

    def token_rows() -> DataFrame:
        rows = docs.select(F.xxhash64(key).alias("k"), F.xxhash64(whole).alias("r"), whole.alias("text"))
        return rows.mapInArrow(_token_rows(length, token), "k bigint, r bigint, place bigint, token bigint, context bigint")

    counted = token_rows().groupBy("token").agg(F.count("*").alias("n"), F.min("context").alias("low"), F.max("context").alias("high"))
    often = written(counted.filter("n > 1").select("token", (F.col("low") != F.col("high")).alias("mixed")), "tokens")
    rows = written(token_rows().join(often, "token"), "token-rows")

    mixed = rows.filter("mixed")
    distinct = mixed.groupBy("token", "context").agg(F.count("*").alias("n"), F.min(F.struct("k", "r", "place")).alias("at"))
    # All places of a text in one row, so that it is joined once; there are no more than its tokens.
    places = F.collect_list(F.struct("token", "context", "n", "at.place")).alias("_wanted")
    wanted = distinct.groupBy(F.col("at.k").alias("_at_k"), F.col("at.r").alias("_at_r")).agg(places)
    sizes = written(distinct.groupBy("token").agg(F.count("*").alias("rows")), "sizes")
    buckets = max(1, -(-(sizes.agg(F.sum("rows")).first()[0] or 0) // BUCKET_ROWS))
    hot = sizes.filter(F.col("rows") > group_rows).select("token")
    at_place = marked.join(wanted, (F.col("_k") == F.col("_at_k")) & (F.col("_r") == F.col("_at_r")))
    cut = "k bigint, r bigint, first bigint, token bigint, context bigint, n bigint, place bigint, lead binary, bytes binary"
    contexts = at_place.mapInArrow(_cut(text, token, length), cut)
    schema = "k bigint, r bigint, first bigint, spans array<bigint>"
    if hot.isEmpty():
        compared = contexts.repartitionByRange(buckets, "lead").mapInArrow(_compare(length, token), schema)
    else:
        contexts = written(contexts, "contexts").dropDuplicates(["token", "context"])
        usual = contexts.join(hot, "token", "left_anti")
        compared = usual.repartitionByRange(buckets, "lead").mapInArrow(_compare(length, token), schema)
        compared = compared.unionByName(_by_hashes(contexts.join(hot, "token", "left_semi"), length))
    # Every place covers its whole context, which takes no join: only places of contexts that occur once learn from the
    # comparison what they cover instead.
    whole_span = F.shiftleft(F.shiftright("place", 16), 10) + F.shiftright("place", 8).bitwiseAND(F.lit(255)) + length
    own = F.struct("first", "spans").alias("own")
    covered = rows.select("k", "r", whole_span.alias("span")).unionByName(compared.select("k", "r", own), allowMissingColumns=True)
    spans = covered.groupBy("k", "r").agg(F.collect_set("span").alias("_spans"), F.collect_list("own").alias("_own"))
    spans = spans.select(F.col("k").alias("_span_k"), F.col("r").alias("_span_r"), "_spans", "_own")
    joined = marked.join(spans, (F.col("_k") == F.col("_span_k")) & (F.col("_r") == F.col("_span_r")), "left")
    kept_fields = [docs.schema[c] for c in columns]
    result = T.StructType([*kept_fields, *T._parse_datatype_string("n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string")])
    return joined.mapInArrow(_removed(columns, text), result)
