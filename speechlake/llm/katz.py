"""Katz backoff scores: Good-Turing discounted bigram and word counts with exactly normalised backoff weights.

Words are known by 64-bit hashes. Documents are packed: a pack holds the bigrams of some documents, counted, with the
documents each occurs in. Its rows go to buckets by the hash of a bigram's first word, so a bucket has all that follows
its words: bigram counts, word counts (every word but the last mark is a first word once per occurrence) and the backoff
weights. What the second words count is asked of the buckets they belong to. Buckets are the partitioned tables of the
model; every bucket scores the tokens it holds, and the sums go back to the documents.

A word that would fill more than a bucket as a first word is hot. A sample finds the hot words; their bigrams are spread
by the second word, under stand-ins for the first one, and only a row of sums per hot word is brought together.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

START, END = np.uint64(1), np.uint64(2)  # marks before and behind a text; the end is a token, the start is not
DISCOUNTED = 5  # counts up to this are discounted
PACK_TOKENS, PACK_DOCS = 1_500_000, 60_000  # bounds on a task's memory
BUCKET_BYTES = 12 << 20  # text per bucket, about
SAMPLED = 16  # one document in so many is read for hot words; that steers where bigrams go, not what they count
LEAST_MASS = 1e-12

PACKS = (
    "bucket int, pack bigint, n_train int, n_docs int, first binary, n_second binary, second binary, n_in binary, docs binary, "
    "often binary, times binary, n_tokens array<bigint>"
)


# --- packs ---------------------------------------------------------------------------------------------------------


class _Pack:
    """Documents as rows of word numbers; ``rows`` gives their bigrams by bucket."""

    def __init__(self, number: int, buckets: int, hot: dict[int, int]):
        self.number, self.buckets, self.hot = number, buckets, hot
        self.words: dict[bytes, int] = {b"\0start": 0, b"\0end": 1}
        self.train, self.held, self.size = [], [], 0

    def add(self, key, text: bytes, held: bool) -> None:
        words, number = text.lower().split(), self.words.setdefault  # bytes: A-Z and ASCII white space only
        row = np.array([0, *[number(w, len(self.words)) for w in words], 1], np.int32)
        (self.held if held else self.train).append((key, row))
        self.size += len(row)

    def hashes(self) -> np.ndarray:
        from xxhash import xxh64_intdigest

        out = np.fromiter(map(xxh64_intdigest, self.words), np.uint64, len(self.words))
        out[:2] = START, END
        return out

    def rows(self) -> Iterator[dict]:
        docs = [row for _, row in [*self.train, *self.held]]
        keys = [key for key, _ in [*self.train, *self.held]]
        sizes = [len(d) - 1 for d in docs]
        shared = {"pack": self.number, "n_train": len(self.train), "n_docs": len(docs)}
        hashes = own = self.hashes()
        self.words, self.train, self.held = {}, [], []  # what follows needs the room
        first, second = np.concatenate([d[:-1] for d in docs]), np.concatenate([d[1:] for d in docs])
        del docs
        for i in np.flatnonzero(np.isin(own, np.array(list(self.hot), np.uint64))):
            at, spread = np.flatnonzero(first == i), self.hot[int(own[i])]
            first[at] = len(hashes) + (own[second[at]] % np.uint64(spread)).astype(np.int32)
            hashes = np.append(hashes, stand_ins(int(own[i]), spread))
        home = (hashes % np.uint64(self.buckets)).astype(np.int64)
        turn = np.lexsort((hashes, home))
        rank = np.empty(len(turn), np.int64)
        rank[turn] = np.arange(len(turn))
        pair = rank[first]
        pair *= len(hashes)
        pair += second
        del first, second
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        doc = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)[order]
        del order
        new_pair = np.concatenate(([True], pair[1:] != pair[:-1]))
        entry = np.flatnonzero(new_pair | np.concatenate(([True], doc[1:] != doc[:-1])))
        times = np.diff(np.append(entry, len(pair))).astype(np.uint32)
        doc = doc[entry]
        n_in = np.bincount((np.cumsum(new_pair) - 1)[entry])
        del entry
        pair = pair[new_pair]
        of_first = turn[pair // len(hashes)]
        second_hash = hashes[pair % len(hashes)]
        del pair, new_pair
        entry_end = np.concatenate(([0], np.cumsum(n_in)))
        cuts = np.searchsorted(home[of_first], np.arange(self.buckets + 1))
        for bucket, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if a == b:
                continue
            starts = np.flatnonzero(np.concatenate(([True], of_first[a + 1 : b] != of_first[a : b - 1])))
            part = slice(entry_end[a], entry_end[b])
            often = np.flatnonzero(times[part] > 1)
            arrays = {
                "first": hashes[of_first[a:b][starts]], "n_second": np.diff(np.append(starts, b - a)).astype(np.uint32), "second": second_hash[a:b],
                "n_in": n_in[a:b].astype(np.uint16), "docs": doc[part], "often": often.astype(np.uint32), "times": times[part][often],
            }
            yield shared | {"bucket": bucket, **{name: a.tobytes() for name, a in arrays.items()}}
        yield shared | {"bucket": self.number % self.buckets, "n_tokens": sizes, "keys": keys}


def stand_ins(word: int, spread: int) -> np.ndarray:
    """Hashes under which the bigrams of a hot first word are kept, by the hash of the second word."""
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(f"{word}|{k}") for k in range(spread)], np.uint64)


def _frequent(buckets: int):
    """Hashes of the first words of sampled texts that may be hot, and their counts; the number of all first words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        counts, texts, total = Counter(), 0, 0
        for batch in batches:
            for value in batch.column(0):
                words = (value.as_py() or "").encode().lower().split()
                counts.update(words)
                texts, total = texts + 1, total + len(words) + 1
            if len(counts) > PACK_TOKENS:  # words too rare here to be hot on the whole
                counts = Counter({w: n for w, n in counts.items() if n * 8 * buckets > total})
        found = [(int(START), texts), *((xxh64_intdigest(w), n) for w, n in counts.items() if n * 4 * buckets > total)]
        words = np.array([w for w, _ in found], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array([n for _, n in found], pa.int64()), pa.array([total] + [0] * (len(found) - 1), pa.int64())], names=["word", "n", "total"])

    return run


def hot_words(docs: DataFrame, text: str, buckets: int) -> dict[int, int]:
    """First words that would fill more than a bucket, and over how many stand-ins each is spread; at most ``buckets``."""
    if buckets == 1:
        return {}
    sample = docs.filter(F.pmod(F.xxhash64(F.col(text), F.lit(3)), F.lit(SAMPLED)) == 0).select(text)
    found = sample.mapInArrow(_frequent(buckets), "word bigint, n bigint, total bigint")
    seen = found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    total = seen.agg(F.sum("total")).first()[0] or 0
    rows = seen.filter(F.col("n") * buckets > total).collect() if total else []
    return {row.word % 2**64: 2 * -(-row.n * buckets // total) for row in rows}


def _packer(buckets: int, hot: dict[int, int], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        pack = _Pack(number, buckets, hot)

        def flush(pack):
            for row in pack.rows():
                yield pa.RecordBatch.from_pylist([{name: row.get(name) for name in schema.names}], schema=schema)

        for batch in batches:
            for key, text, held in zip(batch.column(0), batch.column(1), batch.column(2)):
                pack.add(key.as_py(), (text.as_py() or "").encode(), held.as_py())
                if pack.size >= PACK_TOKENS or len(pack.train) + len(pack.held) >= PACK_DOCS:
                    yield from flush(pack)
                    number += 1
                    pack = _Pack(number, buckets, hot)
        if pack.size:
            yield from flush(pack)

    return run


# --- one bucket ----------------------------------------------------------------------------------------------------


@dataclass
class _Part:
    """The bigrams of one pack in a bucket, and the documents they occur in."""

    pack: int
    n_docs: int
    first: np.ndarray
    second: np.ndarray
    pair: np.ndarray  # per (bigram, document)
    docs: np.ndarray
    times: np.ndarray
    trained: np.ndarray  # occurrences of each bigram in training documents


def _parts(table: pa.Table) -> list[_Part]:
    parts = []
    for row in table.to_pylist():
        if row["first"] is None:
            continue
        n_in, docs = np.frombuffer(row["n_in"], np.uint16), np.frombuffer(row["docs"], np.uint16)
        times = np.ones(len(docs), np.int64)
        times[np.frombuffer(row["often"], np.uint32)] = np.frombuffer(row["times"], np.uint32)
        pair = np.repeat(np.arange(len(n_in)), n_in)
        trained = np.bincount(pair, weights=times * (docs < row["n_train"]), minlength=len(n_in)).astype(np.int64)
        first = np.repeat(np.frombuffer(row["first"], np.uint64), np.frombuffer(row["n_second"], np.uint32))
        parts.append(_Part(row["pack"], row["n_docs"], first, np.frombuffer(row["second"], np.uint64), pair, docs, times, trained))
    return parts


def _first_words(parts: list[_Part]) -> tuple[np.ndarray, np.ndarray]:
    """First words of a bucket, sorted, and how often each occurs in training."""
    words, at = np.unique(np.concatenate([p.first for p in parts]), return_inverse=True)
    return words, np.bincount(at, weights=np.concatenate([p.trained for p in parts]), minlength=len(words)).astype(np.int64)


def _bigrams(parts: list[_Part]):
    """(first, second, trained count) of a bucket's bigrams, and the number of the bigram of each row of each part."""
    first, second = np.concatenate([p.first for p in parts]), np.concatenate([p.second for p in parts])
    order = np.lexsort((second, first))
    new = np.concatenate(([True], (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)))
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    counts = np.bincount(number, weights=np.concatenate([p.trained for p in parts])).astype(np.int64)
    keep = order[new]
    return first[keep], second[keep], counts, number


def _count_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == r).sum()) for r in range(1, DISCOUNTED + 2)]


STATS = 2 * (DISCOUNTED + 1) + 3


class _Hot:
    """Stand-ins of the hot words, sorted, and the word that each stands for."""

    def __init__(self, hot: dict[int, int]):
        subs = [(int(sub), word) for word, spread in hot.items() for sub in stand_ins(word, spread)]
        self.subs, self.words = (np.array(c, np.uint64) for c in (zip(*sorted(subs)) if subs else ([], [])))

    def among(self, first: np.ndarray) -> np.ndarray:
        return np.isin(first, self.subs)

    def word(self, first: np.ndarray) -> np.ndarray:
        return self.words[np.searchsorted(self.subs, first)]


def _stats(hot: dict[int, int]):
    """Word and bigram counts of counts, tokens and distinct words (without end marks and hot words), end marks."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts, values = _parts(table), [0] * STATS
        if parts:
            words, counts = _first_words(parts)
            counts = counts[(words != START) & ~_Hot(hot).among(words)]
            _, second, pairs, _ = _bigrams(parts)
            values = [*_count_of_counts(counts), *_count_of_counts(pairs), int(counts.sum()), int((counts > 0).sum()), int(pairs[second == END].sum())]
        return pa.table({f"s{i}": pa.array([v], pa.int64()) for i, v in enumerate(values)})

    return run


def _hot_bigrams(table: pa.Table, hot: _Hot):
    """Hot first word, second word and trained count of the bigrams under stand-ins in a bucket."""
    parts = _parts(table)
    for part in parts:
        own = hot.among(part.first)
        part.first, part.second, part.trained = part.first[own], part.second[own], part.trained[own]
    if not sum(len(p.first) for p in parts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first, second, counts, _ = _bigrams(parts)
    return hot.word(first), second, counts


def _hot_sums(hot: dict[int, int]):
    """Of each hot word in a bucket: its count, its bigrams with counts 1 .. DISCOUNTED, and the sum of larger counts."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        word, _, counts = _hot_bigrams(table, _Hot(hot))
        names, at = np.unique(word, return_inverse=True)
        sums = lambda x: pa.array(np.bincount(at, weights=x, minlength=len(names)).astype(np.int64))
        few = {f"n{r}": sums(counts == r) for r in range(1, DISCOUNTED + 1)}
        return pa.table({"word": pa.array(names.view(np.int64)), "total": sums(counts), **few, "rest": sums(np.where(counts > DISCOUNTED, counts, 0))})

    return run


def _by_home(words: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    home = (words % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((words, home))
    cuts = np.searchsorted(home[order], np.arange(buckets + 1))
    return [(to, words[order[a:b]]) for to, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]


def _asked_words(table: pa.Table, buckets: int, hot: dict[int, int]) -> list[tuple[int, np.ndarray]]:
    """Second words of a bucket by the bucket that counts them; end marks and hot words are told to all."""
    second = [np.frombuffer(row, np.uint64) for row in table.column("second").to_pylist() if row is not None]
    words = np.unique(np.concatenate(second)) if second else np.zeros(0, np.uint64)
    return _by_home(words[~np.isin(words, np.array([int(END), *hot], np.uint64))], buckets)


def _asker(buckets: int, hot: dict[int, int]):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        asked = _asked_words(table, buckets, hot)
        origin = key[0].as_py()
        return pa.table([
            pa.array([to for to, _ in asked], pa.int32()), pa.array([origin] * len(asked), pa.int32()), pa.array([w.tobytes() for _, w in asked], pa.binary()),
        ], names=["bucket", "origin", "words"])

    return run


def _answer(key: tuple, table: pa.Table, asked: pa.Table) -> pa.Table:
    """Training counts of the words that other buckets ask for, in their order."""
    parts = _parts(table)
    words, counts = _first_words(parts) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    words, counts = np.append(words, np.uint64(2**64 - 1)), np.append(counts, 0)
    out = []
    for row in asked.column("words").to_pylist():
        wanted = np.frombuffer(row, np.uint64)
        at = np.searchsorted(words, wanted)
        got = np.where(words[at] == wanted, counts[at], 0)
        out.append(got.astype(np.uint32 if got.max(initial=0) < 2**32 else np.uint64).tobytes())
    home = key[0].as_py()
    return pa.table([asked.column("origin").cast(pa.int32()), pa.array([home] * len(out), pa.int32()), pa.array(out, pa.binary())], names=["bucket", "home", "counts"])


# --- the model -----------------------------------------------------------------------------------------------------


def _katz_factors(n) -> np.ndarray:
    """Good-Turing factors for counts 0, 1, .. DISCOUNTED from the counts of counts, after Katz's cut at DISCOUNTED."""
    k = DISCOUNTED
    cut = (k + 1) * n[k] / n[0]
    turing = [(r + 1) * n[r] / (r * n[r - 1]) for r in range(1, k + 1)]
    return np.array([1.0, *[(t - cut) / (1 - cut) for t in turing]])


def discounts(of_counts: list[int]) -> np.ndarray:
    """Katz's factors for counts 0, 1, .. DISCOUNTED; each has to be in (0, 1].

    Where the counts of counts themselves give others (copied texts make even counts frequent), they are first smoothed
    to a straight line in logarithms; where that does not fall fast enough either, half an occurrence is taken off.
    """
    n = [float(c) for c in of_counts]
    usable = lambda f: np.isfinite(f).all() and ((f > 0) & (f <= 1)).all()
    if all(n) and n[0] != (DISCOUNTED + 1) * n[DISCOUNTED] and usable(factors := _katz_factors(n)):
        return factors
    ranks = [r for r, c in enumerate(n, 1) if c]
    if len(ranks) > 1:
        slope = np.polyfit(np.log(ranks), np.log([n[r - 1] for r in ranks]), 1)[0]
        if slope < -1.01 and usable(factors := _katz_factors([r**slope for r in range(1, DISCOUNTED + 2)])):
            return factors
    return np.concatenate(([1.0], 1 - 0.5 / np.arange(1, DISCOUNTED + 1)))


@dataclass
class Model:
    """What all buckets share: discounts, tokens, distinct words, end marks, and the chance of an unknown word."""

    word_factors: np.ndarray
    pair_factors: np.ndarray
    tokens: int
    distinct: int
    ends: int
    unknown: float
    scale: float

    @classmethod
    def of(cls, stats: list[int], hot_counts: list[int] = ()) -> "Model":
        k = DISCOUNTED + 1
        words, pairs = list(stats[:k]), stats[k : 2 * k]
        tokens, distinct, ends = stats[2 * k :]
        for count in (ends, *hot_counts):
            if 0 < count <= k:
                words[count - 1] += 1
            tokens, distinct = tokens + count, distinct + (count > 0)
        factors = discounts(words)
        if not tokens:
            return cls(factors, discounts(pairs), 0, 0, 0, 1.0, 1.0)
        # What the discounts take from the words goes to the one unknown word, so that all chances sum to 1.
        left = sum((1 - factors[r]) * r * words[r - 1] for r in range(1, k)) / tokens
        unknown = left if left > LEAST_MASS else 1 / (tokens + distinct + 1)
        return cls(factors, discounts(pairs), tokens, distinct, ends, unknown, (1 - unknown) / (1 - left) if left < 1 else 1.0)

    def word_chance(self, counts: np.ndarray) -> np.ndarray:
        seen = self.word_factors[np.minimum(counts, DISCOUNTED + 1) % (DISCOUNTED + 1)] * counts * (self.scale / max(self.tokens, 1))
        return np.where(counts > 0, seen, self.unknown)


def bigram_logs(model: Model, first: np.ndarray, pairs: np.ndarray, second_counts: np.ndarray, whole: dict | None = None) -> np.ndarray:
    """log10 P(second | first) of bigrams sorted by first word, from their counts and those of their second words.

    All seen bigrams of a first word have to be there, or ``whole`` has its sums: count, discounted count, and the word
    chances of its seen second words. A seen bigram has its discounted share of the first word's count; the rest backs
    off to the word chances of all other words, normalised so that the chances after a word sum to 1.
    """
    starts = np.flatnonzero(np.concatenate(([True], np.diff(first) != 0)))
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(first))))
    seen, words = pairs > 0, model.word_chance(second_counts)
    taken = np.where(seen, model.pair_factors[np.minimum(pairs, DISCOUNTED + 1) % (DISCOUNTED + 1)] * pairs, 0.0)
    sums = np.stack([np.bincount(group, weights=x, minlength=len(starts)) for x in (pairs, taken, np.where(seen, words, 0.0))])
    for i in np.flatnonzero(np.isin(first[starts], np.array(list(whole or ()), np.uint64))):
        sums[:, i] = whole[int(first[starts[i]])]
    total, all_taken, known = sums[:, group]
    share, left = taken / np.maximum(total, 1), 1 - all_taken / np.maximum(total, 1)
    tight = (left <= LEAST_MASS) & (total > 0)  # nothing was discounted: make room for one more occurrence
    share = np.where(tight, share * total / (total + 1), share)
    left = np.where(tight, 1 / (total + 1), left)
    weight = np.where(total > 0, left / (1 - known), 1.0)
    return np.log10(np.where(seen, share, weight * words))


class _Told:
    """What a bucket is told: the model, the sums of hot words, and the counts of its second words."""

    def __init__(self, table: pa.Table, answers: pa.Table, buckets: int, hot: dict[int, int]):
        rows = answers.to_pylist()
        stats = next(row["stats"] for row in rows if row["stats"] is not None)
        self.hot = {hot_row["word"] % 2**64: hot_row for row in rows for hot_row in row.get("hot") or ()}
        words = {word: row["total"] for word, row in self.hot.items() if word != int(START)}
        self.model = Model.of(stats, list(words.values()))
        told = {int(END): self.model.ends, **{word: words.get(word, 0) for word in hot}}
        counts_from = {row["home"]: row["counts"] for row in rows if row["counts"] is not None}
        known, counts = [np.array(list(told), np.uint64)], [np.array(list(told.values()), np.int64)]
        for home, asked in _asked_words(table, buckets, hot):
            raw = counts_from[home]
            known.append(asked)
            counts.append(np.frombuffer(raw, np.uint32 if len(raw) == 4 * len(asked) else np.uint64).astype(np.int64))
        known, counts = np.concatenate(known), np.concatenate(counts)
        order = np.argsort(known)
        self.known, self.counts = known[order], counts[order]

    def count(self, second: np.ndarray) -> np.ndarray:
        return self.counts[np.searchsorted(self.known, second)]

    def whole(self, stand: _Hot) -> dict[int, tuple[float, float, float]]:
        """Sums of the hot words, by their stand-ins; see ``bigram_logs``."""
        factors = self.model.pair_factors
        sums = {word: (row["total"], sum(factors[r] * r * row[f"n{r}"] for r in range(1, DISCOUNTED + 1)) + row["rest"], row["seen"]) for word, row in self.hot.items()}
        return {int(sub): sums[int(word)] for sub, word in zip(stand.subs, stand.words) if int(word) in sums}


def _hot_seen(buckets: int, hot: dict[int, int]):
    """Of each hot word in a bucket: the word chances of the second words seen after it."""

    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        told = _Told(table, answers, buckets, hot)
        word, second, counts = _hot_bigrams(table, _Hot(hot))
        names, at = np.unique(word, return_inverse=True)
        chances = np.where(counts > 0, told.model.word_chance(told.count(second)), 0.0)
        return pa.table({"word": pa.array(names.view(np.int64)), "seen": pa.array(np.bincount(at, weights=chances, minlength=len(names)), pa.float64())})

    return run


def _scorer(buckets: int, hot: dict[int, int]):
    """Sums of a bucket per pack: of log10(count + 1), of known words and of log10 chances, by document."""

    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        told, parts, out = _Told(table, answers, buckets, hot), _parts(table), []
        model = told.model
        if parts:
            first, second, pairs, number = _bigrams(parts)
            second_counts = told.count(second)
            logs = bigram_logs(model, first, pairs, second_counts, told.whole(_Hot(hot)))
            at = 0
            for part in parts:
                own = number[at : at + len(part.first)]
                at += len(part.first)
                count = second_counts[own][part.pair]
                by_doc = lambda x: np.bincount(part.docs, weights=x * part.times, minlength=part.n_docs)  # noqa: B023, E731
                sums = by_doc(np.log10(count + 1.0)), by_doc(count > 0), by_doc(logs[own][part.pair])
                out.append({"pack": part.pack, "base": sums[0].tobytes(), "known": sums[1].astype(np.uint32).tobytes(), "score": sums[2].tobytes()})
        for row in table.filter(pc.is_valid(table.column("n_tokens"))).to_pylist():
            out.append({"pack": row["pack"], "n_train": row["n_train"], "n_tokens": row["n_tokens"], "keys": row["keys"], "tokens": model.tokens, "distinct": model.distinct})
        pa.default_memory_pool().release_unused()
        kinds = {"pack": pa.int64(), "base": pa.binary(), "known": pa.binary(), "score": pa.binary(), "n_train": pa.int32(), "n_tokens": pa.list_(pa.int64()), "keys": table.schema.field("keys").type, "tokens": pa.int64(), "distinct": pa.int64()}
        return pa.table({name: pa.array([row.get(name) for row in out], kind) for name, kind in kinds.items()})

    return run


SUMS = "pack bigint, base binary, known binary, score binary, n_train int, n_tokens array<bigint>, keys array<{key}>, tokens bigint, distinct bigint"


def _finish(key: tuple, table: pa.Table) -> pa.Table:
    """Add up the sums of a pack and set them beside its documents."""
    rows = table.to_pylist()
    about = next(row for row in rows if row["n_tokens"] is not None)
    parts = [row for row in rows if row["base"] is not None]
    n, n_tokens = len(about["n_tokens"]), np.array(about["n_tokens"])
    add = lambda name, kind: sum((np.frombuffer(row[name], kind).astype(np.float64) for row in parts), np.zeros(n))
    base = add("base", np.float64) - n_tokens * np.log10(about["tokens"] + 1.0 * (about["distinct"] + 1))
    columns = {
        "key": pa.array(about["keys"], table.schema.field("keys").type.value_type), "held_out": pa.array(np.arange(n) >= about["n_train"]),
        "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(add("known", np.uint32).astype(np.int64)),
        "train_tokens": pa.array([about["tokens"]] * n, pa.int64()), "base_score": pa.array(base), "score": pa.array(add("score", np.float64)),
    }
    return pa.table(columns)


def held_out(key: str, folds: int = 7, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds == fold


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", held: Column | None = None, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Learns from the rows that are not held out (``held``; by default a seventh is, by the crc32 of the key) and scores
    all of them, whole texts. Tokens are the lower-cased words and one end mark. ``base_score`` sums log10 of add-one
    word chances; ``score`` is the log10 chance of the text under the Katz bigram model. A null text is empty (its only
    token is the end mark); a null key is that of an empty string; repeated rows each count and each get a row; without
    training rows every token is the unknown word, whose chance is 1; an empty table gives no rows. Read ``docs`` from a
    written table: packs are formed in the order of its scan.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), (held_out(key) if held is None else held).alias("held"))
    kind = rows.schema["key"].dataType.simpleString()
    size = docs.agg(F.sum(F.octet_length(text).cast("bigint"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    hot = hot_words(docs, text, buckets)
    schema = f"{PACKS}, keys array<{kind}>"
    packs = rows.mapInArrow(_packer(buckets, hot, to_arrow_schema(_parse_datatype_string(schema))), schema)
    by_bucket = packs.groupBy("bucket")
    # One row; the exchange of the packs is shared by all passes over the buckets.
    parts = by_bucket.applyInArrow(_stats(hot), ", ".join(f"s{i} bigint" for i in range(STATS)))
    stats = parts.agg(F.array(*[F.coalesce(F.sum(f"s{i}"), F.lit(0)) for i in range(STATS)]).alias("stats"))
    asked = by_bucket.applyInArrow(_asker(buckets, hot), "bucket int, origin int, words binary")
    answers = by_bucket.cogroup(asked.groupBy("bucket")).applyInArrow(_answer, "bucket int, home int, counts binary")

    def everywhere(hot_rows: DataFrame | None) -> DataFrame:
        """The statistics and the rows of the hot words (at most one per bucket), for every bucket."""
        every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket")
        told = answers.unionByName(stats.select(every, "stats"), allowMissingColumns=True)
        if hot_rows is None:
            return told
        listed = hot_rows.agg(F.collect_list(F.struct(*hot_rows.columns)).alias("hot"))
        return told.unionByName(listed.select(every, "hot"), allowMissingColumns=True)

    hot_rows = None
    if hot:
        names = ["total", *[f"n{r}" for r in range(1, DISCOUNTED + 1)], "rest"]
        totals = by_bucket.applyInArrow(_hot_sums(hot), "word bigint, " + ", ".join(f"{n} bigint" for n in names))
        totals = totals.groupBy("word").agg(*[F.sum(n).alias(n) for n in names])
        told = everywhere(totals.withColumn("seen", F.lit(0.0)))
        seen = by_bucket.cogroup(told.groupBy("bucket")).applyInArrow(_hot_seen(buckets, hot), "word bigint, seen double")
        hot_rows = totals.join(seen.groupBy("word").agg(F.sum("seen").alias("seen")), "word")
    sums = by_bucket.cogroup(everywhere(hot_rows).groupBy("bucket")).applyInArrow(_scorer(buckets, hot), SUMS.format(key=kind))
    result = f"key {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return sums.groupBy("pack").applyInArrow(_finish, result).withColumnRenamed("key", key)
