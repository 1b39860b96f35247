"""Word and unit error rates.

The error rate is 100 x the sum of edit distances / the sum of reference lengths, over all pairs of a group (NULL
without any reference). Spark ships no edit distance on lists (``levenshtein`` compares characters), so pairs are scored in
Arrow batches: many pairs at a time in 64-bit words, a few long ones each in long integers.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def edit_distance(ref: Sequence, hyp: Sequence) -> int:
    """Least number of insertions, deletions and substitutions between two sequences.

    Bit-parallel: one column of the distance table is held as the differences of its neighbours in two long integers
    (Myers 1999, Hyyro 2003), so a column costs a dozen integer operations.
    """
    start, shorter = 0, min(len(ref), len(hyp))
    while start < shorter and ref[start] == hyp[start]:
        start += 1
    end = 0
    while end < shorter - start and ref[-1 - end] == hyp[-1 - end]:
        end += 1
    ref, hyp = ref[start : len(ref) - end], hyp[start : len(hyp) - end]
    if not len(ref) or not len(hyp):
        return len(ref) + len(hyp)

    places: dict = {}
    for i, item in enumerate(ref):
        places[item] = places.get(item, 0) | (1 << i)
    everywhere = (1 << len(ref)) - 1
    up, down = everywhere, 0
    for item in hyp:
        same = places.get(item, 0) | down
        diagonal = (((same & up) + up) ^ up) | same
        lowered = (up & diagonal) << 1
        raised = (down | (everywhere & ~(diagonal | up))) << 1 | 1
        up, down = everywhere & (lowered | ~(diagonal | raised)), everywhere & raised & diagonal
    # Down the last column from len(hyp): one more where a bit of up is set, one less where a bit of down is.
    return len(hyp) + up.bit_count() - down.bit_count()


_WIDEST = 64  # words of 64 items: longer references are cheaper as long integers
_FEWEST = 16  # pairs in a group: fewer are cheaper one by one
_CELLS = 1 << 23  # of the tables of a group


def edit_distances(pairs: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """``edit_distance`` of many pairs of arrays of non-negative numbers.

    Pairs of similar size take the steps of the bit-parallel rule together, one column of all their tables at a time.
    """
    distances = np.zeros(len(pairs), np.int64)
    left = []
    for k, (ref, hyp) in enumerate(pairs):
        shorter = min(len(ref), len(hyp))
        other = np.flatnonzero(ref[:shorter] != hyp[:shorter])
        start = int(other[0]) if len(other) else shorter
        other = np.flatnonzero(ref[len(ref) - shorter + start :][::-1] != hyp[len(hyp) - shorter + start :][::-1])
        end = int(other[0]) if len(other) else shorter - start
        ref, hyp = ref[start : len(ref) - end], hyp[start : len(hyp) - end]
        if len(ref) and len(hyp):
            left.append((k, ref, hyp) if len(ref) <= len(hyp) else (k, hyp, ref))
        else:
            distances[k] = len(ref) + len(hyp)
    left.sort(key=lambda pair: len(pair[1]))
    for group in _groups(left):
        if len(group) < _FEWEST or len(group[-1][1]) > 64 * _WIDEST:
            for k, ref, hyp in group:
                distances[k] = edit_distance(ref.tolist(), hyp.tolist())
        else:
            distances[[k for k, *_ in group]] = _together([pair[1] for pair in group], [pair[2] for pair in group])
    return distances


def _groups(pairs: list[tuple]) -> Iterator[list[tuple]]:
    """Runs of pairs with references of similar size, whose tables stay within ``_CELLS``."""
    group, items, longest = [], 0, 0
    for pair in pairs:
        words = -(-len(pair[1]) // 64)
        items, longest = items + len(pair[1]), max(longest, len(pair[2]))
        wider = group and words > 1 + len(group[0][1]) // 50
        if wider or group and max(items * words, (len(group) + 1) * longest) > _CELLS:
            yield group
            group, items, longest = [], len(pair[1]), len(pair[2])
        group.append(pair)
    yield group


def _together(refs: list[np.ndarray], hyps: list[np.ndarray]) -> np.ndarray:
    """Distances of pairs whose references take about the same number of words."""
    order = sorted(range(len(hyps)), key=lambda k: -len(hyps[k]))  # pairs still at work are a prefix
    refs, hyps = [refs[k] for k in order], [hyps[k] for k in order]
    n, words = len(refs), -(-max(map(len, refs)) // 64)
    ref_lengths, hyp_lengths = (np.array([len(x) for x in side]) for side in (refs, hyps))
    span = 1 + max(int(x.max()) for x in [*refs, *hyps])
    at = np.arange(ref_lengths.sum()) - np.repeat(np.cumsum(ref_lengths) - ref_lengths, ref_lengths)
    keys, item = np.unique(np.repeat(np.arange(n), ref_lengths) * span + np.concatenate(refs), return_inverse=True)
    places = np.zeros((len(keys) + 1, words), np.uint64)  # the last row: items that the reference lacks
    np.bitwise_or.at(places, (item, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    asked = np.repeat(np.arange(n), hyp_lengths) * span + np.concatenate(hyps)
    found = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    found[keys[found] != asked] = len(keys)
    steps = np.full((hyp_lengths[0], n), len(keys), np.int32)
    steps[np.arange(len(asked)) - np.repeat(np.cumsum(hyp_lengths) - hyp_lengths, hyp_lengths), np.repeat(np.arange(n), hyp_lengths)] = found

    everywhere, one, top = ~np.uint64(0), np.uint64(1), np.uint64(63)
    up, down = np.full((n, words), everywhere), np.zeros((n, words), np.uint64)
    active = n - np.searchsorted(hyp_lengths[::-1], np.arange(hyp_lengths[0]), side="right")
    for step, m in zip(steps, active):
        u, d = up[:m], down[:m]
        same = places[step[:m]] | d
        both = same & u
        total = both + u
        if words > 1:
            # A word passes a carry on if it overflowed, or is full and gets one: all words of a pair as bits of one number.
            over, full = _packed(total < u), _packed(total == everywhere)
            carry = ((over << one) + full) ^ full
            total += np.unpackbits(carry.view(np.uint8).reshape(m, 8), axis=1, bitorder="little", count=words)
        diagonal = (total ^ u) | same
        fall = u & diagonal
        rise = d | ~(diagonal | u)
        lowered, raised = fall << one, rise << one
        raised[:, 0] |= one
        if words > 1:
            lowered[:, 1:] |= fall[:, :-1] >> top
            raised[:, 1:] |= rise[:, :-1] >> top
        up[:m], down[:m] = lowered | ~(diagonal | raised), raised & diagonal
    bits = np.clip(ref_lengths[:, None] - 64 * np.arange(words), 0, 64)
    inside = np.where(bits == 64, everywhere, (one << np.minimum(bits, 63).astype(np.uint64)) - one)
    change = np.bitwise_count(up & inside).astype(np.int64) - np.bitwise_count(down & inside).astype(np.int64)
    distances = np.empty(n, np.int64)
    distances[order] = hyp_lengths + change.sum(axis=1)
    return distances


def _packed(bits: np.ndarray) -> np.ndarray:
    """The up to 64 columns of a matrix as bits of one number per row."""
    whole = np.zeros((len(bits), 8), np.uint8)
    whole[:, : -(-bits.shape[1] // 8)] = np.packbits(bits, axis=1, bitorder="little")
    return whole.view(np.uint64)[:, 0]


def _scored(lengths: np.ndarray, differ: np.ndarray, pairs: Sequence[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    errors = np.zeros(len(lengths), np.int64)
    errors[differ] = edit_distances(pairs)
    return pa.StructArray.from_arrays([pa.array(errors), pa.array(lengths.astype(np.int64))], ["errors", "length"])


def _codes(ref: Sequence, hyp: Sequence) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct item of a pair."""
    numbers = {item: i for i, item in enumerate({*ref, *hyp})}
    return tuple(np.fromiter(map(numbers.__getitem__, side), np.int64, len(side)) for side in (ref, hyp))


def _numbered(refs: list[Sequence], hyps: list[Sequence], equal: pa.Array) -> pa.Array:
    """Scores of lists. ``hyps`` of equal pairs are not looked at."""
    differ = np.flatnonzero(~equal.to_numpy(zero_copy_only=False))
    pairs = [_codes(refs[i], hyps[i]) for i in differ]
    return _scored(np.array([len(r) for r in refs], np.int64), differ, pairs)


_SCORE_TYPE = T.StructType([T.StructField("errors", T.LongType()), T.StructField("length", T.LongType())])


@F.arrow_udf(_SCORE_TYPE)
def _word_scores(ref: pa.Array, hyp: pa.Array, equal: pa.Array) -> pa.Array:
    return _numbered([(r or "").split() for r in ref.to_pylist()], [(h or "").split() for h in hyp.to_pylist()], equal)


@F.arrow_udf(_SCORE_TYPE)
def _unit_scores(ref: pa.Array, hyp: pa.Array, equal: pa.Array) -> pa.Array:
    return _numbered([r or [] for r in ref.to_pylist()], [h or [] for h in hyp.to_pylist()], equal)


def _compared(score, ref: str, hyp: str) -> Column:
    """Scores of two columns; of equal pairs only the reference goes to Python."""
    equal = F.col(ref).eqNullSafe(F.col(hyp))
    return score(F.col(ref), F.when(~equal, F.col(hyp)), equal)


def word_errors(df: DataFrame, ref: str = "ref", hyp: str = "hyp", name: str = "words") -> DataFrame:
    """Add a struct of ``errors`` (word edits from ref to hyp) and ``length`` (words of ref)."""
    return df.withColumn(name, _compared(_word_scores, ref, hyp))


def unit_errors(df: DataFrame, ref: str = "ref_tokens", hyp: str = "hyp_tokens", name: str = "units") -> DataFrame:
    """The same on arrays of tokens."""
    return df.withColumn(name, _compared(_unit_scores, ref, hyp))


def _percent(score: str) -> Column:
    return F.try_divide(F.sum(f"{score}.errors") * 100, F.sum(f"{score}.length"))


def _rate(df: DataFrame, by: list[str], score: str, name: str) -> DataFrame:
    return df.groupBy(*by).agg(
        F.sum(f"{score}.errors").alias("errors"), F.sum(f"{score}.length").alias("length"), _percent(score).alias(name)
    )


def wer(df: DataFrame, by: list[str] = (), ref: str = "ref", hyp: str = "hyp") -> DataFrame:
    """Word error rate in percent, with its edits and reference words."""
    return _rate(word_errors(df.select(*by, ref, hyp), ref, hyp), list(by), "words", "wer")


def uer(df: DataFrame, by: list[str] = (), ref: str = "ref_tokens", hyp: str = "hyp_tokens") -> DataFrame:
    """Unit (token) error rate in percent, with its edits and reference tokens."""
    return _rate(unit_errors(df.select(*by, ref, hyp), ref, hyp), list(by), "units", "uer")


def error_rates(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """``wer`` and ``uer`` of rows with ``ref``, ``hyp``, ``ref_tokens`` and ``hyp_tokens``, in one pass."""
    both = unit_errors(word_errors(df))
    return both.groupBy(*by).agg(_percent("words").alias("wer"), _percent("units").alias("uer"))


def publish_gate(df: DataFrame, floor: float = 1.0) -> DataFrame:
    """Keep only rows whose ``uer`` and ``wer`` both reach ``floor``."""
    return df.filter((F.col("uer") >= floor) & (F.col("wer") >= floor))
