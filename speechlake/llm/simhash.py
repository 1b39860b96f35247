"""SimHash near-duplicates by the general pigeonhole principle.

The 64 bits are grouped into parts, correlated bits together. With thresholds t_1..t_m (-1 leaves a part out) that sum to
``distance - m + 1``, two fingerprints within ``distance`` agree up to t_i bits in at least one part i. The number of
parts and their thresholds are those of the least estimated work over all fingerprints, found by dynamic programming.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechlake.llm.common import written
from speechlake.llm.components import components

BITS, SEED, SHINGLE, DISTANCE = 64, 42, 4, 4
_CHUNK = 1 << 16  # shingles whose bits are counted at once
_PROBE_WORK = 4.0  # work of one probe, in compared candidates


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of a text's word shingles, in their order; a text of fewer words is one shingle."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = min(shingle, len(words))
    spans = zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist())
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - n + 1)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text's word shingles, as a signed number; 0 for a text without words."""
    hashes = shingle_hashes(text, shingle)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        chunk = hashes[at : at + _CHUNK]
        ones += np.unpackbits(chunk.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    over = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(over.view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``key``, ``fp`` and a hash ``r`` of the text of every row; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint((value.as_py() or "").encode(), shingle) for value in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], names=["key", "r", "fp"])

    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("r"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, r bigint, fp bigint")


def bit_pairs(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, per two bits, how many have both set: 64 x 64 sums over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            raw = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float64)
            sums, rows = sums + bits.T @ bits, rows + len(bits)
        at = np.arange(BITS * BITS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(np.append(sums.ravel(), rows).astype(np.int64))], names=["at", "n"])

    rows = fps.select("fp").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for row in rows:
        flat[row["at"]] = row["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def correlated_parts(total: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of about equal size; each takes the bits that correlate most with those it has."""
    share = np.diag(both) / max(total, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    link = np.abs(both / max(total, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(link, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, groups))) // (parts - k)
        left = sorted(free)
        group = [max(left, key=lambda j: (link[j, left].max(), -j))]
        while len(group) < size:
            left = [j for j in left if j not in group]
            group.append(max(left, key=lambda j: (link[j, group].sum(), -j)))
        groups.append(sorted(group))
        free -= set(group)
    return groups


def near_chances(share: np.ndarray, bits: list[int], upto: int) -> list[float]:
    """Chance that two fingerprints differ in at most 0, 1, .. ``upto`` of ``bits``, taking bits as independent."""
    exact = [1.0] + [0.0] * upto
    for j in bits:
        q = 2 * share[j] * (1 - share[j])
        exact = [exact[t] * (1 - q) + (exact[t - 1] * q if t else 0.0) for t in range(upto + 1)]
    return list(np.cumsum(exact))


def allocate(work: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 on, one per part, of the given sum and the least summed work; ``work[i][t + 1]``."""
    best = {0: (0.0, [])}  # by the sum of (threshold + 1) so far
    for costs in work:
        step = {}
        for used, (cost, chosen) in best.items():
            for t, more in enumerate(costs):
                at = used + t
                if at <= total + len(work) and (at not in step or cost + more < step[at][0]):
                    step[at] = (cost + more, [*chosen, t - 1])
        best = step
    return best[total + len(work)]


@dataclass(frozen=True)
class Plan:
    parts: list[list[int]]
    thresholds: list[int]

    def masks(self) -> list[int]:
        return [_signed(sum(1 << j for j in bits)) for bits in self.parts]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _work(total: int, pairs0: float, chances: list[float], bits: int, upto: int) -> list[float]:
    """Estimated work of one part by threshold from -1 on: candidate pairs, and probes with all near values."""
    work = [0.0]
    for t in range(upto + 1):
        candidates = pairs0 * chances[t] / max(chances[0], 1e-300)
        work.append(candidates + (_PROBE_WORK * total * sum(math.comb(bits, k) for k in range(t + 1))))
    return work


def make_plan(fps: DataFrame, distance: int = DISTANCE) -> Plan:
    """Parts and thresholds for distinct ``fps``.

    The number of parts comes from per-bit shares; the candidate counts of its parts are then measured: the pairs that
    agree in a whole part, over all fingerprints, scaled to larger thresholds by the per-bit chances.
    """
    total, both = bit_pairs(fps)
    share = np.diag(both) / max(total, 1)
    upto = min(distance, 2)
    options = []
    for parts in range(1 + distance // (upto + 1), distance + 2):
        groups = correlated_parts(total, both, parts)
        chances = [near_chances(share, bits, upto) for bits in groups]
        work = [_work(total, total * total / 2 * c[0], c, len(bits), upto) for c, bits in zip(chances, groups)]
        options.append((allocate(work, distance - parts + 1)[0], groups, chances))
    _, groups, chances = min(options, key=lambda o: o[0])
    masks = Plan(groups, []).masks()
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(masks)]))
    same = fps.select(keys.alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    pairs = {row.part: row.pairs for row in same.groupBy(F.col("k.part").alias("part")).agg(F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2).alias("pairs")).collect()}
    work = [_work(total, pairs.get(i, 0.0), c, len(bits), upto) for i, (c, bits) in enumerate(zip(chances, groups))]
    return Plan(groups, allocate(work, distance - len(groups) + 1)[1])


def near_links(fps: DataFrame, plan: Plan, distance: int = DISTANCE) -> DataFrame:
    """All pairs ``a`` < ``b`` of distinct fingerprints with at most ``distance`` differing bits.

    Every fingerprint stands in the index once per part; it probes with all values within the part's threshold. A pair
    is verified inside the join, so candidates are never rows.
    """
    used = [(i, bits, mask, t) for i, (bits, mask, t) in enumerate(zip(plan.parts, plan.masks(), plan.thresholds)) if t >= 0]
    fp = F.col("fp")

    def key(i, mask, flip=0):
        value = fp.bitwiseAND(F.lit(mask))
        return F.struct(F.lit(i).alias("part"), (value.bitwiseXOR(F.lit(_signed(flip))) if flip else value).alias("value"))

    index = fps.select(fp.alias("b"), F.explode(F.array(*[key(i, mask) for i, _, mask, _ in used])).alias("k"))
    probes = fps.select(fp.alias("a"), F.explode(F.array(*[key(i, mask, flip) for i, bits, mask, t in used for flip in _flips(bits, t)])).alias("k"))
    index = index.select("b", "k.part", "k.value")
    probes = probes.select("a", "k.part", "k.value")
    met = (probes["part"] == index["part"]) & (probes["value"] == index["value"]) & (probes["a"] < index["b"])
    near = F.bit_count(probes["a"].bitwiseXOR(index["b"])) <= distance
    return probes.join(index, met & near).select("a", "b").distinct()


def _flips(bits: list[int], threshold: int) -> list[int]:
    flips = [0]
    for _ in range(threshold):
        flips += [f | 1 << j for f in flips for j in bits if not f >> j & 1]
    return list(dict.fromkeys(flips))


def grouped(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> tuple[DataFrame, DataFrame]:
    """(``key``, ``r``, ``fp``) of every row, and (``fp``, ``root``, ``component_id``) of every distinct fingerprint.

    Equal fingerprints are one node from the start, so copies cost nothing beyond their own rows.
    """
    rows = written(fingerprints(docs, key, text, shingle), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("key").alias("first_key")), "classes")
    links = near_links(classes.select("fp"), make_plan(classes.select("fp"), distance), distance)
    roots = components(links)
    nodes = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "first_key", F.coalesce("root", "fp").alias("root"))
    nodes = written(nodes, "nodes")
    least = nodes.groupBy("root").agg(F.min("first_key").alias("component_id"))
    # Written, so that the runtime can split the rows of a very frequent fingerprint where they are joined.
    return rows, written(nodes.join(least, "root").select("fp", "root", "component_id"), "members")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` (least key reachable) of every row of ``docs``.

    Rows link if their fingerprints differ in at most ``distance`` bits. Texts that are null or without words have
    fingerprint 0 and link like any other; a null key takes part and gets its component's least key (null if there is
    none); repeated rows are all returned; an empty table gives no rows; other columns are not read.
    """
    rows, members = grouped(docs, key, text, shingle, distance)
    return rows.join(members, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the least key (null first), then text hash.

    Of rows that are alike in key and text one is kept, too. All columns stay; an empty table stays empty.
    """
    rows, members = grouped(docs, key, text, shingle, distance)
    return kept(docs, rows.join(members, "fp").select("key", "r", "root"), key, text)


def kept(docs: DataFrame, rows: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with one row of each ``root`` of ``rows`` (``key``, hash ``r`` of the text, ``root``); see ``keep_one``."""
    least = rows.groupBy("root").agg(F.min(F.struct("key", "r")).alias("least"))
    chosen = written(least.select(F.col("least.key").alias("_key"), F.col("least.r").alias("_r")), "chosen")
    marked = docs.withColumns({"_own_key": F.xxhash64(key), "_own_r": F.xxhash64(text)})
    same = (F.col("_own_r") == F.col("_r")) & (F.col("_own_key") == F.xxhash64("_key")) & F.col(f"`{key}`").eqNullSafe(F.col("_key"))
    kept = marked.join(chosen, same).dropDuplicates(["_own_key", "_own_r"])  # reduced before the shuffle, however many
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
