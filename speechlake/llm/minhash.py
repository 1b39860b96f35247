"""MinHash fingerprints of documents, their likeness to edited texts and to the next documents, and classes of near copies.

A fingerprint holds, for each of PERMUTATIONS universal hash functions, the least value over the word shingles of a text;
two fingerprints agree in about as many places as the Jaccard similarity of the shingle sets says. Documents that agree
in a whole band of places meet in Spark, and their Jaccard similarity is verified on the shingle sets.
"""

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from speechlake.llm.common import broadcast_within, texts_of, written
from speechlake.llm.components import components

PERMUTATIONS, SHINGLE, SIMILARITY, SEED = 128, 5, 0.8, 42
BANDS, ROWS = 20, 5  # two texts of similarity 0.8 share no band in 1 of 2,800 cases, of 0.85 in 1 of 57,000
# The lowest bits of two fingerprints differ in (1 - similarity) / 2 of the places: 13 +- 3.4 at 0.8.
MOST_BITS = 32
WANTED_BROADCAST = 500_000  # rows of two or three numbers
SMALL_BAND = 32  # sets of a band value up to which they are joined in pairs, at most 15 a set; beyond that in blocks
BLOCK_SETS, BLOCK_BYTES = 512, 32 << 20  # of the sets in a block, about; two blocks meet in a task
_COLUMNS = 1 << 12  # shingles counted at once
_AT_ONCE = 256  # shingles hashed at once
_OUT_ROWS = 512
_RANDOM = np.random.default_rng(SEED)
_FACTORS, _SHIFTS = (_RANDOM.integers(0, 1 << 64, PERMUTATIONS, np.uint64) for _ in range(2))
_FACTORS |= np.uint64(1)
_PLACES = _RANDOM.integers(0, 1 << 64, 64, np.uint64) | np.uint64(1)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, in their order."""
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all runs of ``size`` words, in text order; none if there are fewer words."""
    runs = len(words) - size + 1
    if not size or runs <= 0:
        return np.zeros(0, np.uint64)
    mixed = sum(words[k : runs + k] * _PLACES[k] for k in range(size)) + np.uint64(size)
    for factor, shift in zip(_MIX, (30, 27)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * factor
    return mixed ^ (mixed >> np.uint64(31))


def distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted different numbers; NumPy's sort and a mask take a fraction of the time of its ``unique``."""
    hashes = np.sort(hashes)
    return hashes[np.concatenate(([True], hashes[1:] != hashes[:-1]))] if len(hashes) else hashes


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles of a text (A-Z lower-cased); fewer words are one shingle."""
    words = word_hashes(text.lower().split())
    return distinct(shingle_hashes(words, min(size, len(words))))


def least_values(found: np.ndarray) -> np.ndarray:
    """The least value of each hash function over shingle hashes; all bits set without any."""
    least = np.full(PERMUTATIONS, 0xFFFFFFFFFFFFFFFF, np.uint64)
    buffer = np.empty((min(len(found), _AT_ONCE), PERMUTATIONS), np.uint64)
    for at in range(0, len(found), _AT_ONCE):
        part = found[at : at + _AT_ONCE, None]
        values = np.multiply(part, _FACTORS, out=buffer[: len(part)])
        np.add(values, _SHIFTS, out=values)
        np.minimum(least, values.min(axis=0), out=least)
    return least


def _low_bits(least: np.ndarray) -> np.ndarray:
    return (least >> np.uint64(32)).astype(np.uint16)


def fingerprint(found: np.ndarray) -> np.ndarray:
    """Low 16 bits of the least value of each hash function over shingle hashes; all bits set without any."""
    return _low_bits(least_values(found))


class Head:
    """The front of a text, hashed once for all ends that may follow it."""

    def __init__(self, head: bytes):
        words = head.lower().split()
        # The last word goes on behind the head, unless a space ends it.
        self.open = words.pop() if words and not head[-1:].isspace() else b""
        hashes = word_hashes(words)
        self.last, self.short = hashes[1 - SHINGLE :], len(hashes) < SHINGLE
        self.found = distinct(shingle_hashes(hashes, SHINGLE))
        self.least = least_values(self.found)

    def followed_by(self, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes that are not of the head alone, and the fingerprint, of the whole text."""
        words = np.concatenate([self.last, word_hashes((self.open + end.lower()).split())])
        found = distinct(shingle_hashes(words, min(SHINGLE, len(words)) if self.short else SHINGLE))
        return found, _low_bits(np.minimum(self.least, least_values(found)))


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Share of places in which two fingerprints agree, about the Jaccard similarity of their shingle sets."""
    return float((one == other).mean())


def set_digest(found: np.ndarray) -> int:
    """The shingle set as one signed number, the same for texts of the same shingles."""
    from xxhash import xxh64_intdigest

    value = xxh64_intdigest(found.tobytes(), SEED)
    return value - (1 << 64) if value >> 63 else value


def band_values(print_: np.ndarray) -> np.ndarray:
    """One number per band, told apart by the band."""
    places = print_[: BANDS * ROWS].astype(np.uint64).reshape(BANDS, ROWS) + np.uint64(1)
    packed = (places * _PLACES[:ROWS]).sum(axis=1, dtype=np.uint64)
    mixed = (packed ^ (packed >> np.uint64(29))) * _MIX[0] + np.arange(BANDS, dtype=np.uint64) * _MIX[1]
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def _raw(value: pa.Scalar) -> bytes:
    return (value.as_py() or "").encode()


def _nodes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per distinct shingle set: ``node``, least key, a row that has it, its lowest bits and band values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, bits, bands = [], [], []
            for raw in texts_of(batch.column(3)):
                found = shingles(raw)
                print_ = fingerprint(found)
                nodes.append(set_digest(found))
                bits.append(np.packbits((print_ & 1).astype(np.uint8)).view(np.int64))
                bands.append(band_values(print_))
            columns = [*[batch.column(i) for i in range(3)], pa.array(nodes, pa.int64()), *map(pa.array, np.array(bits).reshape(-1, 2).T.copy())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(bands, pa.list_(pa.int64()))], names=["key", "k", "r", "node", "s1", "s2", "bands"])

    rows = docs.select(F.col(key).alias("key"), F.xxhash64(key).alias("k"), F.xxhash64(text).alias("r"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    marked = rows.mapInArrow(run, f"key {kind}, k bigint, r bigint, node bigint, s1 bigint, s2 bigint, bands array<bigint>")
    first = F.min(F.struct("k", "r", "s1", "s2", "bands")).alias("one")
    return written(marked.groupBy("node").agg(F.min("key").alias("first_key"), F.count("*").alias("copies"), first).select("node", "first_key", "copies", "one.*"), "nodes")


def _sets(wanted: DataFrame, docs: DataFrame, key: str, text: str, kind) -> DataFrame:
    """``node`` and ``found`` (``kind`` of its shingle hashes, sorted) of the ``wanted`` nodes, from a row that has each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.sort(shingles(text).astype(kind)).tobytes() for text in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["node", "found"])

    wanted = wanted.select("node", F.col("k").alias("_k"), F.col("r").alias("_r"))
    wanted = broadcast_within(written(wanted, "wanted"), WANTED_BROADCAST)
    texts = docs.withColumns({"_own_k": F.xxhash64(key), "_own_r": F.xxhash64(text)}).join(wanted, (F.col("_own_k") == F.col("_k")) & (F.col("_own_r") == F.col("_r")))
    return written(texts.select("node", F.col(text).alias("text")).mapInArrow(run, "node bigint, found binary").dropDuplicates(["node"]), "sets")


def _told_apart(values: np.ndarray) -> np.ndarray:
    """Sorted numbers of 16 bits as different ones: the second of a kind has another high part, and so on."""
    return values.astype(np.int64) | (np.arange(len(values)) - np.searchsorted(values, values)) << 16


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str, kind=np.uint64) -> DataFrame:
    """The ``pairs`` (``a``, ``b``) of nodes whose shingle sets have a Jaccard similarity of SIMILARITY or more.

    With 16-bit numbers as ``kind`` a quarter of the bytes travels. Different shingles may then count as the same, so
    some pairs too many stay, but none that is similar goes.
    """

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right = []
            for one, other in zip(batch.column(2), batch.column(3)):
                one, other = (np.frombuffer(x.as_buffer(), kind) for x in (one, other))
                if kind is np.uint16:
                    one, other = _told_apart(one), _told_apart(other)
                both = len(np.intersect1d(one, other, assume_unique=True))
                right.append(both >= SIMILARITY * (len(one) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(right, pa.bool_()))

    pairs = written(pairs, "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    found = _sets(nodes.join(ends, "node"), docs, key, text, kind)
    one, other = (found.select(F.col("node").alias(end), F.col("found").alias(f"of_{end}")) for end in ("a", "b"))
    return written(pairs.join(one, "a").join(other, "b").select("a", "b", "of_a", "of_b").mapInArrow(similar, "a bigint, b bigint"), "links")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles any two different sets share."""
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times[column] > 1
    rows, column = rows[common], np.unique(column[common], return_inverse=True)[1]
    turn = np.argsort(column, kind="stable")
    rows, column, both = rows[turn], column[turn], np.zeros((len(sets), len(sets)))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        part = slice(*np.searchsorted(column, (low, low + _COLUMNS)))
        held = np.zeros((len(sets), _COLUMNS), np.float32)  # counts below 2 ** 24 are exact
        held[rows[part], column[part] - low] = 1
        both += held @ held.T
    return both


def _join_roots(group: pa.Table) -> pa.Table:
    """Links between roots, from the similar sets of two blocks of a band value; no more than connect them."""
    roots, block = (group.column(c).to_numpy() for c in ("root", "block"))
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("found")]
    sizes, both = np.array([len(x) for x in sets]), shared_counts(sets)
    similar = both >= SIMILARITY * (sizes[:, None] + sizes[None, :] - both)
    similar &= roots[:, None] < roots[None, :]
    if block.min() != block.max():
        similar &= block[:, None] != block[None, :]  # those of one block meet by themselves
    least, links = {}, []

    def find(root: int) -> int:
        while (above := least.get(root, root)) != root:
            least[root] = root = least.get(above, above)
        return root

    for a, b in np.unique(np.stack([roots[side] for side in np.nonzero(similar)], axis=1), axis=0).tolist():
        one, other = find(a), find(b)
        if one != other:
            least[max(one, other)] = min(one, other)
            links.append((a, b))
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _rest_links(rooted: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """Links (``a``, ``b``) between roots of ``rooted`` (``node``, ``root``): all similar sets that share a band value.

    Only band values whose sets have several roots are looked at, and only sets of different roots compared. Few sets of
    a value are joined in pairs that their lowest bits leave possible; many are dealt into blocks, and any two blocks meet.
    """
    own = nodes.join(rooted, "node").select("node", "root", F.struct("s1", "s2").alias("s"), F.explode("bands").alias("value"))
    values = own.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("sets")).filter("low < high").select("value", "sets")
    own = written(own.join(written(values, "values"), "value"), "open")
    few = own.filter(F.col("sets") <= SMALL_BAND)
    met = (F.col("x.value") == F.col("y.value")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root")) & _near("x.s", "y.s")
    pairs = few.alias("x").join(few.alias("y"), met).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    links = _verified(_verified(pairs, nodes, docs, key, text, np.uint16), nodes, docs, key, text)
    root_a, root_b = (rooted.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")) for end in ("a", "b"))
    links = links.join(root_a, "a").join(root_b, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    many = own.filter(F.col("sets") > SMALL_BAND).select("value", "node", "root")
    found = _sets(nodes.join(many.select("node").distinct(), "node"), docs, key, text, np.uint64)
    size = found.select("node", F.length("found").alias("size"))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("size") / BLOCK_BYTES)).alias("blocks")
    blocks = written(many.join(size, "node").groupBy("value").agg(blocks), "blocks")
    dealt = many.join(blocks, "value").withColumn("block", F.pmod(F.xxhash64("node", "value"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")}).join(found, "node")
    return links.unionByName(dealt.groupBy("value", "first", "second").applyInArrow(_join_roots, "a bigint, b bigint"))


def _near(a: str, b: str):
    """Whether the lowest bits of two fingerprints leave a similarity of SIMILARITY possible."""
    return sum(F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in ("s1", "s2")) <= MOST_BITS


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``node`` and ``class_id`` of every shingle set that several rows have or that is linked to another one.

    Sets are linked if they share a band value and their Jaccard similarity is SIMILARITY or more. First all sets of a
    band value are compared with the least and the greatest one, which joins large groups at the cost of their size; then
    those that this left in different classes are compared with each other (``_rest_links``). Members of a class need not
    be linked to each other.
    """
    nodes = _nodes(docs, key, text)
    bands = nodes.select("node", F.explode("bands").alias("value"))
    heads = written(bands.groupBy("value").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high"), "heads")
    met = bands.join(heads, "value").select("node", F.explode(F.array("low", "high")).alias("head")).filter("node <> head")
    pairs = met.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()
    of_a, of_b = (nodes.select(F.col("node").alias(end), F.struct("s1", "s2").alias(f"s_{end}")) for end in ("a", "b"))
    links = _verified(pairs.join(of_a, "a").join(of_b, "b").filter(_near("s_a", "s_b")).select("a", "b"), nodes, docs, key, text)
    rooted = written(nodes.join(components(links), "node", "left").select("node", F.coalesce("root", "node").alias("root")), "roots")
    above = components(_rest_links(rooted, nodes, docs, key, text)).select(F.col("node").alias("root"), F.col("root").alias("above"))
    rooted = rooted.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
    rooted = nodes.select("node", "first_key", "copies").join(rooted, "node")
    classes = rooted.groupBy("root").agg(F.min("first_key").alias("class_id"), F.sum("copies").alias("n")).filter("n > 1").select("root", "class_id")
    return rooted.join(classes, "root").select("node", "class_id")


def _order(key, r) -> tuple:
    return (key is not None, key if key is not None else 0, r)


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its fingerprint, how like it is to its edited text and the next document, its class.

    ``key``, ``n_chars`` (code points), ``edited_sha256`` of the edited text (the last quarter of the code points, rounded
    down, replaced by the first as many of the next document's, or all), ``fingerprint`` and ``edited_fingerprint`` (hex),
    ``near_edited`` and ``near_next`` (likeness to the edited text's and the next document's fingerprint, 0 to 1), and
    ``class_id``, the least key of the class of near copies (see ``near_classes``; the own key if alone).

    Documents follow each other by key (null first), rows of one key by a hash of their texts; the first follows the last.
    A null text is empty; texts without words have one fingerprint and are one class; texts of any length are taken whole;
    repeated rows follow themselves; a null key has its class's least key (null if there is none); an empty table gives no
    rows. Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("r"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.select("key", "r").repartitionByRange(parts, "key", "r").groupBy(F.spark_partition_id()).agg(F.min(F.struct("key", "r")).alias("first"))
    starts = sorted({_order(*row["first"]) for row in ranged.collect()})
    kind = rows.schema["key"].dataType
    sent = T.StructType([*T._parse_datatype_string("part int, head boolean").fields, T.StructField("key", kind), *T._parse_datatype_string("r bigint, times bigint, packed binary").fields])
    made = T.StructType([T.StructField("key", kind), *T._parse_datatype_string(
        "times bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, node bigint").fields])
    sent_arrow, made_arrow = to_arrow_schema(sent), to_arrow_schema(made)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows to their ranges, once with how often they are there; the first of a range also to the range before it."""
        codec, heads = pa.Codec("zstd", compression_level=1), set()
        for batch in batches:
            out: dict[tuple, list] = {}
            for own, r, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                place = _order(own, r)
                if place in out:
                    out[place][4] += 1
                    continue
                raw = _raw(value)
                packed = len(raw).to_bytes(8, "little") + (codec.compress(raw, asbytes=True) if raw else b"")
                part = bisect_right(starts, place) - 1
                out[place] = [part, False, own, r, 1, packed]
                if place == starts[part] and place not in heads:
                    heads.add(place)
                    out[(part,)] = [(part - 1) % len(starts), True, own, r, 0, packed]
            columns = list(zip(*out.values()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, sent_arrow)], schema=sent_arrow)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a range in order, then the first of the next range."""
        codec, last, out = pa.Codec("zstd", compression_level=1), None, []

        def row(own, times, n_chars, front, begun, print_, node, after, after_print) -> tuple:
            end = after[: n_chars // 4].encode()
            of_edited = begun.followed_by(end)[1]
            return (
                own, times, n_chars, hashlib.sha256(front + end).hexdigest(), print_.tobytes().hex(), of_edited.tobytes().hex(),
                likeness(print_, of_edited), likeness(print_, after_print), node,
            )

        for batch in batches:
            for head, own, times, packed in zip(*(batch.column(c).to_pylist() for c in (1, 2, 4, 5))):
                size = int.from_bytes(packed[:8], "little")
                raw = codec.decompress(packed[8:], size, asbytes=True) if size else b""
                text = raw.decode()
                front = text[: len(text) - len(text) // 4].encode()
                begun = Head(front)
                found, print_ = begun.followed_by(raw[len(front) :])
                if last is not None:
                    out.append(row(*last, text, print_))
                    last = None
                if not head:
                    now = (len(text), front, begun, print_, set_digest(distinct(np.concatenate([begun.found, found]))))
                    if times > 1:
                        out.append(row(own, times - 1, *now, text, print_))
                    last = (own, 1, *now)
                if len(out) >= _OUT_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), made_arrow)], schema=made_arrow)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), made_arrow)], schema=made_arrow)

    ranges = rows.mapInArrow(send, sent).repartitionById(max(len(starts), 1), F.col("part")).sortWithinPartitions("head", "key", "r")
    result = ranges.mapInArrow(follow, made)
    classes = broadcast_within(written(near_classes(docs, key, text), "classes"), WANTED_BROADCAST)
    result = result.join(classes, "node", "left").withColumn("class_id", F.coalesce("class_id", "key"))
    result = result.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times")))).drop("_copy", "times", "node")
    return result.withColumnRenamed("key", key)
