"""Quality classifier by co-training a text-content view and a page-metadata view.

Both views are logistic models on hashed features. In every round each scores all unlabelled documents, and its confident
verdicts become labels for the other one. Each view is then calibrated on labelled rows that neither was
trained on, and the calibrated views are added up as evidence to score all documents.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechlake.llm.common import broadcast_within, written

TEXT_BUCKETS, META_BUCKETS = 1024, 256
# Only the labelled sample is bounded; the views teach each other on every unlabelled document.
LABELLED_ROWS, KNOWN_ROWS = 4000, 200_000
ROUNDS, CONFIDENT, STEPS = 4, 0.97, 8
SUMS = 12  # rows of sums that a pass brings to the driver
_STORED = np.float16
SEED = 11
TEXT_WIDTH = TEXT_BUCKETS + 4
SHORT_BYTES, SHARE_WEIGHT = 200, 4.0
# Byte kinds: 1 for A-Z, 2 for marks other than full stops, commas, hyphens and quotes.
_KIND = np.array([1 if 65 <= b <= 90 else 2 if chr(b) in "!#$%&()*+/:;<=>?@[\\]^_`{|}~" else 0 for b in range(256)])


def text_features(text: bytes) -> np.ndarray:
    """Square roots of the shares of hashed byte triples, shares of repeated words, capitals and marks, and a constant.

    A few bytes are little evidence, so the shares of short texts are drawn towards 0.
    """
    raw = np.frombuffer(text, np.uint8)
    out = np.zeros(TEXT_WIDTH, np.float32)
    out[-1] = 1.0
    if len(raw) >= 3:
        wide = raw.astype(np.uint32)
        triples = ((wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]) * np.uint32(2654435761)
        counts = np.bincount(triples >> np.uint32(22), minlength=TEXT_BUCKETS)  # the top 10 bits
        out[:TEXT_BUCKETS] = np.sqrt(counts / (len(triples) + SHORT_BYTES))
        words = text.split()
        again = sum(map(eq, words, words[1:]))
        kinds = np.bincount(_KIND[raw], minlength=3)
        weight = SHARE_WEIGHT / (len(raw) + SHORT_BYTES)
        out[TEXT_BUCKETS:-1] = weight * again * len(raw) / max(len(words), 1), weight * kinds[1], weight * kinds[2]
    return out


def meta_features(values: tuple) -> np.ndarray:
    """One bucket per (column, value); numbers by their order of magnitude, halves apart; and a constant."""
    import xxhash

    out = np.zeros(META_BUCKETS + 1, np.float32)
    out[-1] = 1.0
    for k, value in enumerate(values):
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            value = None if value != value else int(2 * np.log2(1 + min(abs(value), 1e300)))
        out[xxhash.xxh32_intdigest(f"{k}|{value}", SEED) % META_BUCKETS] += 1.0
    return out


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Weights of a logistic model with a ridge, by Newton steps; the classes weigh the same in sum."""
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = _sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + penalty * w
        bend = x.T @ (x * (weight * p * (1 - p))[:, None]) + np.diag(penalty)
        step = np.linalg.solve(bend, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def calibrate(scores: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of log odds on raw scores, with the targets drawn in a little from 0 and 1."""
    a, b = 1.0, 0.0
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(50):
        p = _sigmoid(a * scores + b)
        d, e = p - target, p * (1 - p) + 1e-9
        bend = np.array([[(e * scores * scores).sum() + 1e-3, (e * scores).sum()], [(e * scores).sum(), e.sum()]])
        step = np.linalg.solve(bend, [(d * scores).sum(), d.sum()])
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(a, 0.0), b if a > 0 else float(np.log((y.sum() + 1) / ((1 - y).sum() + 1)))


@dataclass
class CoTrained:
    """Weights and calibration (slope, offset) of both views, and the log odds of the labels."""

    text: np.ndarray
    meta: np.ndarray
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    prior: float

    def odds(self, text_scores, meta_scores):
        """Calibrated log odds of each view, and of both: evidence over the prior adds up."""
        text = self.text_scale[0] * text_scores + self.text_scale[1]
        meta = self.meta_scale[0] * meta_scores + self.meta_scale[1]
        return text, meta, text + meta - self.prior


class LocalPool:
    """Unlabelled rows held in memory; ``SparkPool`` gives the same sums over a table."""

    def __init__(self, pool_t: np.ndarray, pool_m: np.ndarray):
        self.views = [(np.asarray(pool_t, np.float64), np.asarray(pool_m, np.float64))] if len(pool_t) else []

    def sums(self, teach: "Teaching", weights=None) -> np.ndarray:
        return sum((teach.sums(xt, xm, weights) for xt, xm in self.views), np.zeros(teach.size(weights)))


@dataclass
class Teaching:
    """What one round takes from the unlabelled rows: each view's confident verdicts are the other's labels."""

    text: np.ndarray
    meta: np.ndarray
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    confident: float

    def size(self, weights) -> int:
        return 4 if weights is None else sum(2 * (len(w) + 1) for w in weights)

    def sums(self, xt: np.ndarray, xm: np.ndarray, weights) -> np.ndarray:
        """Numbers of labels by view and class or, at ``weights``, loss and gradient by view and class."""
        out = []
        teachers = ((xm, self.meta, self.meta_scale), (xt, self.text, self.text_scale))
        for k, (x, (other, w, scale)) in enumerate(zip((xt, xm), teachers)):
            p = _sigmoid(scale[0] * (other @ w) + scale[1])
            for label, sure in ((0.0, 1 - p), (1.0, p)):
                rows = x[sure >= self.confident]
                out.append([len(rows)] if weights is None else _loss(rows, label, weights[k]))
        return np.concatenate(out).astype(np.float64)


def _loss(x, y, w) -> np.ndarray:
    """Sum of the losses of rows ``x`` of label ``y``, and its gradient."""
    z = np.clip(x @ w, -40, 40)
    return np.concatenate([[np.log1p(np.exp(np.where(y > 0, -z, z))).sum()], (_sigmoid(z) - y) @ x])


def _learn(pool, teach: Teaching, known, y, start, ridge: float = 1.0):
    """Weights of both views on the labelled rows and on all confident verdicts, from ``start`` on; None without verdicts.

    The classes weigh the same in each of the two sets, and verdicts together weigh no more than the labelled rows, however
    large the table is. Only sums leave the pool; both views take their steps in one pass over it.
    """
    counts = pool.sums(teach).reshape(2, 2)
    if not counts.any():
        return None
    n = len(y)
    mass = np.minimum(counts.sum(axis=1), n)
    part = np.where((counts > 0).all(axis=1), 0.5, 1.0)
    scale = np.where(counts > 0, (part * mass)[:, None] / np.maximum(counts, 1), 0.0)
    sides = (1 - y.mean(), y.mean())
    own = np.where(y > 0, 0.5 / max(sides[1], 1e-9), 0.5 / max(sides[0], 1e-9))
    penalties, bends = [], []
    for x, w in zip(known, start):
        penalty = np.full(x.shape[1], ridge)
        penalty[-1] = 1e-6
        p = _sigmoid(x @ w)
        bends.append(2 * x.T @ (x * (own * np.maximum(p * (1 - p), 1e-3))[:, None]) + np.diag(penalty + 1e-3))
        penalties.append(penalty)

    def value(weights):
        total, slopes, at = 0.0, [], 0
        found = pool.sums(teach, weights)
        for k, (x, w) in enumerate(zip(known, weights)):
            z = np.clip(x @ w, -40, 40)
            total += (own * np.log1p(np.exp(np.where(y > 0, -z, z)))).sum() + 0.5 * (penalties[k] * w * w).sum()
            gradient = x.T @ (own * (_sigmoid(z) - y)) + penalties[k] * w
            for label in range(2):
                one = found[at : at + len(w) + 1] * scale[k, label]
                total, gradient, at = total + one[0], gradient + one[1:], at + len(w) + 1
            slopes.append(gradient)
        return total, np.concatenate(slopes)

    cut = len(start[0])
    split = lambda v: [v[:cut], v[cut:]]
    return split(_descend(lambda v: value(split(v)), np.concatenate(start), lambda v: np.concatenate([np.linalg.solve(b, g) for b, g in zip(bends, split(v))])))


def _descend(value, at: np.ndarray, inverse, steps: int = STEPS) -> np.ndarray:
    """The least point of a convex function from ``at`` on: L-BFGS from ``inverse``, a first guess of the inverse bend."""
    past = []
    now, slope = value(at)
    for _ in range(steps):
        q, used = slope.copy(), []
        for s, t in reversed(past):
            used.append((s @ q) / (s @ t))
            q -= used[-1] * t
        step = inverse(q)
        for (s, t), u in zip(past, reversed(used)):
            step += s * (u - (t @ step) / (s @ t))
        size, down = 1.0, slope @ step
        while True:
            then, after = value(at - size * step)
            if then <= now - 1e-4 * size * down or size < 1e-3:
                break
            size /= 2
        if then >= now:
            break
        if -size * step @ (after - slope) > 1e-12:
            past.append((-size * step, after - slope))
        gain, at, now, slope = now - then, at - size * step, then, after
        if gain <= 1e-4 * now:
            break
    return at


def co_train(xt, xm, y, fold, pool_t, pool_m, rounds=ROUNDS, confident=CONFIDENT) -> CoTrained:
    """``teach_views`` on unlabelled rows in memory."""
    return teach_views(xt, xm, y, fold, LocalPool(pool_t, pool_m), rounds, confident)


def teach_views(xt, xm, y, fold, pool, rounds=ROUNDS, confident=CONFIDENT) -> CoTrained:
    """Train both views on rows outside of ``fold``, let them teach each other on the pool, calibrate on ``fold``."""
    learn = ~fold
    prior = float(np.log((y.sum() + 1) / ((1 - y).sum() + 1)))
    known = [np.asarray(x[learn], np.float64) for x in (xt, xm)]
    weights = [fit(x, y[learn]) for x in known]
    for turn in range(rounds + 1):
        scales = [calibrate(x[fold] @ w, y[fold]) for x, w in zip((xt, xm), weights)]
        if turn == rounds:
            break
        more = _learn(pool, Teaching(*weights, *scales, confident), known, y[learn], weights)
        if more is None:
            break
        weights = more
    return CoTrained(*weights, *scales, prior)


def _features(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            metas = list(zip(*[batch.column(c).to_pylist() for c in columns])) if columns else [()] * batch.num_rows
            rows = [text_features((v.as_py() or "").encode()).astype(_STORED).tobytes() + meta_features(m).astype(_STORED).tobytes() for v, m in zip(batch.column("text"), metas)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=[batch.schema.names[0], "x"])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    width = TEXT_WIDTH + META_BUCKETS + 1
    out = np.empty((len(column), width), np.float32)
    for i, row in enumerate(column):
        out[i] = np.frombuffer(row.as_buffer(), _STORED)
    return out


class SparkPool:
    """All unlabelled rows, as a table of features; a pass over it returns a few rows of sums."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def sums(self, teach: Teaching, weights=None) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(teach.size(weights))
            for batch in batches:
                for at in range(0, batch.num_rows, 2048):
                    x = _matrix(batch.column(0).slice(at, 2048))
                    total += teach.sums(x[:, :TEXT_WIDTH], x[:, TEXT_WIDTH:], weights)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

        def add(table: pa.Table) -> pa.Table:
            whole = sum((np.frombuffer(s.as_buffer()) for s in table.column("s")), np.zeros(teach.size(weights)))
            return pa.table({"s": pa.array([whole.tobytes()], pa.binary())})

        teach = Teaching(teach.text.astype(np.float32), teach.meta.astype(np.float32), teach.text_scale, teach.meta_scale, teach.confident)
        weights = None if weights is None else [w.astype(np.float32) for w in weights]
        total = np.zeros(teach.size(weights))
        # Tasks' sums are added up in SUMS groups; only those come to the driver, in one job.
        sums = self.rows.mapInArrow(run, "s binary").withColumn("g", F.spark_partition_id() % SUMS)
        for row in sums.groupBy("g").applyInArrow(add, "s binary").collect():
            total += np.frombuffer(row.s)
        return total


def train_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", meta: tuple[str, ...] = ("lang", "source", "n_chars"),
    label: str = "quality",
) -> CoTrained | None:
    """Fit on at most LABELLED_ROWS labelled documents and on all unlabelled ones; None if a class has no label.

    A key with contradicting labels counts as the lower one; other values of the label than 0 and 1 are passed over.
    Documents without a key are unlabelled.
    """
    names = [f"meta_{c}" for c in meta]
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *[F.col(c).alias(f"meta_{c}") for c in meta])
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    known = written(known.groupBy(F.col(key).alias("key")).agg(F.min(F.col(label).cast("double")).alias("label")), "known")
    # A label counts if its document is there; the sample is the first keys of a hash order.
    keys = docs.select(F.col(key).alias("key")).filter("key is not null").distinct()
    sample = known.join(keys, "key", "left_semi").withColumn("turn", F.xxhash64(F.col("key"), F.lit(SEED))).orderBy("turn", "key").limit(LABELLED_ROWS)
    # One row per key, so that a repeated key neither exceeds the bound nor dominates the fit.
    least = F.min_by(F.struct("label", "turn", "text", *names), F.xxhash64("text", *names)).alias("one")
    chosen = texts.join(F.broadcast(sample), "key").groupBy("key").agg(least).select("one.*").select(F.struct("label", "turn").alias("of"), "text", *names)
    of = "struct<label:double,turn:bigint>"
    rows = chosen.mapInArrow(_features(names), f"of {of}, x binary").select("of.label", "of.turn", "x").toArrow()
    y = rows.column("label").to_numpy(zero_copy_only=False).astype(np.float64)
    if not (y == 0).any() or not (y == 1).any():
        return None
    order = np.argsort(rows.column("turn").to_numpy(), kind="stable")
    x, y = _matrix(rows.column("x"))[order], y[order]
    del rows
    xt, xm = x[:, :TEXT_WIDTH], x[:, TEXT_WIDTH:]
    fold = np.arange(len(y)) % 4 == 0  # rows are in hash order
    if len(set(y[fold])) < 2 or len(set(y[~fold])) < 2:
        fold = np.ones(len(y), bool) if len(y) < 8 else fold
        if len(set(y[~fold])) < 2:
            return _unheld(xt, xm, y)
    kind = texts.schema["key"].dataType.simpleString()
    pool = texts.mapInArrow(_features(names), f"key {kind}, x binary").join(broadcast_within(known.select("key"), KNOWN_ROWS), "key", "left_anti")
    return teach_views(xt, xm, y, fold, SparkPool(written(pool.select("x"), "pool")))


def _unheld(xt, xm, y) -> CoTrained:
    """Too few labels to hold any back: one fit per view, calibrated on the same rows."""
    text, meta = fit(xt.astype(np.float64), y), fit(xm.astype(np.float64), y)
    prior = float(np.log((y.sum() + 1) / ((1 - y).sum() + 1)))
    return CoTrained(text, meta, calibrate(xt @ text, y), calibrate(xm @ meta, y), prior)


def score_quality(
    docs: DataFrame, model: CoTrained | None, text: str = "text", meta: tuple[str, ...] = ("lang", "source", "n_chars"),
    threshold: float = 0.5,
) -> DataFrame:
    """``docs`` with ``p_text``, ``p_meta``, ``p_quality`` (chance of label 1) and ``keep``, whole texts.

    Without a model (no labels of both classes) the chances are null and every row is kept. A null or empty text has
    the constant feature only, and null metadata is a value like others. Columns of ``docs`` named like the added ones
    are replaced; repeated rows are all returned.
    """
    added = ["p_text", "p_meta", "p_quality", "keep"]
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    if model is None:
        none = F.lit(None).cast("double")
        return kept.withColumns({"p_text": none, "p_meta": none, "p_quality": none, "keep": F.lit(True)})
    wt, wm = model.text.astype(np.float32), model.meta.astype(np.float32)

    @F.pandas_udf("struct<p_text:double,p_meta:double,p_quality:double>")
    def chances(texts, *metas):
        import pandas as pd

        st = np.fromiter((text_features((t or "").encode()) @ wt for t in texts), np.float64, len(texts))
        sm = np.fromiter((meta_features(tuple(None if v != v else v for v in m)) @ wm for m in zip(*metas)), np.float64, len(texts)) if metas else np.zeros(len(texts))
        return pd.DataFrame(dict(zip(["p_text", "p_meta", "p_quality"], map(_sigmoid, model.odds(st, sm)))))

    scored = kept.withColumn("_p", chances(F.col(text), *[F.col(c) for c in meta]))
    return scored.select(*[F.col(f"`{c}`") for c in kept.columns], "_p.*", (F.col("_p.p_quality") >= threshold).alias("keep"))


def classify_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", threshold: float = 0.5) -> DataFrame:
    """Train on ``docs`` and ``labels`` and score every row of ``docs``; see ``train_quality`` and ``score_quality``."""
    return score_quality(docs, train_quality(docs, labels, key, label=label), threshold=threshold)
