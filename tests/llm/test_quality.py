"""Co-training on every unlabelled document."""

import numpy as np

from speechlake.llm import quality


def tables(spark, rare):
    """5,000 unlabelled rows of two sources and, if ``rare``, 60 of a third."""
    rows = [(i, f"A calm sentence number {i % 97} about rivers and stones. " * 3 if i % 2 else f"BUY!! {i % 89}!! NOW!! " * 9, "en", "site" if i % 2 else "shop", 100) for i in range(5800)]
    labels = [(i, i % 2) for i in range(800)]
    rows += [(9000 + i, f"Zebra quartz {i} vex jumbo. " * 6, "xx", "site", 100) for i in range(60)] if rare else []
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return spark.createDataFrame(rows, schema), spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_every_unlabelled_row_is_scored(spark, monkeypatch):
    """The sums of the pool are those of all unlabelled rows, and equal to sums in memory."""
    docs, labels = tables(spark, True)
    seen = []

    class Seen(quality.SparkPool):
        def sums(self, teach, weights=None):
            if not seen:
                x = quality._matrix(self.rows.toArrow().column("x").combine_chunks())
                local = quality.LocalPool(x[:, : quality.TEXT_WIDTH], x[:, quality.TEXT_WIDTH :])
                at = [teach.text, teach.meta]
                assert np.allclose(super().sums(teach), local.sums(teach))
                assert np.allclose(super().sums(teach, at), local.sums(teach, at), rtol=1e-3, atol=1e-2)
                seen.append((len(x), super().sums(teach)))
            return super().sums(teach, weights)

    monkeypatch.setattr(quality, "SparkPool", Seen)
    model = quality.train_quality(docs, labels)
    rows, counts = seen[0]
    assert rows == 5060 and counts.max() > 2000  # beyond any fixed number of pool rows or of verdicts a round
    assert model is not None


def test_gradient():
    rng = np.random.default_rng(1)
    x, w = rng.standard_normal((50, 6)), rng.standard_normal(6)
    for label in (0.0, 1.0):
        loss = quality._loss(x, label, w)
        step = [(quality._loss(x, label, w + d)[0] - quality._loss(x, label, w - d)[0]) / 2e-6 for d in np.eye(6) * 1e-6]
        assert np.allclose(loss[1:], step, atol=1e-5)


def test_one_row_per_labelled_key(spark, monkeypatch):
    docs, labels = tables(spark, False)
    again = docs.filter("doc_id = 1").crossJoin(spark.range(3000)).drop("id")
    seen = []
    teach = quality.teach_views
    monkeypatch.setattr(quality, "teach_views", lambda xt, xm, y, *more: (seen.append(len(y)), teach(xt, xm, y, *more))[1])
    quality.train_quality(docs.unionAll(again), labels)
    assert seen == [800]
