"""Error rates against a plain dynamic program."""

import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from speechlake.operators import score as E
from speechlake.operators.aggregate import batch_stats, best_step, mean_loss_bits, newest_step, step_number
from speechlake.operators.join import pair_transcripts


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_edit_distance():
    rng = random.Random(2)
    for _ in range(3000):
        a = [rng.choice("abcd") for _ in range(rng.randint(0, 70))]
        b = a[:] if rng.random() < 0.3 else [rng.choice("abcd") for _ in range(rng.randint(0, 70))]
        for _ in range(rng.randint(0, 3)):
            if b:
                b[rng.randrange(len(b))] = rng.choice("abcde")
        assert E.edit_distance(a, b) == distance(a, b)


def test_edit_distances_of_many():
    """Groups of one and more words, pairs of very different lengths, empty and equal ones."""
    rng = random.Random(3)
    pairs = []
    for i in range(900):
        longest = (8, 63, 64, 65, 300, 1300)[i % 6]
        a = [rng.randrange(6) for _ in range(longest if i % 4 == 0 else rng.randint(0, longest))]
        b = [x for x in a if rng.random() < 0.8] if rng.random() < 0.5 else [rng.randrange(8) for _ in range(rng.randint(0, 140))]
        pairs.append((np.array(a, np.int64), np.array(b, np.int64)))
    pairs.append((np.arange(4500), np.arange(4500)[::-1]))
    want = [E.edit_distance(a.tolist(), b.tolist()) for a, b in pairs]
    assert E.edit_distances(pairs).tolist() == want
    assert E.edit_distances([]).tolist() == []
    assert [distance(a.tolist(), b.tolist()) for a, b in pairs[:60]] == want[:60]


def test_wer(spark):
    rng = random.Random(4)
    vocab = ["la", "ng'ombe", "ĩ", "x", "yy"]
    rows = []
    for i in range(300):
        ref, hyp = ([rng.choice(vocab) for _ in range(rng.randint(0, 12))] for _ in range(2))
        rows.append((i, "dev" if i % 2 else "test", "  ".join(ref) + " ", "\x1f".join(hyp) or None))
    df = spark.createDataFrame(rows, "utt_id int, split string, ref string, hyp string")
    for split, got in {r.split: r for r in E.wer(df, ["split"]).collect()}.items():
        pairs = [(r[2].split(), (r[3] or "").split()) for r in rows if r[1] == split]
        errors, length = sum(distance(*p) for p in pairs), sum(len(p[0]) for p in pairs)
        assert (got.errors, got.length) == (errors, length)
        assert got.wer == pytest.approx(100 * errors / length)


def test_uer(spark):
    df = spark.createDataFrame([([1, 2, 3], [1, 3]), ([4], []), ([], [7]), ([5], None)], "ref_tokens array<int>, hyp_tokens array<int>")
    got = E.uer(df).first()
    assert (got.errors, got.length, got.uer) == (4, 5, 80.0)


def test_publish_gate(spark):
    df = spark.createDataFrame([(0.5, 9.0), (1.0, 1.0), (3.0, 0.9), (None, 5.0)], "uer double, wer double")
    assert E.publish_gate(df).collect() == [(1.0, 1.0)]


def test_pairs_must_be_unique(spark):
    refs = spark.createDataFrame([(1, "a"), (2, "b")], "utt_id int, ref string")
    hyps = spark.createDataFrame([(2, "x"), (1, "y")], "utt_id int, hyp string")
    assert sorted(pair_transcripts(refs, hyps).collect()) == [(1, "a", "y"), (2, "b", "x")]
    with pytest.raises(PySparkException, match="not unique"):
        pair_transcripts(refs, hyps.unionByName(hyps)).collect()


def test_metric_events(spark):
    df = spark.createDataFrame([(8.0, 2), (3.0, 1), (0.0, 5)], "loss double, batch_size bigint")
    assert mean_loss_bits(df).first()[0] == pytest.approx(11 / 0.6931471805599453 / 8)
    clips = spark.createDataFrame([(0, 5), (0, 3), (1, 4)], "b int, audio_size bigint")
    assert sorted(batch_stats(clips, ["b"]).collect()) == [(0, 2, 8, 2), (1, 1, 4, 0)]


def test_checkpoints(spark):
    rows = [("/r_2/ws_1/step_500", 0.7), ("/r_2/ws_1/step_1000", 0.4), ("/r_2/ws_1/step_4500", 0.4), ("/r_2/step_9000/x", None)]
    df = spark.createDataFrame(rows, "path string, wer double").withColumn("step", step_number("path"))
    assert [r.step for r in df.collect()] == [500, 1000, 4500, None]
    assert best_step(df).first()[0] == "/r_2/ws_1/step_1000"
    assert newest_step(df).first()[0] == "/r_2/ws_1/step_4500"
    assert best_step(df.withColumn("wer", F.lit(None).cast("double"))).first()[0] is None
