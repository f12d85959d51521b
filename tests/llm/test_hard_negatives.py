"""Hard negatives against brute force over all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import hard_negatives
from starloom.llm.hard_negatives import Anchors, Bucket, mine

SCHEMA = "vec_id long, embedding array<float>, label int, id string, whole string, score string, rank int, anchor int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], label, "a", "b", "c", 1, 2) for i, v, label in rows], SCHEMA)


def brute(rows, step, k=5, low=80, high=100, of=100):
    usable = [(i, [math.floor(256 * float(np.float32(c))) for c in v], label) for i, v, label in rows
              if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    anchors = {(i, tuple(v), label) for i, v, label in usable if i % step == 0}
    for a, x, label in anchors:
        scored = sorted((-sum(p * q for p, q in zip(x, v, strict=True)), i, other == label) for i, v, other in usable if i != a)
        for s, p in sorted({(s, i) for s, i, _ in [r for r in scored if r[2]][:k]}):
            fits = [(i, n) for n, i, same in scored if not same and low * -s <= of * -n <= high * -s][:k]
            out += [(a, p, rank, i, -s, -n) for rank, (i, n) in enumerate(fits, 1)]
    return sorted(out)


def clustered(n, d, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] * rng.choice([0.1, 0.5, 1, 3]) + rng.normal(size=d) * rng.choice([0.01, 0.3])
        rows.append((i, v.tolist(), int(rng.integers(4))))
    return rows


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKET", 64)
    monkeypatch.setattr(hard_negatives, "ROWS_AT_ONCE", 300)
    monkeypatch.setattr(hard_negatives, "TOGETHER", 7)
    rows = clustered(1500, 12, 1)
    same = rows[20][1]
    rows += [(5000 + i, same, 1 if i % 3 else 2) for i in range(400)]  # a hot group of copies, with ties
    rows += [(7000, [0.0] * 12, 1), (7001, [0.0] * 12, 1), (7002, [0.0] * 12, 2), (7050, [-c for c in same], 9)]
    rows += [(None, same, 1), (8000, None, 1), (8050, same, None), (8100, [None] * 12, 1), (8150, [float("nan")] * 12, 1), (8200, [float("inf")] * 12, 1)]
    got = mine(table(spark, rows).repartition(6), F.col("vec_id") % 50 == 0, at_once=16)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 50)


def test_repeated_rows_count_each(spark):
    rows = clustered(60, 6, 3) + clustered(60, 6, 3)[:20]
    got = sorted(tuple(r) for r in mine(table(spark, rows).repartition(3), F.col("vec_id") % 10 == 0).collect())
    assert got == brute(rows, 10)


def test_empty_tables_single_rows_and_unequal_lengths(spark):
    assert mine(table(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert mine(table(spark, [(1, [1.0], 1)]), F.col("vec_id") % 10 == 0).count() == 0
    assert mine(table(spark, [(0, [1.0], 1)]), F.col("vec_id") % 10 == 0).count() == 0
    with pytest.raises(Exception, match="different lengths"):
        mine(table(spark, [(0, [1.0], 1), (1, [1.0, 2.0], 1)]), F.col("vec_id") % 10 == 0).count()


def test_large_components_stay_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1, 1]) * 2.0**rng.randint(10, 20) + rng.random() for _ in range(4)], i % 2) for i in range(80)]
    assert sorted(tuple(r) for r in mine(table(spark, rows), F.col("vec_id") % 10 == 0).collect()) == brute(rows, 10)


def test_pruning_keeps_all_matches_and_leaves_others_out():
    rng = np.random.default_rng(5)
    whole = np.floor(rng.normal(size=(2000, 8)) * 300).astype(np.int64)
    length = np.sqrt((whole.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-length)
    whole, length = whole[order], length[order]
    bucket = Bucket(np.arange(2000), np.zeros(2000, np.int64), whole, length)
    anchors = Anchors(np.arange(50), ["x"] * 50, whole[::40])
    scores = whole @ anchors.whole.T
    share = []
    for least in (0.9, 0.5, 0.0, -0.5):
        wanted = (least * length.max() * anchors.length).astype(np.int64)
        lo, hi = bucket.ranges(anchors, np.arange(50), wanted)
        for a in range(50):
            found = set(bucket.candidates(anchors.focus[a], lo[a], hi[a]).tolist()) if (hi[a] > lo[a]).all() else set()
            assert set(np.flatnonzero(scores[:, a] >= wanted[a])) <= found
            share.append((least, len(found) / 2000))
    assert np.mean([s for least, s in share if least == 0.9]) < 0.25
    assert np.mean([s for least, s in share if least == 0.9]) < np.mean([s for least, s in share if least == 0.5])
