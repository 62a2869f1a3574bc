"""Hard negatives against a plain scan: ties, copies, awkward rows, pruning."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import headway.llm.negatives as module
from headway.llm.negatives import Scan, best, bond, hard_negatives, number_kind

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, anchor string, row int, id string"
OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, step, k=5, low=80, high=100):
    """Sorted result rows; those of one id and score are interchangeable, so ids stand for rows."""
    used = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        used.append((i, [math.floor(256 * x) for x in v], label))
    last = (1 << 63) - 1
    out = []
    for at, (i, v, label) in enumerate(used):
        if i is None or i % step:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), last if j is None else j, n, c) for n, (j, w, c) in enumerate(used) if n != at]
        scored.sort()
        for s, p, _, _ in [x for x in scored if x[3] == label][:k]:
            fitting = [x for x in scored if x[3] != label and -low * s <= -100 * x[0] <= -high * s][:k]
            out += [(i, None if p == last else p, r + 1, None if x[1] == last else x[1], -s, -x[0]) for r, x in enumerate(fitting)]
    return sorted(out, key=str)


def found(spark, rows, step, **options):
    frame = spark.createDataFrame([(i, v, c, "own", "own", 1, "own") for i, v, c in rows], SCHEMA).repartition(3)
    got = hard_negatives(frame, F.col("vec_id") % step == 0, **options)
    assert got.columns == OUT
    return sorted((tuple(r) for r in got.collect()), key=str)


def vectors(n, seed, width=6, grain=4):
    """Few distinct values, so that ties abound."""
    rng = random.Random(seed)
    return [(i, [rng.randrange(-1, grain) / grain for _ in range(width)], rng.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_scan(spark, seed, monkeypatch):
    rows = vectors(300, seed)
    want = plain(rows, 10)
    assert want and found(spark, rows, 10) == want
    for name, small in {"BLOCK_ROWS": 7, "ANCHOR_ROWS": 4, "CELL_BLOCKS": 2, "STRIDE": 1}.items():
        monkeypatch.setattr(module, name, small)
    assert found(spark, rows, 10) == want


def test_other_counts_and_windows(spark):
    rows = vectors(200, 3)
    assert found(spark, rows, 20, positives=2, negatives=3, low=50, high=120) == [r for r in plain_with(rows, 20, 2, 3, 50, 120)]


def plain_with(rows, step, positives, negatives, low, high):
    whole = plain(rows, step, 200, low, high)
    kept = []
    for a in sorted({r[0] for r in whole}):
        own = next(v for i, v, _ in rows if i == a)
        label = next(c for i, _, c in rows if i == a)
        score = lambda v: sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(own, v))
        first = sorted((-score(v), i) for i, v, c in rows if c == label and i != a)[:positives]
        kept += [r for r in whole if r[0] == a and (-r[4], r[1]) in first and r[2] <= negatives]
    return sorted(kept, key=str)


def test_awkward_rows(spark):
    a = [0.5, 0.25, 0.0]
    rows = [
        (0, a, 1), (0, a, 1), (0, a, 2), (0, [0.5, 0.25], 2), (1, a, 1), (2, a, 2), (2, a, 2), (None, a, 1), (None, a, 2), (3, [0.5, 0.2], 2), (4, None, 1),
        (5, a, None), (6, [0.5, None, 0.1], 2), (7, [float("nan"), 1.0], 2), (8, [float("inf")], 2), (9, [], 2), (10, [], 1), (11, [-0.5, -0.25], 1), (12, [0.48, 0.25, 9.0, 1.0], 2),
        (20, [-0.1, 0.0], 1), (30, [0.0, 0.0, 0.0], 1),
    ]
    assert found(spark, rows, 10) == plain(rows, 10)
    assert found(spark, [], 10) == []
    assert found(spark, [(1, a, 1), (2, a, 2)], 10) == []


def test_no_candidate_is_lost():
    """Whatever the bounds, what stays is exact and what goes was not needed."""
    rng = np.random.default_rng(5)
    for _ in range(50):
        width, n = int(rng.integers(1, 40)), int(rng.integers(1, 200))
        dims = rng.integers(-300, 300, (width, n))
        query = rng.integers(-300, 300, width)
        exact = query @ dims
        edge = int(rng.choice(exact))
        kind = number_kind(width, 300, 300)
        at, score = bond(Scan(dims.astype(kind)), query.astype(kind), np.arange(n), lambda low, high: high >= edge)
        assert (score == exact[at]).all()
        assert set(np.flatnonzero(exact >= edge)) <= set(at.tolist())
        assert (at[best(score, at, 5)] == np.lexsort((np.arange(n), -exact))[:5][: len(at[best(score, at, 5)])]).all()


def test_large_components_stay_exact(spark):
    rows = [(i, [2.0**18 + i, 2.0**18 - 3 * i, 1.0], i % 2) for i in range(40)]
    assert found(spark, rows, 10) == plain(rows, 10)
    with pytest.raises(Exception, match="64 bits"):
        found(spark, [(0, [1e12, 1e12], 1), (1, [1e12, 1e12], 1)], 10)
