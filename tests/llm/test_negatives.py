import math
import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<double>, label int, key int, dim int, block string, wanted string"


def component(v):
    return math.floor(256 * v) if abs(256 * v) < math.inf else 256 * int(v)


def brute(rows):
    part = [(i, (label + 1) % 10 if i % 7 == 0 else label, [component(x) for x in v]) for i, v, label in rows
            if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, label, c in part:
        if i % 100:
            continue
        scored = sorted((-min(max(sum(x * y for x, y in zip(c, d)), -2**63), 2**63 - 1), j, other != label)
                        for j, other, d in part if j != i and len(d) == len(c))
        for s, j, _ in [x for x in scored if not x[2]][:5]:
            hard = [x for x in scored if x[2] and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k, _) in enumerate(hard, 1)]
    return sorted(out)


def run(spark, monkeypatch, rows):
    monkeypatch.setattr(queries, "table", lambda *a: spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], SCHEMA))
    return sorted(map(tuple, queries.op11_negatives(spark, "").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def vectors(n, dim, seed, near=0.4):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(6, dim))
    return [(i * 5, (centres[i % 6] + near * rnd.normal(size=dim)).round(3).tolist(), int(rnd.integers(0, 4))) for i in range(n)]


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 90)
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    rows = vectors(400, 24, 1) + [(100_000 + i, v, label) for i, v, label in vectors(60, 5, 2)]
    # a third of the rows are one vector; ties go by id; another row of an anchor's id
    rows += [(200_000 + i, rows[0][1], i % 3) for i in range(200)] + [(300, rows[7][1], 2)]
    rows += [(None, rows[0][1], 1), (400_000, None, 1), (400_100, rows[0][1], None), (400_200, [None] * 24, 1),
             (400_300, [math.nan] * 24, 1), (400_400, [math.inf] * 24, 1), (400_500, [0.0] * 24, 2), (400_600, [], 1), (400_601, [], 1), (400_602, [], 2)]
    got = run(spark, monkeypatch, rows)
    assert got == brute(rows) and len(got) > 200


def test_extreme_lengths(spark, monkeypatch):
    rnd = random.Random(4)
    scales = [1e-300, 1e-3, 1.0, 1e6, 1e9, 1e160, 1.7e308]
    rows = [(i * 50, [rnd.uniform(-1, 1) * rnd.choice(scales) for _ in range(6)], rnd.randint(0, 2)) for i in range(80)]
    assert run(spark, monkeypatch, rows) == brute(rows)
    large = [(i * 50, [round(rnd.uniform(-1, 1), 6) * 1e12 for _ in range(20)], rnd.randint(0, 2)) for i in range(60)]
    assert run(spark, monkeypatch, large) == brute(large)


def test_no_rows(spark, monkeypatch):
    assert run(spark, monkeypatch, []) == []
    assert run(spark, monkeypatch, [(0, [1.0, 2.0], 1)]) == []


def test_bounds_hold_and_spare_scores():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(300, 40)).cumsum(axis=1)

    def block(v):
        return negatives.Block({"labels": [0] * len(v), "ids": range(len(v)), "dim": v.shape[1], "raw": v.tobytes(), "summary": negatives.summary(v)})

    scores = negatives.Scores(block(x[:20]), block(x))
    exact = scores.a.c @ scores.b.c.T
    wide = None
    for level in range(len(negatives.SEGMENTS)):
        low, high = scores.bounds(level, np.ones(exact.shape, bool))
        assert (low <= exact).all() and (exact <= high).all()
        assert wide is None or (high - low).sum() < wide
        wide = (high - low).sum()
        # the same for a few pairs
        few = np.arange(exact.size).reshape(exact.shape) % 97 == 0
        alone = negatives.Scores(scores.a, scores.b).bounds(level, few)
        assert np.allclose(alone[0][few], low[few]) and np.allclose(alone[1][few], high[few])
    i, j, s = negatives.best(scores, np.ones(exact.shape, bool), 5)
    assert len(i) < exact.size / 4
    top = negatives.first(i, j, s, scores.b.ids, 5)
    want = [sorted(range(300), key=lambda q: (-exact[p, q], q))[:5] for p in range(20)]
    assert [j[top][i[top] == p].tolist() for p in range(20)] == want
