import math

import numpy as np
import pytest

from tidemark.llm import embeddings


def brute(rows, least=0.93):
    def fine(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ok = [fine(v, label) for _, v, label in rows]
    links = {k: set() for k in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if ok[i] and ok[j] and la == lb and len(a) == len(b):
                a, b = np.array(a, float), np.array(b, float)
                if (a * b).sum() / math.sqrt((a * a).sum()) / math.sqrt((b * b).sum()) >= least:
                    links[i].add(j)
                    links[j].add(i)
    comp = {}
    for i in links:
        todo, seen = [i], {i}
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        comp[i] = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
    return sorted(((rows[i][0] if rows[i][0] is not None else -1), len(links[i]),
                   comp[i] if comp[i] is not None else -1, rows[i][0] is not None and rows[i][0] == comp[i]) for i in links)


def sample():
    rng = np.random.default_rng(4)
    rows = []
    for g in range(40):
        centre = rng.standard_normal(8)
        for _ in range(int(rng.integers(1, 9))):
            v = centre + 0.25 * rng.standard_normal(8)
            rows.append((len(rows), v.astype(np.float32).tolist(), int(g % 3)))
    big = rng.standard_normal(8)
    rows += [(1000 + i, (big + 0.05 * rng.standard_normal(8)).astype(np.float32).tolist(), 1) for i in range(150)]
    rows += [(2000 + i, rows[5][1], rows[5][2]) for i in range(4)] + [rows[7], rows[7]]
    rows += [(3000, None, 1), (3001, [0.0] * 8, 1), (3002, [1.0, None] + [0.0] * 6, 1), (3003, [float("nan")] * 8, 1),
             (3004, [float("inf")] + [1.0] * 7, 1), (3005, rows[0][1], None), (3006, [], 1), (3007, [1.0, 2.0], 1),
             (3008, [2.0, 4.0], 1), (None, rows[0][1], 0), (3009, [1e-30] * 8, 2), (3010, [1e30] * 8, 2)]
    return rows


@pytest.mark.parametrize("shard", [8192, 40])
def test_matches_brute_force(spark, shard):
    rows = sample()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "vec_id long, embedding array<float>, label int, links int, class string")
    out = embeddings.near_vectors(df, shard=shard)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["n_links"],
                  -1 if r["component_id"] is None else r["component_id"], r["kept"]) for r in out.collect())
    want = brute(rows)
    assert len(got) == len(want)
    assert sum(g != w for g, w in zip(got, want)) <= len(want) // 100


def test_recall_of_the_graph():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((60, 16))
    raw = np.repeat(centres, 25, 0) + 0.3 * rng.standard_normal((1500, 16))
    graph = embeddings.Graph(embeddings.unit_rows(raw))
    for n in range(len(raw)):
        graph.add(n)
    truth = graph.unit @ graph.unit.T >= 0.9
    width = graph.audited_beam(graph.unit, 0.9)
    hit = sum(truth[i, graph.linked(q, 0.9, width)].sum() for i, q in enumerate(graph.unit))
    assert hit / truth.sum() > 0.99


def test_empty_and_keep_one(spark):
    df = spark.createDataFrame(sample()[:40], "vec_id long, embedding array<float>, label int")
    assert embeddings.near_vectors(df.limit(0)).count() == 0
    kept = embeddings.keep_one(df)
    assert kept.columns == df.columns and kept.count() == embeddings.near_vectors(df).where("kept").count()


@pytest.mark.parametrize("shard", [8192, 40])
def test_small_tables_are_exact(spark, shard):
    rows = sample()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["n_links"],
                  -1 if r["component_id"] is None else r["component_id"], r["kept"])
                 for r in embeddings.near_vectors(df, shard=shard).collect())
    assert got == brute(rows)


def test_audit_sees_missed_neighbours_outside_a_large_group():
    rng = np.random.default_rng(7)
    group = rng.standard_normal(16) + 0.02 * rng.standard_normal((1500, 16))
    others = rng.standard_normal((300, 16))
    graph = embeddings.Graph(embeddings.unit_rows(np.concatenate((group, others))))
    for n in range(1800):
        graph.add(n)
    for node in range(1500, 1800, 3):  # a third of the others is cut off
        for links in graph.links:
            links[0] = [m for m in links[0] if m != node]
    graph.entry = 0
    queries = embeddings.unit_rows(np.concatenate((group, others + 0.01 * rng.standard_normal((300, 16)))))
    width = graph.audited_beam(queries, 0.93)
    truth = graph.unit @ queries.T >= 0.93
    assert all(set(np.flatnonzero(truth[:, i])) <= set(graph.linked(queries[i], 0.93, width)) for i in range(1500, 1800))


def test_audit_counts_neighbours_that_are_not_links():
    rng = np.random.default_rng(8)
    graph = embeddings.Graph(embeddings.unit_rows(rng.standard_normal((600, 16))))
    for n in range(600):
        graph.add(n)
    graph.links = [[[] for _ in node] for node in graph.links]  # nothing can be found
    assert graph.audited_beam(graph.unit, 0.999, own=True) == 600


def test_vectors_of_extreme_length(spark):
    base = np.array([3.0, -1.0, 0.5, 0.0])
    other = np.array([-1.0, 2.0, 2.0, 1e-9])
    rows = [(i, (k * base).tolist(), 1) for i, k in enumerate([1e-200, 2e-200, 1e200, 2e200, 1.0, 5e-324, 5.9e307])]
    rows += [(10 + i, (k * other).tolist(), 1) for i, k in enumerate([1e-160, 1e160, 1.0])] + [(20, (-base).tolist(), 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    # the smallest numbers have few bits: 5e-324 times the base is (3, -1, 0 or 1, 0) of them
    assert all(got[i] == (6, 0) for i in range(7)) and all(got[i] == (2, 10) for i in (10, 11, 12)) and got[20] == (0, 20)
