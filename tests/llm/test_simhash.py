import itertools
import random

import numpy as np
import xxhash

from tidemark.llm import simhash


def brute_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    sh = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_classes(rows):
    fps = [(i, brute_print(t)) for i, t in rows]
    comp = {i: i for i, _ in fps}
    moved = True
    while moved:
        moved = False
        for (i, a), (j, b) in itertools.combinations(fps, 2):
            if (a ^ b).bit_count() <= 3 and comp[i] != comp[j]:
                comp[i] = comp[j] = min(comp[i], comp[j])
                moved = True
    return {i: (f, comp[i]) for i, f in fps}


def docs():
    rnd = random.Random(3)
    rows = []
    for g in range(25):
        words = ["".join(rnd.choices("abcdefgÉß", k=rnd.randint(1, 6))) for _ in range(rnd.choice([1, 2, 3, 200]))]
        for _ in range(rnd.randint(1, 5)):
            w = list(words)
            if len(w) > 100:
                w[rnd.randrange(len(w))] = "changed"
            rows.append((len(rows) + 1, rnd.choice([" ", "\n", "\t "]).join(w)))
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one"), (905, "x y z " * 30000)]


def test_matches_brute_force(spark):
    rows = docs()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, fp int, component string")
    want = brute_classes(rows)
    got = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.near_duplicates(df).collect()}
    assert got == want
    kept = simhash.keep_one(df.unionAll(df))
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in want.values()})


def test_blocks_of_a_large_tile_and_empty(spark):
    rnd = np.random.default_rng(1)
    base = int(rnd.integers(1 << 62))
    fps = {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rnd.integers(0, 60, (40, 2))} | {int(x) for x in rnd.integers(0, 1 << 62, 300)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = simhash.links(df, 3, block=7).collect()
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for e in edges:
        assert (e["a"] ^ e["b"]).bit_length() >= 1
        parent[root(e["a"])] = root(e["b"])
    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= 3:
            assert root(a) == root(b)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    nulls = spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string")
    assert {r["component_id"] for r in simhash.near_duplicates(nulls).collect()} == {None}
    assert simhash.keep_one(nulls).count() == 1
