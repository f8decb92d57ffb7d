import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(1, 2, 3)):
    """Reshare the excess round by round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return share | capped
        capped |= {s: 3.0 * sizes[s] for s in over}


def corpus(spark):
    rows, k = [], 0
    for s, docs, words in (("a", 300, 5), ("b", 20, 2), ("é", 30, 7), ("Z", 10, 1), (None, 40, 9), ("empty", 3, 0)):
        for i in range(docs):
            rows.append((k, " \n".join(["x y"] * words) or None, s, 1, 0.5))
            k += 1
    rows += [(None, "one", "a", 1, 0.5), (7, "again", "a", 1, 0.5), (7, "again", "a", 1, 0.5)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, copies int, rate double"), rows


def test_targets_and_copies(spark):
    df, rows = corpus(spark)
    sizes = {}
    for _, t, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len(WORDS.findall(t or ""))
    want = brute_targets(sizes)
    out = mixing.mix_copies(df)
    assert set(out.columns) == {*df.columns, "source_size", "target"}
    got = out.collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert r["copies"] in (int(rate + 1e-12), int(rate + 1e-12) + 1) and r["copies"] <= 3
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * len(WORDS.findall(r["text"] or ""))
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.05 * t, 20)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_copies(df.repartition(7)).collect()))
    mixed = mixing.mix(df)
    assert {r["copies"] for r in mixed.collect()} == {1}  # the corpus's own column
    assert mixed.columns == df.columns and mixed.count() == sum(r["copies"] for r in got)


def test_empty_and_wordless(spark):
    df, _ = corpus(spark)
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df.withColumn("text", F.lit(None).cast("string"))).count() == 0
