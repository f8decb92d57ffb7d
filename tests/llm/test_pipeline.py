import corpus_pipeline
from tidemark.llm import packing, simhash

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", "x", 0), (9002, "12 34", "en", "x", 5)], docs.schema)
    now, kept = docs.unionByName(extra), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, SF).collect(), docs.schema)
        assert now.columns == docs.columns
        kept[name] = now
    ids = {n: [r["doc_id"] for r in d.collect()] for n, d in kept.items()}
    assert sorted(ids["language"]) == sorted(r["doc_id"] for r in docs.collect())
    assert sorted(ids["lines"]) == sorted(ids["language"])
    rows = kept["lines"].select("doc_id", "text").collect()
    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in rows}
    left = sorted(ids["near duplicates"])
    assert all((prints[a] ^ prints[b]).bit_count() > 3 for a in left for b in left if a < b)
    assert all(any((prints[a] ^ prints[b]).bit_count() <= 3 for b in prints if b < a) for a in prints if a not in left)
    assert set(ids["mixing"]) <= set(left) and max(map(ids["mixing"].count, left)) <= 3
    out = corpus_pipeline.STAGES[-1][1](spark, kept["mixing"], SF).collect()
    assert sorted(r["doc_id"] for r in out if r["piece"] == 0) == sorted(ids["mixing"])
    fill = {}
    for r in out:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= packing.CAPACITY


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"] and out.count() > 100
