import re
import zlib

import numpy as np
import pandas as pd
import pytest

from tidemark.llm import quality_model, quality_rules

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n\t\n"), (4, "a b a b a b a b"), (5, "x x x\nx x x\n\nx x x"), (6, "é ü #*$ | <>\nq"),
       (7, "one two three four " * 20000), (8, "a b c a b"), (9, "\x1cx\x85y z z z z")]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w in set(windows) if windows.count(w) > 1} if len(words) < 5000 else set(windows)
    marked = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked))


def test_base_counts_match_brute_force(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet").head(150)
    rows = [*ODD, *docs[["doc_id", "text"]].assign(doc_id=docs.doc_id + 100).itertuples(index=False, name=None)]
    df = spark.createDataFrame([(int(i), t, "k") for i, t in rows], "doc_id long, text string, kept string")
    out = quality_rules.measure_rules(df, np.zeros(16)).collect()
    texts = dict(rows)
    for r in out:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(texts[r["doc_id"]]), r
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])


def test_ratio_parts_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    counts = quality_rules.train(docs, labels.where("quality = 1").select("doc_id"))
    own = pd.read_parquet(f"{SF}/documents.parquet")
    n = own.text.map(lambda t: max(0, 2 * len(t.encode().split()) - 1)).sum()
    assert counts.groupBy().sum("raw").first()[0] == n
    measured = quality_rules.measure_rules(docs, quality_rules.weights(counts))
    cut = quality_rules.threshold(measured, labels)
    got = quality_rules.apply_rules(measured, cut).select("doc_id", "kept", "base_failed").toPandas().merge(labels.toPandas())
    clean = got[(got.quality == 1) & ~got.base_failed]
    assert clean.kept.mean() > 0.99 and not got[got.quality == 0].kept.mean() > 0.05
    assert quality_rules.threshold(measured, labels.limit(0)) == quality_rules.THRESHOLD
    assert quality_rules.weights(counts.limit(0)).tolist() == [0.0] * quality_rules.BUCKETS


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    model = quality_model.Attention(6)
    x, starts, y = rng.standard_normal((9, 6)), np.array([0, 2, 6]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = model.forward(x, starts)["y"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
    grads = model.gradients(x, starts, y)
    for name, g in grads.items():
        at = tuple(rng.integers(0, s) for s in g.shape)
        keep, eps = model.p[name][at], 1e-6
        model.p[name][at] = keep + eps
        up = loss()
        model.p[name][at] = keep - eps
        down = loss()
        model.p[name][at] = keep
        assert g[at] == pytest.approx((up - down) / (2 * eps), rel=1e-4, abs=1e-8)


def test_held_out_accuracy_and_cases(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    held = labels.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    model = quality_model.train(docs, spark.createDataFrame(labels[~held]))
    got = quality_model.score(docs, model).toPandas().merge(labels[held])
    assert (got.predicted == got.quality).mean() > 0.95 and got.score.between(0, 1).all()
    odd = spark.createDataFrame([(i, t, 3) for i, t in ODD], "doc_id long, text string, predicted int")
    out = quality_model.score(odd, model).collect()
    assert len(out) == len(ODD) and all(0 <= r["score"] <= 1 for r in out)
    assert quality_model.train(docs, spark.createDataFrame(labels[labels.quality == 1])) is None
    assert {r["score"] for r in quality_model.score(odd, None).collect()} == {0.5}


def brute_bag(text):
    """The features of each passage, word by word."""
    import xxhash
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    out, width = [], quality_model.CLASSES + 9 + quality_model.BUCKETS
    if not words:
        return [[0.0] * width]

    def kind(b):
        c = chr(b)
        return 6 if b > 127 else 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c in ".,;:" else 4 if c in "#*$%&|<>" else 5

    for at in range(0, len(words), 64):
        own = words[at:at + 64]
        kinds = [[sum(kind(b) == k for b in w) for k in range(7)] for w in own]
        total = sum(map(len, own))
        row = [sum(k[i] for k in kinds) / total for i in range(7)]
        before = [words[at + i - 1] if at + i else None for i in range(len(own))]
        row += [sum(a == b for a, b in zip(own, before)) / len(own), sum(k[1] >= 2 and not k[0] for k in kinds) / len(own),
                sum(not (k[0] + k[1] + k[2] + k[6]) for k in kinds) / len(own), sum(k[4] > 0 for k in kinds) / len(own),
                (len(own) - len(set(own))) / len(own), min(total / len(own), 30) / 10, len(own) / 64,
                min(1, text.count("\n") / len(words)), min(1, len(words) / 1000)]
        bag = [0.0] * 32
        for w in own:
            h = xxhash.xxh64_intdigest(w)
            bag[h % 32] += 1 if h >> 40 & 1 else -1
        out.append(row + [x / len(own) ** 0.5 / 4 for x in bag])
    return out


def brute_score(bag, model):
    import math
    p = {k: v.tolist() for k, v in model.p.items()}
    hs, es = [], []
    for row in bag:
        x = [(v - m) / s for v, m, s in zip(row, model.mean.tolist(), model.scale.tolist())]
        h = [math.tanh(sum(v * w[j] for v, w in zip(x, p["W"])) + b) for j, b in enumerate(p["b"])]
        gate = [math.tanh(sum(v * w[j] for v, w in zip(h, p["V"]))) / (1 + math.exp(-sum(v * w[j] for v, w in zip(h, p["U"]))))
                for j in range(len(p["w"]))]
        hs.append(h)
        es.append(sum(g * w for g, w in zip(gate, p["w"])))
    weight = [math.exp(e - max(es)) for e in es]
    z = [sum(a * h[j] for a, h in zip(weight, hs)) / sum(weight) for j in range(len(p["c"]))]
    return 1 / (1 + math.exp(-sum(a * b for a, b in zip(z, p["c"])) - p["d"][0]))


def test_scores_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(60)
    labels = spark.createDataFrame([(r["doc_id"], i % 2) for i, r in enumerate(docs.collect())], "doc_id long, quality int")
    model = quality_model.train(docs, labels)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(-i, t) for i, t in ODD if i != 9] + [(-99, "A b\n" * 3000)]
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in quality_model.score(
        spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for i, text in rows:
        bag = brute_bag(text)
        assert np.allclose(quality_model.encode(text, quality_model.classes(), {}), bag, atol=2e-5), i
        if len(bag) < 200:
            want = brute_score(bag, model)
            assert abs(got[i][0] - want) < 1e-3 and got[i][1] == (got[i][0] >= 0.3), i


def test_training_takes_every_passage(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_model.Attention, "fit", lambda self, bags, labels: seen.extend(zip(map(len, bags), labels)) or self)
    rows = [(1, "w " * 64 * 300), (2, "w " * 65), (2, "w"), (3, None), (4, "x " * 40_000), (None, "y"), (5, "unlabelled")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 0), (4, 1), (None, 1), (6, 1)], "doc_id long, quality int")
    quality_model.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert seen == [(300, 1.0), (1, 1.0), (1, 0.0)]


def test_kept_matches_brute_force(spark):
    import math
    import xxhash
    own = pd.read_parquet(f"{SF}/documents.parquet").head(200)[["doc_id", "text"]]
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    mask = 2**64 - 1

    def grams(text):
        ids = [xxhash.xxh64_intdigest(w) for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
        pairs = [(a * 0x9E3779B97F4A7C15 + b) & mask for a, b in zip(ids, ids[1:])]
        return [(x >> 33) % 16384 for x in ids + [(p ^ (p >> 29)) * 0xBF58476D1CE4E5B9 & mask for p in pairs]]

    trusted = set(labels[labels.quality == 1].doc_id)
    raw, target = [1] * 16384, [1] * 16384
    for i, t in own.itertuples(index=False):
        for g in grams(t):
            raw[g] += 1
            target[g] += i in trusted
    ratio = [math.log(t / sum(target)) - math.log(r / sum(raw)) for t, r in zip(target, raw)]
    llr = {i: (sum(ratio[g] for g in grams(t)) / len(grams(t)) if grams(t) else 0.0) for i, t in own.itertuples(index=False)}
    fails = {}
    for i, t in own.itertuples(index=False):
        n, _, _, _, repeat = brute(t)
        fails[i] = n < 50 or 100 * repeat > 50 * n
    known = {i: q for i, q in zip(labels.doc_id, labels.quality) if i in llr and not fails[i]}
    docs, marks = spark.createDataFrame(own), spark.createDataFrame(labels)
    measured = quality_rules.measure_rules(docs, quality_rules.weights(quality_rules.train(docs, marks.where("quality = 1").select("doc_id"))))
    cut = quality_rules.threshold(measured, marks)

    def gain(x):
        kinds = [[llr[i] for i in known if known[i] == q] for q in (0, 1)]
        return sum(v < x for v in kinds[0]) / len(kinds[0]) + sum(v >= x for v in kinds[1]) / len(kinds[1])

    # no step parts the labels better
    assert gain(cut) >= max(gain(k * quality_rules.STEP) for k in range(-800, 801)) - 1e-9
    got = {r["doc_id"]: (r["llr"], r["kept"]) for r in quality_rules.apply_rules(measured, cut).collect()}
    for i in llr:
        assert abs(got[i][0] - llr[i]) < 1e-9 and (abs(llr[i] - cut) < 1e-9 or got[i][1] == (not fails[i] and llr[i] >= cut)), i
