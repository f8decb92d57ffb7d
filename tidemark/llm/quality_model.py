"""Quality classifier: attention-based multiple-instance learning over passages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, settle

#: Words of a passage.
PASSAGE = 64
#: Hash buckets of the words of a passage.
BUCKETS = 32
#: Labelled documents that the model is fitted on, with all their passages, and the length up to
#: which a document is taken for that; scoring reads every document.
SAMPLE = 4000
SAMPLE_CHARS = 50_000
HIDDEN, GATE, EPOCHS, BATCH = 24, 16, 25, 128
CACHE = 500_000
SYMBOLS = b"#*$%&|<>"
CLASSES = 7


def classes() -> np.ndarray:
    """Class of every byte: lower, upper, digit, sentence mark, symbol, other mark, beyond ASCII."""
    table = np.full(256, 6, np.int8)
    for b in range(128):
        c = chr(b)
        table[b] = 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c in ".,;:" else 5
    table[list(SYMBOLS)] = 4
    return table


def encode(text: str | None, kinds: np.ndarray, cache: dict) -> np.ndarray:
    """One row of features per passage of the whole text (no word: one row of 0)."""
    import xxhash
    words = text.encode("utf-8", "replace").split() if text else []
    if not words:
        return np.zeros((1, CLASSES + 9 + BUCKETS), np.float32)
    if len(cache) > CACHE:
        cache.clear()
    ids = []
    for w in words:
        h = cache.get(w)
        if h is None:
            h = cache[w] = xxhash.xxh64_intdigest(w)
        ids.append(h)
    ids = np.array(ids, np.uint64)
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    kind = kinds[np.frombuffer(b"".join(words), np.uint8)]
    starts = np.cumsum(sizes) - sizes
    passage = np.arange(0, n, PASSAGE)
    count = np.diff(np.append(passage, n)).astype(np.float32)
    of_word = np.stack([np.add.reduceat((kind == k).astype(np.int32), starts) for k in range(CLASSES)], 1)
    chars = np.add.reduceat(of_word, passage, axis=0).astype(np.float32)
    total = chars.sum(1, keepdims=True)
    same = np.zeros(n, np.float32)
    same[1:] = ids[1:] == ids[:-1]
    caps = (of_word[:, 1] >= 2) & (of_word[:, 0] == 0)
    bare = of_word[:, [0, 1, 2, 6]].sum(1) == 0
    marked = of_word[:, 4] > 0
    rows = len(passage)
    filled = np.empty(rows * PASSAGE, np.uint64)
    filled[:n] = ids
    filled[n:] = np.arange(rows * PASSAGE - n)  # no word's hash, in effect
    ordered = np.sort(filled.reshape(rows, PASSAGE), axis=1)
    twice = (ordered[:, 1:] == ordered[:, :-1]).sum(1)
    per = [np.add.reduceat(x.astype(np.float32), passage) / count for x in (same, caps, bare, marked)]
    length = np.add.reduceat(sizes.astype(np.float32), passage) / count
    bag = np.zeros((rows, BUCKETS), np.float32)
    sign = np.where(ids >> np.uint64(40) & np.uint64(1), 1, -1).astype(np.float32)
    np.add.at(bag, (np.arange(n) // PASSAGE, (ids % np.uint64(BUCKETS)).astype(np.int64)), sign)
    lines = np.float32(min(1.0, text.count("\n") / n))
    return np.concatenate([chars / total, np.stack([*per, twice / count, np.minimum(length, 30) / 10, count / PASSAGE,
                                                    np.full(rows, lines), np.minimum(1, np.full(rows, n) / 1000)], 1),
                           bag / np.sqrt(count)[:, None] / 4], 1).astype(np.float32)


class Attention:
    """Gated attention over the passages of a bag, in numpy.

    h = tanh(x W + b); the weight of a passage is the softmax over its bag of
    (tanh(h V) * sigmoid(h U)) w; the score is sigmoid(sum of weight * h, c) + d.
    """

    def __init__(self, width: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        of = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float64)
        self.p = {"W": of(width, HIDDEN), "b": np.zeros(HIDDEN), "V": of(HIDDEN, GATE), "U": of(HIDDEN, GATE),
                  "w": of(GATE), "c": of(HIDDEN), "d": np.zeros(1)}
        self.mean, self.scale = np.zeros(width), np.ones(width)

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict:
        p = self.p
        bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -50, 50)))
        return {"x": x, "bag": bag, "h": h, "t": t, "g": g, "a": a, "z": z, "y": y}

    def gradients(self, x: np.ndarray, starts: np.ndarray, label: np.ndarray) -> dict:
        p, f = self.p, self.forward(x, starts)
        dy = (f["y"] - label) / len(label)
        dz = dy[:, None] * p["c"]
        dzb = dz[f["bag"]]
        da = (dzb * f["h"]).sum(1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, starts)[f["bag"]])
        dt, dg = de[:, None] * p["w"] * f["g"], de[:, None] * p["w"] * f["t"]
        dt, dg = dt * (1 - f["t"] ** 2), dg * f["g"] * (1 - f["g"])
        dh = (f["a"][:, None] * dzb + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
        return {"W": f["x"].T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
                "w": ((f["t"] * f["g"]) * de[:, None]).sum(0), "c": f["z"].T @ dy, "d": dy.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01) -> Attention:
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(0).astype(np.float64), every.std(0).astype(np.float64) + 0.02
        rng, step = np.random.default_rng(11), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), BATCH):
                take = order[at:at + BATCH]
                sizes = np.array([len(bags[i]) for i in take])
                grads = self.gradients(np.concatenate([bags[i] for i in take]), np.cumsum(sizes) - sizes, labels[take])
                step += 1
                for k, g in grads.items():
                    g = g + 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def score(self, bag: np.ndarray) -> float:
        return float(self.forward(bag, np.zeros(1, np.int64))["y"][0])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample: int = SAMPLE) -> Attention | None:
    """A model fitted on every passage of at most ``sample`` labelled documents, by
    hash of the id, among those of at most ``SAMPLE_CHARS`` characters.

    ``labels`` has ``doc_id`` and ``quality`` (0 or 1; other rows say nothing).
    Of labels or documents that share an id the larger label and the smallest text count.
    Without labelled documents of either kind there is no model.
    """
    marks = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("y"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    short = docs.where(F.col(id_col).isNotNull() & (F.length(text) <= SAMPLE_CHARS))
    # ids only, until the sample is known
    ids = marks.join(short.select(F.col(id_col).alias("l")).distinct(), marks["doc_id"] == F.col("l")).select("l", "y")
    chosen = settle(ids.orderBy(F.xxhash64("l"), "l").limit(sample))
    rows = short.select(F.col(id_col).alias("d"), text.alias("text")).join(F.broadcast(chosen), F.col("d") == F.col("l"))
    rows = rows.groupBy("l", "y").agg(F.min("text").alias("text"))

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds, cache = classes(), {}
        for batch in batches:
            yield pd.DataFrame({"l": batch["l"], "y": batch["y"], "bag": [encode(t, kinds, cache).tobytes() for t in batch["text"]]})

    found = sorted(rows.mapInPandas(bags, "l long, y int, bag binary").collect(), key=lambda r: r["l"])
    label = np.array([r["y"] for r in found], np.float64)
    if not len(label) or label.min() == label.max():
        return None
    width = CLASSES + 9 + BUCKETS
    return Attention(width).fit([np.frombuffer(r["bag"], np.float32).reshape(-1, width) for r in found], label)


def score(docs: DataFrame, model: Attention | None, text_col: str = "text", cut: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: better) and ``predicted`` (1 from ``cut``).

    Defined cases: null or empty text is a bag of one empty passage; every
    passage of very long texts counts; repeated rows agree; without a model the
    score is 0.5; extra columns are kept, one called ``score`` or ``predicted`` is replaced.
    """
    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kinds, cache = classes(), {}
        for texts in batches:
            yield pd.Series([0.5 if model is None else model.score(encode(t, kinds, cache)) for t in texts], dtype="float64")

    found, = fresh(docs, "found")
    kept = [F.col(c) for c in docs.columns if c.lower() not in ("score", "predicted")]
    return docs.withColumn(found, rate(F.col(text_col))).select(
        *kept, F.col(found).alias("score"), (F.col(found) >= cut).cast("int").alias("predicted"))
