"""Quality rules: base counts and a hashed n-gram log-likelihood ratio."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, small

#: Hash buckets of the two multinomials.
BUCKETS = 1 << 14
#: Words whose hash a task keeps.
CACHE = 500_000
#: Length-normalised log-likelihood ratio at or above which a document is kept
#: where no labels set the threshold.
THRESHOLD = -0.1
#: Step of the thresholds that are tried.
STEP = 0.005
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"


def word_ids(words: list[bytes], cache: dict) -> np.ndarray:
    """The 64-bit hash of every word."""
    import xxhash
    if len(cache) > CACHE:
        cache.clear()
    out = []
    for w in words:
        h = cache.get(w)
        if h is None:
            h = cache[w] = xxhash.xxh64_intdigest(w)
        out.append(h)
    return np.array(out, np.uint64)


def ngram_buckets(ids: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of all single words and word pairs."""
    mixed = ids[:-1] * np.uint64(0x9E3779B97F4A7C15) + ids[1:]
    mixed ^= mixed >> np.uint64(29)
    both = np.concatenate((ids, mixed * np.uint64(0xBF58476D1CE4E5B9)))
    return ((both >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def train(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``raw``, ``target``: n-gram counts over all documents and over
    those whose id is in ``trusted`` (one column ``doc_id``). At most ``buckets`` rows."""
    mark = trusted.select(F.col("doc_id").alias("t")).where("t is not null").distinct().withColumn("hit", F.lit(True))
    rows = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("text")).where("text is not null")
    rows = rows.join(small(mark), F.col("d") == F.col("t"), "left").select("text", F.col("hit").isNotNull().alias("hit"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, target, cache = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64), {}
        for batch in batches:
            for text, hit in zip(batch["text"], batch["hit"]):
                words = text.encode("utf-8", "replace").split()
                if words:
                    n = np.bincount(ngram_buckets(word_ids(words, cache), buckets), minlength=buckets)
                    raw += n
                    if hit:
                        target += n
        seen = np.flatnonzero(raw)
        yield pd.DataFrame({"bucket": seen, "raw": raw[seen], "target": target[seen]})

    return rows.mapInPandas(count, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def weights(counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log of target over raw probability per bucket, each count plus one."""
    raw, target = np.ones(buckets), np.ones(buckets)
    for r in counts.collect():  # at most ``buckets`` rows
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def measure(text: str | None, ratio: np.ndarray, cache: dict) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the mean
    log-likelihood ratio of the n-grams (0 without words) of a whole text."""
    text = text or ""
    words = text.encode("utf-8", "replace").split()
    if not words:
        return 0, 0, sum(map(text.count, SYMBOLS)), 0, 0, 0.0
    ids = word_ids(words, cache)
    lines, seen, dup = [x for x in text.split("\n") if x.strip(WHITE)], set(), 0
    seen.update(lines)
    dup = len(lines) - len(seen)
    repeat = 0
    if len(words) > 3:
        _, own = np.unique(ids, return_inverse=True)
        own = own.astype(np.int64)
        if len(words) < 2_000_000:
            window = (own[:-2] << 42) | (own[1:-1] << 21) | own[2:]
        else:
            _, pair = np.unique((own[:-1] << 32) | own[1:], return_inverse=True)
            window = (pair[:-1].astype(np.int64) << 32) | own[2:]
        order = np.argsort(window, kind="stable")
        same = window[order][1:] == window[order][:-1]
        often = np.zeros(len(window) + 2, bool)
        first = np.zeros(len(window), bool)
        first[order[1:][same]] = True
        first[order[:-1][same]] = True
        for k in range(3):
            often[k:k + len(window)] |= first
        repeat = int(often.sum())
    llr = float(ratio[ngram_buckets(ids, len(ratio))].mean())
    return (len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), dup, repeat, llr)


def measure_rules(docs: DataFrame, ratio: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``llr`` (mean log-likelihood ratio) and ``base_failed``:
    under 50 words, or over half of the words in repeated 3-word windows.

    Defined cases: null or empty text counts 0 and fails; very long texts are
    measured whole; repeated rows agree; extra columns are kept, those with the
    names above are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr"]
    kind = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, llr double"

    @F.pandas_udf(kind)
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache: dict = {}
        for texts in batches:
            yield pd.DataFrame([measure(t, ratio, cache) for t in texts], columns=names)

    found, = fresh(docs, "found")
    kept = [F.col(c) for c in docs.columns if c.lower() not in (*names, "base_failed")]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (docs.withColumn(found, rate(F.col(text_col))).select(*kept, F.col(f"{found}.*"))
            .withColumn("base_failed", failed))


def threshold(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> float:
    """The log-likelihood ratio that best parts all labelled documents that pass
    the base counts: share of ``quality`` 1 at or above it plus share of 0 below
    it, in the middle of the best steps. ``THRESHOLD`` if a label is missing."""
    own = measured.where(~F.col("base_failed")).select(F.col(id_col).alias("m"), "llr")
    marks = labels.select(F.col("doc_id").alias("l"), "quality").where("quality in (0, 1)")
    step = F.greatest(F.lit(-4000), F.least(F.lit(4000), F.floor(F.col("llr") / STEP))).cast("int")
    seen = own.join(marks, F.col("m") == F.col("l")).groupBy(step.alias("step"), "quality").count().collect()
    n = np.zeros((2, 8003))  # the steps are a fixed range
    for r in seen:
        n[r["quality"], r["step"] + 4001] += r["count"]
    if not n.sum(axis=1).all():
        return THRESHOLD
    n /= n.sum(axis=1, keepdims=True)
    gain = np.cumsum(n[0]) - n[0] - (np.cumsum(n[1]) - n[1])
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    run = best[:np.flatnonzero(np.diff(np.append(best, best[-1] + 9)) > 1)[0] + 1]
    return float((run[0] + run[-1]) / 2 - 4001) * STEP


def apply_rules(measured: DataFrame, cut: float = THRESHOLD) -> DataFrame:
    """``measured`` with ``kept``: the base counts hold and ``llr`` is at or above ``cut``."""
    return measured.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= cut))
