"""Hard-negative mining: segment summaries bound the scores, only what they leave open is scored."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import light, settle, stored

#: Segments of a vector, coarse to fine: each has its mean and deviation stored.
SEGMENTS = (4, 16)
#: Rows and anchors of a block; numbers multiplied at once.
ROWS, ANCHORS, AT_ONCE = 4096, 256, 1 << 22
#: Share of the pairs (one in so many) from which all of them are multiplied at once.
MANY = 16
#: Share of the vectors' lengths by which single-precision summaries may be off.
SLACK = 1e-4
LOWEST, HIGHEST = -2**63, 2**63 - 1


def components(x: np.ndarray) -> np.ndarray:
    """floor(256 * x): exact in double precision, but for what overflows (then Python numbers)."""
    with np.errstate(over="ignore"):
        c = np.floor(256 * x)
    if np.isfinite(c).all():
        return c
    return np.vectorize(lambda v: math.floor(256 * v) if abs(v) < 2.0**900 else 256 * int(v), otypes=[object])(x)


def bounds_at(dim: int, segments: int) -> np.ndarray:
    """First places of the segments, as even as can be."""
    return np.linspace(0, dim, min(segments, dim) + 1).astype(int)[:-1]


def summary(x: np.ndarray) -> bytes:
    """Of the vectors' components, for each level means and deviations of every segment, times the root of its length (so
    that products add up to scores), and last the length: single precision, row by row."""
    dim = x.shape[1]
    with np.errstate(over="ignore", invalid="ignore"):
        c = np.floor(256 * x)
        parts = []
        for segments in SEGMENTS:
            at = bounds_at(dim, segments)
            n = np.diff(np.append(at, dim))
            mean = np.add.reduceat(c, at, axis=1) / n
            spread = np.add.reduceat((c - np.repeat(mean, n, axis=1)) ** 2, at, axis=1)
            parts += [mean * np.sqrt(n), np.sqrt(spread)]
        parts.append(np.linalg.norm(c, axis=1)[:, None])
        return np.concatenate(parts, axis=1).astype(np.float32).tobytes()


class Block:
    """Vectors of a block with their stored summaries."""

    def __init__(self, row):
        self.n, self.dim = len(row["labels"]), int(row["dim"])
        self.ids, self.labels = np.asarray(row["ids"], np.int64), np.asarray(row["labels"], np.int64)
        self.c = components(np.frombuffer(row["raw"], np.float64).reshape(self.n, self.dim))
        self.levels = []
        if self.dim:
            held = np.frombuffer(row["summary"], np.float32).reshape(self.n, -1).astype(float)
            at = 0
            for segments in SEGMENTS:
                s = len(bounds_at(self.dim, segments))
                self.levels.append((held[:, at:at + s], held[:, at + s:at + 2 * s]))
                at += 2 * s
            self.length = held[:, -1]


def products(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the rows ``i`` of ``x`` and ``j`` of ``y``."""
    step = max(1, AT_ONCE // max(1, x.shape[1]))
    return np.concatenate([np.einsum("ij,ij->i", x[i[k:k + step]], y[j[k:k + step]])
                           for k in range(0, len(i), step)] or [np.empty(0)])


class Scores:
    """Bounds, then exact scores, of the pairs of an anchor block and a row block.

    While many pairs are open they are computed for all, once, else for the open ones.
    """

    def __init__(self, a: Block, b: Block):
        self.a, self.b = a, b
        self.exact = all(x.c.dtype != object for x in (a, b)) and math.prod(
            float(np.abs(x.c).max(initial=1)) for x in (a, b)) * a.dim < 2.0**53
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.product: np.ndarray | None = None

    def many(self, open_: np.ndarray) -> bool:
        return MANY * np.count_nonzero(open_) > open_.size

    def bounds(self, level: int, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score of the open pairs by means' products and deviations' products."""
        if level in self.known:
            return self.known[level]
        if not self.a.dim:
            return np.zeros(open_.shape), np.zeros(open_.shape)
        (am, ad), (bm, bd) = self.a.levels[level], self.b.levels[level]
        with np.errstate(over="ignore", invalid="ignore"):
            if self.many(open_):
                mid, dev = am @ bm.T, ad @ bd.T + SLACK * np.outer(self.a.length, self.b.length) + 1e-6
                at = None
            else:
                at = i, j = np.nonzero(open_)
                mid, dev = products(am, bm, i, j), products(ad, bd, i, j) + SLACK * self.a.length[i] * self.b.length[j] + 1e-6
            low, high = mid - dev, mid + dev
        # beyond single precision: no bound
        low[~np.isfinite(low)] = -np.inf
        high[~np.isfinite(high)] = np.inf
        if at is None:
            self.known[level] = low, high
            return low, high
        out = np.full(open_.shape, -np.inf), np.full(open_.shape, -np.inf)
        out[0][at], out[1][at] = low, high
        return out

    def score(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Exact scores of the pairs: long, or Python numbers held at the limits of a long."""
        if not self.exact:
            out = [sum(int(x) * int(y) for x, y in zip(self.a.c[p], self.b.c[q])) for p, q in zip(i, j)]
            return np.array([min(max(s, LOWEST), HIGHEST) for s in out], object)
        if self.product is None and MANY * len(i) <= self.a.n * self.b.n:
            return products(self.a.c, self.b.c, i, j).astype(np.int64)
        if self.product is None:  # whole numbers under 2**53: exact in any order
            self.product = self.a.c @ self.b.c.T
        return self.product[i, j].astype(np.int64)


def best(scores: Scores, allowed: np.ndarray, k: int, floor: np.ndarray | float = -np.inf,
         ceiling: np.ndarray | float = np.inf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``i``, ``j``, score of allowed pairs: among them each anchor's ``k`` first (score, then id)
    from its ``floor`` to its ``ceiling`` (to be checked exactly: some lie outside).

    Level by level, a pair goes if its largest score is under the ``k``-th of the least
    scores of pairs that are surely not over the ceiling, or if its bounds lie outside.
    """
    n = scores.a.n
    open_ = allowed.copy()
    # the floor and ceiling may be off by rounding, the bounds' slack is more than that
    floor, ceiling = (np.broadcast_to(x, n)[:, None] for x in (floor - 0.5, ceiling + 0.5))
    for level in range(len(SEGMENTS) if scores.exact else 0):  # components too long for double precision: all pairs
        low, high = scores.bounds(level, open_)
        open_ &= (high >= floor) & (low <= ceiling)
        if scores.b.n > k:
            sure = np.where(open_ & (high <= ceiling - 1), low, -np.inf)
            open_ &= high >= np.partition(sure, -k, axis=1)[:, -k:][:, :1]
    i, j = np.nonzero(open_)
    return i, j, scores.score(i, j)


def first(i: np.ndarray, j: np.ndarray, s: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` first (score, then id) of each anchor."""
    if s.dtype == object:
        order = np.array(sorted(range(len(i)), key=lambda p: (i[p], -s[p], ids[j[p]])), int)
    else:
        order = np.lexsort((ids[j], -s, i))
    group = i[order]
    rank = np.arange(len(order)) - np.searchsorted(group, group)
    return order[rank < k]


BLOCK = "dim int, block long, keys array<long>, ids array<long>, labels array<long>, raw binary, summary binary, wanted array<array<long>>"


def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One row of a block's vectors and summaries."""
    raw = np.array([np.asarray(v, np.float64) for v in rows["vector"]]).reshape(len(rows), -1)
    held = summary(raw) if raw.shape[1] else b""
    wanted = [list(w) for w in rows["wanted"]] if "wanted" in rows else [[]] * len(rows)
    return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "keys": [rows["key"].tolist()], "ids": [rows["vec_id"].tolist()],
                         "labels": [rows["label"].tolist()], "raw": [raw.tobytes()], "summary": [held], "wanted": [wanted]})


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` of each dimension in blocks of about ``size``, and how many (``blocks``)."""
    # a row for each dimension that occurs
    counts = light(settle(rows.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("long").alias("blocks"))))
    dealt = rows.join(counts, "dim").withColumn("block", F.pmod(F.xxhash64("key"), "blocks"))
    packed = stored(dealt.groupBy("dim", "block").applyInPandas(pack, BLOCK), "blocks")
    return packed.join(counts, "dim")


def pairs(anchors: DataFrame, rows: DataFrame, compare, schema: str) -> DataFrame:
    """``compare(anchor block, row block)`` for each pair of blocks of a dimension, a task each."""
    def dealt(mine: DataFrame, theirs: DataFrame, name: str, other: str) -> DataFrame:
        counts = light(settle(theirs.select("dim", F.col("blocks").alias("others")).distinct()))
        out = mine.withColumnRenamed("block", name).drop("blocks").join(counts, "dim")
        return out.withColumn(other, F.explode(F.sequence(F.lit(0), F.col("others") - 1))).drop("others")

    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        names = [c.split()[0] for c in schema.split(", ")]
        if not len(a) or not len(b):
            return pd.DataFrame(columns=names)
        return compare(a.iloc[0], b.iloc[0])[names]

    keys = ["dim", "a_block", "b_block"]
    return (dealt(anchors, rows, "a_block", "b_block").groupBy(*keys)
            .cogroup(dealt(rows, anchors, "b_block", "a_block").groupBy(*keys)).applyInPandas(run, schema))


def taking_part(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """``key`` (of the row), ``vec_id``, ``label``, ``vector``, ``dim`` of the rows that take part."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("vector"), whole.alias("whole"))
    rows = rows.where("vec_id is not null and label is not null and vector is not null and whole").drop("whole")
    return stored(rows.withColumn("dim", F.size("vector")).withColumn("key", F.monotonically_increasing_id()), "vectors")


def mine(vectors: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100) -> DataFrame:
    """For each anchor (a row for which ``is_anchor``, of ``vec_id`` and ``label``, holds), and each of its
    ``positives`` first rows of the same label, the ``negatives`` first rows of another label that score at least
    ``least`` and at most ``most`` hundredths of the positive.

    A score is the inner product of the vectors' components floor(256 * x), exact; higher
    ones come first, ties by smaller id. Returns ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score``, ``negative_score``. All anchors meet all rows, a block of each in a task; there
    the rows' stored segment means and deviations decide which pairs are scored. Defined cases: rows with a null id,
    label, vector or component, or one that is not finite, take no part; vectors of different dimension are
    not compared; rows of the anchor's id are never its positives or negatives; rows equal in id are
    rows each; a score beyond a long is held at its limit; an anchor with no positive or no
    negative has no row; an empty table has none; other columns are not read.
    """
    rows = taking_part(vectors, id_col, vector_col, label)
    anchors = stored(rows.where(is_anchor), "anchors")
    packed = stored(blocks(rows, ROWS), "row-blocks")

    def near(a, b) -> pd.DataFrame:
        mine, theirs = Block(a), Block(b)
        scores = Scores(mine, theirs)
        allowed = (mine.labels[:, None] == theirs.labels) & (mine.ids[:, None] != theirs.ids)
        i, j, s = best(scores, allowed, positives)
        take = first(i, j, s, theirs.ids, positives)
        i, j, s = i[take], j[take], s[take]
        return pd.DataFrame({"key": np.asarray(a["keys"], np.int64)[i], "positive_id": theirs.ids[j], "positive_score": s.astype(np.int64)})

    found = pairs(blocks(anchors, ANCHORS), packed, near, "key long, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("positive_score"), "positive_id"))
    chosen = stored(found.withColumn("place", place).where(F.col("place") <= positives), "positives")
    wanted = chosen.groupBy("key").agg(F.array_distinct(F.collect_list("positive_score")).alias("wanted"))
    asked = stored(anchors.join(wanted, "key"), "asked")

    def hard(a, b) -> pd.DataFrame:
        mine, theirs = Block(a), Block(b)
        scores = Scores(mine, theirs)
        other = (mine.labels[:, None] != theirs.labels) & (mine.ids[:, None] != theirs.ids)
        asked = [[int(w) for w in ws] for ws in a["wanted"]]
        out = []
        for k in range(max(map(len, asked))):
            # anchors with fewer scores ask for nothing more
            has = np.array([len(ws) > k for ws in asked])
            p = [ws[k] if len(ws) > k else 0 for ws in asked]
            floor, ceiling = (np.array([w * share / 100 for w in p]) for share in (least, most))
            i, j, s = best(scores, other & has[:, None], negatives, floor, ceiling)
            # whole numbers: under 2**60 if scores are exact in double precision
            low, high = (np.array([w * share for w in p], np.int64 if scores.exact else object) for share in (least, most))
            inside = np.array((low[i] <= 100 * s) & (100 * s <= high[i]), bool)
            i, j, s = i[inside], j[inside], s[inside]
            take = first(i, j, s, theirs.ids, negatives)
            i, j, s = i[take], j[take], s[take]
            out.append(pd.DataFrame({"key": np.asarray(a["keys"], np.int64)[i], "positive_score": np.array(p, np.int64)[i],
                                     "negative_id": theirs.ids[j], "negative_score": s.astype(np.int64)}))
        return pd.concat(out)

    found = pairs(blocks(asked, ANCHORS), packed, hard, "key long, positive_score long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("key", "positive_score").orderBy(F.desc("negative_score"), "negative_id"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= negatives)
    ids = anchors.select("key", F.col("vec_id").alias("anchor_id"))
    return chosen.join(ids, "key").join(ranked, ["key", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

