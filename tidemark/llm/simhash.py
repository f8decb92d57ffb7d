"""SimHash near-duplicates by tiled exact comparison of fingerprints."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import connected_components, fresh, settle

#: Fingerprints in one block of a tile; a comparison holds two blocks.
BLOCK = 8192


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the whole text (null or no word: 0).

    Words are runs of non-white-space after lower-casing A-Z; a shingle is
    ``shingle`` words joined by spaces (fewer words: all of them), repeats
    included; a bit is 1 if over half of the shingles' XXH64 (seed 42) have it.
    """
    import xxhash
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    k = min(shingle, len(words))
    of = xxhash.xxh64_intdigest
    hashes = np.fromiter((of(joined[a:b], 42) for a, b in zip(starts[:len(words) - k + 1].tolist(),
                                                             (ends[k - 1:] - 1).tolist())), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[at:at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, text_col: str, out: str, shingle: int = 3) -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of ``text_col`` in ``out``."""
    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))
    return docs.withColumn(out, prints(F.col(text_col)))


def quarter_counts(fp):
    """Population counts of the four 16-bit quarters, as one number of base 17."""
    return sum((F.bit_count(F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF))) * 17 ** k
                for k in range(4)), F.lit(0))


def neighbour_offsets(radius: int) -> list[tuple[int, int, int, int]]:
    """Differences of quarter counts within the radius, one of each opposite pair."""
    span = range(-radius, radius + 1)
    every = (d for d in itertools.product(span, repeat=4) if sum(map(abs, d)) <= radius)
    return [d for d in every if d >= (0, 0, 0, 0)]


def forest(n: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that join the same nodes of ``range(n)`` as the given ones."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def compare_blocks(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints linked across two blocks, as a spanning forest of the links."""
    nodes = np.concatenate((a, b))
    rows = max(1, 2_000_000 // max(1, len(b)))
    left, right = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(a), rows):
        i, j = np.nonzero(np.bitwise_count(a[at:at + rows, None] ^ b[None, :]) <= radius)
        left, right = np.concatenate((left, i + at)), np.concatenate((right, j + len(a)))
        if len(left) > 4 * len(nodes):  # no more than a forest is ever kept
            left, right = forest(len(nodes), left, right)
    left, right = forest(len(nodes), left, right)
    moved = nodes[left] != nodes[right]
    return nodes[left[moved]], nodes[right[moved]]


def links(prints: DataFrame, radius: int = 3, block: int = BLOCK) -> DataFrame:
    """Forest edges ``a``, ``b`` that connect distinct fingerprints ``fp`` (long)
    at ``radius`` or fewer differing bits.

    A tile holds the fingerprints of equal population counts in their four
    quarters. Two tiles whose counts differ by more than the radius in sum hold
    no link and are never paired; all other tiles are compared exactly, block by
    block. At most 17**4 tiles, so the tile list is small; large tiles are cut
    into blocks of about ``block``.
    """
    tiled = settle(prints.select("fp", quarter_counts(F.col("fp")).cast("int").alias("tile")))
    sizes = tiled.groupBy("tile").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    blocks = settle(tiled.join(F.broadcast(sizes), "tile")
                    .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
                    .groupBy("tile", "block").agg(F.collect_list("fp").alias("fps")))
    quarter = [(F.floor(F.col("tile") / 17 ** k) % 17) for k in range(4)]
    steps = F.explode(F.array(*[F.struct(*[F.lit(x).alias(f"d{k}") for k, x in enumerate(d)])
                                for d in neighbour_offsets(radius)])).alias("d")
    shifted = [quarter[k] + F.col(f"d.d{k}") for k in range(4)]
    valid = [x.between(0, 16) for x in shifted]
    near = (sizes.select("tile", steps).where(valid[0] & valid[1] & valid[2] & valid[3])
            .select("tile", sum((x * 17 ** k for k, x in enumerate(shifted)), F.lit(0)).cast("int").alias("other"))
            .join(sizes.select(F.col("tile").alias("other")), "other"))
    mine = blocks.select("tile", "block", "fps")
    theirs = blocks.select(F.col("tile").alias("other"), F.col("block").alias("other_block"),
                           F.col("fps").alias("other_fps"))
    work = (near.join(mine, "tile").join(theirs, "other")
            .where((F.col("tile") != F.col("other")) | (F.col("block") <= F.col("other_block")))
            .select("fps", "other_fps"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [compare_blocks(np.asarray(a, np.int64).view(np.uint64), np.asarray(b, np.int64).view(np.uint64),
                                    radius) for a, b in zip(batch["fps"], batch["other_fps"])]
            ends = [np.concatenate([f[k] for f in found] or [np.empty(0, np.uint64)]).view(np.int64) for k in (0, 1)]
            yield pd.DataFrame({"a": ends[0], "b": ends[1]})

    return work.mapInPandas(compare, "a long, b long")


def fingerprint_classes(prints: DataFrame, radius: int = 3) -> DataFrame:
    """``fp`` and the ``component`` (a fingerprint) of every distinct ``fp``."""
    distinct = settle(prints.select("fp").distinct())
    joined = connected_components(links(distinct, radius))
    return distinct.join(joined, distinct["fp"] == joined["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 3) -> DataFrame:
    """Per document ``doc_id``, ``fp`` (signed 64-bit), ``component_id``.

    ``component_id`` is the smallest id reachable over links of ``radius`` or
    fewer differing bits, the document itself included. Defined cases: null or
    empty text has fingerprint 0 and links like any other; repeated rows share a
    fingerprint; a null id is never the smallest (a component of null ids only
    has a null ``component_id``); no rows give no rows; extra columns are not read.
    """
    prints = settle(with_fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                                      "text", "fp", shingle).select("doc_id", "fp"))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    classes = distinct.join(fingerprint_classes(distinct, radius), "fp")
    ids = classes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of = classes.join(ids, "component").select("fp", "component_id")
    return prints.join(of, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             radius: int = 3) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the smallest id
    (null ids last), of rows with that id the one of the smallest hash."""
    fp, key = fresh(docs, "fp", "key")
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col), F.col(text_col)))
    prints = settle(with_fingerprints(keyed, text_col, fp, shingle).select(
        F.col(id_col).alias("id"), F.col(key).alias("key"), F.col(fp).alias("fp")))
    place = F.struct(F.col("id").isNull(), "id", "key")
    distinct = prints.groupBy("fp").agg(F.min(place).alias("first"))
    classes = distinct.join(fingerprint_classes(distinct, radius), "fp")
    kept = classes.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.key").alias(key))
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).select(*[F.col(c) for c in docs.columns])
