"""Packing documents into sequences: Martello-Toth dominance reduction, then best fit.

Everything that is global works on the histogram of piece lengths, which has at
most ``capacity`` rows however large the corpus is; the pieces themselves are
ranked and joined on the cluster.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import settle, stored

CAPACITY = 4096
END = 1
#: Rows of one length that are ranked in one task.
RANKED = 1_000
#: Encoded chunks that a task keeps.
CACHE = 1_000_000
#: Pieces that a task hands on at a time.
FLUSHED = 1_000


def chunk_encoder(path: str) -> Callable[[str], bytes]:
    """Encoder of whole texts for a word-level BPE file of ``tokenizers``, to
    little-endian unsigned 32-bit ids.

    Such a tokenizer drops white space and never merges over it, so the ids of a
    text are those of its chunks between ASCII white space, each encoded once.
    A plain chunk is a run of lower-cased letters and a run of punctuation, which
    the model's merges take as they are; any other goes through the whole tokenizer.
    """
    import re
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(path)
    model = whole.model
    plain = re.compile(r"([A-Za-z\xe0-\xf6\xf8-\xff\xc0-\xd6\xd8-\xde]+)([!-&(-/:-@\[-`{-~]*)")
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    signs = {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}
    pieces: dict[str, bytes] = {}

    def packed(ids) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def piece(p: str) -> bytes:
        ids = pieces.get(p)
        if ids is None:
            shown_p = p if p.isascii() else p.encode().decode("latin-1").translate(signs)
            ids = pieces[p] = packed([t.id for t in model.tokenize(shown_p)])
        return ids

    class Chunks(dict):
        def __missing__(self, chunk: bytes) -> bytes:
            c = chunk.decode()
            if "<|" not in c and (m := plain.fullmatch(c)):
                word = m[1].lower()
                ids = piece(word) + piece(m[2]) if m[2] else piece(word)
            else:
                ids = packed(whole.encode(c, add_special_tokens=False).ids)
            self[chunk] = ids
            return ids

    cache = Chunks()

    def encode(text: str) -> bytes:
        if len(cache) > CACHE or len(pieces) > CACHE:
            cache.clear()
            pieces.clear()
        return b"".join(map(cache.__getitem__, text.encode().split()))

    return encode


def tokenize(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END,
             capacity: int = CAPACITY) -> DataFrame:
    """Pieces ``doc_id``, ``piece``, ``start``, ``length``, ``ids`` of all documents.

    A document is its whole text's ids and then ``end`` (null text: ``end`` alone);
    longer ones than ``capacity`` are cut. ``ids`` are little-endian unsigned 32-bit.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = chunk_encoder(path)
        names = ["doc_id", "piece", "start", "length", "ids"]
        for batch in batches:
            docs_in, texts, rows = batch.column(0), batch.column(1), []
            for n, text in enumerate(texts):
                text = text.as_py()
                ids = (encode(text) if text else b"") + struct.pack("<I", end)
                total = len(ids) // 4
                rows += [(n, at // capacity, at, min(capacity, total - at), ids[4 * at:4 * (at + capacity)])
                         for at in range(0, total, capacity)]
                if len(rows) >= FLUSHED or n == len(texts) - 1:
                    at, *rest = zip(*rows)
                    rows = []
                    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([docs_in.take(pa.array(at)), *(
                        pa.array(x, t) for x, t in zip(rest, kinds))], names)

    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids binary")


def reduce_dominated(count: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix sets that dominate every other set holding one of their pieces.

    ``count[l]`` is the number of pieces of length ``l``; fixed ones are taken
    out. Returns (lengths, how often). Let k be the longest piece that fits
    beside j. j goes alone if nothing fits. {j, k} is fixed if it fills the
    sequence, or no two pieces fit beside j, or no three do and no two that fit
    are longer than k together: whatever else a packing puts beside j is no
    longer than k and can take k's place, so some best packing has {j, k}.
    """
    fixed: list[tuple[tuple[int, ...], int]] = []
    for j in range(capacity, 0, -1):
        room = capacity - j
        while count[j]:
            count[j] -= 1
            fits = np.flatnonzero(count[:room + 1])
            least = np.repeat(fits[:3], np.minimum(count[fits[:3]], 3))[:3]
            sure = False
            if len(fits):
                k = int(fits[-1])
                sure = k == room or least[:2].sum() > room or len(least) < 2 or (
                    (least.sum() > room or len(least) < 3) and k >= longest_pair(count, fits, room))
            count[j] += 1
            if not len(fits):
                fixed.append(((j,), int(count[j])))
                count[j] = 0
            elif sure:
                times = int(count[j]) // 2 if k == j else int(min(count[j], count[k]))
                count[j] -= times
                count[k] -= times
                fixed.append(((j, k), times))
            else:
                break
    return fixed


def longest_pair(count: np.ndarray, fits: np.ndarray, room: int) -> int:
    """Largest sum within ``room`` of two pieces present (0: none fits)."""
    at = np.searchsorted(fits, room - fits, side="right") - 1
    at = np.where((at >= 0) & (fits[at] == fits) & (count[fits] < 2), at - 1, at)
    ok = at >= 0
    return int(np.max(fits[ok] + fits[at[ok]], initial=0))


def best_fit(count: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit of the remaining pieces, longest first, many alike at a time."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def add(room: int, content: tuple[int, ...], times: int) -> None:
        if room not in groups:
            insort(rooms, room)
        groups.setdefault(room, []).append((content, times))

    for length in np.flatnonzero(count)[::-1].tolist():
        left = int(count[length])
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                whole, rest = divmod(left, each)
                if whole:
                    add(capacity - each * length, (length,) * each, whole)
                if rest:
                    add(capacity - rest * length, (length,) * rest, 1)
                break
            room = rooms[at]
            content, times = groups[room].pop()
            used = min(times, left)
            if used < times:
                groups[room].append((content, times - used))
            elif not groups[room]:
                del groups[room], rooms[at]
            add(room - length, (*content, length), used)
            left -= used
    return [p for group in groups.values() for p in group]


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences) for all pieces."""
    count = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        count[length] = n
    fixed = reduce_dominated(count, capacity)
    return fixed + best_fit(count, capacity)


@dataclass
class Packed:
    """``pieces``: ``key``, ``doc_id``, ``piece``, ``start``, ``length``, ``ids``;
    ``places``: ``key``, ``sequence_id``, ``offset``."""
    pieces: DataFrame
    places: DataFrame

    def sequences(self) -> DataFrame:
        """Every piece with its token ids and its place."""
        return self.pieces.join(self.places, "key").drop("key")


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END,
         capacity: int = CAPACITY) -> Packed:
    """Pack the whole texts of ``docs`` into sequences of at most ``capacity`` ids.

    Defined cases: null or empty text: one piece with ``end`` alone; texts of any
    length are cut, never shortened; rows that repeat or have a null id are
    packed each for itself; an empty table gives no pieces; extra columns are not read.
    """
    pieces = stored(tokenize(docs, path, id_col, text_col, end, capacity).withColumn(
        "key", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # <= capacity rows
    slots, first = [], 0
    used = dict.fromkeys(histogram, 0)
    for content, times in plan_sequences(histogram, capacity):
        offset = 0
        for length in dict.fromkeys(content):
            each = content.count(length)
            slots.append((length, used[length], used[length] + each * times, first, each, offset))
            used[length] += each * times
            offset += each * length
        first += times
    spark = docs.sparkSession
    table = spark.createDataFrame(slots or [], "length long, low long, high long, first long, each long, base long")
    by_length = table.groupBy("length").agg(F.array_sort(F.collect_list(
        F.struct("low", "high", "first", "each", "base"))).alias("slots"))
    salts = spark.createDataFrame([(length, -(-n // RANKED)) for length, n in histogram.items()], "length long, salts long")
    salted = pieces.select("key", "length").join(F.broadcast(salts), "length").select(
        "key", "length", F.pmod(F.xxhash64("key"), F.col("salts")).alias("salt"))
    groups = settle(salted.groupBy("length", "salt").count())
    before = F.sum("count").over(Window.partitionBy("length").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1))
    starts = groups.select("length", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("key")) - 1)
    ranked = ranked.join(starts, ["length", "salt"]).select("key", "length", (F.col("rank") + F.col("before")).alias("rank"))
    slot = F.filter("slots", lambda s: (s["low"] <= F.col("rank")) & (F.col("rank") < s["high"]))[0]
    placed = (ranked.join(F.broadcast(by_length), "length").withColumn("slot", slot)
              .withColumn("nth", F.col("rank") - F.col("slot.low"))
              .select("key", (F.col("slot.first") + F.floor(F.col("nth") / F.col("slot.each"))).alias("sequence_id"),
                      (F.col("slot.base") + F.col("nth") % F.col("slot.each") * F.col("length")).alias("offset")))
    return Packed(pieces, placed)
