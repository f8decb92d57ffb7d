"""Near-duplicate vectors by hierarchical navigable small-world graphs per shard."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import connected_components, fresh, settle, small, stored
from tidemark.llm.simhash import forest

#: Vectors of a shard, links of a node (twice that in the lowest layer), beam while building.
SHARD, LINKS, BUILD_BEAM = 8192, 12, 48
#: First and widest beam of a query; vectors audited of each shard: so many evenly spread and so many not linked to each other.
BEAM, WIDEST, AUDITED = 32, 128, 256
#: Slack of the single-precision search before the exact check.
SLACK = 1e-4


class Graph:
    """HNSW graph over unit vectors (single precision), with seeded layers."""

    def __init__(self, unit: np.ndarray):
        self.unit = unit
        u = np.random.default_rng(len(unit)).random(len(unit))
        self.level = np.minimum((-np.log(1 - u) / math.log(LINKS)).astype(int), 6)
        self.links: list[list[list[int]]] = [[[] for _ in range(top + 1)] for top in self.level]
        self.entry = -1

    def beam(self, q: np.ndarray, starts: list[int], layer: int, width: int) -> list[tuple[float, int]]:
        """The ``width`` best nodes that a best-first walk finds, best first."""
        seen = bytearray(len(self.unit))
        sims = (self.unit[starts] @ q).tolist()
        for n in starts:
            seen[n] = 1
        todo = [(-s, n) for s, n in zip(sims, starts)]
        heapq.heapify(todo)
        best = sorted(zip(sims, starts))[-width:]
        heapq.heapify(best)
        while todo:
            s, n = heapq.heappop(todo)
            if len(best) >= width and -s < best[0][0]:
                break
            new = [m for m in self.links[n][layer] if not seen[m]]
            if not new:
                continue
            for m in new:
                seen[m] = 1
            for s, m in zip((self.unit[new] @ q).tolist(), new):
                if len(best) < width:
                    heapq.heappush(best, (s, m))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, m))
                else:
                    continue
                heapq.heappush(todo, (-s, m))
        return sorted(best, reverse=True)

    def descend(self, q: np.ndarray, layer: int) -> list[int]:
        """Where a walk from the top enters ``layer``."""
        at = [self.entry]
        for above in range(int(self.level[self.entry]), layer, -1):
            at = [self.beam(q, at, above, 1)[0][1]]
        return at

    def spread(self, node: int, near: list[int], most: int) -> list[int]:
        """Of the nearest nodes those not nearer to a chosen one than to ``node``; then the nearest others."""
        own = self.unit[near] @ self.unit[node]
        order = np.argsort(-own, kind="stable")
        near, own = [near[i] for i in order], own[order]
        among = self.unit[near] @ self.unit[near].T
        chosen, passed = [], []
        for i in range(len(near)):
            if len(chosen) < most and (not chosen or among[i, chosen].max() < own[i]):
                chosen.append(i)
            else:
                passed.append(i)
        return [near[i] for i in (chosen + passed)[:most]]

    def add(self, node: int) -> None:
        q, top = self.unit[node], int(self.level[node])
        if self.entry < 0:
            self.entry = node
            return
        entry_top = int(self.level[self.entry])
        at = self.descend(q, top)
        for layer in range(min(top, entry_top), -1, -1):
            near = [n for _, n in self.beam(q, at, layer, BUILD_BEAM)]
            at = near
            self.links[node][layer] = self.spread(node, near, LINKS)
            most = LINKS * (2 if layer == 0 else 1)
            for n in self.links[node][layer]:
                back = self.links[n][layer]
                back.append(node)
                if len(back) > most + LINKS:
                    self.links[n][layer] = self.spread(n, back, most)
        if top > entry_top:
            self.entry = node

    def linked(self, q: np.ndarray, least: float, width: int, near: list[tuple[float, int]] | None = None) -> list[int]:
        """Nodes of similarity ``least`` or more: those in the beam (``near``, if it is
        known), and from them on over links as long as such nodes turn up. A beam of
        all nodes compares them all."""
        if width >= len(self.unit):
            return np.flatnonzero(self.unit @ q >= least).tolist()
        if near is None:
            near = self.beam(q, self.descend(q, 0), 0, width)
        found = [n for s, n in near if s >= least]
        seen, edge = set(found), found
        while edge:
            new = list({m for n in edge for m in self.links[n][0]} - seen)
            if not new:
                break
            sims = self.unit[new] @ q
            edge = [n for n, s in zip(new, sims.tolist()) if s >= least]
            seen.update(new)
            found = found + edge
        return found

    def finds(self, q: np.ndarray, sims: np.ndarray, least: float, width: int) -> bool:
        """Whether a walk finds all links and the nearest of ``sims`` (all nodes'; that of ``q`` itself is -inf)."""
        near = self.beam(q, self.descend(q, 0), 0, width)
        best = max((sims[n] for _, n in near), default=-np.inf)
        links = np.flatnonzero(sims >= least)
        return best >= sims.max() - 1e-6 and not set(links.tolist()) - set(self.linked(q, least, width, near))

    def audited_beam(self, queries: np.ndarray, least: float, own: bool = False) -> int:
        """The first beam, doubled until the links and the nearest node of every
        audited query (by brute force) are found; all nodes if ``WIDEST`` is not enough.

        ``own``: the queries are the nodes, and none counts as its own nearest.
        """
        even = np.linspace(0, len(queries) - 1, AUDITED).astype(int)
        take = np.union1d(even, apart(queries, least, AUDITED))
        width = BEAM
        sims = queries[take] @ self.unit.T
        if own:
            sims[np.arange(len(take)), take] = -np.inf
        while width < len(self.unit):
            if width > WIDEST:
                return len(self.unit)
            if all(self.finds(queries[i], sims[k], least, width) for k, i in enumerate(take)):
                break
            width *= 2
        return width


def apart(unit: np.ndarray, least: float, most: int) -> np.ndarray:
    """At most ``most`` rows in seeded order of which no two are linked: one of each large group, and rows outside."""
    order = np.random.default_rng(len(unit)).permutation(len(unit))
    free, taken = np.ones(len(unit), bool), []
    for i in order:
        if free[i]:
            taken.append(i)
            if len(taken) == most:
                break
            free &= unit @ unit[i] < least
    return np.array(taken, int)


def unit_rows(raw: np.ndarray) -> np.ndarray:
    return (raw / np.sqrt((raw * raw).sum(1))[:, None]).astype(np.float32)


def stack(vectors) -> np.ndarray:
    """The vectors as rows, each divided by the power of two over its largest component: the
    cosines stay the same to the last bit, and no square over- or underflows."""
    raw = np.stack([np.asarray(v, np.float64) for v in vectors])
    return np.ldexp(raw, -np.frexp(np.abs(raw).max(1))[1][:, None])


def restored(part: pd.DataFrame) -> Graph:
    """The graph of a shard from its rows."""
    graph = Graph.__new__(Graph)
    graph.unit = unit_rows(stack(part["vector"]))
    graph.links = [[list(map(int, x)) for x in node] for node in part["links"]]
    graph.level = np.array([len(x) - 1 for x in graph.links])
    graph.entry = int(np.argmax(part["entry"].to_numpy()))
    return graph


def linked_pairs(left: pd.DataFrame, right: pd.DataFrame, least: float, same: bool) -> np.ndarray:
    """Boolean matrix of the links between two shards: both graphs are asked with
    the vectors of the other, and every pair found is checked in double precision."""
    a, b = restored(left), restored(right)
    found = np.zeros((len(left), len(right)), bool)
    width = b.audited_beam(a.unit, least - SLACK, same)
    for i, q in enumerate(a.unit):
        found[i, b.linked(q, least - SLACK, width)] = True
    if same:
        found |= found.T
        np.fill_diagonal(found, False)
    else:
        width = a.audited_beam(b.unit, least - SLACK)
        for j, q in enumerate(b.unit):
            found[a.linked(q, least - SLACK, width), j] = True
    raw_a, raw_b = stack(left["vector"]), stack(right["vector"])
    norm_a, norm_b = np.sqrt((raw_a * raw_a).sum(1)), np.sqrt((raw_b * raw_b).sum(1))
    for i in np.flatnonzero(found.any(1)):
        j = np.flatnonzero(found[i])
        found[i, j] = (raw_b[j] * raw_a[i]).sum(1) / (norm_b[j] * norm_a[i]) >= least
    return found


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 least: float = 0.93, shard: int = SHARD) -> DataFrame:
    """Per vector ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Two vectors of equal non-null label and length link at a cosine of ``least``
    or more in double precision. Equal vectors of a label form one class; classes
    are spread by hash over shards of about ``shard``, each with an HNSW graph;
    every shard is asked with all classes of its label, shard by shard. A pair of
    shards gives counts and a spanning forest of its links, never the pairs.

    Defined cases: vectors that are null, empty, zero or hold null or non-finite
    numbers, and null labels, link with nothing (0 links, their own component);
    repeated rows count as other vectors; a null id is never the smallest, has
    the smallest other id of its component or null, and is not kept; rows of an
    id that repeats are each kept; no rows give no rows; extra columns are not read.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"),
                          F.col(label_col).alias("label"))
    fine = F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists("vector", lambda x: x != 0) & F.col("label").isNotNull(), F.lit(False))
    rows = rows.withColumn("class", F.when(fine, F.xxhash64("label", "vector")))
    classes = rows.where(fine).groupBy("label", "vector").agg(
        F.count("*").alias("rows"), F.min("vec_id").alias("first_id"), F.first("class").alias("class"))
    classes = classes.withColumn("size", F.size("vector"))
    counts = settle(classes.groupBy("label", "size").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards")))
    counts = small(counts)
    sharded = classes.join(counts, ["label", "size"]).withColumn(
        "shard", F.pmod(F.xxhash64("class", F.lit(1)), F.col("shards")).cast("int"))
    label = vectors.schema[label_col].dataType.simpleString()
    base = f"label {label}, size int, shard int, shards int, class long, rows long, first_id {vectors.schema[id_col].dataType.simpleString()}, vector array<double>"

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("class", ignore_index=True)
        graph = Graph(unit_rows(stack(part["vector"])))
        for node in range(len(part)):
            graph.add(node)
        return part.assign(links=graph.links, entry=np.arange(len(part)) == graph.entry)

    names = [x.split()[0] for x in base.split(", ")]
    index = stored(sharded.select(*names).groupBy("label", "size", "shard").applyInPandas(
        build, base + ", links array<array<int>>, entry boolean"), "graphs")

    def search(part: pd.DataFrame) -> pd.DataFrame:
        low, high = part["low"].iat[0], part["high"].iat[0]
        sides = [part[part["shard"] == s].sort_values("class", ignore_index=True) for s in dict.fromkeys((low, high))]
        left, right = sides[0], sides[-1]
        if not len(left) or not len(right):
            return pd.DataFrame({"class": [], "links": [], "root": []})
        found = linked_pairs(left, right, least, low == high)
        links = [found @ right["rows"].to_numpy(np.int64)]
        if low == high:
            ids, shift = left["class"].to_numpy(), 0
        else:
            ids, shift = np.concatenate((left["class"], right["class"])), len(left)
            links.append(left["rows"].to_numpy(np.int64) @ found)
        a, b = np.empty(0, np.int64), np.empty(0, np.int64)
        for at in range(0, len(left), 256):
            i, j = np.nonzero(found[at:at + 256])
            a, b = forest(len(ids), np.concatenate((a, i + at)), np.concatenate((b, j + shift)))
        root = ids.copy()
        root[a] = ids[b]
        return pd.DataFrame({"class": ids, "links": np.concatenate(links), "root": root})

    other = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("other")
    asked = index.select("*", other).withColumn("low", F.least("shard", "other")).withColumn("high", F.greatest("shard", "other"))
    met = settle(asked.drop("other", "first_id").groupBy("label", "size", "low", "high").applyInPandas(
        search, "class long, links long, root long"))
    joined = connected_components(met.where("class != root").select(F.col("class").alias("a"), F.col("root").alias("b")))
    links = met.groupBy("class").agg(F.sum("links").alias("links"))
    own = index.select("class", "rows", "first_id").join(links, "class", "left").join(
        joined, index["class"] == joined["node"], "left").select(
        "class", "first_id", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"),
        F.coalesce("component", "class").alias("component"))
    firsts = own.groupBy("component").agg(F.min("first_id").alias("component_id"))
    out = rows.select("vec_id", "class").join(own.join(firsts, "component").select("class", "n_links", "component_id"),
                                              "class", "left")
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def keep_one(vectors: DataFrame, id_col: str = "vec_id", **how) -> DataFrame:
    """The rows of ``vectors`` whose id is the smallest of its component."""
    mine, = fresh(vectors, "id")
    kept = near_vectors(vectors, id_col, **how).where("kept").select(F.col("vec_id").alias(mine)).distinct()
    return vectors.join(kept, F.col(id_col) == F.col(mine), "left_semi")
