"""Near-duplicate embeddings by a small-world graph per shard.

The vectors of a label are dealt to shards; each shard's vectors become one
hierarchical navigable small-world graph. All vectors of the label search every shard:
a task reads a graph once and then its queries in batches, and only a label of more than
COPY_ROWS queries has further copies of its graphs. A search ends when its beam holds the
first vectors below the threshold; if a beam is full of links, or an audit against brute
force misses too many, the beam is doubled and the search repeated. An audit goes on until
it has seen enough links to judge by; a vector is no link of its own. Every link's cosine
is computed in double precision, and links are united to components.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import staged
from tillroll.llm.components import components

THRESHOLD = 0.98
SHARD_ROWS = 16_384  # vectors of a graph, in expectation at most
COPY_ROWS = 1 << 20  # queries that share one copy of a graph, in expectation at most
NEIGHBOURS = 12  # of a vector in the upper layers; twice as many in the lowest
BUILD_BEAM = 40
FIRST_BEAM = 24
AUDITED = 48  # queries of each batch that are also answered by brute force
LEAST_LINKS = 50  # that a graph's audits must have seen; until then all queries are audited
AUDIT_ROWS = 128  # queries that brute force takes at once
RECALL = 0.98  # share of the audited links that the search must find
SLACK = 1e-5  # what single precision may be off


class Graph:
    """A small-world graph over unit vectors; similarity is the dot product."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        self.layers: list[dict[int, list[int]]] = []
        self.entry = -1

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        graph = cls(vectors)
        # Levels come from the place alone, so a task that runs again builds the same graph.
        levels = np.random.default_rng(len(vectors)).exponential(1 / math.log(NEIGHBOURS), len(vectors)).astype(int)
        for i, level in enumerate(levels.tolist()):
            graph._insert(i, level)
        return graph

    def _insert(self, i: int, level: int) -> None:
        q = self.vectors[i]
        top = len(self.layers) - 1
        entries = [self.entry] if self.entry >= 0 else []
        for layer in range(top, level, -1):
            entries = [self._climb(q, entries[0], layer)]
        for layer in range(min(level, top), -1, -1):
            found = self._beam(q, entries, BUILD_BEAM, layer)
            own = self._diverse(found, NEIGHBOURS)
            links = self.layers[layer]
            links[i] = own
            most = 2 * NEIGHBOURS if layer == 0 else NEIGHBOURS
            for j in own:
                links[j].append(i)
                if len(links[j]) > most:
                    near = np.array(links[j])
                    sims = self.vectors[near] @ self.vectors[j]
                    order = np.lexsort((near, -sims))
                    links[j] = self._diverse([(float(sims[k]), int(near[k])) for k in order], most)
            entries = [j for _, j in found]
        for layer in range(top + 1, level + 1):
            self.layers.append({i: []})
            self.entry = i

    def _diverse(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours nearer to the vector than to each other first, then the nearest of the rest."""
        places = np.array([j for _, j in found], dtype=np.int64)
        among = self.vectors[places] @ self.vectors[places].T
        chosen: list[int] = []
        rest: list[int] = []
        for k, (sim, _) in enumerate(found):
            if len(chosen) == most:
                break
            (rest if chosen and among[k, chosen].max() > sim else chosen).append(k)
        chosen += rest[: most - len(chosen)]
        return places[chosen].tolist()

    def _climb(self, q: np.ndarray, at: int, layer: int) -> int:
        """The vector of the layer that no neighbour beats."""
        links = self.layers[layer]
        sim = float(self.vectors[at] @ q)
        while links[at]:
            near = links[at]
            sims = self.vectors[near] @ q
            k = int(sims.argmax())
            if sims[k] <= sim:
                break
            at, sim = near[k], float(sims[k])
        return at

    def _beam(self, q: np.ndarray, entries: list[int], width: int, layer: int) -> list[tuple[float, int]]:
        """The best `width` vectors found from the entries, nearest first."""
        links = self.layers[layer]
        seen = set(entries)
        sims = self.vectors[entries] @ q
        heap = [(-float(s), j) for s, j in zip(sims, entries)]
        heapq.heapify(heap)
        best = [(float(s), -j) for s, j in zip(sims, entries)]
        heapq.heapify(best)
        while len(best) > width:
            heapq.heappop(best)
        while heap:
            far, j = heapq.heappop(heap)
            if len(best) == width and -far < best[0][0]:
                break
            near = [n for n in links[j] if n not in seen]
            if not near:
                continue
            seen.update(near)
            for s, n in zip((self.vectors[near] @ q).tolist(), near):
                if len(best) < width:
                    heapq.heappush(best, (s, -n))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, -n))
                else:
                    continue
                heapq.heappush(heap, (-s, n))
        return sorted(((s, -j) for s, j in best), key=lambda x: (-x[0], x[1]))

    def within(self, q: np.ndarray, least: float, width: int) -> list[int]:
        """Places whose similarity is at least `least`; the beam doubles while it holds nothing else."""
        if self.entry < 0:
            return []
        at = self.entry
        for layer in range(len(self.layers) - 1, 0, -1):
            at = self._climb(q, at, layer)
        while True:
            found = self._beam(q, [at], width, 0)
            if len(found) < width or found[-1][0] < least:
                return [j for s, j in found if s >= least]
            width *= 2

    def to_bytes(self) -> bytes:
        arrays = {"vectors": self.vectors, "entry": np.array(self.entry)}
        for k, links in enumerate(self.layers):
            arrays[f"ids{k}"] = np.fromiter(links, np.int64, len(links))
            arrays[f"sizes{k}"] = np.fromiter(map(len, links.values()), np.int64, len(links))
            arrays[f"links{k}"] = np.array([j for own in links.values() for j in own], dtype=np.int32)
        out = io.BytesIO()
        np.savez(out, **arrays)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Graph:
        arrays = np.load(io.BytesIO(data))
        graph = cls(arrays["vectors"])
        graph.entry = int(arrays["entry"])
        for k in range(sum(name.startswith("ids") for name in arrays.files)):
            links = np.split(arrays[f"links{k}"], np.cumsum(arrays[f"sizes{k}"])[:-1])
            graph.layers.append({i: own.tolist() for i, own in zip(arrays[f"ids{k}"].tolist(), links)})
        return graph


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision. Scaled first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=np.finfo(float).tiny)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in rows], dtype=np.float64)


def _build(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("node", ignore_index=True)
    vectors = _unit(_matrix(group["vector"]))
    graph = Graph.build(vectors.astype(np.float32))
    nodes = group["node"].to_numpy(dtype=np.int64)
    return pd.DataFrame(
        {
            "family": group["family"].iloc[:1],
            "shard": group["shard"].iloc[:1],
            "graph": [graph.to_bytes()],
            "nodes": [nodes.tobytes()],
            "exact": [vectors.tobytes()],
        }
    )


class Searcher:
    """A graph, and the beam that its audits have asked for so far."""

    def __init__(self, graph: Graph, nodes: np.ndarray, exact: np.ndarray) -> None:
        self.graph = graph
        self.nodes = nodes
        self.exact = exact
        self.width = FIRST_BEAM
        self.seen = 0  # links of audited queries

    def links(self, asked: np.ndarray, vectors: np.ndarray) -> list[tuple[int, int]]:
        """Pairs of an asked node and another node of the graph that the search links with it."""
        single = vectors.astype(np.float32)
        near = self._audit(asked, vectors, single)
        found: list[tuple[int, int]] = []
        for i, node in enumerate(asked.tolist()):
            places = near[i] if i in near else self._near(vectors[i], single[i])
            found += [(node, j) for j in self.nodes[places].tolist() if j != node]
        return found

    def _near(self, q: np.ndarray, single: np.ndarray) -> np.ndarray:
        """Places of the links of one vector, itself included where it is in the graph."""
        if self.width < 2 * len(self.nodes):
            places = np.array(self.graph.within(single, THRESHOLD - SLACK, self.width), dtype=np.int64)
        else:  # no beam was wide enough, so this graph is answered exactly
            places = np.arange(len(self.nodes))
        return places[self.exact[places] @ q >= THRESHOLD]

    def _audit(self, asked: np.ndarray, vectors: np.ndarray, single: np.ndarray) -> dict[int, np.ndarray]:
        """Widens the beam until it finds what brute force finds; what it found for audited queries with links."""
        if self.seen < LEAST_LINKS:
            audited = np.arange(len(asked))
        else:
            audited = np.unique(np.linspace(0, len(asked) - 1, min(AUDITED, len(asked))).astype(int))
        truth: dict[int, np.ndarray] = {}
        for start in range(0, len(audited), AUDIT_ROWS):
            rows = audited[start : start + AUDIT_ROWS]
            which, places = np.nonzero(single[rows] @ self.graph.vectors.T >= THRESHOLD - SLACK)
            of = rows[which]
            linked = (np.einsum("ij,ij->i", vectors[of], self.exact[places]) >= THRESHOLD) & (asked[of] != self.nodes[places])
            of, places = of[linked], places[linked]
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            truth.update(zip(of[starts].tolist(), np.split(places, starts[1:])))
        links = sum(map(len, truth.values()))
        self.seen += links
        while True:
            near = {i: self._near(vectors[i], single[i]) for i in truth}
            missed = sum(len(np.setdiff1d(truth[i], near[i])) for i in truth)
            if missed <= (1 - RECALL) * links or self.width >= 2 * len(self.nodes):
                return near
            self.width *= 2


def _search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of the queries that follow each graph; rows come sorted by key, the graph before its queries."""
    at, searcher = None, None
    for batch in batches:
        keys = batch[["family", "shard", "copy"]].to_numpy(dtype=np.int64)
        graphs = batch["graph"].notna().to_numpy()
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1) | graphs[1:]])
        for start, stop in zip(starts, np.r_[starts[1:], len(batch)]):
            rows = batch.iloc[start:stop]
            if graphs[start]:
                row = rows.iloc[0]
                nodes = np.frombuffer(row["nodes"], np.int64)
                exact = np.frombuffer(row["exact"], np.float64).reshape(len(nodes), -1)
                at, searcher = tuple(keys[start]), Searcher(Graph.from_bytes(row["graph"]), nodes, exact)
                rows = rows.iloc[1:]
            if not len(rows) or tuple(keys[start]) != at:  # a shard without vectors has no graph
                continue
            vectors = _unit(_matrix(rows["single"].where(rows["single"].notna(), rows["double"])))
            found = searcher.links(rows["node"].to_numpy(dtype=np.int64), vectors)
            yield pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


def vector_nodes(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """`label, width, vector, node, copies` of each distinct usable vector of a label.

    Usable: a label, an identifier, and numbers that are all finite and not all zero.
    Vectors of unequal length are never compared. `node` is the smallest identifier.
    """
    v = F.col(vector).cast("array<double>")
    usable = (
        F.col(label).isNotNull()
        & F.col(vec_id).isNotNull()
        & F.col(vector).isNotNull()
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    return (
        vectors.filter(F.coalesce(usable, F.lit(False)))
        .select(F.col(label).alias("label"), F.size(vector).alias("width"), v.alias("vector"), F.col(vec_id).cast("long").alias("vec_id"))
        .groupBy("label", "width", "vector")
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    )


def vector_links(nodes: DataFrame, shard_rows: int = SHARD_ROWS, copy_rows: int = COPY_ROWS) -> DataFrame:
    """`a, b` with a < b: pairs of nodes of one label whose cosine is THRESHOLD or more.

    A query travels to each shard of its label, a graph once for about `copy_rows` queries.
    """
    nodes = staged(nodes.select("label", "width", "vector", "node"), "vector-nodes")
    sizes = nodes.groupBy("label", "width").agg(F.count("*").alias("n"))
    # Staged, so that the numbers are the same whenever a task reads them.
    families = staged(sizes.withColumn("family", F.monotonically_increasing_id()), "vector-families").select(
        "label",
        "width",
        "family",
        F.ceil(F.col("n") / shard_rows).alias("shards"),
        F.ceil(F.col("n") / copy_rows).alias("copies"),
    )
    dealt = nodes.join(families, ["label", "width"])
    shard = F.pmod(F.xxhash64("node", F.lit("shard")), F.col("shards"))
    built = dealt.select("family", shard.alias("shard"), "node", "vector").groupBy("family", "shard")
    graphs = staged(
        built.applyInPandas(_build, "family long, shard long, graph binary, nodes binary, exact binary"), "vector-graphs"
    )
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    indexed = graphs.join(families.select("family", "copies"), "family").withColumn("copy", every(F.col("copies")))
    single = F.col("vector").cast("array<float>")
    lossless = single.cast("array<double>") == F.col("vector")
    asked = dealt.select(
        "family",
        F.pmod(F.xxhash64("node", F.lit("copy")), F.col("copies")).alias("copy"),
        "node",
        F.when(lossless, single).alias("single"),
        F.when(~lossless, F.col("vector")).alias("double"),
        every(F.col("shards")).alias("shard"),
    )
    stream = indexed.drop("copies").unionByName(asked, allowMissingColumns=True).repartition("family", "shard", "copy")
    # A graph has no node of its own, so it comes before its queries.
    stream = stream.sortWithinPartitions("family", "shard", "copy", F.col("node").asc_nulls_first())
    found = stream.mapInPandas(_search, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicate_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """A row per input row: `vec_id, n_links, component_id, kept`.

    Equal vectors of a label are one node of the graph and count each other as links.
    A row whose label or vector cannot be compared (see `vector_nodes`) has no links
    and is its own component. A null identifier has a null component and is not kept.
    Repeated rows of one identifier count as vectors of their own.
    """
    nodes = staged(vector_nodes(vectors, vec_id, vector, label), "vector-distinct")
    links = staged(vector_links(nodes), "vector-links")
    copies = nodes.select("node", "copies")
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = (
        ends.join(copies.withColumnRenamed("node", "b"), "b")
        .groupBy(F.col("a").alias("node"))
        .agg(F.sum("copies").alias("others"))
    )
    found = components(links).withColumnRenamed("id", "node")
    of_node = (
        nodes.join(others, "node", "left")
        .join(found, "node", "left")
        .select(
            "label",
            "width",
            "vector",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).alias("label"),
        F.size(vector).alias("width"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    joined = rows.join(of_node, ["label", "width", "vector"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return joined.select(
        "vec_id",
        F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
