"""Exact k-means over integer vectors by subvector dictionaries.

Vectors are quantized and packed into pages. In a page each block of `SUB` dimensions
has a dictionary of its distinct subvectors, and a vector is its codes, from which it
can be read back without loss. A round computes the squared distance of each dictionary
entry to each centroid's same block once, and a vector's distance is the sum of its
codes' entries. New sums are counts per code times dictionary entries. All of it is
in whole numbers, so no order of tasks changes a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import staged

SUB = 2  # dimensions of a block: few enough for subvectors to repeat
PAGE_ROWS = 16_384  # vectors of a page at most
STEP_ROWS = 2_048  # vectors whose distances are held at once
LARGEST = 1 << 27  # of a quantized component; then squared distances fit 64 bits

_PAGE = "vec_ids binary, missing binary, codes binary, entries binary, counts binary"


def whole_vectors(vectors: DataFrame, dimensions: int) -> DataFrame:
    """`vec_id, embedding` of the vectors with this many components, none null, NaN or infinite."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding"))
    return rows.filter((F.size("embedding") == dimensions) & finite)


def _quantize(values: np.ndarray, scale: int) -> np.ndarray:
    floored = np.floor(values * float(scale))
    if len(floored) and np.abs(floored).max() > LARGEST:
        raise ValueError(f"a component beyond {LARGEST // scale}: its squared distance would not fit 64 bits")
    return floored.astype(np.int64)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


class Page:
    """Vectors as codes into one dictionary of distinct subvectors per block."""

    def __init__(self, codes: np.ndarray, entries: list[np.ndarray]) -> None:
        self.codes = codes  # vectors x blocks
        self.entries = entries  # per block: distinct subvectors x dimensions of the block

    @classmethod
    def encode(cls, vectors: np.ndarray) -> Page:
        codes, entries = [], []
        for at in range(0, vectors.shape[1], SUB):
            distinct, code = np.unique(vectors[:, at : at + SUB], axis=0, return_inverse=True)
            codes.append(code.reshape(-1))
            entries.append(distinct)
        return cls(np.stack(codes, axis=1).astype(np.uint16), entries)

    def decode(self) -> np.ndarray:
        return np.concatenate([e[self.codes[:, b]] for b, e in enumerate(self.entries)], axis=1)

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's nearest centroid, the smaller number on ties, and its squared distance."""
        tables, at = [], 0
        for distinct in self.entries:
            apart = distinct[:, None, :] - centroids[None, :, at : at + distinct.shape[1]]
            tables.append((apart * apart).sum(axis=2))
            at += distinct.shape[1]
        cluster = np.empty(len(self.codes), dtype=np.int64)
        distance = np.empty(len(self.codes), dtype=np.int64)
        for start in range(0, len(self.codes), STEP_ROWS):
            codes = self.codes[start : start + STEP_ROWS]
            total = np.zeros((len(codes), len(centroids)), dtype=np.int64)
            for b, table in enumerate(tables):
                total += table[codes[:, b]]
            best = total.argmin(axis=1)
            cluster[start : start + len(codes)] = best
            distance[start : start + len(codes)] = total[np.arange(len(codes)), best]
        return cluster, distance

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Per cluster the sum of its vectors: how often each code occurs, times its entry."""
        parts = []
        for b, distinct in enumerate(self.entries):
            cells = cluster * len(distinct) + self.codes[:, b]
            often = np.bincount(cells, minlength=k * len(distinct)).reshape(k, len(distinct))
            parts.append(often @ distinct)
        return np.concatenate(parts, axis=1)

    def row(self, vec_ids: pa.Array) -> dict[str, bytes]:
        return {
            "vec_ids": vec_ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
            "missing": vec_ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
            "codes": self.codes.tobytes(),
            "entries": b"".join(e.tobytes() for e in self.entries),
            "counts": np.array([e.shape for e in self.entries], dtype=np.int64).tobytes(),
        }

    @classmethod
    def from_row(cls, row: dict[str, bytes]) -> Page:
        shapes = np.frombuffer(row["counts"], dtype=np.int64).reshape(-1, 2)
        flat = np.frombuffer(row["entries"], dtype=np.int64)
        ends = np.cumsum(shapes.prod(axis=1))
        entries = [part.reshape(shape) for part, shape in zip(np.split(flat, ends[:-1]), shapes)]
        return cls(np.frombuffer(row["codes"], dtype=np.uint16).reshape(-1, len(shapes)), entries)


def dictionary_pages(vectors: DataFrame, dimensions: int, scale: int) -> DataFrame:
    """Pages of up to `PAGE_ROWS` of the vectors that a task reads, each a row; no exchange."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        ids: list[pa.Array] = []
        size = 0

        def page() -> pa.RecordBatch:
            packed = Page.encode(np.concatenate(held))
            return pa.RecordBatch.from_pylist([packed.row(pa.concat_arrays(ids))])

        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, PAGE_ROWS - size)
                held.append(_quantize(_matrix(part.column(1), dimensions), scale))
                ids.append(part.column(0).cast(pa.int64()))
                start, size = start + part.num_rows, size + part.num_rows
                if size == PAGE_ROWS:
                    yield page()
                    held, ids, size = [], [], 0
        if size:
            yield page()

    return vectors.select("vec_id", "embedding").mapInArrow(pack, _PAGE)


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Page]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield row, Page.from_row(row)


def _new_centroids(pages: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid replaced by its vectors' floored mean; one without vectors stays."""
    k, dimensions = centroids.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dimensions), dtype=np.int64)
        for _, page in _pages(batches):
            cluster, _ = page.nearest(centroids)
            count += np.bincount(cluster, minlength=k)
            sums += page.sums(cluster, k)
        columns = [pa.array(range(k), pa.int32()), pa.array(count), pa.array(sums.tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    # Sums of many tasks may pass 64 bits; decimals of 38 digits hold them.
    found = pages.mapInArrow(partial, "cluster int, n long, sums array<long>").groupBy("cluster").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(dimensions)]).alias("sums"),
    )
    moved = centroids.copy()
    for row in found.filter("n > 0").collect():  # one row per centroid
        moved[row.cluster] = [int(s) // row.n for s in row.sums]
    return moved


def _seeds(vectors: DataFrame, k: int, scale: int, salt: str) -> np.ndarray:
    """The vectors whose identifier has the smallest digests, as the first centroids."""
    digest = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = vectors.select(digest.alias("digest"), "embedding").orderBy(F.col("digest").asc_nulls_last(), "embedding")
    rows = first.limit(k).collect()
    return _quantize(np.array([r.embedding for r in rows], dtype=np.float64), scale)


def cluster_vectors(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dimensions: int = 64, scale: int = 64, salt: str = "1:"
) -> DataFrame:
    """`vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256` of each whole vector.

    Component x counts as floor(`scale` * x). The first centroids are the vectors with the
    smallest SHA-256 of `salt` and identifier; equal identifiers are ordered by components,
    missing ones come last. Each round assigns and replaces, then vectors are assigned once
    more. Vectors of another length and those with null, NaN or infinite components are
    left out; repeated rows all count; with fewer than `k` vectors there are fewer centroids,
    with none no rows. Components beyond `LARGEST` / `scale` are an error. Sums of distances
    beyond 64 bits are one, too.
    """
    spark = vectors.sparkSession
    kept = whole_vectors(vectors, dimensions)
    schema = "vec_id long, cluster int, distance long"
    result = schema + ", cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = _seeds(kept, k, scale, salt)
    if not len(centroids):
        return kept.select(
            "vec_id", *(F.lit(None).cast(t).alias(n) for n, t in (c.split() for c in result.split(", ")[1:]))
        ).limit(0)
    pages = staged(dictionary_pages(kept, dimensions, scale), "centroid-pages")
    for _ in range(rounds):
        centroids = _new_centroids(pages, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, page in _pages(batches):
            cluster, distance = page.nearest(centroids)
            ids = np.frombuffer(row["vec_ids"], dtype=np.int64)
            missing = np.frombuffer(row["missing"], dtype=bool)
            columns = [pa.array(ids, mask=missing), pa.array(cluster.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    assigned = staged(pages.mapInArrow(assign, schema), "centroid-assigned")
    spread = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"))
    by_cluster = {r.cluster: int(r.inertia) for r in spread.collect()}  # one row per centroid
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame(
        [(c, by_cluster[c], sum(by_cluster.values()), digests[c]) for c in sorted(by_cluster)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", *(c.split()[0] for c in result.split(", ")[1:]))
