"""Exact k-means over integer vectors by the Shallot search.

Every vector remembers its nearest and second-nearest centroid of the last search, an upper bound
of its distance to the nearest and a lower bound of its distance to all others. Each round moves
the bounds by what the centroids moved. A vector whose bounds do not settle it is searched again:

1. its exact distances to both remembered centroids are computed, and the search starts from the
   closer one;
2. the centroids are scanned in the order of their distance from that start. A centroid farther
   from the start than (distance of the vector to the start) + (its second-best distance so far)
   can be neither nearest nor second nearest, and nor can any later one, so the ball shrinks with
   each better centroid and the scan ends at its edge;
3. all that lie inside the ball are compared by exact integer squared distances; of equal ones the
   smaller number wins.

Bounds are doubles with a margin far above their rounding error, and they only decide what need
not be compared, so results are those of comparing everything.

A round is one pass of Spark over the stored vectors: the new state is written once, and tasks
hand out sums per (centroid, component), which Spark adds up as decimals. Only the centroids
themselves (``K`` by ``DIMENSIONS`` integers) and their sums come to the driver. A vector is never
grouped with others, so any number of equal vectors is fine; the table of the round before is
deleted once the next one is written.

Rules for odd rows: a null vector, one with another number of components, and one with a null,
NaN or infinite component are left out. Components become floor(256 * x) and are held within
plus and minus 2^27 (x beyond half a million), where squared distances still fit a long. Rows with
a null id or a repeated id take part like others, but null ids start no cluster unless all others
do; equal hashes are ordered by the vector. With fewer vectors than ``K`` each of them starts a
cluster; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeloom.llm.tables import columns, discard, keep

DIMENSIONS = 64
K = 40
ROUNDS = 5
SCALE = 256
LIMIT = 1 << 27
#: Relative and absolute margin of the bounds; doubles err by less than a millionth of it.
MARGIN, LEAST = 1e-9, 1e-6

STATE = "id long, v array<int>, cluster int, second int, upper double, lower double, distance long, searched int"
SUMS = "cluster int, n long, total array<long>"
NAMES = ["id", "v", "cluster", "second", "upper", "lower", "distance", "searched"]


def quantised(vectors: DataFrame, id_column: str, vector_column: str, dimensions: int) -> DataFrame:
    """id and v: the usable vectors as integers."""
    rows = columns(vectors, id_column, vector_column)
    x = F.col(f"`{vector_column}`").cast("array<double>")
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    whole = F.transform(x, lambda e: F.floor(F.greatest(F.least(e * SCALE, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))
    # a CASE keeps the conversion from components that are no numbers
    usable = F.size(x).eqNullSafe(dimensions) & F.forall(x, finite)
    return rows.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.when(usable, whole).alias("v")).filter("v is not null")


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors whose ``sha256('<seed>:<id>')`` come first; ``k`` rows at most reach the driver."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    rows = vectors.select(named.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``x`` to the vector or rows ``c``."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def neighbours(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid all centroids by distance, itself among them, and lower bounds of the distances."""
    k = len(centroids)
    far = np.stack([squared(centroids, c) for c in centroids])
    order = np.lexsort((np.broadcast_to(np.arange(k), (k, k)), far), axis=1)
    near = np.sqrt(np.take_along_axis(far, order, axis=1).astype(np.float64))
    return order, near * (1 - MARGIN) - LEAST


class Search:
    """The centroids of a round with what the search needs of them."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None) -> None:
        self.centroids = centroids
        self.order, self.near = neighbours(centroids)
        k = len(centroids)
        if k > 1:
            own = self.order == np.arange(k)[:, None]
            self.half = np.where(own, np.inf, self.near).min(axis=1) / 2
        else:
            self.half = np.full(k, np.inf)
        if before is None:
            self.moved = None
        else:
            moved = np.sqrt(squared(centroids, before).astype(np.float64)) * (1 + MARGIN) + LEAST
            self.moved = moved
            # the farthest move among all other centroids
            top = int(moved.argmax())
            self.others = np.full(k, moved[top])
            self.others[top] = np.delete(moved, top).max(initial=0.0)

    def settled(self, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The moved bounds, and which vectors keep their centroid without a search."""
        upper = upper + self.moved[cluster]
        lower = lower - self.others[cluster]
        reach = np.maximum(lower, self.half[cluster])
        done = upper < reach
        rest = np.flatnonzero(~done)
        exact = np.sqrt(squared(x[rest], self.centroids[cluster[rest]]).astype(np.float64))
        upper[rest] = exact * (1 + MARGIN) + LEAST
        done[rest] = upper[rest] < reach[rest]
        return upper, lower, done

    def find(self, x: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, ...]:
        """Nearest and second-nearest centroid, their squared distances, and comparisons made.

        ``one`` and ``two`` are the remembered centroids; they differ unless there is only one.
        """
        d1, d2 = squared(x, self.centroids[one]), squared(x, self.centroids[two])
        if len(self.centroids) == 1:
            return one.copy(), one.copy(), d1, np.full(len(x), np.iinfo(np.int64).max), np.ones(len(x), np.int32)
        swap = (d2 < d1) | ((d2 == d1) & (two < one))
        best, second = np.where(swap, two, one), np.where(swap, one, two)
        d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
        made = np.full(len(x), 2, np.int32)
        start, other = best.copy(), second.copy()
        by_start = np.argsort(start, kind="stable")
        edges = np.flatnonzero(np.diff(start[by_start], prepend=-1))
        for rows in np.split(by_start, edges[1:]):
            if not len(rows):
                continue
            s = start[rows[0]]
            from_start = np.sqrt(d1[rows].astype(np.float64)) * (1 + MARGIN) + LEAST
            for c, near in zip(self.order[s].tolist(), self.near[s].tolist(), strict=True):
                # the ball ends where the second-best so far can't be reached any more
                inside = near <= from_start + np.sqrt(d2[rows].astype(np.float64)) * (1 + MARGIN) + LEAST
                if not inside.all():
                    rows, from_start = rows[inside], from_start[inside]
                    if not len(rows):
                        break
                if c == s:
                    continue
                new = rows[other[rows] != c]
                d = squared(x[new], self.centroids[c])
                made[new] += 1
                first = (d < d1[new]) | ((d == d1[new]) & (c < best[new]))
                next_ = ~first & ((d < d2[new]) | ((d == d2[new]) & (c < second[new])))
                up, at = new[first], new[next_]
                second[up], d2[up] = best[up], d1[up]
                best[up], d1[up] = c, d[first]
                second[at], d2[at] = c, d[next_]
        return best, second, d1, d2, made


def values_of(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)


def assignment(search: Search, dimensions: int, last: bool):
    """A function for ``mapInArrow`` that gives each vector its centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = values_of(b.column(1), dimensions)
            n, k = len(x), len(search.centroids)
            if b.num_columns == 2:  # the first round: nothing is remembered
                cluster, second = np.zeros(n, np.int64), np.full(n, min(1, k - 1))
                upper, lower, open_ = np.zeros(n), np.zeros(n), np.arange(n)
            else:
                cluster, second = (b.column(i).to_numpy().astype(np.int64) for i in (2, 3))
                upper, lower, done = search.settled(x, cluster, b.column(4).to_numpy(), b.column(5).to_numpy())
                open_ = np.flatnonzero(~done)
            made = np.zeros(n, np.int32)
            if len(open_):
                best, next_, d1, d2, made[open_] = search.find(x[open_], cluster[open_], second[open_])
                cluster[open_], second[open_] = best, next_
                upper[open_] = np.sqrt(d1.astype(np.float64)) * (1 + MARGIN) + LEAST
                lower[open_] = np.sqrt(d2.astype(np.float64)) * (1 - MARGIN) - LEAST
            distance = pa.array(squared(x, search.centroids[cluster])) if last else pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array(cluster.astype(np.int32)),
                    pa.array(second.astype(np.int32)),
                    pa.array(upper),
                    pa.array(lower),
                    distance,
                    pa.array(made),
                ],
                NAMES,
            )

    return run


def summed(k: int, dimensions: int):
    """A function for ``mapInArrow`` that gives each centroid's count and component sums in the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cluster, x = b.column(1).to_numpy(), values_of(b.column(0), dimensions)
            order = np.argsort(cluster, kind="stable")
            at = np.flatnonzero(np.diff(cluster[order], prepend=-1))
            if not len(at):
                continue
            total = np.add.reduceat(x[order], at, axis=0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cluster[order][at], pa.int32()),
                    pa.array(np.diff(at, append=len(order)), pa.int64()),
                    pa.array(list(total), pa.list_(pa.int64())),
                ],
                ["cluster", "n", "total"],
            )

    return run


def moved_centroids(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each non-empty centroid's vectors' floor(sum / count) by component; ``K`` by ``DIMENSIONS`` sums reach the driver."""
    k, dimensions = centroids.shape
    parts = state.select("v", "cluster").mapInArrow(summed(k, dimensions), SUMS)
    sums = (
        parts.select("cluster", "n", F.posexplode("total").alias("place", "x"))
        .groupBy("cluster", "place")
        .agg(F.sum(F.col("x").cast("decimal(28,0)")).alias("total"), F.sum(F.col("n").cast("decimal(28,0)")).alias("n"))
    )
    out = centroids.copy()
    for r in sums.collect():
        out[r.cluster, r.place] = int(r.total) // int(r.n)
    return out


def shallot(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = K,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    seed: int = 2,
) -> tuple[DataFrame, np.ndarray]:
    """id, v, cluster, second, distance and searched of every usable vector, and the centroids.

    ``rounds`` times every vector goes to its nearest centroid and the centroids move; then the
    vectors are assigned once more. ``searched`` counts the exact distances of the last pass.
    """
    state = keep(quantised(vectors, id_column, vector_column, dimensions), "vectors")
    centroids, before = first_centroids(state, k, seed), None
    if not len(centroids):
        empty = state.selectExpr("id", "v", *(f"cast(null as {t}) {c}" for c, t in (x.split() for x in STATE.split(", ")[2:])))
        return empty, centroids
    for r in range(rounds + 1):
        found = state.mapInArrow(assignment(Search(centroids, before), dimensions, r == rounds), STATE)
        after = keep(found, "assigned")
        discard(state)
        state = after
        if r < rounds:
            centroids, before = moved_centroids(state, centroids), centroids
    return state, centroids


def clustered(vectors: DataFrame) -> DataFrame:
    """Every usable vector with its cluster, squared distance, inertias and its centroid's digest."""
    state, centroids = shallot(vectors)
    spark = vectors.sparkSession
    digests = [
        (c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())
    ]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")  # K rows
    of_cluster = state.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = of_cluster.agg(F.sum("cluster_inertia").alias("inertia"))  # one row
    facts = of_cluster.join(named, "cluster").crossJoin(F.broadcast(total))
    rows = state.join(F.broadcast(facts), "cluster")
    return rows.select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "second", "searched"
    )
