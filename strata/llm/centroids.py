"""Centroid clustering by equal-average equal-variance search, in exact integers (operator 12).

Vectors become integers, ``floor(scale * x)``. In every round each vector looks for its nearest
centroid among the centroids sorted by component sum (the mean times the dimension): it starts
at its own sum and goes outward, the nearer side first. With S the sum and
V = dims * (sum of squares) - S**2 of a vector,

    dims * distance >= (S_x - S_c)**2                                   (mean inequality)
    dims * distance >= (S_x - S_c)**2 + (sqrt(V_x) - sqrt(V_c))**2      (deviation inequality)

so the search of a vector ends as soon as the first exceeds its best distance, since all
centroids further out lie farther still, and a centroid that only the second rejects is
skipped. The rest are measured in 64-bit integers: no result depends on rounding, and equal
distances go to the smaller number.

A round is one pass over the vectors, which are written once, as integers. A task sends one row
of exact sums for each centroid; the driver holds the centroids alone (``clusters`` x ``dims``
numbers, both parameters), and they go to the tasks with the function.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise

DIMS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2


def largest_component(dims: int) -> int:
    """Components below this, either way, keep ``dims**2 * (2 * component)**2`` within 2**62, so
    that every number of the search fits 64 bits."""
    return (1 << 30) // dims


def _deviation(x: np.ndarray) -> np.ndarray:
    """floor(sqrt(dims * sum of squares - sum**2)) of each row."""
    spread = x.shape[1] * (x * x).sum(axis=1) - x.sum(axis=1) ** 2
    root = np.sqrt(spread.astype(np.float64)).astype(np.int64)
    root -= root * root > spread
    root += (root + 1) ** 2 <= spread
    return root


class Search:
    """Centroids (rows of int64), sorted by component sum for the outward scan."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.sums = sums[self.number]
        self.values = centroids[self.number]
        self.deviations = _deviation(self.values)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each row of ``x`` the number of its nearest centroid (the smaller of equals) and
        the squared distance; and how many distances were measured in all."""
        rows, dims, count = len(x), x.shape[1], len(self.sums)
        far, none = np.int64(1) << 31, np.int64((1 << 62) // dims)
        sums, deviations = x.sum(axis=1), _deviation(x)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best, chosen = np.full(rows, none), np.full(rows, count)
        live, measured = np.arange(rows), 0
        while len(live):
            down, up = left[live], right[live]
            below = np.where(down >= 0, sums[live] - self.sums[down], far)
            above = np.where(up < count, self.sums[np.minimum(up, count - 1)] - sums[live], far)
            go_down, gap = below <= above, np.minimum(below, above)
            on = (gap < far) & (gap * gap <= dims * best[live])
            live, gap, go_down = live[on], gap[on], go_down[on]
            place = np.where(go_down, down[on], up[on])
            left[live] -= go_down
            right[live] += ~go_down
            # floors are less than one apart from the roots, so this never exceeds their distance
            apart = np.maximum(np.abs(deviations[live] - self.deviations[place]) - 1, 0)
            near = gap * gap + apart * apart <= dims * best[live]
            at, place = live[near], place[near]
            distance = ((x[at] - self.values[place]) ** 2).sum(axis=1)
            number = self.number[place]
            better = (distance < best[at]) | ((distance == best[at]) & (number < chosen[at]))
            best[at[better]], chosen[at[better]] = distance[better], number[better]
            measured += len(at)
        return chosen, best, measured


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int,
                 scale: int) -> DataFrame:
    """Columns id and v: the integer vectors of the rows with ``dims`` components, none null or
    non-finite. A component that is too large for exact 64-bit distances raises an error."""
    value = F.col("x")
    fine = F.forall(value, lambda c: F.coalesce(
        ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    limit = largest_component(dims)
    scaled = F.transform(value, lambda c: c.cast("double") * F.lit(float(scale)))
    too_large = F.exists(scaled, lambda c: F.abs(c) >= F.lit(float(limit)))
    message = F.concat(F.lit("a component of vector "), F.coalesce(F.col("id").cast("string"), F.lit("null")),
                       F.lit(f" is not below {limit / scale}"))
    whole = F.transform(scaled, lambda c: F.floor(c).cast("int"))
    rows = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].alias("x"))
    return rows.where((F.size(value) == dims) & fine).select(
        "id", F.when(too_large, F.raise_error(message)).otherwise(whole).alias("v"))


def _start_order(seed: int) -> Column:
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    return F.sha2(text.cast("binary"), 256)


def _sums(search: Search, dims: int, count: int):
    """The task of a round: its vectors' sums by centroid."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((count, dims), np.int64), np.zeros(count, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"), dims)
            cluster, _, _ = search.nearest(x)
            order = np.argsort(cluster, kind="stable")
            found, starts = np.unique(cluster[order], return_index=True)
            total[found] += np.add.reduceat(x[order], starts, axis=0)
            n += np.bincount(cluster, minlength=count)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict(
            {"cluster": at.astype(np.int32), "n": n[at],
             **{f"s{d}": total[at, d] for d in range(dims)}})
    return run


def _assign(search: Search, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cluster, distance, _ = search.nearest(_matrix(batch.column("v"), dims))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                ["id", "cluster", "distance"])
    return run


@dataclass
class Clustering:
    """``members``: id (named as in the input), cluster, distance; one row per kept vector.
    ``centroids``: one row of integers for each cluster, as the last round left them."""

    members: DataFrame
    centroids: np.ndarray


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
            dims: int = DIMS, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE,
            seed: int = SEED) -> Clustering:
    """Cluster the kept vectors (see ``kept_vectors``) around ``clusters`` centroids.

    Centroids start as the kept vectors with the smallest sha256 of ``seed:id`` (a null id is
    empty; equal ids by their components), in that order; fewer vectors than ``clusters`` give
    as many centroids. Each round assigns all vectors and replaces each centroid that has any by
    the floor of their mean, component by component; then they are assigned once more. Repeated
    rows each count. Rows that are not kept, and other columns, do not appear; no kept row gives
    no members and no centroids.
    """
    spark = vectors.sparkSession
    kept = materialise(kept_vectors(vectors, id_col, vector_col, dims, scale), "whole-vectors")
    first = kept.select(_start_order(seed).alias("h"), "v").orderBy("h", "v").limit(clusters)
    centroids = np.array([r.v for r in first.collect()], np.int64).reshape(-1, dims)
    types = f"{id_col} {kept.schema['id'].dataType.simpleString()}, cluster int, distance bigint"
    if not len(centroids):
        return Clustering(spark.createDataFrame([], types), centroids)
    names = [f"s{d}" for d in range(dims)]
    partial = "cluster int, n bigint, " + ", ".join(f"{s} bigint" for s in names)
    for _ in range(rounds):
        sums = kept.select("v").mapInArrow(_sums(Search(centroids), dims, len(centroids)), partial)
        for r in sums.groupBy("cluster").agg(F.sum("n").alias("n"),
                                             *[F.sum(s).alias(s) for s in names]).collect():
            centroids[r.cluster] = [r[s] // r.n for s in names]
    members = kept.mapInArrow(_assign(Search(centroids), dims), types.replace(id_col, "id", 1))
    return Clustering(members.withColumnRenamed("id", id_col), centroids)


def with_inertia(found: Clustering) -> DataFrame:
    """The members with cluster_inertia and inertia (distances summed over the cluster and over
    all) and centroid_sha256 (of the final centroid's components, joined by commas)."""
    spark = found.members.sparkSession
    members = materialise(found.members, "clustered")
    shas = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for i, c in enumerate(found.centroids.tolist())]
    sums = members.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    inertia, sha = sum(r.cluster_inertia for r in sums), dict(shas)
    facts = spark.createDataFrame(
        [(r.cluster, r.cluster_inertia, inertia, sha[r.cluster]) for r in sums],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # a row for each cluster: their number is a parameter
    return members.join(F.broadcast(facts), "cluster")
