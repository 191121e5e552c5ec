"""Centroid clustering of whole-number vectors, in column expressions only.

Components become integers once and are staged.  A round reads them, takes each vector's squared distance to every
centroid with ``zip_with`` and ``aggregate`` against literal arrays, the nearest centroid as the least
``(distance, number)``, and the column sums of each cluster by one aggregate whose partial sums are taken before the
shuffle: ``k`` rows a task travel, ``k`` rows come back, and a cluster may hold any share of all vectors.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from hirelens.llm.common import stage


@dataclass
class Clustering:
    """Final centroids, and a staged row ``(id, cluster, distance)`` per vector."""

    centroids: list[list[int]]
    rows: DataFrame
    inertia: list[int]  # per cluster: the sum of its distances


def whole_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``(id, v)`` of the usable vectors, ``v`` holding ``floor(scale * x)`` of every component."""
    x = F.col("x")
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    doubles = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].cast("array<double>").alias("x"))
    return doubles.filter((F.size(x) == dims) & finite).select("id", F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c)).alias("v"))


def _literal(numbers: list[int]) -> Column:
    """An array literal; as one text, because a call to the driver's JVM per number takes longer than a round."""
    return F.expr(f"CAST(array({', '.join(map(str, numbers))}) AS array<bigint>)")


def nearest(centroids: list[list[int]], v: Column) -> Column:
    """The struct ``(distance, cluster)`` with the least distance to ``v``; of equal ones the smaller number."""
    return F.array_min(F.array(*[
        F.struct(
            F.aggregate(F.zip_with(v, _literal(c), lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"),
                        lambda total, d: total + d).alias("distance"),
            F.lit(number).alias("cluster"),
        )
        for number, c in enumerate(centroids)
    ]))


def _moved(rows: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """Every centroid replaced by the floor of its vectors' mean; those without vectors stay."""
    at = rows.select("v", nearest(centroids, F.col("v"))["cluster"].alias("cluster"))
    sums = at.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims)])
    moved = list(centroids)
    for cluster, n, *totals in sums.collect():  # one row per centroid
        moved[cluster] = [total // n for total in totals]
    return moved


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> Clustering:
    """``rounds`` rounds of k-means on ``floor(scale * x)``, then one more assignment.

    The first centroids are the ``k`` vectors with the smallest SHA-256 of ``seed:id``, in that order.  Vectors that are
    null, of another length, or hold null or non-finite components are left out.  Repeated rows are vectors of their
    own; a null id begins a centroid only if there are too few others; of equal hashes the smaller vector comes
    first.  Fewer vectors than ``k`` give as many centroids, an empty table none.  Other columns are ignored.
    Components are refused beyond the size at which a squared distance still fits 64 bits.
    """
    seen = Observation()
    largest = F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v"))))
    rows = stage(whole_vectors(vectors, dims, scale, id_col, vector_col).observe(seen, largest.alias("largest")), "vectors")
    most = 1 << (62 - dims.bit_length()) // 2 - 1
    if (seen.get["largest"] or 0) >= most:
        raise ValueError(f"components reach {seen.get['largest']}; exact distances need less than {most}")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.select("v", order.alias("hash")).orderBy(F.col("hash").asc_nulls_last(), "v").limit(k)
    centroids = [list(r["v"]) for r in first.collect()]
    if not centroids:
        none = rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return Clustering([], none, [])
    for _ in range(rounds):
        centroids = _moved(rows, centroids, dims)
    best = rows.select("id", nearest(centroids, F.col("v")).alias("best"))
    placed = stage(best.select("id", "best.cluster", "best.distance"), "clusters")
    inertia = [0] * len(centroids)
    for cluster, total in placed.groupBy("cluster").agg(F.sum("distance")).collect():
        inertia[cluster] = total
    return Clustering(centroids, placed, inertia)


def cluster_table(made: Clustering, id_col: str = "vec_id") -> DataFrame:
    """Each vector with its cluster, distance, the inertia of its cluster and of all, and its centroid."""
    def of_cluster(values: Column) -> Column:
        return F.get(values, F.col("cluster"))

    centroids = F.array(*map(_literal, made.centroids or [[]]))
    return made.rows.select(
        F.col("id").alias(id_col), "cluster", "distance", of_cluster(_literal(made.inertia)).alias("cluster_inertia"),
        F.lit(sum(made.inertia)).cast("long").alias("inertia"), of_cluster(centroids).alias("centroid"),
    )
