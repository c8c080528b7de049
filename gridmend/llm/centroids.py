"""Lloyd's clustering on integer vectors with an incremental distance matrix.

Squared distances are |v|^2 - 2 v.c + |c|^2. The products v.c of every vector with every centroid are kept
as exact integers beside the vector. After a round only the components of a centroid that changed touch
them, and only vectors that moved touch the sums the centroids are made of.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmend.llm.tables import remove, saved_at
from gridmend.shipping import ship

#: Largest component after scaling for which products, distances and their sums over 64 components fit in 64 bits.
LARGEST = 1 << 26
OUTPUT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def whole_numbers(embedding: Column, dim: int, scale: int) -> Column:
    """floor(scale * x) of every component as integers; NULL for vectors of another length or with NULL or non-finite components.

    Raises for components beyond ``LARGEST``, whose distances a long cannot hold.
    """
    scaled = F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))
    large = F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling")).cast("array<int>")
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    small = F.forall(embedding, lambda x: F.abs(x.cast("double")) * scale < LARGEST)
    return F.when(F.coalesce((F.size(embedding) == dim) & finite, F.lit(False)), F.when(small, scaled.cast("array<int>")).otherwise(large))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _nearest(vectors: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector; the smaller number wins a tie."""
    distances = (vectors * vectors).sum(axis=1)[:, None] - 2 * dots + (centroids * centroids).sum(axis=1)[None, :]
    cluster = distances.argmin(axis=1)
    return cluster, distances[np.arange(len(cluster)), cluster]


def _assign(batches: Iterator[pa.RecordBatch], old: np.ndarray, new: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Bring the products up to date by the changed components, then take the nearest centroid."""
    k, dim = new.shape
    changed = [np.flatnonzero(new[c] != old[c]) for c in range(k)]
    for batch in batches:
        vectors = _matrix(batch.column("v"), dim)
        dots = _matrix(batch.column("dots"), k)
        for c, parts in enumerate(changed):
            if len(parts):
                dots[:, c] += vectors[:, parts] @ (new[c, parts] - old[c, parts])
        cluster, distance = _nearest(vectors, dots, new)
        offsets = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * k)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("v"), pa.ListArray.from_arrays(offsets, pa.array(dots.ravel())),
             pa.array(cluster.astype(np.int32)), batch.column("cluster"), pa.array(distance)],
            names=["vec_id", "v", "dots", "cluster", "before", "distance"],
        )


def _moved_sums(batches: Iterator[pa.RecordBatch], k: int, dim: int) -> Iterator[pa.RecordBatch]:
    """What a partition's moved vectors add to and take from each cluster: one row per cluster."""
    sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
    for batch in batches:
        vectors = _matrix(batch.column("v"), dim)
        to, before = batch.column("cluster").to_numpy(), batch.column("before").to_numpy()
        for c in range(k):
            gained, lost = to == c, before == c
            sums[c] += vectors[gained].sum(axis=0) - vectors[lost].sum(axis=0)
            counts[c] += gained.sum() - lost.sum()
    touched = np.flatnonzero(sums.any(axis=1) | (counts != 0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(touched.astype(np.int32)), pa.array(counts[touched]), pa.array(list(sums[touched]), pa.list_(pa.int64()))],
        names=["cluster", "n", "sums"],
    )


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``, NULL ids last, equal ids by their components. An action."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [r["v"] for r in vectors.select("v", order.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()]


def cluster(embeddings: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """One row per usable vector: its cluster after ``rounds`` rounds, its distance, both inertias and its centroid's hash. Actions.

    Vectors that are NULL, of another length than ``dim`` or with NULL or non-finite components are left out;
    zero vectors take part. Repeated rows each count and are returned each. With fewer than ``k`` vectors
    each is a first centroid; an empty table gives an empty result. Other columns, whatever their names, are
    not read. Rounds end early only when no centroid changed, since the rest would change nothing.

    The state (vector, products, cluster) is written each round and the one before it removed, so two of
    them are on disk at most. The driver holds the centroids: k x dim integers.
    """
    spark = embeddings.sparkSession
    ship(spark)
    kept = embeddings.select("vec_id", whole_numbers(F.col("embedding"), dim, scale).alias("v")).where("v IS NOT NULL")
    start = first_centroids(kept, k, seed)
    if not start:
        return spark.createDataFrame([], OUTPUT)
    new = np.array(start, dtype=np.int64)
    k = len(new)
    old = np.zeros_like(new)  # products with zero vectors are zero
    state = kept.select("vec_id", "v", F.array(*[F.lit(0).cast("long")] * k).alias("dots"), F.lit(-1).alias("cluster"))
    sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
    schema = "vec_id long, v array<int>, dots array<long>, cluster int, before int, distance long"
    path = None
    for turn in range(rounds + 1):
        assigned = state.select("vec_id", "v", "dots", "cluster").mapInArrow(partial(_assign, old=old, new=new), schema)
        done, done_path = saved_at(assigned, f"centroids-{turn}")
        if path:
            remove(spark, path)
        state, path = done, done_path
        if turn == rounds:
            break
        moved = state.where("cluster != before").select("v", "cluster", "before")
        of_partitions = moved.mapInArrow(partial(_moved_sums, k=k, dim=dim), "cluster int, n long, sums array<long>")
        totals = of_partitions.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(dim)]).alias("sums"))
        for row in totals.collect():  # at most k rows
            counts[row["cluster"]] += row["n"]
            sums[row["cluster"]] += np.array(row["sums"])
        old, new = new, new.copy()
        filled = counts > 0
        new[filled] = sums[filled] // counts[filled][:, None]
        if (old == new).all():
            break
    inertias = {r["cluster"]: int(r["d"]) for r in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    digests = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in new]

    def of_cluster(values: list) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1)

    return state.select(
        "vec_id", "cluster", "distance",
        of_cluster([inertias.get(c, 0) for c in range(k)]).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertias.values())).cast("long").alias("inertia"),
        of_cluster(digests).alias("centroid_sha256"),
    )


def sql(embeddings: str = "embeddings", k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """DuckDB SQL for :func:`cluster`, all distances computed anew each round."""
    parts = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v "
        f"FROM {embeddings} WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {dim})",
        "x AS MATERIALIZED (SELECT r, j, v[j] AS x FROM v, range(1, %d) t(j))" % (dim + 1),
        f"f AS MATERIALIZED (SELECT v, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, v) - 1 AS k FROM v)",
        f"c0 AS MATERIALIZED (SELECT k, j, v[j] AS c FROM f, range(1, {dim + 1}) t(j) WHERE k < {k})",
    ]
    for i in range(rounds + 1):
        parts.append(f"d{i} AS MATERIALIZED (SELECT r, k, sum((x - c) * (x - c)) AS d FROM x JOIN c{i} USING (j) GROUP BY r, k)")
        parts.append(f"a{i} AS MATERIALIZED (SELECT r, k, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)")
        if i < rounds:
            mean = "(sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*)"
            parts.append(f"m{i} AS MATERIALIZED (SELECT k, j, ({mean})::BIGINT AS c FROM x JOIN a{i} USING (r) GROUP BY k, j)")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT k, j, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (k, j))")
    last = rounds
    return (
        "WITH " + ",\n".join(parts)
        + f", s AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c{last} GROUP BY k)\n"
        + "SELECT vec_id, k::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, "
        + f"(sum(d) OVER ())::BIGINT AS inertia, centroid_sha256 FROM a{last} JOIN v USING (r) JOIN s USING (k)"
    )
