"""Nearest neighbours by multi-index hashing: learned binary codes, found by their substrings, reranked as floats."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridmend.llm import vectors
from gridmend.llm.tables import saved
from gridmend.shipping import ship

#: The rotation and the radius are fitted on at most so many vectors; every vector is indexed.
SAMPLE, RECALL, ROUNDS, BLOCK, QUERIES, SEED = 10_000, 0.98, 30, 8192, 1024, 5
POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


@dataclass
class Codes:
    """Signs of rotated vectors, eight to a byte; a byte is a substring of the index. ``radius``: of the search."""

    centre: np.ndarray
    rotation: np.ndarray
    radius: int = 0

    def of(self, x: np.ndarray) -> np.ndarray:
        return np.packbits((x - self.centre) @ self.rotation > 0, axis=1)


def distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return POPCOUNT[codes ^ code].sum(axis=1, dtype=np.int64)


def fit(sample: np.ndarray, k: int, recall: float = RECALL) -> Codes:
    """Iterative quantization: principal axes, then alternately the signs and the rotation nearest to them.

    The radius is the Hamming distance within which ``recall`` of the sampled queries' true ``k`` nearest in the sample lie; in the
    whole table the nearest are nearer.
    """
    rng = np.random.default_rng(SEED)
    centre = sample.mean(axis=0)
    x, dim = sample - centre, sample.shape[1]
    bits = max(8, dim // 8 * 8)
    if dim >= 8:
        axes = np.linalg.eigh(np.cov(x.T))[1][:, ::-1][:, :bits]
        rotation = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
        for _ in range(ROUNDS):
            projected = x @ axes
            left, _, right = np.linalg.svd(np.where(projected @ rotation > 0, 1.0, -1.0).T @ projected)
            rotation = (left @ right).T
        codes = Codes(centre, axes @ rotation)
    else:
        codes = Codes(centre, rng.normal(size=(dim, bits)))
    all_codes, far = codes.of(sample), []
    for q in range(0, min(len(sample), 500)):
        near = np.argsort(((sample - sample[q]) ** 2).sum(axis=1), kind="stable")[1 : k + 1]
        far.extend(distances(all_codes[near], all_codes[q]).tolist())
    codes.radius = int(np.sort(far)[min(len(far) - 1, int(np.ceil(recall * len(far))))]) if far else bits
    return codes


class Tables:
    """The substring tables of a block of codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(c, kind="stable") for c in codes.T]
        self.starts = [np.searchsorted(c[o], np.arange(257)) for c, o in zip(codes.T, self.order)]
        self.flips = [np.flatnonzero(POPCOUNT <= r).astype(np.uint8) for r in range(9)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code differs from ``code`` in at most ``radius`` bits.

        By the pigeonhole principle one of their m substrings differs in at most radius // m bits, so only the
        buckets that near are probed in each table, and the codes found there are compared whole.
        """
        found = np.zeros(len(self.codes), bool)
        for byte, order, starts in zip(code, self.order, self.starts):
            for value in byte ^ self.flips[min(8, radius // len(code))]:
                found[order[starts[value] : starts[value + 1]]] = True
        rows = np.flatnonzero(found)
        return rows[distances(self.codes[rows], code) <= radius]


def searched(block: pa.Table, queries: pa.Table, codes: Codes | None, k: int) -> pa.Table:
    """The ``k`` best rows of a block for each query. The radius grows while it holds fewer than ``k``."""
    x, y = vectors.matrix(block["embedding"]), vectors.matrix(queries["embedding"])
    ids, asking, home = block["vec_id"].to_numpy(), queries["vec_id"].to_numpy(), queries["query"].to_numpy()
    plain = codes is None or x.shape[1] != len(codes.centre)
    tables = None if plain else Tables(codes.of(x))
    code = None if plain else codes.of(y)
    out: list[tuple[np.ndarray, ...]] = []
    for q in range(len(y)):
        other = ids != asking[q]
        rows = np.flatnonzero(other)
        if not plain:
            radius, most = codes.radius, 8 * code.shape[1]
            while True:
                near = tables.within(code[q], radius)
                near = near[other[near]]
                if len(near) >= min(k, len(rows)) or radius >= most:
                    break
                radius = min(most, radius + max(1, most // 16))
            rows = near
        score = np.sqrt(((x[rows] - y[q]) ** 2).sum(axis=1))
        best = np.lexsort((ids[rows], score))[:k]
        out.append((np.full(len(best), home[q]), np.full(len(best), asking[q]), ids[rows[best]], score[best]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
    return pa.table(dict(zip(("query", "query_id", "vec_id", "score"), columns)))


def search(table: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest rows (Euclidean) of every query row of (vec_id, embedding). Actions.

    All rows but those of the query's own vec_id are candidates; ties go to the smaller vec_id. Equal vectors keep their
    ``k`` + 1 smallest ids, which no result can go beyond. Rows and queries are dealt into blocks by hash; a block of rows with its substring
    tables meets a block of queries, and returns ``k`` rows per query. Rows without a usable vector or vec_id take
    no part; a query row that occurs twice is answered once; vectors of another dimension are not candidates.
    """
    spark = table.sparkSession
    ship(spark)
    good = table.where(vectors.usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    good = good.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), is_query.alias("asks")).distinct()
    good = saved(good.withColumns({"same": F.xxhash64("embedding"), "dim": F.size("embedding")}), "search-rows")
    nth = F.row_number().over(Window.partitionBy("same", "embedding").orderBy("vec_id"))
    rows = good.withColumn("nth", nth).where(F.col("nth") <= k + 1).drop("nth")
    asked = good.where("asks").withColumn("query", F.xxhash64("vec_id", "embedding"))
    total, asking = good.count(), good.where("asks").count()
    some = vectors.sample(good, SAMPLE)
    codes = spark.sparkContext.broadcast(fit(some, k) if len(some) > 1 else None)
    n, m = max(1, -(-total // BLOCK)), max(1, -(-asking // QUERIES))
    deal = lambda blocks: F.pmod(F.xxhash64("vec_id", "same"), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    blocks = rows.select("dim", deal(n).alias("i"), every(m).alias("j"), "vec_id", "embedding").groupBy("dim", "i", "j")
    queries = asked.select("dim", every(n).alias("i"), "query", "vec_id", "embedding", deal(m).alias("j")).groupBy("dim", "i", "j")
    found = blocks.cogroup(queries).applyInArrow(lambda a, b: searched(a, b, codes.value, k), "query long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id")).cast("int")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
