"""Near-duplicate vectors by an inverted multi-index: a grid of two codebooks, visited cell by cell, then verified."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmend.functions.joins import broadcast_if, is_small
from gridmend.llm import vectors
from gridmend.llm.tables import components, saved
from gridmend.shipping import ship

#: The codebooks are fitted on at most so many vectors; every vector is indexed. Visits are looked for among the first so many cells, then among more.
SAMPLE, RECALL, FIRST_VISITS, PER_CELL, MOST_CODES, BLOCK, SEED = 20_000, 0.95, 64, 256, 256, 1024, 11
#: Vectors are placed in parts of so many visits.
PLACED = 1 << 20


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def codebook(x: np.ndarray, codes: int) -> np.ndarray:
    """Lloyd's k-means."""
    rng = np.random.default_rng(SEED)
    centres = x[rng.choice(len(x), min(codes, len(x)), replace=False)]
    for _ in range(15):
        near = nearest(x, centres).argmin(axis=1)
        for c in np.unique(near):
            centres[c] = x[near == c].mean(axis=0)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None] - 2 * x @ centres.T


@dataclass
class Grid:
    first: np.ndarray
    second: np.ndarray
    visits: int

    def cells(self, x: np.ndarray, visits: int | None = None) -> np.ndarray:
        """The cells nearest to unit vectors, nearest first, as a multi-sequence traversal meets them.

        A cell's distance is the sum of its two codewords' distances. The k nearest cells only use the k nearest
        codewords of either half, and the pair of ranks (i, j) comes after (i + 1)(j + 1) - 1 others, so few pairs are ranked.
        """
        half = self.first.shape[1]
        visits = min(visits or self.visits, len(self.first) * len(self.second))
        a, b = nearest(x[:, :half], self.first), nearest(x[:, half:], self.second)
        by_a, by_b = a.argsort(axis=1, kind="stable")[:, :visits], b.argsort(axis=1, kind="stable")[:, :visits]
        i, j = (g.ravel() for g in np.meshgrid(np.arange(by_a.shape[1]), np.arange(by_b.shape[1]), indexing="ij"))
        few = (i + 1) * (j + 1) <= visits
        i, j = i[few], j[few]
        far = np.take_along_axis(a, by_a, 1)[:, i] + np.take_along_axis(b, by_b, 1)[:, j]
        order = far.argsort(axis=1, kind="stable")[:, :visits]
        return np.take_along_axis(by_a[:, i] * len(self.second) + by_b[:, j], order, 1)


def ranks(grid: Grid, x: np.ndarray, home: np.ndarray, most: int) -> np.ndarray:
    """The place of cell ``home`` among the ``most`` cells nearest to each vector, or ``most``; in parts of bounded size."""
    part = max(1, PLACED // most)
    out = []
    for i in range(0, len(x), part):
        met = grid.cells(x[i : i + part], most) == home[i : i + part, None]
        out.append(np.where(met.any(1), met.argmax(1), most))
    return np.concatenate(out)


def fit(sample: np.ndarray, rows: int, cosine: float, recall: float = RECALL) -> Grid:
    """Codebooks with about ``PER_CELL`` vectors per cell, and the visits at which ``recall`` of the hardest links are found:
    pairs of a sampled vector and one at exactly the linking cosine from it, either visiting the other's cell."""
    x = unit(sample)
    codes = int(np.clip(np.sqrt(rows / PER_CELL), 2, MOST_CODES))
    half = max(1, x.shape[1] // 2)
    grid = Grid(codebook(x[:, :half], codes), codebook(x[:, half:], codes), 1)
    rng = np.random.default_rng(SEED)
    x = x[:2000]
    aside = rng.normal(size=x.shape)
    aside = aside - (aside * x).sum(1, keepdims=True) * x
    norm = np.sqrt((aside * aside).sum(1, keepdims=True))
    y = cosine * x + np.sqrt(1 - cosine**2) * np.where(norm > 0, aside / np.maximum(norm, 1e-300), 0)
    homes, whole, most = (grid.cells(x, 1)[:, 0], grid.cells(y, 1)[:, 0]), len(grid.first) * len(grid.second), FIRST_VISITS
    while True:
        needed = np.sort(np.minimum(ranks(grid, x, homes[1], most), ranks(grid, y, homes[0], most)))
        last = int(needed[int(np.ceil(recall * len(needed))) - 1])
        if last < most or most >= whole:
            break
        most *= 4
    grid.visits = min(last + 1, whole)
    return grid


def pairs_in(block: pa.Table, cosine: float) -> pa.Table:
    """(node, links, root) of the vectors of a cell's block of residents and of visitors that are linked there.

    A pair is met in one cell or, if each visits the other's cell, in two; a resident only counts the visitors
    whose cell it does not visit itself, so in sum every link counts once on either side.
    """
    guest = np.array(block["guest"].to_pylist(), bool)
    x = unit(vectors.matrix(block["embedding"]))
    node, weight, home = (block[c].to_numpy() for c in ("node", "copies", "home"))
    visits = vectors.matrix(block["visits"])
    here, there = np.flatnonzero(~guest), np.flatnonzero(guest)
    i, j = np.nonzero(x[here] @ x[there].T >= cosine - 1e-12) if len(here) and len(there) else (np.zeros(0, int),) * 2
    i, j = here[i], there[j]
    differ = node[i] != node[j]
    i, j = i[differ], j[differ]
    exact = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
    i, j = i[exact], j[exact]
    links = np.bincount(j, weights=weight[i], minlength=len(node))
    alone = ~(visits[i] == home[j][:, None]).any(axis=1)
    links += np.bincount(i[alone], weights=weight[j[alone]], minlength=len(node))
    root = np.unique(node, return_inverse=True)[1]  # a vector may be both resident and visitor
    i, j = root[i], root[j]
    label = np.arange(root.max() + 1)
    while True:
        least = label.copy()
        np.minimum.at(least, i, label[j])
        np.minimum.at(least, j, label[i])
        least = least[least]
        if np.array_equal(least, label):
            break
        label = least
    known = np.unique(node)
    some = (links > 0) | (known[label[root]] != node)
    return pa.table({"node": node[some], "links": links[some].astype(np.int64), "root": known[label[root]][some]})


def near_duplicates(table: DataFrame, cosine: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, embedding, label). Actions.

    Vectors of equal label (and dimension) link at a cosine of at least ``cosine``. Equal vectors of a label are one node with
    a number of copies (its number is a 64-bit hash), so copies meet in no task. Residents and visitors of a crowded cell
    are dealt into blocks, and a block returns a row per linked vector, not per pair. Rows without a
    usable vector, label or vec_id link with nothing; their component is their own vec_id. Other columns are ignored.
    """
    spark = table.sparkSession
    ship(spark)
    takes_part = vectors.usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    node = F.when(takes_part, F.xxhash64("label", "embedding"))
    rows = saved(table.select("vec_id", "embedding", "label").withColumn("node", node), "dedup-rows")
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.first("label").alias("label"), F.first("embedding").cast("array<double>").alias("embedding"), F.count(F.lit(1)).alias("copies"),
        F.min("vec_id").alias("vec_id"),
    )
    nodes = saved(nodes.withColumn("dim", F.size("embedding")), "dedup-nodes")
    some = vectors.sample(nodes, SAMPLE)
    if not len(some):
        linked = spark.createDataFrame([], "node long, links long, root long")
    else:
        grid = spark.sparkContext.broadcast(fit(some, nodes.count(), cosine))
        dim = some.shape[1]

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = max(1, PLACED // grid.value.visits)
            for batch in (whole.slice(i, step) for whole in batches for i in range(0, whole.num_rows, step)):
                if batch.num_rows:
                    cells = grid.value.cells(unit(vectors.matrix(batch["embedding"])))
                    visits = pa.array(cells.tolist(), pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells[:, 0], pa.int32()), visits], names=[*batch.schema.names, "home", "visits"])

        # Vectors of another dimension share one cell per dimension.
        schema = "node long, label " + dict(nodes.dtypes)["label"] + ", embedding array<double>, copies long, vec_id long, dim int, home int, visits array<int>"
        others = nodes.where(F.col("dim") != dim).withColumns({"home": F.lit(-1), "visits": F.array(F.lit(-1))})
        index = saved(nodes.where(F.col("dim") == dim).mapInArrow(placed, schema).unionByName(others), "dedup-index")
        key = ["label", "dim", "cell"]
        residents, visitors = index.withColumn("cell", F.col("home")), index.withColumn("cell", F.explode("visits"))
        many = residents.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("here"))
        guests = visitors.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("there"))
        sizes = saved(many.join(guests, key), "dedup-sizes")
        sizes = broadcast_if(is_small(sizes), sizes)
        own = lambda blocks: F.pmod(F.col("node"), F.col(blocks)).cast("int")
        every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
        resident = residents.join(sizes, key).withColumns({"guest": F.lit(False), "i": own("here")}).withColumn("j", every("there"))
        visitor = visitors.join(sizes, key).withColumns({"guest": F.lit(True), "j": own("there")}).withColumn("i", every("here"))
        columns = [*key, "i", "j", "guest", "node", "copies", "home", "visits", "embedding"]
        blocks = resident.select(*columns).unionAll(visitor.select(*columns)).groupBy(*key, "i", "j")
        linked = saved(blocks.applyInArrow(lambda block: pairs_in(block, cosine), "node long, links long, root long"), "dedup-linked")
    groups = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")), "dedup-components")
    counted = linked.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.select("node", "copies", "vec_id").join(counted, "node", "left").join(groups, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links")
    named = saved(named.join(least, "component").select(F.col("node").alias("_node"), links, "component_id"), "dedup-named")
    out = rows.select("vec_id", "node").join(named, F.col("node") == F.col("_node"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
