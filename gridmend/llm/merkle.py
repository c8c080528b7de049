"""A Merkle manifest of a table: a tree per source, a tree over the sources, and an inclusion proof per row.

Only every ``STORED``-th level of a tree is persisted, as blocks: the nodes of one level below one ancestor
``STORED`` levels up, at most ``FANOUT ** STORED`` of them. Interior nodes between two stored levels are
regenerated from a block while its proofs are written, and dropped with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridmend.functions.joins import broadcast_if, is_small
from gridmend.llm.tables import numbered, partitions, saved
from gridmend.shipping import ship

FANOUT, STORED = 16, 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "lefts array<string>, rights array<string>, subroot string"
OUTPUT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


class Tree(NamedTuple):
    blocks: list[DataFrame]  # of levels 0, STORED, 2 * STORED, ...
    roots: DataFrame  # (tree, digest)


def leaf_digest(values: Sequence[Column]) -> Column:
    """sha256 of the values, each as byte count, ``:`` and UTF-8 text, or ``-`` if NULL."""
    texts = [v.cast("string") for v in values]
    parts = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def height_of(count: Column) -> Column:
    """Levels above the leaves of a tree until one node remains."""
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(14)), lambda i: F.pow(F.lit(FANOUT), i).cast("long") < count))


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def _above(digests: Column) -> Column:
    """The level over a list of nodes: the digest of every ``FANOUT`` consecutive ones."""
    runs = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(digests, i * FANOUT + 1, FANOUT), ""), 256))


def grow(leaves: DataFrame, name: str) -> Tree:
    """The stored levels over ``leaves`` (tree, position, height, node), ``node`` a struct with ``digest``. Actions, two per stored level."""
    blocks, roots, nodes, base = [], [], leaves, 0
    size = FANOUT**STORED
    while True:
        members = F.transform(F.sort_array(F.collect_list(F.struct("position", "node"))), lambda m: m["node"])
        grouped = nodes.groupBy("tree", F.floor(F.col("position") / size).alias("block")).agg(F.first("height").alias("height"), members.alias("nodes"))
        levels = F.least(F.col("height") - base, F.lit(STORED))
        stored = saved(grouped.withColumn("levels", levels), f"{name}-{base}")
        blocks.append(stored)
        top, tops = F.col("nodes.digest"), []
        for _ in range(STORED + 1):
            tops.append(top[0])
            top = _above(top)
        topped = saved(stored.select("tree", "block", "height", _pick(tops, F.col("levels")).alias("digest")), f"{name}-{base}-tops")
        done = F.col("height") <= base + STORED
        roots.append(topped.where(done).select("tree", "digest"))
        open_nodes = topped.where(~done)
        if open_nodes.isEmpty():
            break
        nodes = open_nodes.select("tree", F.col("block").alias("position"), "height", F.struct("digest").alias("node"))
        base += STORED
    every = roots[0]
    for more in roots[1:]:
        every = every.unionAll(more)
    return Tree(blocks, every)


def _pick(values: Sequence[Column], index: Column) -> Column:
    """values[index], the others not evaluated."""
    chosen = F.when(index == 0, values[0])
    for i, value in enumerate(values[1:], 1):
        chosen = chosen.when(index == i, value)
    return chosen


def _interior(digests: list[str], levels: int) -> list[list[str]]:
    """The block's own level and those between it and the next stored one."""
    found = [digests]
    for _ in range(levels - 1):
        below = found[-1]
        found.append([_digest("".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
    return found


def _paths(digests: list[str], levels: int) -> Iterator[tuple[list[str], list[str]]]:
    """For each node its siblings to the left and to the right, level by level up to the block's top."""
    found = _interior(digests, levels) if levels else []
    sides = []
    for nodes in found:
        starts = [i - i % FANOUT for i in range(len(nodes))]
        sides.append([("".join(nodes[s:i]), "".join(nodes[i + 1 : s + FANOUT])) for i, s in enumerate(starts)])
    for i in range(len(digests)):
        path = [sides[level][i // FANOUT**level] for level in range(len(sides))]
        yield [left for left, _ in path], [right for _, right in path]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The proofs of a block's nodes, one row each, which are the blocks of the stored level below."""
    names = ["tree", "block", "lefts", "rights", "subroot"]
    for row, tree in _with_tree(batches):
        first = row["block"] * FANOUT**STORED
        paths = list(_paths([n["digest"] for n in row["nodes"]], row["levels"]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["tree"]] * len(paths), tree), pa.array(range(first, first + len(paths)), pa.int64()),
             pa.array([left + row["lefts"] for left, _ in paths], pa.list_(pa.string())),
             pa.array([right + row["rights"] for _, right in paths], pa.list_(pa.string())),
             pa.array([row["subroot"]] * len(paths), pa.string())],
            names=names,
        )


def _with_tree(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.DataType]]:
    for batch in batches:
        for row in _rows([batch]):
            yield row, batch.schema.field("tree").type


def _proven(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    """The manifest's rows of a block of leaves: digest of the proof, and the root folded from the leaf as found now."""
    for row in _rows(batches):
        nodes, above = row["nodes"], list(zip(row["lefts"], row["rights"]))
        columns: list[list] = [[], [], [], []]
        for node, (lefts, rights) in zip(nodes, _paths([n["digest"] for n in nodes], row["levels"])):
            path = [*zip(lefts, rights), *above]
            folded = node["found"] or node["digest"]
            for left, right in path:
                folded = _digest(left + folded + right)
            for values, value in zip(columns, (node["key"], node["digest"], _digest("".join(a + b for a, b in path)), folded)):
                values.append(value)
        keys, leaves, proofs, roots = columns
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(leaves, pa.string()), pa.array([row["subroot"]] * len(keys), pa.string()),
             pa.array([root] * len(keys), pa.string()), pa.array(proofs, pa.string()), pa.array(roots, pa.string()),
             pa.array([r == root for r in roots])],
            names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
        )


def descend(tree: Tree, above: DataFrame) -> DataFrame:
    """The blocks of leaves, each with the proof of its top: siblings from there to the end of ``above``.

    ``above`` (tree, lefts, rights, subroot) has one row per tree: the proof that goes on over its root.
    """
    of_tree = above.withColumnRenamed("tree", "_tree")
    kind = above.schema["tree"].dataType.simpleString()
    passed = None
    for level in range(len(tree.blocks) - 1, -1, -1):
        blocks = tree.blocks[level]
        top = F.col("height") <= (level + 1) * STORED
        known = blocks.where(top).join(of_tree, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
        if passed is not None:
            parent = passed.withColumnsRenamed({"tree": "_tree", "block": "_block"})
            same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block"))
            known = known.unionByName(blocks.where(~top).join(parent, same).drop("_tree", "_block"))
        if level == 0:
            return known
        passed = known.select("tree", "block", "levels", "nodes", "lefts", "rights", "subroot").mapInArrow(
            _children, f"tree {kind}, block long, {PROOF}"
        )


def _positions(leaves: DataFrame, by: Sequence[str]) -> DataFrame:
    """``leaves`` with ``position`` within ``tree`` in the order of ``by`` and the tree's ``count``. An action.

    A range shuffle sorts by tree and ``by``; a written row knows its partition and place there. The runs of
    a tree within a partition, at most partitions + trees, give each run its start.
    """
    spark = leaves.sparkSession
    keyed = leaves.withColumn("salt", F.monotonically_increasing_id())  # parts rows equal in everything else
    order = ["tree", *by, "salt"]
    ordered = keyed.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).drop("salt")
    local = saved(
        ordered.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "merkle-ordered"
    )
    runs = local.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns({"start": F.coalesce(F.sum("n").over(before), F.lit(0)), "count": F.sum("n").over(Window.partitionBy("tree"))})
    runs = saved(runs.select(F.col("tree").alias("_tree"), F.col("part").alias("_part"), "first", "start", "count"), "merkle-runs")
    same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("part") == F.col("_part"))
    placed = local.join(broadcast_if(is_small(runs), runs), same)
    return placed.withColumn("position", F.col("start") + F.col("at") - F.col("first")).drop("_tree", "_part", "part", "at", "first", "start")


def manifest(rows: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Leaf, subroot, root, digest of the proof and the result of verifying it, for every row of documents. Actions.

    A proof holds the siblings level by level, left to right, from the leaf over its source's root to the
    root. It is checked against the row as it is found now: ``tampered`` (a text column of ``rows``, if there)
    takes the place of ``text`` then. Sources order bytewise, NULL first; leaves by ``doc_id``, NULL first, then by digest, so
    equal rows stand side by side and each has its own proof. Every column may be NULL; texts of any length
    are hashed whole; an empty table gives no rows. Other columns are not read.
    """
    spark = rows.sparkSession
    ship(spark)
    own = [F.col(c) for c in FIELDS]
    digest = leaf_digest(own)
    now = F.lit(None).cast("string")
    if "tampered" in rows.columns:
        now = F.when(~F.col("tampered").eqNullSafe(F.col("text")), leaf_digest([*own[:-1], F.col("tampered")]))
    leaves = saved(rows.select(F.col("source").alias("tree"), F.col("doc_id").alias("key"), digest.alias("digest"), now.alias("found")), "merkle-leaves")
    placed = _positions(leaves, ["key", "digest"])
    node = F.struct("digest", "key", "found")
    of_sources = grow(placed.select("tree", "position", height_of(F.col("count")).alias("height"), node.alias("node")), "merkle")
    roots = numbered(of_sources.roots.withColumnRenamed("tree", "source"), ["source"], "merkle-roots")
    count = roots.count()
    if not count:
        return spark.createDataFrame([], OUTPUT)
    sources = roots.select(
        F.lit(0).alias("tree"), "position", height_of(F.lit(count)).alias("height"), F.struct("digest", "source").alias("node")
    )
    of_all = grow(sources, "merkle-sources")
    root = of_all.roots.first()["digest"]
    nothing = F.array().cast("array<string>")
    start = spark.range(1).select(F.lit(0).alias("tree"), nothing.alias("lefts"), nothing.alias("rights"), F.lit(None).cast("string").alias("subroot"))
    over_sources = descend(of_all, start).mapInArrow(_source_proofs, f"tree string, {PROOF}")

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _proven(batches, root)

    return descend(of_sources, saved(over_sources, "merkle-over")).select("levels", "nodes", "lefts", "rights", "subroot").mapInArrow(prove, OUTPUT)


def _source_proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The proof of each source's root in the tree over all sources."""
    for row in _rows(batches):
        nodes = row["nodes"]
        paths = list(_paths([n["digest"] for n in nodes], row["levels"]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([n["source"] for n in nodes], pa.string()), pa.array([left + row["lefts"] for left, _ in paths], pa.list_(pa.string())),
             pa.array([right + row["rights"] for _, right in paths], pa.list_(pa.string())), pa.array([n["digest"] for n in nodes], pa.string())],
            names=["tree", "lefts", "rights", "subroot"],
        )


def tampered(doc_id: Column, text: Column, one_in: int = 5) -> Column:
    """``text`` with its A-Z lower-cased where ``one_in`` divides the id's crc32; rows without an id stay."""
    chosen = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % one_in == 0, F.lit(False))
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(chosen, F.translate(text, capitals, capitals.lower())).otherwise(text)


def sql(documents: str = "documents", leaf_levels: int = 7, source_levels: int = 4) -> str:
    """DuckDB SQL for :func:`manifest` with every level at hand, for up to 16 ** leaf_levels rows of a source and 16 ** source_levels sources."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def leaf(text: str) -> str:
        values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    steps = "list_reduce(range(8), lambda c, i: xor(c >> 1, (c & 1) * 3988292384), xor(a, b))"
    crc = f"xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT), lambda a, b: {steps}, 4294967295::BIGINT), 4294967295)"
    low = f"CASE WHEN ({crc}) % 5 = 0 THEN translate(text, '{capitals}', '{capitals.lower()}') ELSE text END"
    parts = [
        f"l AS MATERIALIZED (SELECT doc_id, coalesce('s' || source, '') AS g, {leaf('text')} AS d, {leaf(low)} AS found FROM {documents})",
        "t0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM l)",
    ]

    def tree(name: str, levels: int) -> None:
        for k in range(levels):
            left = f"((n + {16**k - 1}) // {16**k})"
            parts.append(
                f"{name}r{k} AS MATERIALIZED (SELECT g, p // 16 AS run, min(n) AS n, list(d ORDER BY p) AS ds FROM {name}{k} GROUP BY g, run)"
            )
            over = f"CASE WHEN {left} = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END"
            parts.append(f"{name}{k + 1} AS MATERIALIZED (SELECT g, run AS p, n, {over} AS d FROM {name}r{k})")

    def climb(name: str, levels: int, source: str, position: str, group: str) -> None:
        """Adds siblings and the folded digest level by level, as a chain of selections over ``source``."""
        before = source
        for k in range(levels):
            at = f"({position} // {16**k})"
            more = f"((r.n + {16**k - 1}) // {16**k}) > 1"
            left, right = f"array_to_string(r.ds[:{at} % 16], '')", f"array_to_string(r.ds[{at} % 16 + 2:], '')"
            parts.append(
                f"{name}p{k} AS MATERIALIZED (SELECT b.* EXCLUDE (proof, acc), b.proof || CASE WHEN {more} THEN {left} || {right} ELSE '' END AS proof, "
                f"CASE WHEN {more} THEN sha256({left} || b.acc || {right}) ELSE b.acc END AS acc "
                f"FROM {before} b JOIN {name}r{k} r ON r.g = {group} AND r.run = {at} // 16)"
            )
            before = f"{name}p{k}"

    tree("t", leaf_levels)
    parts.append(
        f"u0 AS MATERIALIZED (SELECT '' AS g, g AS own, d, row_number() OVER (ORDER BY g) - 1 AS p, count(*) OVER () AS n FROM t{leaf_levels})"
    )
    tree("u", source_levels)
    parts.append("b0 AS MATERIALIZED (SELECT t0.*, u0.p AS q, u0.d AS subroot, '' AS proof, found AS acc FROM t0 JOIN u0 ON u0.own = t0.g)")
    climb("t", leaf_levels, "b0", "b.p", "b.g")
    climb("u", source_levels, f"tp{leaf_levels - 1}", "b.q", "''")
    return (
        "WITH " + ",\n".join(parts)
        + f"\nSELECT b.doc_id, t0.d AS leaf, b.subroot, r.d AS root, sha256(b.proof) AS proof_sha256, b.acc AS folded_root, b.acc = r.d AS verified "
        + f"FROM up{source_levels - 1} b JOIN t0 ON t0.g = b.g AND t0.p = b.p CROSS JOIN u{source_levels} r"
    )
