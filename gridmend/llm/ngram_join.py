"""Jaccard join of documents on word n-grams: exact, by cells of agreeing slices and then pivots within a cell.

Jaccard distance is a metric, so pivots bound distances by the triangle inequality. Unrelated texts, though, are all
about 1 apart, where no bound helps. Cells therefore come first: shingles are dealt by hash into more slices than two
linked sets can differ in, so linked sets agree on a whole slice, and sets that agree on none are never compared.
A cell too large for one task is parted by the rare shingles its sets share (``sharing``).
Within a cell, the sets whose distances do differ, pivots make Voronoi regions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridmend.functions.joins import broadcast_if, is_small
from gridmend.llm import words
from gridmend.llm.tables import Scratch, components, connected, for_rows, small_batches
from gridmend.shipping import ship

GROWTH = 1.37
CELL, CELL_BYTES, PIVOTS, LEAF = 1000, 8 << 20, 8, 64
TEXT_BYTES = 4 << 20  # texts cut into shingles at once
ROUND_PIVOTS, MOST_PARTS, SMALL_ROWS = 1024, 2, 500_000
#: Shingles in ``COMMON`` of a hash sample of so many texts are left out of the slices, which no result depends on.
SAMPLE, COMMON = 4000, 4
ODD = tuple(np.uint64(m) for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * ODD[0]
    x = (x ^ (x >> np.uint64(27))) * ODD[1]
    return x ^ (x >> np.uint64(31))


def name_hashes(names: pa.Array) -> np.ndarray:
    """64 bits of each string: two rounds over its bytes, eight at a time."""
    lengths = pc.binary_length(names).to_numpy(zero_copy_only=False).astype(np.int64)
    blocks = -(-lengths // 8)
    starts = words.offsets(blocks)
    padded = np.zeros(int(starts[-1]) * 8, np.uint8)
    if len(names):
        _, ends, data = names.cast(pa.large_string()).buffers()
        first = np.frombuffer(ends, np.int64)[names.offset : names.offset + len(names)]
        padded[words.ragged(starts[:-1] * 8, lengths)] = np.frombuffer(data or b"", np.uint8)[words.ragged(first, lengths)]
    value = mixed(lengths.astype(np.uint64) + ODD[2])
    eights = padded.view(np.uint64)
    for k in range(int(blocks.max()) if len(blocks) else 0):
        more = np.flatnonzero(blocks > k)
        value[more] = mixed((value[more] * ODD[2]) ^ eights[starts[:-1][more] + k])
    return value


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all sets, each ascending and distinct; sizes). Words are parted by space and tab to carriage
    return, A-Z in lower case; a text with fewer than ``n`` words has them all as its one shingle."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(texts)
    flat = pc.dictionary_encode(pc.list_flatten(split))
    names = flat.dictionary
    hashes = name_hashes(pc.ascii_lower(names))
    empty = pc.equal(pc.binary_length(names), 0).to_numpy(zero_copy_only=False)
    codes, owner = flat.indices.to_numpy(zero_copy_only=False), pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
    full = ~empty[codes]
    value, owner = hashes[codes[full]], owner[full]
    counts = np.bincount(owner, minlength=len(texts))
    at = words.offsets(counts)
    grams = np.zeros(len(value), np.uint64)
    span = np.minimum(np.repeat(at[1:], counts) - np.arange(len(value)), n)
    for k in range(n):
        has = np.flatnonzero(span > k)
        grams[has] = mixed((grams[has] + ODD[2]) * ODD[1] ^ value[has + k])
    first = np.arange(len(value)) == np.repeat(at[:-1], counts)
    keep = (span == n) | (first & (np.repeat(counts, counts) < n))
    grams, owner = grams[keep], owner[keep]
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], np.bincount(owner[new], minlength=len(texts))


def sums_by(group: np.ndarray, values: np.ndarray, groups: int) -> np.ndarray:
    """Sums of 64-bit values by group, modulo 2**64."""
    low = np.bincount(group, weights=(values & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=groups).astype(np.uint64)
    high = np.bincount(group, weights=(values >> np.uint64(32)).astype(np.float64), minlength=groups).astype(np.uint64)
    return low + (high << np.uint64(32))


def bands(most: int) -> np.ndarray:
    """Lower ends of the bands of set sizes, each at most ``GROWTH`` times the one before (or one more)."""
    ends = [1]
    while ends[-1] <= most * 2:
        ends.append(max(ends[-1] + 1, int(ends[-1] * GROWTH)))
    return np.array(ends, np.int64)


def slices_of(low: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(slices, spare ones) of each band but the last: more than its linked sets can differ in, by 1 + spare.

    The spare ones make up for slices that stay empty: few, unless the slices are so small that sets often have some.
    """
    slices, spares = [], []
    for start, end in zip(low[:-1].tolist(), low[1:].tolist()):
        differ = (100 - percent) * 2 * (end - 1) // (100 + percent)
        spare = 1 + differ // 4
        for s in range(1, 2 + differ // 2):
            empty = (differ + 1 + s) * math.exp(-start / (differ + 1 + s))
            if empty + 4 * math.sqrt(empty) <= s:
                spare = s
                break
        slices.append(differ + 1 + spare)
        spares.append(spare)
    return np.array(slices, np.int64), np.array(spares, np.int64)


def common_shingles(texts: DataFrame, n: int) -> np.ndarray:
    """Hashes, ascending, of the shingles that many texts of a sample of ``SAMPLE`` share. An action; bounded by the sample."""
    picked = texts.where("text IS NOT NULL").orderBy("text_hash", "doc_id").limit(SAMPLE).select("text_hash", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, seen = [], set()
        for batch in words.slices(batches, "text"):
            new = [h not in seen and not seen.add(h) for h in batch["text_hash"].to_pylist()]
            found.append(shingle_sets(batch["text"].filter(pa.array(new)), n)[0])
        values, times = np.unique(np.concatenate([*found, np.zeros(0, np.uint64)]), return_counts=True)
        yield pa.RecordBatch.from_pydict({"gram": pa.array(values[times >= COMMON].view(np.int64))})

    rows = picked.repartitionByRange(1, "text_hash").mapInArrow(count, "gram long").toArrow()
    return np.sort(rows["gram"].to_numpy().astype(np.int64).view(np.uint64))


def without(grams: np.ndarray, sizes: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets without the ``common`` shingles, and what is left of their sizes."""
    if not len(common) or not len(grams):
        return grams, sizes
    at = np.minimum(np.searchsorted(common, grams), len(common) - 1)
    rare = common[at] != grams
    return grams[rare], np.bincount(np.repeat(np.arange(len(sizes)), sizes)[rare], minlength=len(sizes))


def slice_keys(grams: np.ndarray, sizes: np.ndarray, percent: int, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(set numbers, keys): two sets whose Jaccard similarity is ``percent`` or more share a key.

    Linked sets of sizes a and b differ in at most (100 - percent) (a + b) / (100 + percent) shingles. A band of
    sizes deals them into so many slices, as its largest sizes allow differences, plus 1 + some spare ones; so
    linked sets agree on 1 + spare whole slices at least. Empty slices, on which strangers agree, are left out
    where a set has no more of them than are spare. A pair meets in the band of its larger set, so a set
    that can be the smaller of a pair in the next band is dealt there too. Without ``common`` shingles
    sets differ in no more than with them, so these can be left out of the slices.
    """
    if not len(sizes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = bands(int(sizes.max()))
    slices_in, spare_in = slices_of(low, percent)
    grams, left = without(grams, sizes, np.zeros(0, np.uint64) if common is None else common)
    band = np.searchsorted(low, sizes, "right") - 1
    all_sets, all_keys = [], []
    for up in (0, 1):
        chosen = np.flatnonzero((sizes > 0) & ((up == 0) | (sizes * 100 // percent >= low[band + 1])))
        k = band[chosen] + up
        slices = slices_in[k]
        starts = words.offsets(slices)
        at = words.offsets(left)[:-1][chosen]
        values = grams[words.ragged(at, left[chosen])]
        row = np.repeat(np.arange(len(chosen)), left[chosen])
        slot = starts[:-1][row] + ((values >> np.uint64(32)) % slices[row].astype(np.uint64)).astype(np.int64)
        held = np.bincount(slot, minlength=int(starts[-1]))
        owner = np.repeat(np.arange(len(chosen)), slices)
        blank = np.bincount(owner, weights=held == 0, minlength=len(chosen))
        number = np.arange(int(starts[-1])) - starts[:-1][owner]
        key = mixed(sums_by(slot, mixed(values), int(starts[-1])) + mixed((k[owner] * 1_000_003 + number).astype(np.uint64) * ODD[2]))
        use = (held > 0) | (blank[owner] > spare_in[k[owner]])
        all_sets.append(chosen[owner[use]])
        all_keys.append(key[use].view(np.int64))
    return np.concatenate(all_sets), np.concatenate(all_keys)


def prefix_rows(grams: np.ndarray, sizes: np.ndarray, percent: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set numbers, shingles, skip) of what can be in a set's prefix: all shingles but common ones and, where these are too few, the first common ones.

    Linked sets share ``percent`` of either at least, so in any order of all shingles each has the first shared one
    among its own first ones, all but that share and one more. The order is rare ones first, ``common`` ones last by their hashes;
    ``skip`` is how many others a set has beyond its prefix, below 0 where the prefix takes common ones.
    """
    starts = words.offsets(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    is_common = np.zeros(len(grams), bool)
    if len(common) and len(grams):
        is_common = common[np.minimum(np.searchsorted(common, grams), len(common) - 1)] == grams
    upto = np.append(0, np.cumsum(is_common))
    commons = upto[starts[1:]] - upto[starts[:-1]]
    skip = (sizes - commons) - (sizes - -(-sizes * percent // 100) + 1)
    number = upto[1:] - upto[starts[:-1]][owner]  # of a common one among those of its set, from 1
    use = ~is_common | (number <= -skip[owner])
    return owner[use], grams[use], skip[owner[use]]


def overlaps(values: np.ndarray, sizes: np.ndarray, chosen: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Shared shingles of the ``chosen`` sets with each of ``rows``; sets are given by small shingle numbers."""
    at = words.offsets(sizes)
    out = np.zeros((len(chosen), len(rows)), np.int64)
    if not len(rows) or not len(chosen):
        return out
    mine = values[words.ragged(at[:-1][rows], sizes[rows])]
    starts = words.offsets(sizes[rows])[:-1]
    mark = np.zeros(int(values.max()) + 1, np.int32)
    for i, c in enumerate(chosen):
        held = values[at[c] : at[c + 1]]
        mark[held] = 1
        out[i] = np.add.reduceat(mark[mine], starts)
        mark[held] = 0
    return out


class Shared:
    """Numbers of shingles that sets share; sets are given by small shingle numbers, each also has the list of sets that hold it."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray):
        self.values, self.sizes, self.at = values, sizes, words.offsets(sizes)
        self.owner = np.repeat(np.arange(len(sizes)), sizes)[np.argsort(values, kind="stable")]
        self.starts = words.offsets(np.bincount(values))
        self.mark = np.zeros(len(self.starts), np.int32)

    def counts(self, one: int, rows: np.ndarray) -> np.ndarray:
        """Of set ``one`` with each of ``rows``, by the lists of its shingles or by theirs, whichever are fewer."""
        held = self.values[self.at[one] : self.at[one + 1]]
        starts, many = self.starts[held], self.starts[held + 1] - self.starts[held]
        if many.sum() <= self.sizes[rows].sum():
            return np.bincount(self.owner[words.ragged(starts, many)], minlength=len(self.sizes))[rows]
        self.mark[held] = 1
        theirs = self.values[words.ragged(self.at[:-1][rows], self.sizes[rows])]
        out = np.add.reduceat(self.mark[theirs], words.offsets(self.sizes[rows])[:-1]) if len(rows) else np.zeros(0, np.int64)
        self.mark[held] = 0
        return out


def linked(values: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Labels of the connected components of a cell's sets, all comparable in one task.

    Regions of sets are joined recursively: ``PIVOTS`` sets are pivots, a set belongs to the region of its
    nearest one and also enters every region whose pivot is no farther than that plus twice the linking
    distance, so every linked pair meets in a region. A region that is not smaller than what it came from, or small,
    is joined directly, where a set is only compared with those not yet known to be connected with it.
    """
    m = len(sizes)
    values = np.unique(values, return_inverse=True)[1]
    label, shared_by = np.arange(m), Shared(values, sizes)
    reach = 1 - percent / 100

    def unite(a: int, others: np.ndarray) -> None:
        found = np.unique(np.append(label[others], label[a]))
        label[np.isin(label, found)] = found[0]

    def similar(chosen: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shared = overlaps(values, sizes, chosen, rows)
        union = sizes[chosen][:, None] + sizes[rows][None] - shared
        return 100 * shared >= percent * union, 1 - shared / union

    def directly(rows: np.ndarray) -> None:
        for i, a in enumerate(rows):
            others = rows[i + 1 :]
            others = others[label[others] != label[a]]
            others = others[np.minimum(sizes[others], sizes[a]) * 100 >= percent * np.maximum(sizes[others], sizes[a])]
            if len(others):
                shared = shared_by.counts(a, others)
                unite(a, others[100 * shared >= percent * (sizes[others] + sizes[a] - shared)])

    def join(rows: np.ndarray) -> None:
        if len(rows) <= LEAF:
            return directly(rows)
        pivots = rows[:: len(rows) // PIVOTS][:PIVOTS]
        near, far = similar(pivots, rows)
        for p, close in zip(pivots, near):
            unite(p, rows[close])
        enters = far <= far.min(axis=0) + 2 * reach + 1e-9
        for region in enters:
            inside = rows[region]
            if len(np.unique(label[inside])) == 1:
                continue
            if len(inside) < 0.8 * len(rows):
                join(inside)
            else:
                directly(inside)

    join(np.arange(m))
    return label


def join(documents: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id, text_hash and component (a node, NULL without shingles) of every document. Actions.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of word ``n``-grams;
    component_id is the smallest doc_id reachable by links. Texts without words (NULL, empty) have no
    shingles and no links. Equal sets are one node, its number 63 bits of a hash of the set.
    Documents with a NULL doc_id link as others do, but give no component its number. Rows may repeat; other columns are ignored.
    """
    with small_batches(documents.sparkSession):
        return _joined(documents, n, percent)


def _joined(documents: DataFrame, n: int, percent: int) -> DataFrame:
    spark, scratch = documents.sparkSession, Scratch(documents.sparkSession)
    ship(spark)
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    common = spark.sparkContext.broadcast(common_shingles(texts, n))

    def node_of(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(sizes)), sizes)
        return (mixed(sums_by(row, mixed(grams), len(sizes)) ^ sizes.astype(np.uint64)) >> np.uint64(1)).astype(np.int64)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text", TEXT_BYTES):
            grams, sizes = shingle_sets(batch["text"], n)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast(pa.int64()), batch["text_hash"], pa.array(sizes, pa.int64()), pa.array(node_of(grams, sizes))],
                names=["doc_id", "text_hash", "n_shingles", "node"],
            )

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text", TEXT_BYTES):
            grams, sizes = shingle_sets(batch["text"], n)
            node = node_of(grams, sizes)
            _, once = np.unique(node, return_index=True)
            some = np.zeros(len(sizes), bool)
            some[once] = True
            sets, keys = slice_keys(grams[np.repeat(some, sizes)], sizes[some], percent, common.value)
            # Within a batch the sets of a key are linked to its first, and the sets so connected stand for each other: one
            # of them goes on with the keys, and the others are linked to that one only.
            order = np.lexsort((sets, keys))
            keys, sets = keys[order], sets[order]
            first = np.ones(len(keys), bool)
            first[1:] = keys[1:] != keys[:-1]
            heads = sets[first][np.cumsum(first) - 1] if len(keys) else sets
            label, nodes = connected(int(some.sum()), heads[~first], sets[~first]), node[some]
            others = np.flatnonzero(label != np.arange(len(label)))
            keys, nodes, pairs = keys[first], nodes[label[sets[first]]], (nodes[label[others]], nodes[others])
            for kind, a, b in ((KEY, keys, nodes), (PAIR, *pairs)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), pa.array(b), pa.array(a)], names=["kind", "node", "other"])

    rows = scratch.saved(texts.mapInArrow(digests, "doc_id long, text_hash long, n_shingles long, node long"), "join-rows")
    # Most keys occur once, so they are never written: each goes through one shuffle, and only meetings come out.
    cells = components(meeting(texts.select("text").mapInArrow(keys_of, "kind tinyint, node long, other long")), "join-cells", scratch)
    # One text of every set that shares a cell with another.
    wanted = rows.where("n_shingles > 0").groupBy("node").agg(F.min("text_hash").alias("text_hash")).join(cells.withColumnRenamed("component", "cell"), "node")
    wanted = scratch.saved(wanted.select("cell", "node", "text_hash"), "join-wanted")
    scratch.drop("join-cells-labels")
    held = texts.select("text", "text_hash").join(broadcast_if(is_small(wanted, SMALL_ROWS), wanted), "text_hash")
    held = held.groupBy("cell", "node").agg(F.min("text").alias("text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text", TEXT_BYTES):
            grams, sizes = shingle_sets(batch["text"], n)
            data, at = grams.tobytes(), words.offsets(sizes) * 8
            yield pa.RecordBatch.from_arrays([batch["cell"], batch["node"], pa.array([data[a:b] for a, b in zip(at, at[1:])], pa.binary())], names=["cell", "node", "grams"])

    members = scratch.saved(held.mapInArrow(sets, "cell long, node long, grams binary"), "join-sets")
    scratch.drop("join-wanted")

    def sizes_of(sets: DataFrame) -> DataFrame:
        sized = sets.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("grams")).alias("bytes"))
        return sized.where("n > 1")

    counts = scratch.saved(sizes_of(members), "join-counts")
    fits = (F.col("n") <= CELL) & (F.col("bytes") <= CELL_BYTES)
    small = members.join(counts.where(fits), "cell").select("cell", "node", "grams")
    wide, large = members.join(counts.where(~fits).select("cell"), "cell"), None
    if not counts.where(~fits).isEmpty():
        cells = components(sharing(wide, percent, common), "join-narrow", scratch).withColumnRenamed("component", "cell")
        narrow = scratch.saved(wide.drop("cell").join(cells, "node").select("cell", "node", "grams"), "join-narrow-sets")
        counts = scratch.saved(sizes_of(narrow), "join-narrow-counts")
        small = small.unionAll(narrow.join(counts.where(fits), "cell").select("cell", "node", "grams"))
        large = narrow.join(counts.where(~fits).select("cell"), "cell")

    def within(batch: pa.Table) -> pa.Table:
        node, grams = batch["node"].to_numpy(), [np.frombuffer(g, np.uint64) for g in batch["grams"].to_pylist()]
        label = linked(np.concatenate(grams), np.array([len(g) for g in grams]), percent)
        return pa.table({"a": pa.array(node[label]), "b": pa.array(node)})

    links = small.groupBy("cell").applyInArrow(within, "a long, b long")
    links = scratch.saved(links.where("a != b"), "join-small-links")  # first, so that the sets of small cells can go
    if large is not None:
        links = links.unionAll(large_cells(large, percent, scratch))
    links = scratch.saved(links, "join-links")
    del small, wide, large, members, held
    scratch.drop("join-sets", "join-counts", "join-small-links", *NARROW_TABLES, *LARGE_TABLES)
    found_components = components(links, "join-components", scratch)
    nodes = rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
    grouped = nodes.join(found_components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    named = scratch.saved(grouped.join(least, "component").select(F.col("node").alias("_node"), "component_id", "component"), "join-named")
    scratch.drop("join-links", "join-components-labels")
    linked_rows = (F.col("node") == F.col("_node")) & (F.col("n_shingles") > 0)
    alone = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    return rows.join(named, linked_rows, "left").select("doc_id", "n_shingles", alone, "text_hash", "component")


KEY, PAIR = 1, 2


def meeting(found: DataFrame) -> DataFrame:
    """(a, b) of nodes that have a slice in common: each key's nodes with its first, from rows sorted by key, and the pairs found before.

    A key has one row per batch at most that holds it, and a task keeps nothing but the key it is at.
    """

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = head = None
        for batch in batches:
            pairs = batch.filter(pa.array(batch["kind"].to_numpy() == PAIR))
            yield pa.RecordBatch.from_arrays([pairs["other"], pairs["node"]], names=["a", "b"])
            batch = batch.filter(pa.array(batch["kind"].to_numpy() == KEY))
            key, node = batch["other"].to_numpy(), batch["node"].to_numpy()
            if not len(key):
                continue
            new = np.append(key[0] != last_key, key[1:] != key[:-1])
            which = np.cumsum(new) - 1
            first = np.where(which >= 0, node[np.flatnonzero(new)][which] if new.any() else 0, 0 if head is None else head)
            last_key, head = key[-1], int(first[-1])
            other = np.unique(np.stack([first, node])[:, first != node], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(other[0]), pa.array(other[1])], names=["a", "b"])

    return found.repartition("other").sortWithinPartitions("kind", "other", "node").mapInArrow(heads, "a long, b long")


def sharing(members: DataFrame, percent: int, common: Broadcast) -> DataFrame:
    """(a, b) that connect the sets of each cell that share a shingle of their prefixes, rare ones first; all linked ones do.

    Sets that share a passage agree on slices by chance, and many such sets chain up to a cell that grows with the table. Its shingles'
    frequencies tell passages apart: a stranger shares none of the rare shingles that make up a prefix. Those
    of one set only are counted and go no further.
    """

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "grams", TEXT_BYTES):
            sets = [np.frombuffer(g, np.uint64) for g in batch["grams"].to_pylist()]
            row, grams, skip = prefix_rows(np.concatenate(sets), np.array([len(g) for g in sets]), percent, common.value)
            cell, node = (batch[c].to_numpy() for c in ("cell", "node"))
            keys = mixed(grams ^ mixed(cell[row].astype(np.uint64) * ODD[2]))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(node[row]), pa.array(skip, pa.int32())], names=["key", "node", "skip"])

    rows = members.select("cell", "node", "grams").mapInArrow(tokens, "key long, node long, skip int")
    shared = rows.withColumn("times", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("times > 1")
    last = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("times"), F.desc("key")))
    prefix = shared.withColumn("last", last).where("last > skip")
    return meeting(prefix.select(F.lit(KEY).cast("tinyint").alias("kind"), "node", F.col("key").alias("other")))


#: Scratch tables of the cells that ``sharing`` parts.
NARROW_TABLES = ("join-narrow-sets", "join-narrow-counts", "join-narrow-labels")

#: What ``large_cells`` leaves in its scratch tables.
LARGE_TABLES = tuple(
    f"join-{t}" for t in ("large", "numbered", "ranges", "picked", "pivots", "places", "base", "asked", "large-links", "large-named", "large-components-labels")
)


def large_cells(members: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) that connect the linked sets of cells too large for one task. Actions, some per round.

    In a round every large cell has up to ``ROUND_PIVOTS`` pivots, twice as many in the next up to ``MOST_PARTS`` times as
    many, and its sets are compared with them, in blocks of about ``CELL`` sets of like sizes and parts of ``ROUND_PIVOTS`` pivots.
    Only blocks that hold sizes a pivot can be linked to meet it, so a round moves little more than the sets once. What a pivot
    connects is never compared again: the next pivots are sets
    outside their cell's largest component that have not been pivots. It ends when there are none; then of any
    two sets in different components one has been compared with the whole cell. By the triangle
    inequality a set can only be linked to a pivot if their distances to the cell's first pivots differ
    by no more than the linking distance, and if their sizes are alike; others are passed over.
    """
    spark = members.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    members = scratch.saved(members, "join-large")
    scratch.drop("join-sets", "join-counts")
    if members.isEmpty():
        return links
    sized = members.select("cell", "node", F.octet_length("grams").alias("bytes"))
    number, upto = (f.over(Window.partitionBy("cell").orderBy("bytes", "node")) for f in (F.row_number(), F.sum("bytes")))
    block = F.greatest(F.floor((number - 1) / CELL), F.floor(upto / CELL_BYTES)).cast("int")
    sets = members.count()
    numbered = scratch.saved(for_rows(sized.withColumn("block", block), sets), "join-numbered")
    ranges = numbered.groupBy("cell", "block").agg(F.min("bytes").alias("low"), F.max("bytes").alias("high"))
    ranges = scratch.saved(for_rows(ranges, sets), "join-ranges")
    base = members.join(broadcast_if(is_small(numbered, SMALL_ROWS), numbered.drop("bytes")), ["cell", "node"])
    base = base.withColumns({"hash": F.xxhash64("node"), "to_first": F.lit(None).cast("array<double>")})
    open_nodes, asked, parts = numbered.select("cell", "node"), None, 1
    while True:
        ranked = F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64("node"), "node"))
        most = PIVOTS if asked is None else ROUND_PIVOTS * parts
        picked = open_nodes.withColumn("rank", ranked).where(F.col("rank") <= most).select("cell", "node", "rank")
        picked = scratch.saved(for_rows(picked, sets), "join-picked")
        if picked.isEmpty():
            return links
        pivots = scratch.saved(for_rows(base.drop("block").join(picked.drop("rank"), ["cell", "node"]), sets, CELL), "join-pivots")
        if asked is None:  # the first pivots, to which every distance is kept
            met = pivots.join(ranges.select("cell", "block"), "cell")
            both = base.groupBy("cell", "block").cogroup(met.groupBy("cell", "block"))
            base = scratch.saved(both.applyInArrow(measured(percent), base.schema), "join-base")
            near = base.select("cell", "node", F.posexplode("to_first").alias("at", "far")).where(F.col("far") <= 1 - percent / 100 + 1e-9)
            first = picked.select("cell", F.col("node").alias("a"), (F.col("rank") - 1).alias("at"))
            found = near.join(first, ["cell", "at"]).select("a", F.col("node").alias("b"))
            asked = scratch.saved(picked.select("node"), "join-asked")
            scratch.drop("join-large")
        else:
            # Pivots meet the blocks that hold sizes like theirs, in parts of so many pivots and of about so many bytes of them.
            alike = (F.col("high") * 100 >= F.col("bytes") * percent) & (F.col("bytes") * 100 >= F.col("low") * percent)
            places = picked.join(numbered.drop("block"), ["cell", "node"]).join(F.broadcast(ranges), "cell").where(alike)
            at, upto = (f.over(Window.partitionBy("cell", "block").orderBy("rank")) for f in (F.row_number(), F.sum("bytes")))
            part = F.greatest(F.floor((at - 1) / ROUND_PIVOTS), F.floor(upto / CELL_BYTES)).cast("int").alias("part")
            places = scratch.saved(for_rows(places.select("cell", "node", "block", part), sets), "join-places")
            met = pivots.drop("hash").join(broadcast_if(is_small(places, SMALL_ROWS), places), ["cell", "node"])
            parts_of = places.select("cell", "block", F.col("part").alias("part")).distinct()  # an alias, so that the sides' columns differ
            blocks = base.drop("hash").join(F.broadcast(parts_of), ["cell", "block"])
            both = blocks.groupBy("cell", "block", "part").cogroup(met.groupBy("cell", "block", "part"))
            found, parts = both.applyInArrow(compared(percent), "a long, b long"), min(2 * parts, MOST_PARTS)
            asked = scratch.saved(asked.unionAll(picked.select("node")), "join-asked")
        links = scratch.saved(links.unionAll(found.where("a != b")), "join-large-links")
        blocks = both = found = pivots = met = places = None  # so that their shuffles can be dropped
        named = base.select("cell", "node").join(components(links, "join-large-components", scratch), "node", "left")
        named = named.select("cell", "node", F.coalesce("component", "node").alias("component"))
        named = scratch.saved(for_rows(named, sets), "join-large-named")
        counted = named.groupBy("cell", "component").agg(F.count(F.lit(1)).alias("n"))
        largest = counted.groupBy("cell").agg(F.max_by("component", F.struct("n", "component")).alias("largest"))
        outside = named.join(largest, "cell").where("component != largest").select("cell", "node")
        open_nodes = outside.join(asked, "node", "left_anti")


def unpacked(block: pa.Table, pivots: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    grams = [np.frombuffer(g, np.uint64) for g in [*block["grams"].to_pylist(), *pivots["grams"].to_pylist()]]
    return np.unique(np.concatenate(grams), return_inverse=True)[1], np.array([len(g) for g in grams])


def measured(percent: int):
    """Distances of a block's sets to the pivots, in the order of the pivots' hashes."""

    def measure(block: pa.Table, pivots: pa.Table) -> pa.Table:
        values, sizes = unpacked(block, pivots)
        rows, chosen = np.arange(len(block)), len(block) + np.array(pivot_order(pivots), np.int64)
        shared = overlaps(values, sizes, chosen, rows)
        far = 1 - shared / (sizes[chosen][:, None] + sizes[rows][None] - shared)
        return block.set_column(block.schema.get_field_index("to_first"), "to_first", pa.array(far.T.tolist(), pa.list_(pa.float64())))

    return measure


def pivot_order(pivots: pa.Table) -> list[int]:
    nodes = pivots["node"].to_pylist()
    return sorted(range(len(nodes)), key=lambda i: (pivots["hash"][i].as_py(), nodes[i]))


def compared(percent: int):
    """(pivot, set) of the linked ones, of those pairs that the first pivots leave possible."""

    def compare(block: pa.Table, pivots: pa.Table) -> pa.Table:
        sizes = (shared_by := Shared(*unpacked(block, pivots))).sizes
        mine, theirs = (np.array(t["to_first"].to_pylist(), float) for t in (block, pivots))
        node, pivot, a, b = block["node"].to_numpy(), pivots["node"].to_numpy(), [], []
        for i in range(len(pivots) if len(block) else 0):
            size = sizes[len(block) + i]
            alike = np.minimum(sizes[: len(block)], size) * 100 >= percent * np.maximum(sizes[: len(block)], size)
            rows = np.flatnonzero(alike & (np.abs(mine - theirs[i]).max(axis=1) <= 1 - percent / 100 + 1e-9))
            shared = shared_by.counts(len(block) + i, rows)
            close = rows[100 * shared >= percent * (sizes[rows] + sizes[len(block) + i] - shared)]
            a.append(np.full(len(close), pivot[i]))
            b.append(node[close])
        return pa.table({"a": np.concatenate(a) if a else np.zeros(0, np.int64), "b": np.concatenate(b) if b else np.zeros(0, np.int64)})

    return compare
