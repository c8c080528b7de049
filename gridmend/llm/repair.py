"""Token ids in shards compressed by Re-Pair grammars, with random access to any document's ids.

The file format is Parquet with one row per shard. Its documents come in ascending order of doc_id
(NULL first): ``doc_ids``, the number of ids of each (``n_tokens``) and the end of each one's symbols
(``symbol_ends``). ``symbols`` holds the symbols of all of them, little-endian, ``width`` bytes each. Symbols below
len(terminals) stand for the token ids in ``terminals``; symbol len(terminals) + r stands for the two symbols
``left[r]``, ``right[r]``, both smaller than itself. ``lengths`` has the number of ids that each symbol expands
to, so the symbol that holds a given id is found without expanding those before it. Rules never reach over the
end of a document. ``part`` numbers the ranges of doc_id, ``shard`` the shards of one, ``at`` counts the ids of the
part before the shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridmend.llm import words
from gridmend.llm.tables import partitions
from gridmend.shipping import ship

SHARD_BYTES = 16 << 20
MIN_COUNT = 4
SCHEMA = (
    "part int, shard int, at long, doc_ids array<bigint>, n_tokens array<bigint>, symbol_ends array<bigint>, width int, symbols binary, "
    "terminals array<int>, left array<int>, right array<int>, lengths array<bigint>"
)
MIXES = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def replace_pairs(symbols: np.ndarray, ends: np.ndarray, weights: np.ndarray | None, first: int) -> tuple:
    """(symbols, ends, lefts, rights by round) once no pair is left that occurs ``MIN_COUNT`` times without overlap.

    ``ends`` are the ends of the sequences no pair may leave; a sequence counts ``weights`` times. A round replaces
    many pairs at once: where occurrences of different pairs overlap, those of the more frequent pair are taken, so the
    most frequent one is replaced everywhere. A place is looked at again only if its pair is frequent or new:
    other pairs can only become rarer. Pairs are counted in a hash table that they enter alone; those that meet
    another pair in it wait for a round with another hash, at last for one that sorts.
    """
    n = len(symbols)
    symbols = symbols.astype(np.int32)
    following, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)  # n stands for none
    starts = np.append(0, ends)[:-1][np.diff(ends, prepend=0) > 0]
    following[ends[ends > 0] - 1] = n
    before[starts] = n
    each = None if weights is None else np.repeat(weights.astype(np.int32), np.diff(ends, prepend=0))
    rank, alive, marked = np.zeros(n + 1, np.int32), np.ones(n, bool), np.zeros(n, bool)
    active, lefts, rights, turn, idle = np.flatnonzero(following < n).astype(np.int32), [], [], 0, 0
    while len(active):
        key = np.multiply(symbols[active], first, dtype=np.int64)
        key += symbols[following[active]]
        exact = idle == len(MIXES)
        for mix in () if exact else (turn, turn + 1):  # rare pairs go, most of them by the first count
            slot, size = _slots(key, mix)
            often = np.flatnonzero((np.bincount(slot, None if each is None else each[active], size) >= MIN_COUNT)[slot])
            active, key = active[often], key[often]
        if exact:
            slot, size = _slots(key, None)
        else:
            slot = slot[often]
        if not len(active):
            break
        owner = np.zeros(size, np.int64)
        owner[slot] = key
        alone = owner[slot] == key
        # Of a run of one pair that overlaps itself, every second place counts.
        repeats = 1 + np.flatnonzero((active[1:] == following[active[:-1]]) & (key[1:] == key[:-1]))
        begin = np.maximum.accumulate(np.where(np.diff(repeats, prepend=-1) > 1, repeats - 1, 0)) if len(repeats) else repeats
        alone[repeats[(repeats - begin) % 2 == 1]] = False
        good = np.flatnonzero(alone)
        places, slot, key = active[good], slot[good], key[good]
        counts = np.bincount(slot, None if each is None else each[places], size)
        frequent = np.flatnonzero(counts >= MIN_COUNT)
        by_count = np.argsort(counts[frequent], kind="stable")
        order = np.zeros(size, np.int32)
        order[frequent[by_count]] = np.arange(1, len(frequent) + 1)
        mine = order[slot]
        some = np.flatnonzero(mine)
        places, mine, key = places[some], mine[some], key[some]
        rank[places] = mine
        take = np.flatnonzero((mine >= rank[before[places]]) & (mine >= rank[following[places]]))
        rank[places] = 0
        taken, mine, key = places[take], mine[take], key[take]
        used = np.bincount(mine, None if each is None else each[taken], len(frequent) + 1) >= MIN_COUNT
        take = np.flatnonzero(used[mine])
        taken, mine, key, turn = taken[take], mine[take], key[take], turn + 1
        if not len(taken):
            if exact:
                break  # counted by sorting, and none is frequent
            idle += 1
            continue
        in_slots = np.zeros(len(frequent), bool)  # rules are numbered by their slots
        in_slots[by_count] = used[1:]
        number = np.zeros(len(frequent) + 1, np.int32)
        number[1:] = (np.cumsum(in_slots) - 1)[by_count]
        rule = number[mine]
        rules = np.zeros(int(used.sum()), np.int64)
        rules[rule] = key
        lefts.append(rules // first)
        rights.append(rules % first)
        gone = following[taken]
        symbols[taken] = first + rule
        alive[gone] = False
        after = following[gone]
        following[taken] = after
        inside = after < n
        before[after[inside]] = taken[inside]
        first, idle = first + len(rules), 0
        previous = before[taken]
        touched = np.concatenate([active, taken, previous[previous < n]])
        if len(touched) < n // 32:
            active = np.unique(touched)
            active = active[alive[active]]
        else:
            marked[touched] = True
            active = np.flatnonzero(marked & alive).astype(np.int32)
            marked[touched] = False
        active = active[following[active] < n]
    kept = np.cumsum(alive)
    new_ends = np.where(ends > 0, kept[np.maximum(ends, 1) - 1], 0) if n else ends
    return symbols[alive], new_ends, lefts, rights


def _slots(key: np.ndarray, turn: int | None) -> tuple[np.ndarray, int]:
    """(slot of each pair, number of slots): by one of the hashes or, without a turn, a slot for each pair."""
    if turn is None:
        pairs, slot = np.unique(key, return_inverse=True)
        return slot, len(pairs)
    bits = min(max(int(len(key)).bit_length() + 1, 8), 20)
    hashed = key.view(np.uint64) * MIXES[turn % len(MIXES)]
    hashed >>= np.uint64(64 - bits)
    return hashed.view(np.int64), 1 << bits


def compress(codes: np.ndarray, counts: np.ndarray, ids: np.ndarray, at: np.ndarray, end: int) -> dict:
    """A shard's grammar and symbols from its distinct pieces (see ``words.Encoder.encode``).

    Re-Pair first runs on the distinct pieces, weighted by how often each occurs, which counts all pairs inside
    pieces; then on the whole sequence, for pairs across pieces. Both go on until no pair has ``MIN_COUNT`` uses.
    """
    present = np.zeros(max(int(ids.max(initial=0)), end) + 1, bool)
    present[ids], present[end] = True, True
    terminals, number = np.flatnonzero(present), (np.cumsum(present) - 1).astype(np.int32)
    stop, symbols, ends = int(number[end]), number[ids], at[1:]
    symbols, ends, lefts, rights = replace_pairs(symbols, ends, np.bincount(codes, minlength=len(ends)), len(terminals))
    symbols, sequences = words.joined(codes, counts, symbols, np.append(0, ends), stop)
    first = len(terminals) + sum(map(len, lefts))
    symbols, ends, more_lefts, more_rights = replace_pairs(symbols, sequences[1:], None, first)
    lefts, rights = [*lefts, *more_lefts], [*rights, *more_rights]
    first = len(terminals) + sum(map(len, lefts))
    none = [np.zeros(0, np.int64)]
    left, right = np.concatenate(lefts or none), np.concatenate(rights or none)
    lengths = np.ones(first, np.int64)
    done = len(terminals)
    for part_left, part_right in zip(lefts, rights):  # a round's rules only use symbols of earlier rounds
        lengths[done : done + len(part_left)] = lengths[part_left] + lengths[part_right]
        done += len(part_left)
    sums = words.offsets(lengths[symbols])[ends]
    width = 2 if first <= 1 << 16 else 4
    return {
        "n_tokens": np.diff(sums, prepend=0), "symbol_ends": ends, "width": width, "symbols": symbols.astype(f"<u{width}").tobytes(),
        "terminals": terminals.astype(np.int64), "left": left, "right": right, "lengths": lengths,
    }


def decode(shard: Mapping, document: int | None = None, start: int = 0, stop: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ends of the documents in them) of a shard, or ids ``start`` to ``stop`` of one of its documents.

    For a part of a document only the rules on the way to its ids are opened, as ``lengths`` steers.
    """
    symbols = np.frombuffer(shard["symbols"], f"<u{shard['width']}").astype(np.int64)
    lengths, ends = np.asarray(shard["lengths"], np.int64), np.asarray(shard["symbol_ends"], np.int64)
    terminals = np.asarray(shard["terminals"], np.int64).astype(np.uint32)
    left, right = np.asarray(shard["left"], np.int64), np.asarray(shard["right"], np.int64)
    if document is None:
        flat, at = expansions(terminals, left, right, lengths)
        return flat[words.ragged(at[symbols], lengths[symbols])], words.offsets(lengths[symbols])[ends]
    symbols = symbols[ends[document - 1] if document else 0 : ends[document]]
    places = words.offsets(lengths[symbols])
    stop = int(places[-1]) if stop is None else min(stop, int(places[-1]))
    places = places[:-1]
    while True:
        wanted = (places < stop) & (places + lengths[symbols] > start)
        symbols, places = symbols[wanted], places[wanted]
        rule = symbols - len(terminals)
        if not (rule >= 0).any():
            return terminals[symbols], np.array([len(symbols)])
        opened = np.flatnonzero(rule >= 0)
        into = np.repeat(np.arange(len(symbols)), 1 + (rule >= 0))
        second = np.append(False, into[1:] == into[:-1])
        symbols, places, at = symbols[into], places[into], opened + np.arange(len(opened))
        symbols[at], symbols[at + 1] = left[rule[opened]], right[rule[opened]]
        places[second] += lengths[symbols[at]]


def expansions(terminals: np.ndarray, left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all symbols one after the other, where each begins), built from the shallow rules to the deep ones."""
    at, t = words.offsets(lengths), len(terminals)
    flat = np.empty(int(at[-1]), np.uint32)
    flat[:t] = terminals
    depth = np.zeros(len(lengths), np.int32)
    rules = np.arange(t, len(lengths))
    while True:
        deeper = np.maximum(depth[left], depth[right]) + 1
        if np.array_equal(deeper, depth[t:]):
            break
        depth[t:] = deeper
    order = rules[np.argsort(depth[t:], kind="stable")]
    for some in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        for half, shift in ((left[some - t], 0), (right[some - t], lengths[left[some - t]])):
            flat[words.ragged(at[some] + shift, lengths[half])] = flat[words.ragged(at[half], lengths[half])]
    return flat, at


def write_ids(documents: DataFrame, path: str, tokenizer: str, end: int = 2, shard_bytes: int = SHARD_BYTES) -> None:
    """Tokenize (doc_id, text) and write the format above. ``tokenizer`` is a path of the tokenizers library's JSON.

    One range shuffle brings documents into ascending order; a frequent doc_id is spread by its texts. A shard
    takes texts of about ``shard_bytes``, one document at least, and no more rows than an Arrow batch holds (10,000 by
    default), so short texts make smaller shards. NULL texts are empty and
    have the end id only; rows repeat as they come; other columns are ignored; an empty table makes no shard.
    """
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(words.definition(tokenizer))
    by = ["doc_id", F.xxhash64("text")]
    ordered = documents.select("doc_id", "text").repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by)
    parted = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = words.encoder(shared.value, spaces=True)
        before = 0
        for number, batch in enumerate(words.slices(batches, "text", shard_bytes)):
            encoded = encoder.encode(batch["text"])
            pa.default_memory_pool().release_unused()  # what the grammar's arrays need is more than what Arrow would keep
            row = compress(*encoded, end)
            del encoded
            row |= {"part": batch["part"][0].as_py(), "shard": number, "at": before, "doc_ids": batch["doc_id"].to_pylist()}
            before += int(row["n_tokens"].sum())
            yield pa.RecordBatch.from_pylist([row], schema=ARROW)

    parted.mapInArrow(shards, SCHEMA).write.parquet(path)


ARROW = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("at", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())),
    ("symbol_ends", pa.list_(pa.int64())), ("width", pa.int32()), ("symbols", pa.binary()), ("terminals", pa.list_(pa.int32())),
    ("left", pa.list_(pa.int32())), ("right", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int64())),
])


def shard_of(batch: pa.RecordBatch, i: int) -> dict:
    """A row of the format for ``decode``: its lists as arrays, doc_ids as an Arrow one, since they may be NULL."""
    shard = {}
    for name, value in ((n, batch[n][i]) for n in batch.schema.names):
        if not isinstance(value, (pa.ListScalar, pa.LargeListScalar)):
            shard[name] = value.as_py()
        else:
            shard[name] = value.values if name == "doc_ids" else value.values.to_numpy()
    return shard


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and n_symbols of every document, decoded from the files."""
    ship(spark)
    shards = spark.read.schema(SCHEMA).parquet(path)
    totals = shards.groupBy("part").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = shard_of(batch, i)
                ids, ends = decode(shard)
                data, at = memoryview(ids.astype("<u4").tobytes()), np.append(0, ends)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": shard["doc_ids"],
                    "start": shard["part_start"] + shard["at"] + at[:-1],
                    "n_tokens": np.diff(at),
                    "ids_crc32": np.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at, at[1:])], np.int64),
                    "n_symbols": np.diff(np.asarray(shard["symbol_ends"], np.int64), prepend=0),
                })

    joined = shards.join(F.broadcast(starts), "part")
    return joined.mapInArrow(digests, "doc_id long, start long, n_tokens long, ids_crc32 long, n_symbols long")
