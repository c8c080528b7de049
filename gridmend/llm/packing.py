"""Packing token sequences by linear grouping: a plan over the histogram of lengths, carried out on all pieces.

The plan sees how many pieces have each length (at most ``capacity`` numbers, however many documents there
are) and says, for every stretch of the pieces sorted by length, into which sequences and at which offset they go.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmend.llm import words
from gridmend.llm.tables import numbered, saved
from gridmend.shipping import ship

CAPACITY, GROUPS, SMALL_PART, UNITS, MOST_COLUMNS = 4096, 40, 8, 512, 400
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def configurations(sizes: list[int], needs: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """Numbers of sequences to fill by each configuration (how many pieces of each size), for few sizes.

    Column generation: the linear programme over the known configurations is solved by pivoting, its prices
    make a knapsack that finds a better configuration, until there is none. Sizes are rounded up to
    1/``UNITS`` of the capacity there. The result is rounded down; what that leaves is packed by best fit. After
    ``MOST_COLUMNS`` configurations it goes on with those it has: pieces are packed all the same, perhaps less tightly.
    """
    n, unit = len(sizes), max(1, -(-capacity // UNITS))
    heavy = np.array([-(-s // unit) for s in sizes])
    room, need = capacity // unit, np.array(needs, float)
    basis = np.diag([float(room // h) for h in heavy])  # columns: configurations
    for _ in range(MOST_COLUMNS):
        prices = np.linalg.solve(basis.T, np.ones(n))
        value, pick = np.zeros(room + 1), np.full(room + 1, -1)
        for w in range(1, room + 1):
            fits = np.flatnonzero(heavy <= w)
            value[w] = value[w - 1]
            if len(fits):
                gains = value[w - heavy[fits]] + prices[fits]
                k = int(gains.argmax())
                if gains[k] > value[w] + 1e-12:
                    value[w], pick[w] = gains[k], fits[k]
        if value[room] <= 1 + 1e-7:
            break
        column, w = np.zeros(n), room
        while w > 0:
            if pick[w] >= 0:
                column[pick[w]] += 1
                w -= heavy[pick[w]]
            else:
                w -= 1
        amounts, change = np.linalg.solve(basis, need), np.linalg.solve(basis, column)
        ratios = np.where(change > 1e-9, amounts / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(ratios.argmin())] = column
    amounts = np.floor(np.linalg.solve(basis, need) + 1e-9).astype(np.int64)
    chosen, left = [], np.array(needs, np.int64)
    for column, amount in sorted(zip(basis.T.astype(np.int64), amounts), key=lambda c: (-int(c[1]), c[0].tolist())):
        used = column > 0
        amount = min([int(amount), *(left[used] // column[used]).tolist()])
        if amount > 0:
            chosen.append((column, amount))
            left -= column * amount
    return chosen


@dataclass
class Plan:
    """Rows (length, first rank within the length, count, first sequence, offset), and the open sequences."""

    capacity: int
    rows: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    open: dict[int, list[tuple[int, int]]] = field(default_factory=dict)  # room -> [(first sequence, count)]
    rooms: list[int] = field(default_factory=list)

    def add_room(self, room: int, first: int, count: int) -> None:
        if room and count:
            if room not in self.open:
                self.open[room] = []
                bisect.insort(self.rooms, room)
            self.open[room].append((first, count))

    def best_fit(self, length: int, rank: int, count: int) -> None:
        """``count`` pieces of one length, each into the open sequence with the least room that holds it."""
        while count:
            at = bisect.bisect_left(self.rooms, length)
            if at == len(self.rooms):
                break
            room = self.rooms[at]
            first, there = self.open[room].pop()
            if not self.open[room]:
                del self.open[room]
                self.rooms.pop(at)
            take = min(there, count)
            self.rows.append((length, rank, take, first, self.capacity - room))
            self.add_room(room, first + take, there - take)
            self.add_room(room - length, first, take)
            rank, count = rank + take, count - take
        each = self.capacity // length
        for per, many in ((each, count // each), (count % each, 1)):
            if per and many:
                for k in range(per):
                    self.rows.append((length, rank, many, self.sequences, k * length))
                    rank += many
                self.add_room(self.capacity - per * length, self.sequences, many)
                self.sequences += many


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """The plan of linear grouping, or that of best fit in descending length alone where it takes fewer sequences."""
    grouped, plain = linear_grouping(histogram, capacity, groups), Plan(capacity)
    for length in sorted(histogram, reverse=True):
        plain.best_fit(length, 0, histogram[length])
    return plain if plain.sequences < grouped.sequences else grouped


def linear_grouping(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """Linear grouping: large lengths are rounded up within ``groups`` groups of equally many pieces, sequences are
    filled by configurations of the rounded sizes, the real lengths take their places, and what is left goes by
    best fit in descending length, the pieces of up to capacity / ``SMALL_PART`` tokens last."""
    result = Plan(capacity)
    large = sorted((s for s, n in histogram.items() if capacity // SMALL_PART < s < capacity and n), reverse=True)
    total = sum(histogram[s] for s in large)
    queues: dict[int, list[list[int]]] = {}  # rounded size -> [length, first rank, count], longest first
    done = 0
    for s in large:
        left, at = histogram[s], 0
        while left:
            group = done * groups // total
            take = min(left, -(-(group + 1) * total // groups) - done)
            queues.setdefault(group, []).append([s, at, take])
            done, at, left = done + take, at + take, left - take
    by_size: dict[int, list[list[int]]] = {}
    for queue in queues.values():
        by_size.setdefault(queue[0][0], []).extend(queue)
    sizes = sorted(by_size, reverse=True)
    needs = [sum(part[2] for part in by_size[s]) for s in sizes]
    for column, amount in configurations(sizes, needs, capacity) if sizes else []:
        slots = []
        for s, many in zip(sizes, column.tolist()):
            for _ in range(many):
                slots.append(taken(by_size[s], amount))
        at = 0
        while at < amount:  # stretches in which every slot has one length
            step, offset = min(slot[0][2] for slot in slots), 0
            for slot in slots:
                s, first, count = slot[0]
                result.rows.append((s, first, step, result.sequences, offset))
                offset += s
                slot[0] = [s, first + step, count - step]
                if count == step:
                    slot.pop(0)
            result.add_room(capacity - offset, result.sequences, step)
            result.sequences, at = result.sequences + step, at + step
    rest = [tuple(part) for s in sizes for part in by_size[s] if part[2]]
    rest += [(s, 0, n) for s, n in histogram.items() if s not in set(large) and n]
    for s, first, count in sorted(rest, key=lambda part: (-part[0], part[1])):
        result.best_fit(s, first, count)
    return result


def taken(queue: list[list[int]], amount: int) -> list[list[int]]:
    """The next ``amount`` pieces of a queue, as [length, first rank, count]."""
    out = []
    while amount:
        s, first, count = queue[0]
        take = min(count, amount)
        out.append([s, first, take])
        amount -= take
        queue[0] = [s, first + take, count - take]
        if count == take:
            queue.pop(0)
    return out


def token_pieces(documents: DataFrame, tokenizer: str, end: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of the pieces of (doc_id, text); only documents longer than
    ``capacity`` are cut. A NULL or empty text has the end id only."""
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(words.definition(tokenizer))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = words.encoder(shared.value, spaces=False)
        for batch in words.slices(batches, "text"):
            ids, ends = encoder.ids(batch["text"], end)
            data, tokens = memoryview(ids.astype("<u4").tobytes()), np.diff(ends)
            many = -(-tokens // capacity)
            row = np.repeat(np.arange(len(tokens)), many)
            piece = words.ragged(np.zeros(len(tokens), np.int64), many)
            start = piece * capacity
            length = np.minimum(tokens[row] - start, capacity)
            first = ends[:-1][row] + start
            crc = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(row)).cast(pa.int64()), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return documents.select("doc_id", "text").mapInArrow(cut, PIECES)


def pack(documents: DataFrame, tokenizer: str, end: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of ``token_pieces`` with sequence_id and offset. Actions.

    Pieces are numbered in the order of their length; the plan gives stretches of these numbers a row of
    sequences and an offset. Its size depends on the capacity, not on the documents. Repeated rows are packed as often
    as they occur; other columns are ignored; an empty table needs no sequence.
    """
    spark = documents.sparkSession
    # Written before they are numbered: a range shuffle reads its input twice, first for its bounds.
    cut = saved(token_pieces(documents, tokenizer, end, capacity), "pack-cut")
    pieces = numbered(cut, ["length", "doc_id", "piece", "ids_crc32"], "pack-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, position = {}, 0
    for s in sorted(histogram):
        starts[s], position = position, position + histogram[s]
    rows = sorted((starts[s] + first, sequence, offset) for s, first, _, sequence, offset in plan(histogram, capacity).rows)
    shared = spark.sparkContext.broadcast(np.array(rows, np.int64).reshape(-1, 3))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretches = shared.value
        for batch in batches:
            at = batch["position"].to_numpy()
            row = np.searchsorted(stretches[:, 0], at, "right") - 1
            sequence = stretches[row, 1] + at - stretches[row, 0]
            columns = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(stretches[row, 2])], names=[f.split()[0] for f in PLACED.split(", ")])

    return pieces.mapInArrow(place, PLACED)


PLACED = PIECES + ", sequence_id long, offset long"
