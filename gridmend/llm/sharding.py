"""Balanced label propagation: equal texts gather in one shard while all shards keep equally many rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridmend.llm.tables import numbered, saved

SALTS, ORDERS, ROUNDS = 192, 256, 16


def quotas(rows: int, shards: int) -> list[int]:
    """Rows of each shard: at most one apart."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _of(values: list[int], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), index + 1)


def propagate(cells: DataFrame, room: list[int], rounds: int = ROUNDS) -> DataFrame:
    """(g, salt, shard) of the cells (g, salt, n) of linked documents. Actions, two per round.

    A cell holds the documents of a group with one salt, about 1/``SALTS`` of it; a group's documents are all
    linked with one another, so a group has at most ``SALTS`` cells and a window over it is bounded. Cells
    start in a shard by hash. Each round they look at their neighbours' shards and propose the one with
    most of them among those with room, if it has more than their own (or as many, and either a lower
    number or their own is full). Of the proposals to a shard those are accepted that fit in its room, in
    an order of hashes whose running sums come from a histogram. It ends when nothing moves.
    """
    shards = len(room)
    order = (F.pmod(F.xxhash64("g"), F.lit(ORDERS)) * SALTS + F.col("salt")).cast("int")
    start = F.pmod(F.xxhash64("g", "salt"), F.lit(shards)).cast("int")
    state = saved(cells.select("g", "salt", "n", order.alias("order"), start.alias("shard"), F.lit(True).alias("moved")), "shards-0")
    for turn in range(rounds):
        load = [0] * shards
        for row in state.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # one row per shard
            load[row["shard"]] = row["n"]
        free = [max(0, r - n) for r, n in zip(room, load)]
        group, here = Window.partitionBy("g"), Window.partitionBy("g", "shard")
        open_here = _of(free, F.col("shard")) > 0
        seen = state.withColumn("own", F.sum("n").over(here)).withColumn("open", open_here)
        best = F.max(F.when(F.col("open"), F.struct("own", (-F.col("shard")).alias("minus")))).over(group)
        seen = seen.withColumn("best", best).withColumn("to", -F.col("best.minus"))
        wants = (F.col("best.own") > F.col("own")) | ((F.col("best.own") == F.col("own")) & ((F.col("to") < F.col("shard")) | ~F.col("open")))
        seen = seen.withColumn("wants", F.coalesce((F.col("to") != F.col("shard")) & wants, F.lit(False)))
        seen = saved(seen.select("g", "salt", "n", "order", "shard", "to", "wants"), f"shards-wants-{turn}")
        wanted = seen.where("wants").groupBy("to", "order").agg(F.sum("n").alias("n"))
        running = F.sum("n").over(Window.partitionBy("to").orderBy("order"))
        fits = wanted.withColumn("upto", running).where(F.col("upto") <= _of(free, F.col("to")))
        limit = [-1] * shards
        for row in fits.groupBy("to").agg(F.max("order").alias("order")).collect():  # one row per shard
            limit[row["to"]] = row["order"]
        if max(limit) < 0:
            break
        moves = F.col("wants") & (F.col("order") <= _of(limit, F.col("to")))
        state = saved(seen.select("g", "salt", "n", "order", F.when(moves, F.col("to")).otherwise(F.col("shard")).alias("shard")), f"shards-{turn + 1}")
    return state.select("g", "salt", "shard")


def shard(documents: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, linked, shard and slot of every document; shard sizes differ by a row at most. Actions.

    ``size`` is the text's UTF-8 bytes plus 8. Documents with equal texts are linked; a NULL text links
    with nothing and has the checksum of no bytes, an empty text is a text like any other. Label
    propagation places the linked ones; where a shard ends up above its quota, its last rows are set free. Those and
    the unlinked documents are numbered and fill the shards to their quotas. Slots count a shard's rows
    from 0: first the linked ones, then those that fill it. Other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.md5("text").alias("g"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    rows = saved(rows, "shards-rows")
    quota = quotas(rows.count(), shards)
    cells = rows.where("g IS NOT NULL").groupBy("g", "salt").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("all", F.sum("n").over(Window.partitionBy("g"))).where("all > 1").drop("all")
    placed = rows.join(propagate(cells, quota), ["g", "salt"], "left")
    ranked = numbered(placed.drop("salt"), ["shard", "g", "doc_id"], "shards-placed")  # unplaced rows first
    count = [0] * (shards + 1)
    for row in ranked.groupBy(F.coalesce("shard", F.lit(-1)).alias("s")).agg(F.count(F.lit(1)).alias("n")).collect():
        count[row["s"] + 1] = row["n"]
    starts = list(accumulate(count, initial=0))[1:-1]
    rank = F.col("position") - _of(starts, F.col("shard"))
    settled = F.col("shard").isNotNull() & (rank < _of(quota, F.col("shard")))
    kept = ranked.where(settled).select("doc_id", "size", "text_crc32", F.lit(True).alias("linked"), "shard", rank.alias("slot"))
    loose = ranked.where(~settled).select("doc_id", "size", "text_crc32", F.col("shard").isNotNull().alias("linked"))
    held = [min(n, q) for n, q in zip(count[1:], quota)]
    ends = list(accumulate(q - h for q, h in zip(quota, held)))
    loose = numbered(loose, ["doc_id", "text_crc32"], "shards-loose")
    target = sum((F.col("position") >= e).cast("int") for e in ends[:-1]) if shards > 1 else F.lit(0)
    fills = loose.withColumn("shard", target).select(
        "doc_id", "size", "text_crc32", "linked", "shard",
        (F.col("position") - _of([0, *ends[:-1]], F.col("shard")) + _of(held, F.col("shard"))).alias("slot"),
    )
    return kept.unionAll(fills)
