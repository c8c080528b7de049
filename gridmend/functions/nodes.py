"""Quantile nodes, nearest-node lookup and the two kinds of correction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ADDITIVE, MULTIPLICATIVE = "+", "*"
KINDS = {"additive": ADDITIVE, "multiplicative": MULTIPLICATIVE}


def kind_symbol(kind: str) -> str:
    """``+`` or ``*`` for a kind given as a word or as the symbol itself."""
    if kind in (ADDITIVE, MULTIPLICATIVE):
        return kind
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {sorted(KINDS)}, got {kind!r}")
    return KINDS[kind]


def node_positions(n: int) -> list[float]:
    """``n`` equally spaced quantiles inside (0, 1), both ends excluded."""
    return [(i + 0.5) / n for i in range(n)]


def quantile_nodes(n: int) -> Column:
    return F.array(*[F.lit(q) for q in node_positions(n)])


def nearest_node_by_rank(rank2: Column, pool_size: Column, n: Column | int) -> Column:
    """0-based nearest node of the quantile ``rank2 / (2 * pool_size)``, the lower one on a tie.

    Integer arithmetic, because a floating quantile can fall on the wrong side of a tie.
    """
    n = F.lit(n) if isinstance(n, int) else n
    n = n.cast("bigint")
    raw = F.floor((n * rank2 - 1) / (pool_size * 2))
    return F.greatest(F.lit(0).cast("bigint"), F.least(n - 1, raw)).cast("int")


def nearest_node_by_quantile(q: Column, n: Column | int) -> Column:
    """0-based nearest node of a floating quantile, the lower one on a tie."""
    n = F.lit(n) if isinstance(n, int) else n
    raw = F.ceil(F.round(q * n, 9) - 1)
    return F.greatest(F.lit(0).cast("bigint"), F.least(n.cast("bigint") - 1, raw)).cast("int")


def nearest_node_uneven(q: Column, nodes: Column, n: Column | None = None) -> Column:
    """0-based nearest node of a quantile among ascending ``nodes`` at any distances, the lower one on a tie.

    A binary search in the array, so its cost grows with the logarithm of the nodes. NULL for a missing quantile
    and for an empty array.
    """
    n = F.size(nodes) if n is None else n

    def at(i: Column) -> Column:
        return F.get(nodes, i)

    def halve(ends: Column, _: Column) -> Column:
        """``low`` is the last node known to be at most q, or 0; ``high`` lies after all such nodes."""
        middle = F.floor((ends["low"] + ends["high"]) / 2).cast("int")
        up = at(middle) <= q
        return F.struct(F.when(up, middle).otherwise(ends["low"]).alias("low"), F.when(up, ends["high"]).otherwise(middle).alias("high"))

    turns = F.sequence(F.lit(1), F.ceil(F.log2(F.greatest(n, F.lit(2)))).cast("int"))
    start = F.struct(F.lit(0).alias("low"), n.cast("int").alias("high"))
    low = F.aggregate(turns, start, halve)["low"]
    above = F.least(low + 1, n - 1)
    nearer = F.abs(at(above) - q) < F.abs(q - at(low))
    return F.when(q.isNotNull() & (n > 0), F.when(nearer, above).otherwise(low)).cast("int")


def apply_correction(value: Column, factor: Column, kind: str) -> Column:
    return value + factor if kind_symbol(kind) == ADDITIVE else value * factor
