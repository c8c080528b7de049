"""Uniform draws that depend on a key alone: the same after a retry and for any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_uniform(seed: int, *key: Column) -> Column:
    """Uniform on [0, 1) from the first 32 bits of the MD5 of ``seed|key|...``; a NULL key is a key of its own."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("\u0000")) for k in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
