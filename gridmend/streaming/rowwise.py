"""Row-local corrections of cubes that arrive as files.

Every correction here looks at one row at a time, so it needs no state, watermark or shuffle. Pools,
calendars and checks need whole series and stay batch work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gridmend.sources.store import nan_to_null


def read_cube_stream(spark: SparkSession, path: str, schema: StructType, value_cols: list[str]) -> DataFrame:
    """Cube files below ``path`` as they arrive, NaN as missing."""
    return nan_to_null(spark.readStream.schema(schema).parquet(path), value_cols)


def correct_stream(
    stream: DataFrame, correction: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Append corrected rows to ``out``, each input file once, until the input is used up.

    ``checkpoint`` must lie on storage the cluster shares: it is what a restarted job resumes from.
    """
    corrected = correction(stream)
    writer = corrected.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(out)
