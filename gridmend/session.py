"""Sessions for local work, and the shared scratch folder of whatever session runs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "gridmend", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "1000")  # plans give paths whole
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder the cluster shares (``spark.checkpoint.dir``).

    Only a local session without that setting, as in tests, gets a temporary folder of the machine; on a cluster
    its executors could not share one, so that raises.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{shared or tempfile.mkdtemp(prefix='gridmend-')}/{name}-{uuid.uuid4().hex}"
