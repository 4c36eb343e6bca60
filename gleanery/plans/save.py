"""Where intermediate frames are kept: the cluster's shared folder."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir.  Only on a local master (tests, a laptop) a folder of our own is made where none is set; a cluster
    has to name one that all its machines see."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        at = spark.conf.get("spark.checkpoint.dir", None)
        if not at and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(at or tempfile.mkdtemp(prefix="gleanery-"))
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(spark: SparkSession) -> Callable[[DataFrame], DataFrame]:
    """Cut a frame's lineage in the shared folder: a lost executor then costs a re-read and no recomputation."""
    shared_folder(spark)
    return lambda df: df.checkpoint()
