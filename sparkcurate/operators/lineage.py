"""Tables that cut lineage, in the folder that the cluster names for checkpoints."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder of checkpoints: spark.checkpoint.dir, or one that was set before. Where none is, it is an error, but in one local process, where a temporary folder does."""
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not known:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors see")
        known = tempfile.mkdtemp(prefix="sparkcurate-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(known)
    return known


def cut(df: DataFrame) -> DataFrame:
    """df as a checkpoint: made once, read from shared files afterwards, so that lost executors lose nothing."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
