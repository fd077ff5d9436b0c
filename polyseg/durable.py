"""Results that are used more than once, written to the cluster's checkpoint folder; Arrow batches that fit in memory."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Rows an Arrow batch may hold; bounds a Python worker's memory with long texts.
BATCH_ROWS = "512"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Use ``spark.checkpoint.dir``; where it is unset a temporary folder serves, but only in local mode."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.match(r"local($|\[)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="polyseg-ckpt-")
    context.setCheckpointDir(folder)


def kept(df: DataFrame) -> DataFrame:
    """The rows as they are now, computed once."""
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint()


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows, for the session: Spark reads the setting when a lazy result runs, so it can't be put back here."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
