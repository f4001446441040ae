"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame

_OWN: dict[str, str] = {}


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage: the rows are written to `spark.checkpoint.dir`, or to a temporary folder where that is unset (local tests)."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None):
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="varzea-levels-")
            spark.sparkContext.setCheckpointDir(_OWN[app])
    return df.checkpoint()
