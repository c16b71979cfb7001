"""Stages that later ones read more than once."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def stage(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder of ``spark.checkpoint.dir``; a folder of our own is
    used only where that is unset and the master is local."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="corvine-"))
    return df.checkpoint(eager=True)
