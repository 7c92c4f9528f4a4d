"""Cutting a plan where its result is read more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once, in the folder of ``spark.checkpoint.dir``; lazy as before where that is unset.

    The files are shared by all executors, so a lost one costs the reading of a file.
    """
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df
