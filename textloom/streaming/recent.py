"""The latest predictions of each session."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def recent_predictions(log: DataFrame, session: str, at: str, tie: str, n: int = 20) -> DataFrame:
    """The ``n`` newest entries per session, newest first, with their ``position``.

    Spark applies the rank limit before the shuffle as well, so a session that
    owns most of the log sends ``n`` rows per task.
    """
    order = Window.partitionBy(session).orderBy(F.desc(at), F.desc(tie))
    return log.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= n)
