"""Row counts taken while a frame is written, by the same job that writes it."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class RowCounts:
    """Counts of the frames that are watched, known once one action has run on the last of them.

    A watched frame must reach that action on one path: a plan that reads it twice counts it
    twice. Filters are not pushed below a watch, so watch after the filters of a scan.
    """

    def __init__(self) -> None:
        self.watched: list[tuple[str, Observation]] = []

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        self.watched.append((name, Observation()))
        return df.observe(self.watched[-1][1], F.count(F.lit(1)).alias("rows"))

    def counts(self) -> dict[str, int]:
        """Rows by name; waits for the action."""
        return {name: self._rows(observation) for name, observation in self.watched}

    @staticmethod
    def _rows(observation: Observation) -> int:
        try:
            return observation.get["rows"]
        except Py4JJavaError as error:
            # What the optimizer proves empty is not run and reports no metrics.
            if "assertion failed" not in str(error):
                raise
            return 0

    def removals(self, spark: SparkSession) -> DataFrame:
        """``(step, rows, removed)`` as ``profile.removal_report``, without reading a frame again."""
        counted = list(self.counts().items())
        removed = [0, *[before - after for (_, before), (_, after) in zip(counted, counted[1:])]]
        return spark.createDataFrame([(name, n, gone) for (name, n), gone in zip(counted, removed)], "step string, rows long, removed long")
