"""What has been done: an append-only table of stage events.

Events are written to folders of their own, so stages that end at the same time do not meet in one commit.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "stage STRING, key STRING, status STRING, at BIGINT"
DONE, FAILED, RESET = "done", "failed", "reset"


class Ledger:
    """Events below a folder; the latest event of a (stage, key) is its state."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _append(self, stage: str, key: str, status: str) -> None:
        event = self.spark.createDataFrame([(stage, key, status)], "stage STRING, key STRING, status STRING")
        self.mark_all(event.coalesce(1))

    def mark_all(self, events: DataFrame) -> None:
        """Append events (stage, key, status) of one moment; Spark commits all of them or none."""
        at = F.lit(time.time_ns() // 1000)
        name = f"{self.path}/{uuid.uuid4().hex}"
        events.select("stage", "key", "status", at.alias("at")).write.json(name)

    def mark(self, stage: str, key: str = "", status: str = DONE) -> None:
        self._append(stage, key, status)

    def reset(self, stage: str, key: str = "") -> None:
        """Make a stage run again."""
        self._append(stage, key, RESET)

    def state(self) -> DataFrame:
        try:
            events = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").json(self.path)
        except AnalysisException:
            events = self.spark.createDataFrame([], SCHEMA)
        latest = events.groupBy("stage", "key").agg(F.max_by("status", "at").alias("status"), F.max("at").alias("at"))
        return latest.where(F.col("status") != RESET)

    def is_done(self, stage: str, key: str = "") -> bool:
        return not self.state().where((F.col("stage") == stage) & (F.col("key") == key)).isEmpty()
