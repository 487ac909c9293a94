"""Rows that could be used and rows that could not, written in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpusmill.session import PACKED, remove_folder, work_folder

CAUSE = "cause"


@dataclass(frozen=True)
class Parted:
    """Both parts of the table at ``path``, and how many rows each has; a row with a ``cause`` is rejected."""

    kept: DataFrame
    rejected: DataFrame
    n_kept: int
    n_rejected: int
    path: str

    def remove(self) -> None:
        """Delete the table, once neither part is read any more; the counts stay."""
        remove_folder(self.kept.sparkSession, self.path)


def part(rows: DataFrame, name: str = "parted") -> Parted:
    """Write the rows down once, counting both kinds on the way; either part is a filter on the written table.

    Rejected rows are few, and the scan of either part skips row groups by the null counts of ``cause``.
    """
    seen = Observation()
    cause = F.col(CAUSE)
    counted = rows.observe(seen, F.count_if(cause.isNull()).alias("kept"), F.count_if(cause.isNotNull()).alias("rejected"))
    path = work_folder(rows.sparkSession, name)
    counted.write.options(**PACKED).parquet(path)
    written = rows.sparkSession.read.schema(counted.schema).parquet(path)
    counts = seen.get
    return Parted(
        written.where(cause.isNull()).drop(CAUSE), written.where(cause.isNotNull()), counts["kept"], counts["rejected"], path
    )
