"""The fingerprint state: the newest delivered fingerprint of each key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession

from tidemark import schemas
from tidemark.sources.versioned_table import VersionedTable


@dataclass(frozen=True)
class StateTable:
    """Fingerprints below ``path``, of which the last committed one of a key counts.

    One run at a time may write: of two that began together exactly one commits,
    the other gets an error and leaves the state as the first one made it.
    """

    spark: SparkSession
    path: str
    key_cols: Sequence[str] = ("id", "code")
    buckets: int | None = None

    @property
    def table(self) -> VersionedTable:
        keys = tuple(self.key_cols)
        return VersionedTable(self.spark, self.path, (*keys, "sha2"), keys, self.buckets, newest_only=True)

    def commits(self) -> list[Row]:
        return self.table.commits()

    def is_committed(self, run_id: str) -> bool:
        return self.table.is_committed(run_id)

    def read(self) -> DataFrame:
        """The state after the newest commit, or no rows before the first."""
        latest = self.table.latest_commit()
        if latest is None:
            return self.spark.createDataFrame([], schemas.state_schema(self.key_cols))
        return self.table.newest(latest).select(*self.key_cols, "sha2")

    def upsert(self, batch: DataFrame, run_id: str, about: int | None = None) -> int:
        """Add the batch's fingerprints, one row per key, ``about`` so many, and return the commit's version."""
        return self.table.append(batch.select(*self.key_cols, "sha2"), run_id, about)
