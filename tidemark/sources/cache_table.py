"""The lookup cache: all answers ever given, bucketed by id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources.versioned_table import VersionedTable


@dataclass(frozen=True)
class CacheTable:
    """Answers below ``path``; they are added and never replaced.

    An answer without a uuid says that the lookup knows the id and has no
    uuid for it; it is kept, so that the id is not asked for again. Which
    answer is the newest is decided by the commit's version and the page, both
    numbers; ``partition_ref`` (``<run id>_<page>``) is text to look at.
    """

    spark: SparkSession
    path: str
    buckets: int | None = None

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(self.spark, self.path, ("uuid", "id", "partition_ref", "page"), ("id",), self.buckets)

    def read(self) -> DataFrame:
        """All answers with their ``version`` and ``page``."""
        return self.table.rows()

    def is_committed(self, run_id: str) -> bool:
        return self.table.is_committed(run_id)

    def append(self, answers: DataFrame, run_id: str, about: int | None = None) -> int:
        """Add a run's answers, ``about`` so many; without a ``page`` column it is read off ``partition_ref``."""
        page = F.col("page") if "page" in answers.columns else F.regexp_extract("partition_ref", r"_([0-9]+)$", 1).try_cast("long")
        return self.table.append(answers.select(*schemas.CACHE.names, page.cast("long").alias("page")), run_id, about)
