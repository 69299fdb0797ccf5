"""What the steps of a run have finished, so that a repeat goes on where it failed."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.files import delete, read_text, write_text


@dataclass(frozen=True)
class StepLog:
    """An entry for each finished step of one run below ``folder``.

    An entry holds the table that the step wrote, the report's sections so far, and
    the ``basis`` it rests on. It is only good for a repeat on the same basis.
    """

    spark: SparkSession
    folder: str
    basis: dict

    def _path(self, step: str) -> str:
        return f"{self.folder}/{step}.json"

    def finished(self, step: str) -> dict | None:
        """The entry of a step, if there is one on this basis."""
        text = read_text(self.spark, self._path(step))
        entry = json.loads(text) if text else None
        return entry if entry and entry["basis"] == self.basis else None

    def finish(self, step: str, path: str, schema: T.StructType, sections: dict, **more) -> None:
        entry = {"basis": self.basis, "path": path, "schema": schema.jsonValue(), "sections": sections, **more}
        write_text(self.spark, self._path(step), json.dumps(entry))

    def table(self, entry: dict) -> DataFrame:
        """What the step has written."""
        return self.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(entry["path"])

    def clear(self) -> None:
        delete(self.spark, self.folder)
