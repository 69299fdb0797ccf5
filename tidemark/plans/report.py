"""The run report."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The sections of a report and their counters.
SECTIONS = {
    "load": ["date_ref", "predicate", "row_count"],
    "cleanup": [
        "raw_count",
        "duplicated_count",
        "de_duplicated_count",
        "no_description",
        "description_count",
        "no_code_count",
        "code_count",
        "valid_rows",
    ],
    "process": [
        "raw_count",
        "matched_count",
        "not_matched_count",
        "new_count",
        "repeated_count",
        "transformed_count",
        "valid_rows",
    ],
    "persist": ["raw_count", "valid_rows"],
}


def _blank_sections() -> dict[str, dict]:
    return {name: {**dict.fromkeys(counters), "status": "unknown"} for name, counters in SECTIONS.items()}


@dataclass
class RunReport:
    """What a run did: its status and, per section, counters and status."""

    elapsed: float = 0.0
    status: str = "unknown"
    additional_info: str | None = None
    sections: dict[str, dict] = field(default_factory=_blank_sections)

    def note(self, section: str, **counters) -> None:
        """Record counters of a section."""
        unknown = counters.keys() - set(SECTIONS[section])
        if unknown:
            raise KeyError(f"no such counters in {section}: {sorted(unknown)}")
        self.sections[section].update(counters)

    def fill(self, section: str, **counters) -> None:
        """Record the last counters of a section and its success."""
        self.note(section, **counters)
        self.sections[section]["status"] = "success"

    def as_dict(self) -> dict:
        return {
            "elapsed": self.elapsed,
            "status": self.status,
            "additional_info": self.additional_info,
            **self.sections,
        }

    def to_json(self) -> str:
        return json.dumps(self.as_dict(), indent=4)

    def to_df(self, spark: SparkSession) -> DataFrame:
        """One row per entry: section, name and value, as text; the run's own are in the section ``run``."""
        run = {"elapsed": self.elapsed, "status": self.status, "additional_info": self.additional_info}
        rows = [
            (section, name, None if value is None else str(value))
            for section, entries in {"run": run, **self.sections}.items()
            for name, value in entries.items()
        ]
        return spark.createDataFrame(rows, "section string, name string, value string")
