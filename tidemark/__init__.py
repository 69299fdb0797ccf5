"""Incremental enrichment of keyed tables on Spark."""

from tidemark.config import RunConfig
from tidemark.plans import RunReport, RunResult, run_incremental

__all__ = ["RunConfig", "RunReport", "RunResult", "run_incremental"]
