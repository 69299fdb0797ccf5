"""Configuration of an incremental run."""

from __future__ import annotations

from dataclasses import dataclass, field

from tidemark.operators.lookup import PAGE_SIZE, PAGES_PER_WAVE
from tidemark.sources.partitions import DAYS_BACK


@dataclass(frozen=True)
class RunConfig:
    """``root`` is a folder all executors reach; it holds state, cache and outputs.

    One key, ``key_cols``, serves deduplication, comparison and state.
    ``order_cols`` say which row of a key is the newest. Rows need a
    ``description_col`` and a ``code_col``; ``lookup_key`` is what the lookup
    is asked for, ``page_size`` ids at a time and ``pages_per_wave`` pages a job.
    ``until_run_date`` ignores partitions after the run date.
    With ``output_cols`` a run also writes these columns of what it delivers,
    by ``output_partition_cols``, to ``published/run=<run id>``. With
    ``publish_views`` each step's rows become a named view as it ends.
    """

    root: str
    secret: bytes = field(repr=False)
    key_cols: tuple[str, ...] = ("id", "code")
    order_cols: tuple[str, ...] = ("created_at",)
    fingerprint_cols: tuple[str, ...] = ("code", "id", "group_id")  # fixed value
    null_token: str | None = None
    description_col: str = "description"
    code_col: str = "code"
    lookup_key: str = "id"
    days_back: int = DAYS_BACK
    until_run_date: bool = False
    page_size: int = PAGE_SIZE
    pages_per_wave: int = PAGES_PER_WAVE
    hot_rows: int | None = None
    state_buckets: int | None = None
    sample_size: int = 20
    publish_views: bool = False
    output_cols: tuple[str, ...] | None = None
    output_partition_cols: tuple[str, ...] = ()
    view_names: tuple[str, str, str, str] = ("raw", "cleanup", "process", "persisted")  # fixed values
