from tidemark.sources.cache_table import CacheTable
from tidemark.sources.partitions import (
    latest_partition,
    latest_partition_scan,
    list_partitions,
    recent_partitions,
    scan_partition,
)
from tidemark.sources.shared import new_folder, read_if_there, shared_dir
from tidemark.sources.state_table import StateTable
from tidemark.sources.versioned_table import VersionedTable
from tidemark.sources.views import publish_output, publish_view, scan_view

__all__ = [
    "CacheTable",
    "StateTable",
    "VersionedTable",
    "latest_partition",
    "latest_partition_scan",
    "list_partitions",
    "new_folder",
    "publish_output",
    "publish_view",
    "read_if_there",
    "recent_partitions",
    "scan_partition",
    "scan_view",
    "shared_dir",
]
