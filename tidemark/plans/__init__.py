from tidemark.plans.cleanup import cleanup, cleanup_report
from tidemark.plans.incremental import RunResult, run_incremental
from tidemark.plans.process import LookupReport, lookup_enrich, process_report, transform
from tidemark.plans.report import RunReport

__all__ = [
    "LookupReport",
    "RunReport",
    "RunResult",
    "cleanup",
    "cleanup_report",
    "lookup_enrich",
    "process_report",
    "run_incremental",
    "transform",
]
