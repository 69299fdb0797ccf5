from tidemark.operators.changes import change_detect, change_detect_by_code, rows_to_save
from tidemark.operators.dedup import dedup_discarded, dedup_latest
from tidemark.operators.enrich import (
    enrich_full_outer,
    enrich_matched,
    enrich_tagged,
    enrich_unmatched,
    known_answers,
    latest_answers,
    unmatched_sample,
)
from tidemark.operators.lookup import (
    ask_function,
    ask_table,
    assign_pages,
    items_without_id,
    lookup_pages,
    malformed_pages,
    page_outcome,
    page_waves,
    parse_responses,
    unseen_keys,
)
from tidemark.operators.required import require, require_code, require_description
from tidemark.operators.skew import hot_keys, lookup_join
from tidemark.operators.state import state_upsert, state_upsert_by_id

__all__ = [
    "ask_function",
    "ask_table",
    "assign_pages",
    "change_detect",
    "change_detect_by_code",
    "dedup_discarded",
    "dedup_latest",
    "enrich_full_outer",
    "enrich_matched",
    "enrich_tagged",
    "enrich_unmatched",
    "hot_keys",
    "items_without_id",
    "known_answers",
    "latest_answers",
    "lookup_join",
    "lookup_pages",
    "malformed_pages",
    "page_outcome",
    "page_waves",
    "parse_responses",
    "require",
    "require_code",
    "require_description",
    "rows_to_save",
    "state_upsert",
    "state_upsert_by_id",
    "unmatched_sample",
    "unseen_keys",
]
