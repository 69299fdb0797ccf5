from tidemark.functions.dates import partition_date, partition_predicate_text, workday_anchor
from tidemark.functions.fingerprint import row_fingerprint
from tidemark.functions.keyed_uuid import derive_entity_id, keyed_uuid, register_keyed_uuid

__all__ = [
    "derive_entity_id",
    "keyed_uuid",
    "partition_date",
    "partition_predicate_text",
    "register_keyed_uuid",
    "row_fingerprint",
    "workday_anchor",
]
