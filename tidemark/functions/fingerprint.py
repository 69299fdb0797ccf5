"""Row fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "||"


def row_fingerprint(*cols: str | Column, null_token: str | None = None) -> Column:
    """SHA-256 (lower-case hex) over the columns joined with ``||``.

    ``concat_ws`` skips nulls, so ``(a, null, b)`` and ``(a, b, null)`` hash
    alike. ``null_token`` writes that text in place of a null and tells the
    two apart, at the price of other fingerprints than without it.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    if null_token is not None:
        parts = [F.coalesce(p.cast("string"), F.lit(null_token)) for p in parts]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)
