"""Deterministic UUIDs: HMAC-SHA256 under a secret, shaped as a version-4 UUID.

Built from Catalyst expressions only, so that it runs inside whole-stage
codegen instead of a Python worker.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fingerprint import SEPARATOR

_BLOCK = 64  # SHA-256 block length in bytes


def hmac_pads(secret: bytes) -> tuple[str, str]:
    """The inner and outer HMAC key pads as hex text."""
    key = sha256(secret).digest() if len(secret) > _BLOCK else secret
    key = key.ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key).hex(), bytes(b ^ 0x5C for b in key).hex()


def keyed_uuid(value: str | Column, secret: bytes) -> Column:
    """UUID of a text under ``secret``; a null hashes as the text ``None``."""
    text = F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit("None"))
    inner_pad, outer_pad = (F.unhex(F.lit(pad)) for pad in hmac_pads(secret))
    inner = F.sha2(F.concat(inner_pad, F.encode(text, "UTF-8")), 256)
    digest = F.sha2(F.concat(outer_pad, F.unhex(inner)), 256)
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-4"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def derive_entity_id(uuid: str | Column, code: str | Column, secret: bytes) -> Column:
    """Entity id: the keyed UUID of ``uuid||code``."""
    return keyed_uuid(F.concat_ws(SEPARATOR, uuid, code), secret)


def register_keyed_uuid(spark: SparkSession, secret: bytes, name: str = "deterministic_uuid") -> None:
    """Make :func:`keyed_uuid` callable from SQL text as ``name(text)``.

    A SQL function is inlined by Catalyst; no Python runs when it is called. Its
    text holds the pads made from the secret, as plans and logs then do: only
    sessions whose users may know the secret should register it.
    """
    inner_pad, outer_pad = hmac_pads(secret)
    digest = (
        f"sha2(unhex('{outer_pad}') || unhex(sha2(unhex('{inner_pad}')"
        " || encode(coalesce(value, 'None'), 'UTF-8'), 256)), 256)"
    )
    shaped = (
        "concat(substr(d, 1, 8), '-', substr(d, 9, 4), '-4', substr(d, 14, 3), '-',"
        " translate(substr(d, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab'),"
        " substr(d, 18, 3), '-', substr(d, 21, 12))"
    ).replace("(d,", f"({digest},")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS STRING RETURN {shaped}"
    )
