"""Declared schemas of the state and cache tables, and boundary casts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The columns of the cache and, below, of the state. A null uuid is an answer, too.
CACHE = T.StructType(
    [
        T.StructField("uuid", T.StringType(), True),
        T.StructField("id", T.StringType(), False),
        T.StructField("partition_ref", T.StringType(), False),
    ]
)

#: What a lookup answers for one page of ids.
RESPONSE = T.StructType(
    [
        T.StructField("page", T.LongType(), False),
        T.StructField("status", T.IntegerType(), False),
        T.StructField("body", T.StringType(), True),
    ]
)

#: Pages whose body could not be read.
MALFORMED = T.StructType([T.StructField("page", T.LongType()), T.StructField("body", T.StringType())])

#: One item of a response body.
ANSWER_DDL = "array<struct<uuid: string, id: string>>"


def state_schema(key_cols: Sequence[str]) -> T.StructType:
    """Schema of the state table: the keys as text plus the fingerprint."""
    return T.StructType([T.StructField(c, T.StringType(), False) for c in (*key_cols, "sha2")])


def keys_as_text(df: DataFrame, key_cols: Iterable[str]) -> DataFrame:
    """Cast the keys to string, the type they have in the state and the cache.

    Doing it once at load keeps non-numeric ids legal: under ANSI mode a
    bigint/string comparison would cast the string side and fail on them.
    """
    return df.withColumns({c: F.col(c).cast("string") for c in key_cols})
