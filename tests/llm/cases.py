"""Tables of odd rows that every operator has to take."""

from __future__ import annotations

import re

from tests.conftest import TESTDATA

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id long, score double, counts string, row int, place string, key string, size int, copies int, _row string, h long"
)
CLASH = (7, 0.5, "c", 1, "p", "k", 3, 4, "r", 9)

SENTENCE = "The river runs past the old mill and on to the sea where boats wait for wind and tide. "


def document(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *CLASH)


def odd_rows():
    """Null in any column, empty, white, very short and very long texts, ties, repeated rows and ids."""
    long = " ".join(f"word{i % 997} and{i % 89}" for i in range(6000))
    return [
        document(1, SENTENCE * 3),
        document(1, SENTENCE * 3),
        document(2, SENTENCE * 3, None, None),
        document(3, None),
        document(4, ""),
        document(5, " \n\t "),
        document(6, "Hi"),
        document(None, SENTENCE * 2, "en", "b"),
        document(None, None, None, None),
        document(8, long, "en", "b"),
        document(9, "x" * 20000, "xx", "c"),
        document(10, "Ünïcode \U0001f642 ß <|endoftext|> ok\x1cno " * 5, "de", "c"),
    ]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def small(spark):
    return spark.read.parquet(str(TESTDATA / "sf0.001" / "documents.parquet"))


def small_labels(spark):
    return spark.read.parquet(str(TESTDATA / "sf0.001" / "labels.parquet"))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
