"""Batched lookups: which keys to ask, in which pages, and what came back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas

PAGE_SIZE = 499  # fixed value: most ids one request may carry
PAGES_PER_WAVE = 16_384

#: ``(page, ids)`` rows in, ``(page, status, body)`` rows out.
Ask = Callable[[DataFrame], DataFrame]

#: What became of a page: a sound body, none (204), another status, or a body that is no list of items.
ANSWERED, EMPTY, FAILED, MALFORMED = "answered", "empty", "failed", "malformed"


def unseen_keys(batch: DataFrame, cache: DataFrame, key: str = "id") -> DataFrame:
    """The distinct keys of the batch the cache has no answer for.

    Both sides are made distinct first, so that the join moves each key once.
    """
    cached = cache.select(F.col("id").alias(key)).distinct()
    return batch.select(key).distinct().join(cached, key, "left_anti")


def assign_pages(
    keys: DataFrame, key: str = "id", page_size: int = PAGE_SIZE, bucket_digits: int = 3
) -> DataFrame:
    """Number the non-null keys into pages of exactly ``page_size``, from 1 on.

    At most five digits, which a million starts go with. The order is that of
    (first hex digits of the md5, key). The digits cut
    the keys into 16**``bucket_digits`` even buckets that are ranked in
    parallel; a bucket starts where the buckets before it end. Pages depend
    on the keys alone, so a recomputed task finds the same ones.
    """
    if not 1 <= bucket_digits <= 5:
        raise ValueError("1 to 5 digits: each start of a bucket is broadcast")
    bucketed = keys.select(
        key, F.substring(F.md5(F.col(key)), 1, bucket_digits).alias("_bucket")
    ).where(F.col("_bucket").isNotNull())
    # At most 16**bucket_digits rows: one task and a broadcast are enough.
    starts = (
        bucketed.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .select("_bucket", (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_start"))
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        bucketed.withColumn("_rank", rank)
        .join(F.broadcast(starts), "_bucket")
        .select(F.expr(f"(_start + _rank - 1) div {page_size} + 1").alias("page"), key)
    )


def lookup_pages(paged_keys: DataFrame, key: str = "id") -> DataFrame:
    """One row per page with its ``ids``, at most a page size of them."""
    return paged_keys.groupBy("page").agg(F.sort_array(F.collect_list(key)).alias("ids"))


def ask_function(fetch: Callable[[int, list[str]], tuple[int, str | None]], requests_at_once: int) -> Ask:
    """Ask by calling ``fetch(page, ids) -> (status, body)`` on the executors.

    ``requests_at_once`` tasks call in parallel, each one page after another.
    A retried task calls again for its pages. ``fetch`` returns the status of
    a failed request; if it raises, Spark retries the task.
    """

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page", pa.int64()), ("status", pa.int32()), ("body", pa.string())])
        for batch in batches:
            for page, ids in zip(batch.column("page"), batch.column("ids")):
                status, body = fetch(page.as_py(), ids.as_py())
                answer = {"page": page.as_py(), "status": status, "body": body}
                yield pa.RecordBatch.from_pylist([answer], schema)

    def ask(pages: DataFrame) -> DataFrame:
        # A stated number: a page is small, adaptive execution would merge all.
        return pages.repartition(requests_at_once, "page").mapInArrow(call, schemas.RESPONSE)

    return ask


def ask_table(service: DataFrame, uuid: Column | None = None) -> Ask:
    """Ask a table with columns ``id`` and ``uuid`` in place of a remote service.

    Answers like one: status 200 and a JSON array, or 204 for a page without
    any answer. A ``uuid`` that costs something to derive is best given as a column
    of the table's others: then it is derived of the rows that are asked for.
    """
    uuid = F.col("uuid") if uuid is None else uuid

    def ask(pages: DataFrame) -> DataFrame:
        asked = pages.select("page", F.explode("ids").alias("id"))
        bodies = (
            asked.join(service, "id")
            .select("page", "id", uuid.alias("uuid"))
            .groupBy("page")
            .agg(F.to_json(F.sort_array(F.collect_set(F.struct("id", "uuid")))).alias("body"))
        )
        return (
            pages.select("page")
            .join(bodies, "page", "left")
            .select("page", F.when(F.col("body").isNull(), 204).otherwise(200).alias("status"), "body")
        )

    return ask


def _items() -> Column:
    """The items of a ``body``, null for one that does not begin with a JSON array of objects."""
    items = F.from_json("body", schemas.ANSWER_DDL)
    return F.when(F.json_array_length("body").isNotNull(), items)


def parsed_items() -> Column:
    """The items of a response with status 200, null where its body cannot be read; reading a body costs, so once is best."""
    return F.when(F.col("status") == 200, _items())


def page_outcome(items: Column | None = None) -> Column:
    """What became of a response's page, from its ``status`` and ``body``, or its :func:`parsed_items`.

    A status of 200 says that the service was reached, not that its answer can be
    read: without a JSON array of objects (or nulls) in the body the page is malformed.
    """
    status = F.col("status")
    items = _items() if items is None else items
    answered = F.when(items.isNotNull(), ANSWERED).otherwise(MALFORMED)
    return F.when(status == 200, answered).when(status == 204, EMPTY).otherwise(FAILED)


def malformed_pages(responses: DataFrame) -> DataFrame:
    """page, body of the responses whose body cannot be read."""
    return responses.where(page_outcome() == MALFORMED).select("page", "body")


def page_waves(pages: DataFrame, pages_per_wave: int) -> DataFrame:
    """Number the pages' waves, from 0 on: each has ``pages_per_wave`` pages, the last one the rest."""
    return pages.withColumn("wave", F.expr(f"(page - 1) div {pages_per_wave}"))


def parse_responses(responses: DataFrame, run_id: str) -> DataFrame:
    """Cache rows of the answered pages; a malformed body answers nothing.

    Items repeated within a page count once, which needs no shuffle as a
    page is one row. An item without a uuid is an answer, too; one without an
    id answers nothing and is left out (:func:`items_without_id` counts them).
    """
    return (
        responses.select("page", F.inline(F.array_distinct(parsed_items())))
        .where(F.col("id").isNotNull())
        .select("uuid", "id", F.concat_ws("_", F.lit(run_id), "page").alias("partition_ref"))
    )


def items_without_id(items: Column | None = None) -> Column:
    """How many items of a response's ``body``, or of its :func:`parsed_items`, have no id; 0 for a malformed one."""
    items = _items() if items is None else items
    return F.coalesce(F.size(F.filter(items, lambda x: x["id"].isNull())), F.lit(0))
