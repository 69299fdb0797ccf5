"""The given tables in the shapes the operators take."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import keyed_uuid, row_fingerprint
from tidemark.operators.lookup import Ask, ask_table
from tidemark.plans import cleanup
from tidemark.sources import new_folder

SECRET = b"my-unique-secret"  # fixed value: the secret the expected UUIDs were made with
KEYS = ("id", "code")
ORDER = ("created_at", "part_id", "supp_id")
FINGERPRINT = ("code", "id", "group_id")

CUT = "2000-01-01"  # rows before it are the earlier run's, the others this run's
EARLIER_DAY = dt.date(2024, 5, 9)
THIS_DAY = dt.date(2024, 5, 10)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as keyed rows; some lack a code or a description."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.nullif("l_linenumber", F.lit(7)).cast("string").alias("code"),
        (F.col("l_suppkey") % 3).alias("group_id"),
        F.col("l_shipdate").alias("created_at"),
        F.nullif("l_returnflag", F.lit("R")).alias("description"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supp_id"),
    )


def _cut():
    return F.lit(CUT).cast("timestamp_ntz")


def earlier_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).where(F.col("created_at") < _cut())


def batch_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).where(F.col("created_at") >= _cut())


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """This run's rows after the cleanup."""
    return cleanup(batch_raw(spark, sf_dir), KEYS, ORDER)


def staged(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The rows written and read back, as a run does before using them more than once."""
    path = new_folder(spark, "staged")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows after the cleanup, where no earlier run is kept apart."""
    return cleanup(raw(spark, sf_dir), KEYS, ORDER)


def staged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, cleaned(spark, sf_dir))


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprints of the earlier run."""
    return cleanup(earlier_raw(spark, sf_dir), KEYS, ORDER).select(
        *KEYS, row_fingerprint(*FINGERPRINT).alias("sha2")
    )


def service_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders that the lookup has an answer for: those not pending."""
    orders = read(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    return orders.select(F.col("o_orderkey").cast("string").alias("id"), "o_orderstatus")


def service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the lookup knows: an answer for each order that is not pending."""
    return service_ids(spark, sf_dir).select("id", keyed_uuid("id", SECRET).alias("uuid"), "o_orderstatus")


def ask(spark: SparkSession, sf_dir: str) -> Ask:
    """The service, asked page by page."""
    return ask_table(service_ids(spark, sf_dir), keyed_uuid("id", SECRET))


def troubled(ask: Ask) -> Ask:
    """The same service behind a proxy: even pages get a body of another kind, each fifth one no answer."""
    page = F.col("page")

    def asked(pages: DataFrame) -> DataFrame:
        return ask(pages).select(
            "page",
            F.when(page % 2 == 0, 200).when(page % 5 == 0, 503).otherwise(F.col("status")).alias("status"),
            F.when(page % 2 == 0, "<html>busy</html>").when(page % 5 != 0, F.col("body")).alias("body"),
        )

    return asked


def cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All the lookup knows, as answered by an earlier run."""
    return service(spark, sf_dir).select("uuid", "id", F.lit("1999-12-31_1").alias("partition_ref"))


def small_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the finished orders, so that others are still to be asked for."""
    finished = F.col("o_orderstatus") == "F"
    return service(spark, sf_dir).where(finished).select(
        "uuid", "id", F.lit("1999-12-31_1").alias("partition_ref")
    )


def full_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as a long-lived cache holds them: finished orders answered twice, pending ones without a uuid."""
    rows = cache(spark, sf_dir)
    orders = read(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    none = orders.select(
        F.lit(None).cast("string").alias("uuid"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.lit("1999-12-31_2").alias("partition_ref"),
    )
    return rows.unionByName(small_cache(spark, sf_dir)).unionByName(none)


def by_part(df: DataFrame) -> DataFrame:
    """The part as code, which several ids share."""
    return df.withColumn("code", F.col("part_id").cast("string"))


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the partition columns of their day."""
    return read(spark, sf_dir, "events").select(
        "*", F.year("ts").alias("year"), F.month("ts").alias("month"), F.day("ts").alias("day")
    )


def day_files(spark: SparkSession, rows: DataFrame) -> str:
    """The folder of the rows' files, partitioned by year, month and day."""
    path = new_folder(spark, "days")
    rows.write.partitionBy("year", "month", "day").parquet(path)
    return path


@contextmanager
def day_table(spark: SparkSession, rows: DataFrame, path: str | None = None) -> Iterator[str]:
    """The rows as a catalog table partitioned by year, month and day; its name goes at the end, its files stay.

    ``path`` names the files if they are written already.
    """
    path = path or day_files(spark, rows)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    place = path.replace("'", "\\'")
    columns = rows.drop("year", "month", "day").schema.toDDL()
    spark.sql(
        f"CREATE TABLE {name} ({columns}, year INT, month INT, day INT) USING parquet"
        f" PARTITIONED BY (year, month, day) LOCATION '{place}'"
    )
    try:
        spark.sql(f"MSCK REPAIR TABLE {name}")
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")


def raw_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows with one day for the earlier run and one for this."""
    is_earlier = F.col("created_at") < _cut()
    day = F.when(is_earlier, F.lit(EARLIER_DAY)).otherwise(F.lit(THIS_DAY))
    return raw(spark, sf_dir).withColumns({"year": F.year(day), "month": F.month(day), "day": F.day(day)})
