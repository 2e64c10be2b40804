"""Table layouts that let a month's run read little and shuffle little.

* The claim tables are partitioned by the month of the date their report selects by. A run adds the
  months of its window as a predicate on that column, so other months' files are not listed.
* The histories are bucketed and sorted by their join key. A run with ``ReportConfig.colocated``
  joins on that key alone, and Spark shuffles only the month's claims to the buckets. The price: the
  rows of one hot key stay together in one bucket, where a shuffle join could split them. Buckets
  must be no fewer than ``spark.sql.shuffle.partitions``, or Spark shuffles both sides.

Tables written here are ordinary catalog tables; ``load_catalog_tables`` binds them to roles.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Role: (date column of its report window, column of the date's month).
MONTHS = {"claim": ("bill_dt", "bill_month"), "claim_b": ("remit_dt", "remit_month")}
#: Role: key of its join with the claims.
BUCKET_KEYS = {"posting": "claim_id", "claim_header": "header_id", "denial": "ar_seq"}


def with_month(role: str, df: DataFrame) -> DataFrame:
    """``df`` with its month column: the first day of the date's month, null for a null date."""
    date, month = MONTHS[role]
    return df.withColumn(month, F.trunc(F.col(date).cast("date"), "MM"))


def in_months(role: str, df: DataFrame, lo: dt.date, hi: dt.date) -> Column:
    """The window's months as a condition on the month column; true where ``df`` has none.

    The day of a zoned timestamp depends on the session's time zone, which need not be the writer's:
    its window reaches a day further to both sides.
    """
    date, month = MONTHS[role]
    if month not in df.columns:
        return F.lit(True)
    slack = dt.timedelta(days=1 if df.schema[date].dataType.typeName() == "timestamp" else 0)
    return F.col(month).between(F.lit((lo - slack).replace(day=1)), F.lit((hi + slack).replace(day=1)))


def write_layout(tables: dict[str, DataFrame], names: dict[str, str], location: str | None = None, buckets: int = 200, mode: str = "errorifexists") -> None:
    """Write the roles of ``names`` (role: catalog table) in their layout, below ``location`` if given.

    Claims are cut into ranges of month and key, so a large month is written by many tasks, each
    into few files. A bucket is one file, written by one task. Other roles are written as they are.
    """
    for role, name in names.items():
        df = tables[role]
        if role in MONTHS:
            df = with_month(role, df)
            month = MONTHS[role][1]
            writer = df.repartitionByRange(month, F.xxhash64(MONTHS[role][0], "icn")).write.partitionBy(month)
        elif role in BUCKET_KEYS:
            key = BUCKET_KEYS[role]
            writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        else:
            writer = df.write
        if location:
            writer = writer.option("path", f"{location.rstrip('/')}/{role}")
        writer.format("parquet").mode(mode).saveAsTable(name)


def load_catalog_tables(spark: SparkSession, names: dict[str, str]) -> dict[str, DataFrame]:
    """Roles bound to tables of the session's catalog, with their buckets and partitions."""
    return {role: spark.table(name) for role, name in names.items()}
