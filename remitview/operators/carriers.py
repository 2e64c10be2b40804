"""Carrier names, joined after the report's sum.

The carrier name depends on the carrier code alone, and the code is a report
column. So the amounts are summed without the name, and each sum is then joined
with the carriers: equal (code, name) rows of the dimension multiply the
amount, different names of one code give one row each, as joining first would.
The big side is a grouped one by then, and no aggregation above the join can
inherit a partitioning by carrier code, whose hot carrier would fill one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitview.config import ReportConfig
from remitview.functions import derive as D


def carrier_counts(carriers: DataFrame, cfg: ReportConfig, *names: str) -> DataFrame:
    """``(__carrier, names..., __times)``: equal carrier rows counted (null codes match nothing)."""
    named = carriers.where(F.col("carrier_cd").isNotNull())
    return named.groupBy(D.text_key("carrier_cd", cfg).alias("__carrier"), *names).agg(
        F.count(F.lit(1)).alias("__times")
    )


def join_carriers(
    df: DataFrame, carriers: DataFrame, code: str, how: str, cfg: ReportConfig, names: tuple[str, ...] = ("carrier_nm",)
) -> DataFrame:
    """``df`` with the carriers' ``names`` and ``__times``, the number of equal carrier rows
    (1 for a row without a carrier in a left join)."""
    counts = carrier_counts(carriers, cfg, *names)
    joined = df.join(counts, D.text_key(code, cfg) == F.col("__carrier"), how)
    return joined.withColumn("__times", F.coalesce("__times", F.lit(1).cast("bigint"))).drop("__carrier")
