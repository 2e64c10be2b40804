"""Extract sinks (K1, K2).

Three renderings of the quoted-comma extract:

* ``csv`` -- Spark's CSV writer with every field quoted, embedded quotes
  doubled (a well-formed file; the original wrote a name holding a quote
  unescaped, which breaks the line), nulls written as ``None``, dates ISO and
  timestamps ``YYYY-MM-DD HH:MM:SS`` like ``str()``.  Every part file starts
  with the header; read the directory back with ``header=True``.
* ``text`` -- byte parity with the original extract: one ``"a","b",...`` line
  per row built by ``present.quoted_line`` (quotes not escaped), the header
  line first.  The header is the only row of the first input partition of a
  union, so it is the first line of ``part-00000``; concatenating the part
  files in name order gives the original single file.

* ``delivery`` -- the rows of ``csv`` in part files that are one extract when
  joined in name order: the header once, in the first; the rows in the order of
  their columns, cut into ranges; no file over ``rows_per_file`` rows.

All writers are distributed: every task writes its own part file through
Spark's commit protocol, so a lost executor only re-runs its tasks.
``single_file=True`` coalesces to one writer task for a one-file delivery.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitview.functions.present import NULL_TEXT, quoted_line, timestamp_text
from remitview.plans.headers import headers_for

CSV_OPTIONS = {
    "header": "true",
    "quoteAll": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": NULL_TEXT,
    "emptyValue": "",
    "dateFormat": "yyyy-MM-dd",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
    # The writer trims by default; blank padding of codes is data.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _cell(df: DataFrame, c: str) -> Column:
    # Timestamps as str(datetime) text: the writer's pattern would either drop
    # fractional seconds or pad whole ones.
    return timestamp_text(c) if dict(df.dtypes)[c].startswith("timestamp") else F.col(c)


def header_line(headers) -> str:
    return '"' + '","'.join(headers) + '"'


def write_quoted_csv(
    df: DataFrame,
    path: str,
    template: str,
    program: str | None = None,
    partition_by: list[str] | None = None,
    single_file: bool = False,
    mode: str = "overwrite",
) -> None:
    """Escaped, fully quoted CSV with the report headers."""
    pairs = headers_for(template, program)
    cells = [_cell(df, c).alias(h) for c, h in pairs]
    out = df.select(*cells, *[F.col(p) for p in partition_by or []])
    if single_file:
        out = out.coalesce(1)
    writer = out.write.mode(mode).options(**CSV_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_delivery(
    df: DataFrame,
    path: str,
    template: str,
    program: str | None = None,
    rows_per_file: int = 1_000_000,
    mode: str = "overwrite",
    observation: Observation | None = None,
    metrics: tuple[Column, ...] = (),
) -> None:
    """CSV part files that are one ordered extract when joined in name order.

    A report's rows differ in some column, so ranges over all columns cut any
    hot value. The header is the only row of the union's first partition.
    Rows are observed after the sort: a job that samples ranges counts none.
    """
    columns = [c for c, _ in headers_for(template, program)]
    body = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    if observation is not None:
        body = body.observe(observation, *metrics)
    body = body.select(*[_cell(df, c).cast("string").alias(c) for c in columns])
    head = df.sparkSession.range(1, numPartitions=1).select(*[F.lit(h).alias(c) for c, h in headers_for(template, program)])
    options = {**CSV_OPTIONS, "header": "false", "maxRecordsPerFile": str(rows_per_file)}
    head.unionByName(body).write.mode(mode).options(**options).csv(path)


def read_delivery(spark: SparkSession, path: str, template: str, program: str | None = None) -> DataFrame:
    """Rows of a delivery as text columns named by the headers."""
    headers = [h for _, h in headers_for(template, program)]
    schema = T.StructType([T.StructField(h, T.StringType()) for h in headers])
    rows = spark.read.schema(schema).options(**{**CSV_OPTIONS, "header": "false"}).csv(path)
    is_header = reduce(and_, [F.col(f"`{h}`").eqNullSafe(F.lit(h)) for h in headers])
    return rows.where(~is_header)


def quoted_text(df: DataFrame, template: str, program: str | None = None) -> DataFrame:
    """Header line + one quoted line per row: ``value`` and ``is_body`` (0 for the header)."""
    pairs = headers_for(template, program)
    head = df.sparkSession.range(1, numPartitions=1).select(
        F.lit(header_line([h for _, h in pairs])).alias("value"), F.lit(0).alias("is_body")
    )
    body = df.select(quoted_line([c for c, _ in pairs], schema=df.schema).alias("value"), F.lit(1).alias("is_body"))
    return head.unionByName(body)


def write_quoted_text(
    df: DataFrame,
    path: str,
    template: str,
    program: str | None = None,
    single_file: bool = False,
    mode: str = "overwrite",
) -> None:
    """Byte-parity extract (unescaped quotes), header first in part-00000.

    Distributed: the header is the only row of the union's first partition.
    ``single_file``: one writer task; coalescing does not keep partition
    order, so that task sorts the header ahead of the body.
    """
    out = quoted_text(df, template, program)
    if single_file:
        out = out.coalesce(1).sortWithinPartitions("is_body")
    out.drop("is_body").write.mode(mode).text(path)
