"""The monthly run: four reports for the month before the run date (K2, M1-M3).

Layout under ``out_root``::

    attempts/<attempt>/run_date=YYYYMMDD/report=open/program=ffs/part-*.csv
    attempts/<attempt>/run_date=YYYYMMDD/report=open/program=cco/part-*.csv
    attempts/<attempt>/run_date=YYYYMMDD/report=denied/program=ffs/part-*.csv
    attempts/<attempt>/run_date=YYYYMMDD/report=denied/program=cco/part-*.csv
    run_date=YYYYMMDD/_status/     (one row per state: 'running' first, 'complete' last)

In ``text`` mode (byte parity) each extract is a directory under
``report=.../`` named by ``extract_names`` (default ``open_ffs.YYYYMMDD.txt``),
holding one part file with ``single_file=True``.

Each template is computed *once* for both programs -- the program is one more
group key: one scan, one join pipeline and one aggregation per template instead of
one per report. The result is kept while each program is written under its own
headers.

Every run writes a directory of its own. Its last act appends one row to
``_status``, with the path, row count and money total of every report; that row,
committed like any Spark output, makes it the month's current attempt. A reader
takes the paths from the manifest, never from a directory listing. A failure
propagates and appends nothing, so a rerun that dies leaves the last complete
month as it was.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from remitview.config import PROGRAMS, ReportConfig
from remitview.functions import derive as D
from remitview.functions.period import as_date, prev_month_window, run_stamps
from remitview.functions.present import display_view
from remitview.operators.history_filter import HistoryFilter, planned_bytes, settings_for
from remitview.plans import denied_report as DR
from remitview.plans import open_report as OR
from remitview.session import COLOCATED
from remitview.sources import sink
from remitview.sources.tables import DENIED_ROLES, OPEN_ROLES, check_roles

TEMPLATES = ("open", "denied")
FORMATS = ("csv", "display", "text", "delivery")
#: The amount each report recovers.
AMOUNT = {"open": "amount_recovered", "denied": "actual_amount_recovered"}


def default_extract_names() -> dict[tuple[str, str], str]:
    """File names of the text extracts; ``{d}`` is the run date YYYYMMDD."""
    return {(t, p): f"{t}_{p}.{{d}}.txt" for t in TEMPLATES for p in PROGRAMS}


def _with_program(rows: DataFrame, cfg: ReportConfig) -> DataFrame:
    # Program from the report's own ICN columns: stem || line is the original
    # claim number, so its prefix is the original prefix.
    icn = F.concat(F.col("icn"), F.col("icn_detail_line"))
    return rows.withColumn("program", D.program_of(icn, cfg)).where(F.col("program").isNotNull())


@contextlib.contextmanager
def window_inputs(
    tables: dict[str, DataFrame], lo: dt.date, hi: dt.date, cfg: ReportConfig = ReportConfig()
):
    """The run's tables with the reports' claims kept for the run's duration.

    Each template reads its claims twice (semi-join keys, main pipeline).
    Keeping them, after all the claim filters and with the template's columns
    alone, turns that into one scan. The templates re-apply the same filters,
    so results are unchanged; lost cached blocks are recomputed from lineage.
    """
    claim = OR.month_claims(tables["claim"], None, lo, hi, cfg, cfg.open_report_status).select(*OPEN_ROLES["claim"])
    claim_b = DR.month_claims(tables["claim_b"], None, lo, hi, cfg)
    kept = [claim.persist(), claim_b.persist()]
    try:
        yield {**tables, "claim": kept[0], "claim_b": kept[1]}
    finally:
        for df in kept:
            df.unpersist()


def open_template(tables: dict[str, DataFrame], lo: dt.date, hi: dt.date, cfg: ReportConfig) -> DataFrame:
    """The OPEN template for both programs, with a ``program`` column."""
    rows = _with_program(OR.open_rows(tables, None, lo, hi, cfg, status=cfg.open_report_status), cfg)
    return OR.group_open(rows, tables, cfg, ("program",))


def denied_template(tables: dict[str, DataFrame], lo: dt.date, hi: dt.date, cfg: ReportConfig) -> DataFrame:
    """The DENIED template for both programs, with a ``program`` column."""
    rows = _with_program(DR.denied_rows(tables, None, lo, hi, cfg), cfg)
    return DR.group_denied(rows, tables, cfg, ("program",))


BUILDERS = {"open": open_template, "denied": denied_template}


def template_reports(
    tables: dict[str, DataFrame],
    lo: dt.date,
    hi: dt.date,
    cfg: ReportConfig = ReportConfig(),
) -> dict[str, DataFrame]:
    """``{'open': df, 'denied': df}``, each with a ``program`` column (ffs / cco)."""
    return {t: BUILDERS[t](tables, lo, hi, cfg) for t in TEMPLATES}


def run_month(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    as_of,
    out_root: str,
    cfg: ReportConfig = ReportConfig(),
    fmt: str = "csv",
    single_file: bool = False,
    extract_names: dict[tuple[str, str], str] | None = None,
    history_filter: HistoryFilter | None = HistoryFilter(),
    rows_per_file: int = 1_000_000,
) -> dict[str, str]:
    """Write the four reports of the month before ``as_of``; returns the output paths.

    ``extract_names[(template, program)]``: names of text extracts, ``{d}`` for the run date.
    ``history_filter``: when to test the claims' keys in the histories' scans; None for never.
    ``rows_per_file``: size of the files of a ``delivery``.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}")
    check_roles(tables, {**OPEN_ROLES, **DENIED_ROLES})
    as_of = as_date(as_of)
    lo, hi = prev_month_window(as_of)
    stamp = run_stamps(as_of)["yyyymmdd"]
    attempt = uuid.uuid4().hex
    base = f"{out_root.rstrip('/')}/attempts/{attempt}/run_date={stamp}"
    log = _log_path(out_root, as_of)
    names = {k: v.format(d=stamp) for k, v in {**default_extract_names(), **(extract_names or {})}.items()}
    _append_status(spark, log, attempt, as_of, lo, hi, "running", [])
    with settings_for(spark, COLOCATED if cfg.colocated else None), window_inputs(tables, lo, hi, cfg) as month:
        with settings_for(spark, _filter_settings(month, history_filter)):
            reports = _build_and_write(month, lo, hi, cfg, base, names, fmt, single_file, rows_per_file)
    _append_status(spark, log, attempt, as_of, lo, hi, "complete", reports)
    return {**{t: f"{base}/report={t}" for t in TEMPLATES}, "_status": log}


def _filter_settings(month: dict[str, DataFrame], options: HistoryFilter | None) -> dict[str, str] | None:
    """Settings of the histories' filters. Counting the kept claims, which both templates read
    anyway, is done only where a history is large enough to be filtered."""
    if options is None or max(planned_bytes(month[r]) for r in ("posting", "denial")) < options.min_history_bytes:
        return None
    with ThreadPoolExecutor(max_workers=2) as pool:
        counts = list(pool.map(lambda role: month[role].count(), ("claim", "claim_b")))
    return options.settings(max(counts))


def _build_and_write(
    tables: dict[str, DataFrame], lo: dt.date, hi: dt.date, cfg: ReportConfig, base: str,
    names: dict[tuple[str, str], str], fmt: str, single_file: bool, rows_per_file: int,
) -> list[dict]:
    """Build and write both templates as concurrent Spark jobs (one driver thread each).

    The two templates share no stages, so their scans, joins and writes are
    scheduled side by side; the first failure propagates.
    """

    def one(template: str) -> list[dict]:
        df = BUILDERS[template](tables, lo, hi, cfg)
        return _write_template(df, template, f"{base}/report={template}", names, fmt, single_file, rows_per_file)

    with ThreadPoolExecutor(max_workers=len(TEMPLATES)) as pool:
        futures = [pool.submit(one, t) for t in TEMPLATES]
        return [r for f in futures for r in f.result()]


def _write_template(
    df: DataFrame, template: str, path: str, names: dict[tuple[str, str], str], fmt: str, single_file: bool, rows_per_file: int
) -> list[dict]:
    """Write one extract per program (headers differ); what the manifest says of each.

    The template's result is kept between the writes (lost blocks are
    recomputed from lineage, so this survives executor loss). Rows and money
    are observed by the writing tasks themselves; a task that is run again counts once.
    """
    df = df.persist()
    metrics = (F.count(F.lit(1)).alias("rows"), F.sum(AMOUNT[template]).alias("recovered"))
    try:
        written = []
        for program in PROGRAMS:
            seen = Observation(f"{template}-{program}")
            part = df.where(F.col("program") == F.lit(program)).drop("program")
            target = f"{path}/program={program}"
            if fmt == "delivery":
                sink.write_delivery(part, target, template, program, rows_per_file, observation=seen, metrics=metrics)
            elif fmt == "text":
                target = f"{path}/{names[(template, program)]}"
                sink.write_quoted_text(part.observe(seen, *metrics), target, template, program, single_file=single_file)
            else:
                # 'display': money as $#,##0.00 and dates as MM/DD/YYYY (the
                # presentation the original workbook applied).
                part = part.observe(seen, *metrics)
                out = display_view(part, template) if fmt == "display" else part
                sink.write_quoted_csv(out, target, template, program, single_file=single_file)
            written.append({"template": template, "program": program, "path": target, **seen.get})
        return written
    finally:
        df.unpersist()


REPORT_SCHEMA = "struct<template:string,program:string,path:string,rows:bigint,recovered:decimal(38,2)>"
STATUS_SCHEMA = f"state string, attempt string, seq bigint, as_of string, first_day string, last_day string, reports array<{REPORT_SCHEMA}>"


def _log_path(out_root: str, as_of: dt.date) -> str:
    return f"{out_root.rstrip('/')}/run_date={run_stamps(as_of)['yyyymmdd']}/_status"


def _read_log(spark: SparkSession, path: str) -> list:
    """Status rows of a month, two per attempt, in order."""
    try:
        rows = spark.read.schema(STATUS_SCHEMA).json(path).collect()
    except AnalysisException:  # no status yet
        return []
    return sorted(rows, key=lambda r: (r["seq"] or 0, r["attempt"] or ""))


def _append_status(
    spark: SparkSession, path: str, attempt: str, as_of: dt.date, lo: dt.date, hi: dt.date, state: str, reports: list[dict],
) -> None:
    """Append one row: an attempt's state and window, and what it wrote.

    ``seq`` is one more than the log's highest. Two attempts that end at once may share it; the
    greater attempt id then counts as the later one, for every reader.
    """
    seq = 1 + max((r["seq"] or 0 for r in _read_log(spark, path)), default=0)
    values = {"state": state, "attempt": attempt, "seq": seq, "as_of": as_of.isoformat(), "first_day": lo.isoformat(), "last_day": hi.isoformat()}
    fields = ("template", "program", "path", "rows", "recovered")
    entries = F.array(*[F.struct(*[F.lit(r[f]).alias(f) for f in fields]) for r in reports]).cast(f"array<{REPORT_SCHEMA}>")
    row = spark.range(1, numPartitions=1).select(*[F.lit(v).alias(k) for k, v in values.items()], entries.alias("reports"))
    row.write.mode("append").json(path)


def read_status(spark: SparkSession, out_root: str, as_of) -> str | None:
    """'complete' (some attempt is), 'running' (none is yet) or None (never started) for the run of ``as_of``."""
    states = {r["state"] for r in _read_log(spark, _log_path(out_root, as_date(as_of)))}
    return "complete" if "complete" in states else "running" if states else None


def read_manifest(spark: SparkSession, out_root: str, as_of):
    """The row of the month's current attempt, the last complete one: ``state``, ``attempt`` and
    ``reports`` (template, program, path, rows, recovered). Before any is complete the row of the
    last attempt, without reports; None if the run never started."""
    rows = _read_log(spark, _log_path(out_root, as_date(as_of)))
    complete = [r for r in rows if r["state"] == "complete"]
    return (complete or rows or [None])[-1]
