"""OPEN template: open claims billed in the window, with their recovered amount.

Logical plan (the reference computes the same rows with one nested SQL query):

    claim  --filter (record flags, contract, project, program, bill type,
    |              window, never rebilled, carrier, report status)
    |--inner-- claim_header            on header_id
    |--left--- live posting totals     on claim_id   (semi-joined with the claims, summed)
    derive -> group by the report columns but the carrier name -> SUM(recovered)
    |--left--- carrier_a (filtered, equal rows counted)  on carrier_cd

Notes on the physical plan:

* Every claim predicate is a plain comparison on a claim column, so all of
  them reach the parquet scan as pushed filters, including the report-status
  filter: ``STATUS = 'OPEN'`` after the aggregate is rewritten to the raw
  status codes that map to 'OPEN' (the status is a group key, so filtering
  groups by it equals filtering rows by it).
* Postings are reduced to the claims and summed per claim before the join
  (``operators.preagg``). The header join is itself the reduction of the
  headers: nothing is aggregated below it.
* Carrier names join the grouped rows (``operators.carriers``).
* No broadcast is forced: Spark decides by statistics and measured sizes.
* ``claim_id`` is not a group key: claims with equal report columns merge and
  their amounts add, as in the original report.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitview.config import ReportConfig
from remitview.functions import derive as D
from remitview.operators.carriers import join_carriers
from remitview.operators.preagg import live_posting_totals
from remitview.plans.headers import OPEN_COLUMNS
from remitview.sources.layout import in_months

OPEN_GROUP_KEYS = tuple(c for c in OPEN_COLUMNS if c != "amount_recovered")

CLAIM_COLUMNS = (
    "claim_id", "header_id", "ar_seq", "last_name", "first_name", "recipient_id", "icn",
    "from_dos", "thru_dos", "bill_amt", "paid_amt", "carrier_cd", "bill_dt", "rebill_dt",
    "status_cd", "source_elig_cd",
)


def status_codes_for(label: str, cfg: ReportConfig) -> tuple[str, ...]:
    """Raw status codes whose derived open status equals ``label``."""
    codes = tuple(c for c in cfg.open_pass_statuses if c == label)
    if label == cfg.open_paid_label:
        codes += tuple(cfg.open_paid_statuses)
    return codes


def open_claim_filter(cfg: ReportConfig, program: str | None, lo, hi) -> Column:
    """The claim-level WHERE of the OPEN template (before the status filter)."""
    c = F.col
    # Most selective first: generated code short-circuits AND left to right.
    cond = (
        D.as_date_col("bill_dt").between(F.lit(lo), F.lit(hi))
        & D.one_of("delete_ind", (cfg.live_flag,), cfg)
        & D.one_of("contract_num", (cfg.contract_num,), cfg)
        # Lexical comparison on a text code: '9' >= '30' is true.
        & D.at_least("project_cd", cfg.project_floor, cfg)
        & (D.text_key("bill_type_cd", cfg) != F.lit(cfg.excluded_bill_type))
        & c("rebill_dt").isNull()
        & D.not_equal_trimmed("carrier_cd", cfg.excluded_carrier)
    )
    if program is not None:
        cond = cond & D.program_predicate("icn", program, cfg)
    return cond


def month_claims(claim: DataFrame, program: str | None, lo, hi, cfg: ReportConfig, status: str | None) -> DataFrame:
    """The template's claims, whole rows."""
    cond = open_claim_filter(cfg, program, lo, hi) & in_months("claim", claim, lo, hi)
    if status is not None:
        cond = cond & D.one_of("status_cd", status_codes_for(status, cfg), cfg)
    return claim.where(cond)


def listed_carriers(tables: dict[str, DataFrame], cfg: ReportConfig) -> DataFrame:
    return tables["carrier_a"].where(
        D.one_of("data_source_cd", (cfg.carrier_data_source,), cfg)
        & D.one_of("carrier_office_cd", (cfg.carrier_office,), cfg)
    )


def open_rows(
    tables: dict[str, DataFrame],
    program: str | None,
    lo: dt.date,
    hi: dt.date,
    cfg: ReportConfig = ReportConfig(),
    status: str | None = None,
) -> DataFrame:
    """Claim-level rows of the template, before grouping (one per claim; carrier names come later)."""
    month = month_claims(tables["claim"], program, lo, hi, cfg, status)
    totals = live_posting_totals(tables["posting"], month, cfg).select("claim_id", "remit_total")
    header = tables["claim_header"].select("header_id", "paid_hdr_amt", "paid_dt")
    joined = month.select(*CLAIM_COLUMNS).join(header, "header_id", "inner").join(totals, "claim_id", "left")
    return joined.select(
        "ar_seq",
        "last_name",
        "first_name",
        "recipient_id",
        D.icn_stem("icn").alias("icn"),
        D.icn_line("icn").alias("icn_detail_line"),
        "from_dos",
        "thru_dos",
        F.col("bill_amt").alias("billed_amount"),
        F.col("paid_amt").alias("line_paid_amount"),
        F.col("paid_hdr_amt").alias("paid_amount"),
        F.col("paid_dt").alias("paid_date"),
        D.zero_if_null("remit_total").alias("remit_amt"),
        F.col("carrier_cd").alias("carrier_code"),
        F.col("bill_dt").alias("original_bill_date"),
        D.rebill_or_bill("rebill_dt", "bill_dt").alias("rebill_date"),
        D.open_status("status_cd", cfg).alias("status"),
        D.source_code("source_elig_cd", cfg).alias("source_code"),
    )


def group_open(
    rows: DataFrame, tables: dict[str, DataFrame], cfg: ReportConfig = ReportConfig(), by: tuple[str, ...] = ()
) -> DataFrame:
    """SUM of the recovered amount over the 18 other report columns (and the columns ``by``)."""
    sums = rows.groupBy(*by, *(k for k in OPEN_GROUP_KEYS if k != "carrier_name")).agg(
        F.sum("remit_amt").alias("__total")
    )
    named = join_carriers(sums, listed_carriers(tables, cfg), "carrier_code", "left", cfg)
    return (
        named.withColumnRenamed("carrier_nm", "carrier_name")
        .withColumn("amount_recovered", (F.col("__total") * F.col("__times")).cast(D.MONEY_SUM))
        .select(*by, *OPEN_COLUMNS)
    )


def open_report(
    tables: dict[str, DataFrame],
    program: str,
    lo: dt.date,
    hi: dt.date,
    cfg: ReportConfig = ReportConfig(),
) -> DataFrame:
    """The OPEN report for one program ('ffs' or 'cco') and one bill-date window."""
    return group_open(open_rows(tables, program, lo, hi, cfg, status=cfg.open_report_status), tables, cfg)
