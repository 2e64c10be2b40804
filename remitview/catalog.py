"""Registered queries: one per operator group of the reference (see README).

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the driver's
test tables (through the role stand-ins in ``sources.standins``).  Every query
reads whole tables; the only row filters are the report semantics themselves
(month / year windows, programs, statuses).  ``remitview.oracle`` has the
DuckDB twin of each key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitview.config import ReportConfig
from remitview.functions import derive as D
from remitview.functions import period
from remitview.functions import present as P
from remitview.operators import crosswalk as X
from remitview.operators.carriers import carrier_counts, join_carriers
from remitview.operators.preagg import contract_denials, live_posting_totals
from remitview.plans import denied_report as DR
from remitview.plans import open_report as OR
from remitview.plans import run as R
from remitview.plans.headers import DENIED_COLUMNS, OPEN_COLUMNS, to_headers
from remitview.sources import standins as S

CFG = ReportConfig()
CFG_NOCASE = ReportConfig(case_sensitive_codes=False)
CFG_CODE_PAGE = ReportConfig(code_order="cp037")
CFG_PADDED = ReportConfig(blank_padded=True)

# Report windows of the stand-in data: the run of 1996-09-15 reports August
# 1996; the thin CCO program is reported over the whole of 1996.
AS_OF = dt.date(1996, 9, 15)
MONTH_LO, MONTH_HI = period.prev_month_window(AS_OF)
YEAR_LO, YEAR_HI = dt.date(1996, 1, 1), dt.date(1996, 12, 31)

Query = Callable[[SparkSession, str], DataFrame]


def _open(spark, sf_dir):
    return S.open_tables(spark, sf_dir)


def _denied(spark, sf_dir):
    return S.denied_tables(spark, sf_dir)


def _count(name="n"):
    return F.count(F.lit(1)).alias(name)


# --- the four reports ------------------------------------------------------


def open_ffs(spark, sf_dir):
    return OR.open_report(_open(spark, sf_dir), "ffs", MONTH_LO, MONTH_HI, CFG)


def open_cco(spark, sf_dir):
    return OR.open_report(_open(spark, sf_dir), "cco", YEAR_LO, YEAR_HI, CFG)


def denied_ffs(spark, sf_dir):
    return DR.denied_report(_denied(spark, sf_dir), "ffs", MONTH_LO, MONTH_HI, CFG)


def denied_cco(spark, sf_dir):
    return DR.denied_report(_denied(spark, sf_dir), "cco", YEAR_LO, YEAR_HI, CFG)


def _month(spark, sf_dir, template):
    tables = {**_open(spark, sf_dir), **_denied(spark, sf_dir)}
    return R.BUILDERS[template](tables, MONTH_LO, MONTH_HI, CFG)


def month_open(spark, sf_dir):
    """K2: the monthly run's own plan, open claims of both programs in one pass."""
    return _month(spark, sf_dir, "open")


def month_denied(spark, sf_dir):
    """K2: the monthly run's own plan, denied claims of both programs in one pass."""
    return _month(spark, sf_dir, "denied")


def report_headers(spark, sf_dir):
    """The CCO open report under its extract headers (with their one odd spelling)."""
    return to_headers(open_cco(spark, sf_dir), "open", "cco")


def denied_report_headers(spark, sf_dir):
    """The CCO denied report under its extract headers."""
    return to_headers(denied_cco(spark, sf_dir), "denied", "cco")


# --- run parameters, scalar functions, filters -----------------------------


def prev_month_window(spark, sf_dir):
    """M1/M2: report window of every bill date taken as a run date, and the report-window test."""
    claim = _open(spark, sf_dir)["claim"]
    first, last = period.prev_month_bounds(F.col("bill_dt"))
    return claim.select(
        "claim_id",
        first.alias("first_day"),
        last.alias("last_day"),
        F.col("bill_dt").between(F.lit(MONTH_LO), F.lit(MONTH_HI)).alias("in_report_window"),
    )


def program_split(spark, sf_dir):
    """Program of each claim number (null number: neither)."""
    claim = _open(spark, sf_dir)["claim"]
    return claim.groupBy(
        D.icn_prefix("icn").alias("icn_prefix"), D.program_of("icn", CFG).alias("program")
    ).agg(_count())


def claim_number_split(spark, sf_dir):
    """claim number stem and detail line."""
    claim = _open(spark, sf_dir)["claim"]
    return claim.select(
        "claim_id", "icn", D.icn_stem("icn").alias("icn_stem"), D.icn_line("icn").alias("icn_line")
    )


def lexical_code_range(spark, sf_dir):
    """Text comparison on the project code."""
    claim = _open(spark, sf_dir)["claim"]
    return claim.where(D.at_least("project_cd", CFG.project_floor, CFG)).groupBy("project_cd").agg(_count())


def lexical_code_collated(spark, sf_dir):
    """W2 for a source whose code page orders letters before digits: both orders of every code."""
    claim = S.lettered_projects(_open(spark, sf_dir))["claim"]
    return claim.groupBy(
        "project_cd",
        D.at_least("project_cd", CFG.project_floor, CFG).alias("in_binary_order"),
        D.at_least("project_cd", CFG_CODE_PAGE.project_floor, CFG_CODE_PAGE).alias("in_code_page"),
    ).agg(_count())


def null_rejecting_filters(spark, sf_dir):
    """W4/W8/F4: '<>' and trimmed '<>' both reject nulls."""
    claim = _open(spark, sf_dir)["claim"]
    kept = claim.where(
        (F.col("bill_type_cd") != F.lit(CFG.excluded_bill_type)) & D.not_equal_trimmed("carrier_cd", CFG.excluded_carrier)
    )
    return kept.groupBy("bill_type_cd", "carrier_cd").agg(_count())


def rebill_fallback(spark, sf_dir):
    """Rebill date falls back to the bill date."""
    claim = _open(spark, sf_dir)["claim"]
    return claim.select(
        "claim_id",
        "bill_dt",
        "rebill_dt",
        D.rebill_or_bill("rebill_dt", "bill_dt").alias("rebill_date"),
        F.col("rebill_dt").isNull().alias("never_rebilled"),
    )


def open_status(spark, sf_dir):
    """Open-report status of every claim status code."""
    claim = _open(spark, sf_dir)["claim"]
    return claim.groupBy("status_cd", D.open_status("status_cd", CFG).alias("status")).agg(_count())


def source_code(spark, sf_dir):
    """Eligibility source label (null -> TPL)."""
    claim = _denied(spark, sf_dir)["claim_b"]
    return claim.groupBy("source_elig_cd", D.source_code("source_elig_cd", CFG).alias("source_code")).agg(_count())


def denied_status(spark, sf_dir):
    """Denied status label and the status filter."""
    claim = _denied(spark, sf_dir)["claim_b"]
    code = F.col("transact_status_cd")
    return claim.groupBy(
        "transact_status_cd",
        D.denied_status(code, CFG).alias("status"),
        code.isin(*CFG.denied_status_filter).alias("in_report"),
    ).agg(_count())


def cast_date_window(spark, sf_dir):
    """Remit timestamps cast to date before the window test."""
    claim = _denied(spark, sf_dir)["claim_b"]
    in_window = claim.where(D.as_date_col("remit_dt").between(F.lit(MONTH_LO), F.lit(MONTH_HI)))
    return in_window.groupBy(D.as_date_col("remit_dt").alias("remit_date")).agg(
        _count(), F.max("remit_dt").alias("last_remit_ts")
    )


def date_text(spark, sf_dir):
    """dates as MM/DD/YY text."""
    claim = _denied(spark, sf_dir)["claim_b"]
    return claim.select(
        "ar_seq",
        "icn",
        D.date_text("from_dos").alias("from_dos"),
        D.date_text("thru_dos").alias("thru_dos"),
        D.date_text("paid_dt").alias("paid_date"),
        D.date_text("bill_dt").alias("original_bill_date"),
        D.date_text("last_bill_dt").alias("rebill_date"),
    )


# --- joins and aggregation -------------------------------------------------


def header_join(spark, sf_dir):
    """Claim to claim header (inner)."""
    t = _open(spark, sf_dir)
    header = t["claim_header"].select("header_id", "paid_hdr_amt", "paid_dt")
    return t["claim"].select("claim_id", "header_id").join(header, "header_id", "inner")


def left_join_on_predicate(spark, sf_dir):
    """Live postings per claim; a claim with none keeps a null amount."""
    t = _open(spark, sf_dir)
    totals = live_posting_totals(t["posting"], None, CFG)
    joined = t["claim"].select("claim_id").join(totals, "claim_id", "left")
    return joined.select(
        "claim_id",
        F.coalesce(F.col("n_postings"), F.lit(0)).alias("n_live_postings"),
        F.col("remit_total").cast(D.MONEY_SUM).alias("live_remit_total"),
    )


def carrier_lookup(spark, sf_dir):
    """Left join to the carrier dimension with constants in ON (fan-out kept)."""
    t = _open(spark, sf_dir)
    carriers = OR.listed_carriers(t, CFG).select("carrier_cd", "carrier_nm")
    return t["claim"].select("claim_id", "carrier_cd").join(carriers, "carrier_cd", "left")


def padded_carrier_join(spark, sf_dir):
    """J3 on CHAR columns: claims counted by carrier, padded on one side, the other or both."""
    t = S.padded_carriers(_open(spark, sf_dir))
    per_code = t["claim"].groupBy("carrier_cd").agg(_count("n_claims"))
    named = join_carriers(per_code, OR.listed_carriers(t, CFG_PADDED), "carrier_cd", "left", CFG_PADDED)
    return named.select("carrier_cd", "carrier_nm", (F.col("n_claims") * F.col("__times")).alias("n"))


def recovered_zero_default(spark, sf_dir):
    """Recovered amount per claim, 0.00 without live postings."""
    t = _open(spark, sf_dir)
    totals = live_posting_totals(t["posting"], None, CFG)
    joined = t["claim"].select("claim_id").join(totals, "claim_id", "left")
    return joined.select("claim_id", D.zero_if_null("remit_total").cast(D.MONEY_SUM).alias("amount_recovered"))


def post_agg_status(spark, sf_dir):
    """The OPEN aggregate over all programs with the status filter *after* grouping."""
    t = _open(spark, sf_dir)
    rows = OR.open_rows(t, None, YEAR_LO, YEAR_HI, CFG, status=None)
    return OR.group_open(rows, t, CFG).where(F.col("status") == F.lit(CFG.open_report_status))


def left_join_collapse(spark, sf_dir):
    """A WHERE on the carrier's default flag turns the left join into an inner join."""
    t = _denied(spark, sf_dir)
    per_code = t["claim_b"].groupBy("carrier_cd").agg(_count("n_claims"), F.sum("remit_amt").alias("remit"))
    named = join_carriers(per_code, DR.default_carriers(t, CFG), "carrier_cd", "inner", CFG)
    return named.select(
        "carrier_cd",
        "carrier_nm",
        (F.col("n_claims") * F.col("__times")).alias("n"),
        (F.col("remit") * F.col("__times")).cast(D.MONEY_SUM).alias("remit_total"),
    )


def _denials_per_claim(t):
    """Denial rows of the contract, counted per claim key (map-side combine)."""
    return contract_denials(t["denial"], None, CFG).groupBy("ar_seq").agg(_count("n_denials"))


def right_join_collapse(spark, sf_dir):
    """Claim RIGHT JOIN denial with WHERE on claim columns = inner join; k denials -> k rows."""
    t = _denied(spark, sf_dir)
    claims = t["claim_b"].where(F.col("contract_num") == F.lit(CFG.contract_num))
    per_claim = claims.groupBy("ar_seq").agg(_count("n_claims"), F.sum("remit_amt").alias("remit"))
    joined = per_claim.join(_denials_per_claim(t), "ar_seq", "inner")
    return joined.select(
        "ar_seq",
        (F.col("n_claims") * F.col("n_denials")).alias("n"),
        (F.col("remit") * F.col("n_denials")).cast(D.MONEY_SUM).alias("remit_total"),
    )


def recovered_fanout_sum(spark, sf_dir):
    """A2: denied amounts with join fan-out, no null default, over all programs."""
    t = _denied(spark, sf_dir)
    claims = DR.denied_claims(t, None, YEAR_LO, YEAR_HI, CFG).select("ar_seq", "icn", "carrier_cd", "remit_amt")
    times = carrier_counts(DR.default_carriers(t, CFG), CFG)
    fanned = claims.join(times, F.col("carrier_cd") == F.col("__carrier"), "inner")
    per_line = fanned.groupBy("ar_seq", D.icn_stem("icn").alias("icn"), D.icn_line("icn").alias("icn_detail_line")).agg(
        F.sum(F.col("remit_amt") * F.col("__times")).alias("remit")
    )
    joined = per_line.join(_denials_per_claim(t), "ar_seq", "inner")
    return joined.select(
        "ar_seq", "icn", "icn_detail_line",
        (F.col("remit") * F.col("n_denials")).cast(D.MONEY_SUM).alias("actual_amount_recovered"),
    )


def group_by_ordinal(spark, sf_dir):
    """A2 (SQL form): GROUP BY column ordinals."""
    return spark.sql(
        """
        SELECT carrier_cd, transact_status_cd, substring(icn, 1, 2) AS icn_prefix,
               CAST(SUM(remit_amt) AS DECIMAL(38,2)) AS remit_total, COUNT(*) AS n
        FROM {claim_b}
        GROUP BY 1, 2, 3
        """,
        claim_b=_denied(spark, sf_dir)["claim_b"],
    )


def distinct_after_group(spark, sf_dir):
    """A3: DISTINCT over a grouped result (Catalyst drops it)."""
    claim = _denied(spark, sf_dir)["claim_b"]
    grouped = claim.groupBy("carrier_cd", D.source_code("source_elig_cd", CFG).alias("source_code")).agg(
        F.sum("remit_amt").cast(D.MONEY_SUM).alias("remit_total")
    )
    return grouped.distinct()


# --- crosswalks, code sets, exclusion --------------------------------------


def _action_lookup(spark, sf_dir, cfg):
    t = _denied(spark, sf_dir)
    cs = cfg.case_sensitive_codes
    counted = t["claim_b"].groupBy("action_cd").agg(_count())
    return X.lookup(counted, "action_cd", X.resolve(t["action_xwalk"], cs), "action_description", None, cs)


def action_description(spark, sf_dir):
    """First-match, blank-padded action crosswalk."""
    return _action_lookup(spark, sf_dir, CFG)


def action_description_nocase(spark, sf_dir):
    """The same crosswalk compared case-insensitively."""
    return _action_lookup(spark, sf_dir, CFG_NOCASE)


def carrier_description(spark, sf_dir):
    """Carrier crosswalks (ELSE 'NOCOD', also for null codes) on claim and denial codes."""
    t = _denied(spark, sf_dir)

    def described(codes, xwalk, side):
        counted = codes.groupBy("code").agg(_count())
        texts = X.lookup(counted, "code", X.resolve(xwalk), "description", CFG.carrier_desc_default)
        return texts.withColumn("side", F.lit(side))

    claim_codes = t["claim_b"].select(F.col("carrier_action_cd").alias("code"))
    denial_codes = t["denial"].select(F.col("carrier_action_cd2").alias("code"))
    return described(claim_codes, t["carrier_xwalk1"], "claim").unionByName(
        described(denial_codes, t["carrier_xwalk2"], "denial")
    )


def denial_type(spark, sf_dir):
    """ACTIONABLE / FINAL / null from two ordered code sets."""
    t = _denied(spark, sf_dir)
    resolved = X.resolve(X.code_sets_as_crosswalk(t["denial_code_set"], ("ACTIONABLE", "FINAL")))
    return X.lookup(t["claim_b"].groupBy("action_cd").agg(_count()), "action_cd", resolved, "denial_type")


def action_exclusion(spark, sf_dir):
    """NOT IN a literal list (nulls rejected, comma literal not split)."""
    t = _denied(spark, sf_dir)
    return X.exclude_codes(t["claim_b"].groupBy("action_cd").agg(_count()), "action_cd", t["action_exclusion"])


# --- presentation ----------------------------------------------------------


def display_format(spark, sf_dir):
    """money as $#,##0.00 and dates as MM/DD/YYYY."""
    t = _open(spark, sf_dir)
    header = t["claim_header"].select("header_id", "paid_hdr_amt", "paid_dt")
    rows = t["claim"].select("claim_id", "header_id", "bill_amt", "bill_dt").join(header, "header_id", "inner")
    return rows.select(
        "claim_id",
        P.display_money("bill_amt").alias("billed_display"),
        P.display_money("paid_hdr_amt").alias("paid_display"),
        P.display_date("bill_dt").alias("bill_date_display"),
        P.display_date("paid_dt").alias("paid_date_display"),
    )


def quoted_line(spark, sf_dir):
    """Extract lines of the FFS open (1996) and FFS denied (August) reports."""
    open_rep = OR.open_report(_open(spark, sf_dir), "ffs", YEAR_LO, YEAR_HI, CFG)
    denied_rep = DR.denied_report(_denied(spark, sf_dir), "ffs", MONTH_LO, MONTH_HI, CFG)
    open_lines = open_rep.select(
        F.lit("open").alias("report"), P.quoted_line(list(OPEN_COLUMNS), schema=open_rep.schema).alias("line")
    )
    denied_lines = denied_rep.select(
        F.lit("denied").alias("report"), P.quoted_line(list(DENIED_COLUMNS), schema=denied_rep.schema).alias("line")
    )
    return open_lines.unionByName(denied_lines)


QUERIES: dict[str, Query] = {
    "open_ffs": open_ffs,
    "open_cco": open_cco,
    "denied_ffs": denied_ffs,
    "denied_cco": denied_cco,
    "month_open": month_open,
    "month_denied": month_denied,
    "report_headers": report_headers,
    "denied_report_headers": denied_report_headers,
    "prev_month_window": prev_month_window,
    "program_split": program_split,
    "claim_number_split": claim_number_split,
    "lexical_code_range": lexical_code_range,
    "lexical_code_collated": lexical_code_collated,
    "null_rejecting_filters": null_rejecting_filters,
    "header_join": header_join,
    "left_join_on_predicate": left_join_on_predicate,
    "carrier_lookup": carrier_lookup,
    "padded_carrier_join": padded_carrier_join,
    "recovered_zero_default": recovered_zero_default,
    "post_agg_status": post_agg_status,
    "rebill_fallback": rebill_fallback,
    "open_status": open_status,
    "source_code": source_code,
    "action_description": action_description,
    "action_description_nocase": action_description_nocase,
    "carrier_description": carrier_description,
    "denial_type": denial_type,
    "action_exclusion": action_exclusion,
    "left_join_collapse": left_join_collapse,
    "right_join_collapse": right_join_collapse,
    "recovered_fanout_sum": recovered_fanout_sum,
    "group_by_ordinal": group_by_ordinal,
    "distinct_after_group": distinct_after_group,
    "denied_status": denied_status,
    "cast_date_window": cast_date_window,
    "date_text": date_text,
    "display_format": display_format,
    "quoted_line": quoted_line,
}
