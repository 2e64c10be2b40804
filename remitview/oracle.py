"""DuckDB oracle SQL for every query in ``remitview.catalog``.

The reports are written from their meaning, in staged CTEs: filter the month, total per claim,
count denial lines per claim key, look texts up by first match in ``VALUES`` tables, group by all
other columns. Both sides read the same driver tables; the role stand-ins are re-declared here as
DuckDB CTEs.

Blank-padded comparison is written out as ``rtrim(x) = rtrim('literal')``.
"""

from __future__ import annotations

import datetime as dt

from remitview.config import ReportConfig
from remitview.sources import standins as S

CFG = ReportConfig()

# DuckDB spellings of the stand-in columns that use Spark-only date functions.
_DUCK_OVERRIDES = {
    "claim": {
        "from_dos": "CAST(o_orderdate AS DATE) - CAST(o_custkey % 20 AS INTEGER)",
        "thru_dos": "CAST(o_orderdate AS DATE) - 1",
        "rebill_dt": (
            "CASE WHEN o_orderpriority = '5-LOW' AND o_custkey % 2 = 0 THEN CAST(o_orderdate AS DATE) + 30 END"
        ),
        "recipient_id": "'R' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')",
        "icn": (
            "CASE o_orderkey % 101 WHEN 7 THEN NULL"
            " WHEN 8 THEN substring(CAST(o_orderkey AS VARCHAR), 1, 1)"
            " WHEN 9 THEN '60'"
            " ELSE lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') || lpad(CAST(o_orderkey AS VARCHAR), 8, '0')"
            " || lpad(CAST(o_custkey % 10 AS VARCHAR), 2, '0') END"
        ),
        "carrier_cd": (
            "CASE o_custkey % 25 WHEN 24 THEN '  CNEXC ' WHEN 23 THEN NULL"
            " ELSE 'C' || lpad(CAST(o_custkey % 25 AS VARCHAR), 2, '0') END"
        ),
    },
    "claim_header": {"paid_dt": "DATE '1996-01-01' + CAST(c_custkey % 365 AS INTEGER)"},
    "claim_b": {
        "last_name": "'LN' || CAST(l_partkey % 40 AS VARCHAR)",
        "recipient_id": "'R' || lpad(CAST(l_partkey AS VARCHAR), 9, '0')",
        "icn": (
            "lpad(CAST(l_orderkey % 100 AS VARCHAR), 2, '0') || lpad(CAST(l_orderkey AS VARCHAR), 8, '0')"
            " || lpad(CAST(l_linenumber AS VARCHAR), 2, '0')"
        ),
        "from_dos": "CAST(l_shipdate AS DATE) - 10",
        "thru_dos": "CAST(l_shipdate AS DATE) - 3",
        "paid_dt": "CAST(l_shipdate AS DATE) + CAST(l_partkey % 30 AS INTEGER)",
        "bill_dt": "CAST(l_shipdate AS DATE) - 5",
        "last_bill_dt": "CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(l_shipdate AS DATE) - 2 END",
        "remit_dt": "l_shipdate + to_minutes(l_linenumber * 200)",
        "carrier_cd": "'S' || CAST(l_suppkey AS VARCHAR)",
        "carrier_claim_ref": "'CR' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)",
        "carrier_ack_ts": "l_shipdate + INTERVAL 36 HOUR",
    },
    "denial": {"carrier_action_cd1": "'C' || substring(o_orderpriority, 1, 1)"},
}

_ROLE_SOURCES = {
    "claim": ("orders", S.CLAIM_EXPRS),
    "claim_header": ("customer", S.HEADER_EXPRS),
    "posting": ("lineitem", S.POSTING_EXPRS),
    "claim_b": ("lineitem", S.CLAIM_B_EXPRS),
}


def _select(role: str, where: str = "") -> str:
    table, exprs = _ROLE_SOURCES.get(role, (None, None)) if role != "denial" else ("orders", S.DENIAL_EXPRS)
    over = _DUCK_OVERRIDES.get(role, {})
    cols = ", ".join(f"{over.get(c, e)} AS {c}" for c, e in exprs.items())
    return f"SELECT {cols} FROM {table}" + (f" WHERE {where}" if where else "")


_ROLE_SQL = {
    "claim": lambda: _select("claim"),
    "claim_header": lambda: _select("claim_header"),
    "posting": lambda: _select("posting"),
    "carrier_a": lambda: (
        "SELECT 'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS carrier_cd, n_name AS carrier_nm,"
        " CASE WHEN n_regionkey IN (1, 2) THEN 'GCS' ELSE 'EXT' END AS data_source_cd,"
        " CASE WHEN n_regionkey = 2 THEN '0001' ELSE '0000' END AS carrier_office_cd FROM nation"
        " UNION ALL SELECT 'C' || lpad(CAST(r_regionkey AS VARCHAR), 2, '0'), r_name, 'GCS', '0000' FROM region"
    ),
    "claim_b": lambda: _select("claim_b"),
    "carrier_b": lambda: (
        "SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS carrier_cd, s_name AS carrier_nm,"
        " CASE WHEN s_acctbal > 0 THEN 'Y' ELSE 'N' END AS default_ind FROM supplier"
        " UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR), CASE WHEN s_nationkey = 0 THEN s_name"
        " ELSE s_name || ' ALT' END, 'Y' FROM supplier WHERE s_nationkey IN (0, 1)"
    ),
    "denial": lambda: _select("denial") + " UNION ALL " + _select("denial", "o_orderpriority = '1-URGENT'"),
}


def with_roles(*roles: str) -> str:
    return "WITH " + ",\n".join(f"{r} AS ({_ROLE_SQL[r]()})" for r in roles) + "\n"


# --- CASE builders ---------------------------------------------------------


def _key(expr: str, case_sensitive: bool) -> str:
    k = f"rtrim({expr})"
    return k if case_sensitive else f"lower({k})"


def case_first_match(expr: str, xwalk, default: str | None, case_sensitive: bool = True) -> str:
    """The crosswalk as an ordered CASE, comparing blank-padded."""
    branches = " ".join(
        f"WHEN {_key(expr, case_sensitive)} = {_key(S.sql_literal(code), case_sensitive)} THEN {S.sql_literal(desc)}"
        for code, _, desc in sorted(xwalk, key=lambda r: r[1])
    )
    return f"CASE {branches} ELSE {S.sql_literal(default)} END"


def _in_list(expr: str, codes, case_sensitive: bool = True) -> str:
    lits = ", ".join(_key(S.sql_literal(c), case_sensitive) for c in codes)
    return f"{_key(expr, case_sensitive)} IN ({lits})"


def case_denial_type(expr: str, case_sensitive: bool = True) -> str:
    parts = []
    for name in ("ACTIONABLE", "FINAL"):
        codes = [c for c, s in S.DENIAL_CODE_SET if s == name]
        parts.append(f"WHEN {_in_list(expr, codes, case_sensitive)} THEN '{name}'")
    return "CASE " + " ".join(parts) + " ELSE NULL END"


def not_excluded(expr: str) -> str:
    return "NOT " + _in_list(expr, S.ACTION_EXCLUSION)


# --- report templates ------------------------------------------------------

OPEN_STATUS_CASE = (
    "CASE WHEN {c} IN ('OPEN', 'DENIED', 'REVERSED') THEN {c}"
    " WHEN {c} IN ('PAID-PD', 'PAID-PP', 'PAID-OP', 'PAID-EP') THEN 'PAID' ELSE NULL END"
)
SOURCE_CASE = "CASE WHEN {c} = 'RS' THEN 'RSC' ELSE 'TPL' END"
DENIED_STATUS_CASE = (
    "CASE WHEN {c} = 'D' THEN 'DENIED' WHEN {c} = 'V' THEN 'VOID' WHEN {c} = '8' THEN 'REVERSED' ELSE 'OTHER' END"
)


def _first_match(name: str, xwalk) -> str:
    """CTE ``name(code, description)``: the text of least priority for each trimmed code."""
    rows = ", ".join(f"({S.sql_literal(c)}, {p}, {S.sql_literal(d)})" for c, p, d in xwalk)
    return f"""{name} AS (
  SELECT rtrim(v.code) AS code, v.description FROM (VALUES {rows}) v(code, priority, description)
  QUALIFY row_number() OVER (PARTITION BY rtrim(v.code) ORDER BY v.priority) = 1)"""


def _program(column: str, program: str | None) -> str:
    """Condition that a claim number belongs to the program; a null number belongs to none."""
    if program is None:
        return "TRUE"
    listed = ", ".join(S.sql_literal(x) for x in CFG.cco_prefixes)
    belongs = f"substring({column}, 1, 2) IN ({listed})"
    return belongs if program == "cco" else f"NOT {belongs}"


def open_sql(program: str | None, lo: dt.date, hi: dt.date) -> str:
    """Open claims of the month, from the report's meaning: totals per claim first, then carriers."""
    return with_roles("claim", "claim_header", "posting", "carrier_a").rstrip() + f""",
month AS (
  FROM claim SELECT * WHERE status_cd = 'OPEN' AND rebill_dt IS NULL AND bill_dt >= DATE '{lo}' AND bill_dt <= DATE '{hi}'),
eligible AS (
  FROM month SELECT * WHERE {_program("icn", program)} AND trim(carrier_cd) <> 'CNEXC' AND project_cd >= '30'
    AND bill_type_cd <> 'SP' AND contract_num = '478' AND delete_ind = 'N'),
totals AS (
  FROM posting SELECT claim_id, sum(coalesce(remit_amt, 0)) AS total WHERE delete_ind = 'N' GROUP BY claim_id),
names AS (
  FROM carrier_a SELECT carrier_cd AS code, carrier_nm AS name WHERE carrier_office_cd = '0000' AND data_source_cd = 'GCS'),
rows_out AS (
  SELECT e.ar_seq, e.last_name, e.first_name, e.recipient_id, left(e.icn, greatest(length(e.icn) - 2, 0)) AS icn,
    right(e.icn, 2) AS icn_detail_line, e.from_dos, e.thru_dos, e.bill_amt AS billed_amount,
    e.paid_amt AS line_paid_amount, hd.paid_hdr_amt AS paid_amount, hd.paid_dt AS paid_date,
    coalesce(t.total, 0) AS total, e.carrier_cd AS carrier_code, names.name AS carrier_name,
    e.bill_dt AS original_bill_date, e.bill_dt AS rebill_date, e.status_cd AS status,
    if(coalesce(e.source_elig_cd, '') = 'RS', 'RSC', 'TPL') AS source_code
  FROM eligible e INNER JOIN claim_header hd USING (header_id)
    LEFT JOIN totals t USING (claim_id) LEFT JOIN names ON names.code = e.carrier_cd)
SELECT * EXCLUDE (total), CAST(sum(total) AS DECIMAL(38,2)) AS amount_recovered FROM rows_out GROUP BY ALL
"""


def denied_ctes(program: str | None, lo: dt.date, hi: dt.date) -> str:
    """Roles and CTEs: ``kept`` (the month's denied claims with a default carrier) and ``reasons``
    (denial lines, counted, by claim key)."""
    excluded = ", ".join(f"({S.sql_literal(c)})" for c in S.ACTION_EXCLUSION)
    return with_roles("claim_b", "carrier_b", "denial").rstrip() + f""",
excluded AS (SELECT DISTINCT rtrim(v.code) AS code FROM (VALUES {excluded}) v(code)),
carriers AS (FROM carrier_b SELECT carrier_cd, carrier_nm WHERE default_ind = 'Y'),
kept AS (
  SELECT b.*, carriers.carrier_nm FROM claim_b b INNER JOIN carriers USING (carrier_cd)
    ANTI JOIN excluded ON excluded.code = rtrim(b.action_cd)
  WHERE b.action_cd IS NOT NULL AND b.transact_status_cd IN ('8', 'D', 'V') AND b.contract_num = '478'
    AND b.remit_dt >= TIMESTAMP '{lo}' AND b.remit_dt < TIMESTAMP '{hi}' + INTERVAL 1 DAY
    AND {_program("b.icn", program)}),
reasons AS (
  FROM denial SELECT ar_seq, action_cd1, carrier_action_cd1, carrier_action_cd2, count(*) AS times
  WHERE contract_num = '478' GROUP BY ALL)"""


def denied_sql(program: str | None, lo: dt.date, hi: dt.date) -> str:
    """Denied claims of the month: each claim line times its denial lines, texts looked up."""
    types = [(code, ("ACTIONABLE", "FINAL").index(name), name) for code, name in S.DENIAL_CODE_SET]
    day = lambda c: f"strftime({c}, '%m/%d/%y')"
    return denied_ctes(program, lo, hi) + f""",
{_first_match("actions", S.ACTION_XWALK)},
{_first_match("types", types)},
{_first_match("texts1", S.CARRIER_XWALK1)},
{_first_match("texts2", S.CARRIER_XWALK2)},
rows_out AS (
  SELECT k.ar_seq, k.last_name, k.first_name, k.recipient_id, left(k.icn, greatest(length(k.icn) - 2, 0)) AS icn,
    right(k.icn, 2) AS icn_detail_line, {day("k.from_dos")} AS from_dos, {day("k.thru_dos")} AS thru_dos,
    k.bill_amt AS billed_amount, k.paid_amt AS line_paid_amount, k.hdr_paid_amt AS paid_amount,
    {day("k.paid_dt")} AS paid_date, r.action_cd1 AS denial_action_cd, actions.description AS action_description,
    r.carrier_action_cd1, if(texts1.code IS NULL, 'NOCOD', texts1.description) AS carrier_description1,
    r.carrier_action_cd2, if(texts2.code IS NULL, 'NOCOD', texts2.description) AS carrier_description2,
    types.description AS denial_type, k.carrier_cd AS carrier_code, k.carrier_nm AS carrier_name,
    k.carrier_claim_ref AS carrier_denial_claim_number, k.carrier_ack_ts AS carrier_action_date,
    {day("k.bill_dt")} AS original_bill_date, {day("k.last_bill_dt")} AS rebill_date,
    {DENIED_STATUS_CASE.format(c="k.transact_status_cd")} AS status,
    if(coalesce(k.source_elig_cd, '') = 'RS', 'RSC', 'TPL') AS source_code, k.remit_amt * r.times AS total
  FROM kept k INNER JOIN reasons r USING (ar_seq)
    LEFT JOIN actions ON actions.code = rtrim(k.action_cd) LEFT JOIN types ON types.code = rtrim(k.action_cd)
    LEFT JOIN texts1 ON texts1.code = rtrim(k.carrier_action_cd) LEFT JOIN texts2 ON texts2.code = rtrim(r.carrier_action_cd2))
SELECT * EXCLUDE (total), CAST(sum(total) AS DECIMAL(38,2)) AS actual_amount_recovered FROM rows_out GROUP BY ALL
"""


# --- operator queries ------------------------------------------------------

_M_LO, _M_HI = "1996-08-01", "1996-08-31"
_Y_LO, _Y_HI = "1996-01-01", "1996-12-31"


def _claim(sql: str) -> str:
    return with_roles("claim") + sql


def _page_ranks(code: str) -> str:
    """A code's letters as their places in the code page; lists compare letter by letter."""
    page = "".join(chr(i) for i in sorted(range(32, 127), key=lambda i: chr(i).encode("cp037")))
    return f"list_transform(string_split({code}, ''), lambda x: strpos({S.sql_literal(page)}, x))"


def _claim_b(sql: str) -> str:
    return with_roles("claim_b") + sql


def _action_sql(case_sensitive: bool) -> str:
    return _claim_b(
        f"SELECT action_cd, {case_first_match('action_cd', S.ACTION_XWALK, None, case_sensitive)} AS action_description,"
        " COUNT(*) AS n FROM claim_b GROUP BY 1, 2"
    )


def _both_programs(template) -> str:
    parts = [f"SELECT '{p}' AS program, * FROM ({template(p, _M_LO, _M_HI)}) {p}_rows" for p in ("ffs", "cco")]
    return " UNION ALL ".join(parts)


def _headed(sql: str, template: str) -> str:
    from remitview.plans.headers import headers_for

    return "SELECT " + ", ".join(f'{c} AS "{h}"' for c, h in headers_for(template, "cco")) + f" FROM ({sql}) report"


def oracle_queries() -> dict[str, str]:
    return {
        "open_ffs": open_sql("ffs", _M_LO, _M_HI),
        "open_cco": open_sql("cco", _Y_LO, _Y_HI),
        "denied_ffs": denied_sql("ffs", _M_LO, _M_HI),
        "denied_cco": denied_sql("cco", _Y_LO, _Y_HI),
        "month_open": _both_programs(open_sql),
        "month_denied": _both_programs(denied_sql),
        "report_headers": _headed(open_sql("cco", _Y_LO, _Y_HI), "open"),
        "denied_report_headers": _headed(denied_sql("cco", _Y_LO, _Y_HI), "denied"),
        "padded_carrier_join": with_roles("claim", "carrier_a")
        + "SELECT c.carrier_cd, a.carrier_nm, COUNT(*) AS n FROM"
        " (SELECT if(claim_id % 2 = 1, carrier_cd || '   ', carrier_cd) AS carrier_cd FROM claim) c"
        " LEFT JOIN carrier_a a ON a.carrier_cd = rtrim(c.carrier_cd) AND a.data_source_cd = 'GCS'"
        " AND a.carrier_office_cd = '0000' GROUP BY 1, 2",
        "prev_month_window": _claim(
            "SELECT claim_id,"
            " CAST(date_trunc('month', bill_dt - INTERVAL 1 MONTH) AS DATE) AS first_day,"
            " CAST(last_day(bill_dt - INTERVAL 1 MONTH) AS DATE) AS last_day,"
            f" bill_dt BETWEEN DATE '{_M_LO}' AND DATE '{_M_HI}' AS in_report_window FROM claim"
        ),
        "program_split": _claim(
            "SELECT substring(icn, 1, 2) AS icn_prefix,"
            " CASE WHEN substring(icn, 1, 2) IN ('60', '70') THEN 'cco'"
            " WHEN substring(icn, 1, 2) NOT IN ('60', '70') THEN 'ffs' END AS program,"
            " COUNT(*) AS n FROM claim GROUP BY 1, 2"
        ),
        "claim_number_split": _claim(
            "SELECT claim_id, icn, substring(icn, 1, length(icn) - 2) AS icn_stem, right(icn, 2) AS icn_line FROM claim"
        ),
        "lexical_code_range": _claim(
            "SELECT project_cd, COUNT(*) AS n FROM claim WHERE project_cd >= '30' GROUP BY project_cd"
        ),
        "lexical_code_collated": _claim(
            f"SELECT project_cd, project_cd >= '30' AS in_binary_order, {_page_ranks('project_cd')} >= {_page_ranks(chr(39) + '30' + chr(39))} AS in_code_page,"
            f" COUNT(*) AS n FROM (SELECT {S.LETTERED_PROJECT} AS project_cd FROM claim) GROUP BY ALL"
        ),
        "null_rejecting_filters": _claim(
            "SELECT bill_type_cd, carrier_cd, COUNT(*) AS n FROM claim"
            " WHERE bill_type_cd <> 'SP' AND trim(carrier_cd) <> 'CNEXC' GROUP BY 1, 2"
        ),
        "header_join": with_roles("claim", "claim_header")
        + "SELECT c.claim_id, c.header_id, h.paid_hdr_amt, h.paid_dt FROM claim c"
        " JOIN claim_header h ON c.header_id = h.header_id",
        "left_join_on_predicate": with_roles("claim", "posting")
        + "SELECT c.claim_id, COUNT(p.claim_id) AS n_live_postings,"
        " CAST(SUM(p.remit_amt) AS DECIMAL(38,2)) AS live_remit_total FROM claim c"
        " LEFT JOIN posting p ON c.claim_id = p.claim_id AND p.delete_ind = 'N' GROUP BY c.claim_id",
        "carrier_lookup": with_roles("claim", "carrier_a")
        + "SELECT c.claim_id, c.carrier_cd, a.carrier_nm FROM claim c"
        " LEFT OUTER JOIN carrier_a a ON a.carrier_cd = c.carrier_cd AND a.data_source_cd = 'GCS'"
        " AND a.carrier_office_cd = '0000'",
        "recovered_zero_default": with_roles("claim", "posting")
        + "SELECT claim_id, CAST(SUM(remit_amt) AS DECIMAL(38,2)) AS amount_recovered FROM ("
        " SELECT c.claim_id, CASE WHEN p.remit_amt IS NULL THEN 0.00 ELSE p.remit_amt END AS remit_amt"
        " FROM claim c LEFT JOIN posting p ON c.claim_id = p.claim_id AND p.delete_ind = 'N') t GROUP BY claim_id",
        "post_agg_status": open_sql(None, _Y_LO, _Y_HI),
        "rebill_fallback": _claim(
            "SELECT claim_id, bill_dt, rebill_dt,"
            " CASE WHEN rebill_dt IS NOT NULL THEN rebill_dt ELSE bill_dt END AS rebill_date,"
            " rebill_dt IS NULL AS never_rebilled FROM claim"
        ),
        "open_status": _claim(
            f"SELECT status_cd, {OPEN_STATUS_CASE.format(c='status_cd')} AS status, COUNT(*) AS n"
            " FROM claim GROUP BY 1, 2"
        ),
        "source_code": _claim_b(
            f"SELECT source_elig_cd, {SOURCE_CASE.format(c='source_elig_cd')} AS source_code, COUNT(*) AS n"
            " FROM claim_b GROUP BY 1, 2"
        ),
        "action_description": _action_sql(True),
        "action_description_nocase": _action_sql(False),
        "carrier_description": with_roles("claim_b", "denial")
        + "SELECT side, code, description, COUNT(*) AS n FROM ("
        f" SELECT 'claim' AS side, carrier_action_cd AS code,"
        f" {case_first_match('carrier_action_cd', S.CARRIER_XWALK1, 'NOCOD')} AS description FROM claim_b"
        " UNION ALL"
        f" SELECT 'denial', carrier_action_cd2,"
        f" {case_first_match('carrier_action_cd2', S.CARRIER_XWALK2, 'NOCOD')} FROM denial"
        ") t GROUP BY 1, 2, 3",
        "denial_type": _claim_b(
            f"SELECT action_cd, {case_denial_type('action_cd')} AS denial_type, COUNT(*) AS n"
            " FROM claim_b GROUP BY 1, 2"
        ),
        "action_exclusion": _claim_b(
            f"SELECT action_cd, COUNT(*) AS n FROM claim_b WHERE {not_excluded('action_cd')} GROUP BY 1"
        ),
        "left_join_collapse": with_roles("claim_b", "carrier_b")
        + "SELECT b.carrier_cd, b.carrier_nm, COUNT(*) AS n,"
        " CAST(SUM(a.remit_amt) AS DECIMAL(38,2)) AS remit_total FROM claim_b a"
        " LEFT JOIN carrier_b b ON a.carrier_cd = b.carrier_cd WHERE b.default_ind = 'Y' GROUP BY 1, 2",
        "right_join_collapse": with_roles("claim_b", "denial")
        + "SELECT a.ar_seq, COUNT(*) AS n, CAST(SUM(a.remit_amt) AS DECIMAL(38,2)) AS remit_total"
        " FROM claim_b a RIGHT OUTER JOIN denial c ON a.contract_num = c.contract_num AND a.ar_seq = c.ar_seq"
        " WHERE a.contract_num = '478' GROUP BY a.ar_seq",
        "recovered_fanout_sum": denied_ctes(None, _Y_LO, _Y_HI)
        + """, lines AS (SELECT ar_seq, sum(times) AS times FROM reasons GROUP BY ar_seq)
SELECT ar_seq, left(icn, greatest(length(icn) - 2, 0)) AS icn, right(icn, 2) AS icn_detail_line,
  CAST(sum(remit_amt * times) AS DECIMAL(38,2)) AS actual_amount_recovered
FROM kept INNER JOIN lines USING (ar_seq) GROUP BY ALL""",
        "group_by_ordinal": _claim_b(
            "SELECT carrier_cd, transact_status_cd, substring(icn, 1, 2) AS icn_prefix,"
            " CAST(SUM(remit_amt) AS DECIMAL(38,2)) AS remit_total, COUNT(*) AS n FROM claim_b GROUP BY 1, 2, 3"
        ),
        "distinct_after_group": _claim_b(
            f"SELECT DISTINCT carrier_cd, {SOURCE_CASE.format(c='source_elig_cd')} AS source_code,"
            " CAST(SUM(remit_amt) AS DECIMAL(38,2)) AS remit_total FROM claim_b GROUP BY 1, 2"
        ),
        "denied_status": _claim_b(
            f"SELECT transact_status_cd, {DENIED_STATUS_CASE.format(c='transact_status_cd')} AS status,"
            " transact_status_cd IN ('D', '8', 'V') AS in_report, COUNT(*) AS n FROM claim_b GROUP BY 1, 2, 3"
        ),
        "cast_date_window": _claim_b(
            "SELECT CAST(remit_dt AS DATE) AS remit_date, COUNT(*) AS n, MAX(remit_dt) AS last_remit_ts"
            f" FROM claim_b WHERE CAST(remit_dt AS DATE) BETWEEN DATE '{_M_LO}' AND DATE '{_M_HI}' GROUP BY 1"
        ),
        "date_text": _claim_b(
            "SELECT ar_seq, icn, strftime(from_dos, '%m/%d/%y') AS from_dos, strftime(thru_dos, '%m/%d/%y') AS thru_dos,"
            " strftime(paid_dt, '%m/%d/%y') AS paid_date, strftime(bill_dt, '%m/%d/%y') AS original_bill_date,"
            " strftime(last_bill_dt, '%m/%d/%y') AS rebill_date FROM claim_b"
        ),
        "display_format": with_roles("claim", "claim_header")
        + f"SELECT c.claim_id, {_money('c.bill_amt')} AS billed_display, {_money('h.paid_hdr_amt')} AS paid_display,"
        " strftime(c.bill_dt, '%m/%d/%Y') AS bill_date_display, strftime(h.paid_dt, '%m/%d/%Y') AS paid_date_display"
        " FROM claim c JOIN claim_header h ON c.header_id = h.header_id",
        "quoted_line": _quoted_line_sql(),
    }


def _money(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} < 0 THEN '-$' || format('{{:,.2f}}', abs({x}))"
        f" ELSE '$' || format('{{:,.2f}}', {x}) END"
    )


def _line(cols) -> str:
    parts = " || '\",\"' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'None')" for c in cols)
    return f"'\"' || {parts} || '\"'"


def _quoted_line_sql() -> str:
    from remitview.plans.headers import DENIED_COLUMNS, OPEN_COLUMNS

    open_q = open_sql("ffs", _Y_LO, _Y_HI)
    denied_q = denied_sql("ffs", _M_LO, _M_HI)
    # Each template query starts with its own WITH; wrap both as subqueries.
    return (
        f"SELECT 'open' AS report, {_line(OPEN_COLUMNS)} AS line FROM ({open_q}) o"
        f" UNION ALL SELECT 'denied', {_line(DENIED_COLUMNS)} FROM ({denied_q}) d"
    )
