"""Report roles built from the driver's test tables (TPC-H-like parquet).

The driver tables stand in for the claim systems:

==============  =====================================  ===========================
role            stand-in                               key / notes
==============  =====================================  ===========================
claim           orders                                 claim_id = o_orderkey
claim_header    customer                               header_id = o_custkey
posting         lineitem                               claim_id = l_orderkey, live
                                                       unless l_returnflag = 'R'
carrier_a       nation + region                        carrier 'Cnn'; two rows for
                                                       C00..C04 (fan-out)
claim_b         lineitem                               ar_seq = l_orderkey; the
                                                       (orderkey, linenumber)
                                                       repeats give equal claims
carrier_b       supplier (+ duplicate rows for two     carrier 'S<suppkey>'
                nations)
denial          orders (+ a duplicate of each          ar_seq = o_orderkey; orders
                1-URGENT order)                        without lines = denials
                                                       without a claim
==============  =====================================  ===========================

Attribute columns are deterministic functions of the source columns (codes,
nulls, padding and short claim numbers included), so every edge case of the
templates occurs in the data at every scale.  The crosswalk inputs are small
invented tables with the same shapes as the real ones (padded keys, shadowed
keys, a case pair, the empty code, a slash pair, a literal with a comma).

``remitview.oracle`` builds the same roles in DuckDB SQL.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Invented fixture values (codes and texts are made up; shapes match the
# production crosswalks).  Index i of a *_IN_DATA list is the code of rows
# whose selector column modulo len(list) equals i.
# ---------------------------------------------------------------------------
ACTION_CODES_IN_DATA = (
    "K01", "K02", "K03", "K03   ", "K04", "ab", "AB", "Ab", "", "   ",
    None, "P1/P2", "XA", "XB", "XA, XB", "ZZZ9", "K06", "K05",
)
CARRIER_CODES_IN_DATA = ("L02", "L01", "K03 ", "", "  ", None, "UNKN", "K05", "l01")
DENIAL_CD2_IN_DATA = ("L02", "L01", "", None, "UNKN", "K03", "K05  ")
DENIAL_ACTION_IN_DATA = ("K01", "K02", "K03", None, "ZZZ9")

ACTION_XWALK = (
    ("K01", 1, "text one"),
    ("K02", 2, "text two"),
    ("K03  ", 3, "text three"),
    ("K04", 4, "text four"),
    ("ab", 5, "text five"),
    ("AB", 6, "text six"),
    ("K04", 7, "text seven"),
    ("", 8, "text eight"),
    ("P1/P2", 9, "text nine"),
    ("XA", 10, "text ten"),
    ("K05", 11, "text eleven"),
    ("K03", 12, "text twelve"),
    ("K06", 13, "text thirteen"),
)
CARRIER_XWALK1 = (
    ("L02", 1, "reason one"),
    ("L01", 2, "reason two"),
    ("K03", 3, "reason three"),
    ("K05", 4, "reason four"),
    ("L01", 5, "reason five"),
    ("", 6, "reason six"),
)
# Same codes; only the empty code's text differs between the two lookups.
CARRIER_XWALK2 = tuple((c, p, "reason none" if c == "" else d) for c, p, d in CARRIER_XWALK1)
DENIAL_CODE_SET = (
    ("K01", "ACTIONABLE"), ("K04", "ACTIONABLE"), ("ab", "ACTIONABLE"), ("XA", "ACTIONABLE"),
    ("K06", "ACTIONABLE"),
    ("K02", "FINAL"), ("K03", "FINAL"), ("K05", "FINAL"), ("P1/P2", "FINAL"), ("K02", "FINAL"),
    ("XB", "FINAL"),
)
ACTION_EXCLUSION = ("K06", "XA, XB", "K05", "K06", "NEVERSEEN")

XWALK_SCHEMA = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("description", T.StringType()),
    ]
)
CODE_SET_SCHEMA = T.StructType([T.StructField("code", T.StringType()), T.StructField("set_name", T.StringType())])
CODE_SCHEMA = T.StructType([T.StructField("code", T.StringType())])


def sql_literal(v) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def pick(selector: str, values) -> str:
    """SQL CASE choosing ``values[selector % len(values)]`` (valid in Spark SQL and DuckDB)."""
    n = len(values)
    branches = " ".join(f"WHEN {i} THEN {sql_literal(v)}" for i, v in enumerate(values))
    return f"CASE ({selector}) % {n} {branches} END"


# Spark SQL expressions of each stand-in role column.
CLAIM_EXPRS = {
    "claim_id": "o_orderkey",
    "header_id": "o_custkey",
    "ar_seq": "o_orderkey",
    "last_name": "substring(o_orderpriority, 3)",
    "first_name": "o_orderstatus",
    "recipient_id": "concat('R', lpad(cast(o_custkey AS string), 9, '0'))",
    "icn": (
        "CASE o_orderkey % 101 WHEN 7 THEN NULL"
        " WHEN 8 THEN substring(cast(o_orderkey AS string), 1, 1)"
        " WHEN 9 THEN '60'"
        " ELSE concat(lpad(cast(o_custkey % 100 AS string), 2, '0'), lpad(cast(o_orderkey AS string), 8, '0'),"
        " lpad(cast(o_custkey % 10 AS string), 2, '0')) END"
    ),
    "from_dos": "date_sub(cast(o_orderdate AS date), cast(o_custkey % 20 AS int))",
    "thru_dos": "date_sub(cast(o_orderdate AS date), 1)",
    "bill_amt": "cast(o_totalprice AS decimal(18,2))",
    "paid_amt": "cast(cast(o_totalprice AS decimal(18,2)) - cast(o_custkey % 100 AS decimal(18,2)) AS decimal(18,2))",
    "carrier_cd": (
        "CASE o_custkey % 25 WHEN 24 THEN '  CNEXC ' WHEN 23 THEN NULL"
        " ELSE concat('C', lpad(cast(o_custkey % 25 AS string), 2, '0')) END"
    ),
    "bill_dt": "cast(o_orderdate AS date)",
    "rebill_dt": (
        "CASE WHEN o_orderpriority = '5-LOW' AND o_custkey % 2 = 0"
        " THEN date_add(cast(o_orderdate AS date), 30) END"
    ),
    "status_cd": (
        "CASE WHEN o_orderstatus = 'O' THEN 'OPEN'"
        " WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'OPEN'"
        " WHEN o_orderstatus = 'P' THEN 'REVERSED'"
        " WHEN o_orderpriority = '3-MEDIUM' THEN 'PAID-PP' ELSE 'PAID-PD' END"
    ),
    "source_elig_cd": "CASE o_custkey % 3 WHEN 0 THEN 'RS' WHEN 1 THEN 'EL' END",
    "delete_ind": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderkey % 3 = 0 THEN 'Y' ELSE 'N' END",
    "contract_num": "CASE WHEN o_custkey % 50 = 49 THEN '479' ELSE '478' END",
    "project_cd": (
        "CASE o_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '9' WHEN 2 THEN '29' WHEN 3 THEN '3'"
        " ELSE cast(30 + o_custkey % 10 AS string) END"
    ),
    "bill_type_cd": (
        "CASE WHEN o_custkey % 11 = 0 THEN NULL"
        " WHEN o_orderpriority = '2-HIGH' AND o_custkey % 3 = 0 THEN 'SP' ELSE 'PR' END"
    ),
}

HEADER_EXPRS = {
    "header_id": "c_custkey",
    "paid_hdr_amt": "cast(c_acctbal AS decimal(18,2))",
    "paid_dt": "date_add(DATE'1996-01-01', cast(c_custkey % 365 AS int))",
}

POSTING_EXPRS = {
    "claim_id": "l_orderkey",
    "delete_ind": "CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END",
    "remit_amt": (
        "CASE WHEN l_linestatus = 'O' AND l_linenumber = 1 THEN NULL"
        " ELSE cast(cast(l_extendedprice AS decimal(18,2)) - cast(l_quantity AS decimal(18,2)) AS decimal(18,2)) END"
    ),
}

CLAIM_B_EXPRS = {
    "ar_seq": "l_orderkey",
    "contract_num": "CASE WHEN l_suppkey % 50 = 49 THEN '479' ELSE '478' END",
    "last_name": "concat('LN', cast(l_partkey % 40 AS string))",
    "first_name": "l_linestatus",
    "recipient_id": "concat('R', lpad(cast(l_partkey AS string), 9, '0'))",
    "icn": (
        "concat(lpad(cast(l_orderkey % 100 AS string), 2, '0'), lpad(cast(l_orderkey AS string), 8, '0'),"
        " lpad(cast(l_linenumber AS string), 2, '0'))"
    ),
    "from_dos": "date_sub(cast(l_shipdate AS date), 10)",
    "thru_dos": "date_sub(cast(l_shipdate AS date), 3)",
    "paid_dt": "date_add(cast(l_shipdate AS date), cast(l_partkey % 30 AS int))",
    "bill_dt": "date_sub(cast(l_shipdate AS date), 5)",
    "last_bill_dt": "CASE WHEN l_linestatus = 'O' THEN NULL ELSE date_sub(cast(l_shipdate AS date), 2) END",
    "bill_amt": "cast(l_extendedprice AS decimal(18,2))",
    "paid_amt": "cast(cast(l_extendedprice AS decimal(18,2)) - cast(l_quantity AS decimal(18,2)) AS decimal(18,2))",
    "hdr_paid_amt": "cast(l_quantity * 10 AS decimal(18,2))",
    "remit_amt": (
        "CASE WHEN l_linenumber = 7 THEN NULL"
        " ELSE cast(cast(l_extendedprice AS decimal(18,2)) - cast(l_quantity * 100 AS decimal(18,2)) AS decimal(18,2)) END"
    ),
    "remit_dt": "timestampadd(MINUTE, l_linenumber * 200, l_shipdate)",
    "action_cd": pick("l_partkey", ACTION_CODES_IN_DATA),
    "carrier_action_cd": pick("l_suppkey", CARRIER_CODES_IN_DATA),
    "carrier_cd": "concat('S', cast(l_suppkey AS string))",
    "carrier_claim_ref": "concat('CR', cast(l_orderkey AS string), '-', cast(l_linenumber AS string))",
    "carrier_ack_ts": "timestampadd(HOUR, 36, l_shipdate)",
    "transact_status_cd": (
        "CASE WHEN l_returnflag = 'R' THEN 'D' WHEN l_returnflag = 'A' THEN 'V'"
        " WHEN l_linestatus = 'O' THEN '8' ELSE 'X' END"
    ),
    "source_elig_cd": "CASE WHEN l_suppkey % 3 = 0 THEN 'RS' END",
}

DENIAL_EXPRS = {
    "contract_num": "'478'",
    "ar_seq": "o_orderkey",
    "action_cd1": pick("o_custkey", DENIAL_ACTION_IN_DATA),
    "carrier_action_cd1": "concat('C', substring(o_orderpriority, 1, 1))",
    "carrier_action_cd2": pick("o_orderkey", DENIAL_CD2_IN_DATA),
}


# Valid in Spark SQL and DuckDB.
LETTERED_PROJECT = (
    "CASE claim_id % 6 WHEN 0 THEN 'A' || project_cd WHEN 1 THEN project_cd || 'A'"
    " WHEN 2 THEN 'b' || project_cd WHEN 3 THEN '-' || project_cd WHEN 4 THEN 'A' ELSE project_cd END"
)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _project(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {c}" for c, e in exprs.items()])


# Bound role definitions per session and directory.  They are lazy plans (no
# data is cached); binding them once saves re-parsing the projections.
_BOUND: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def _memo(spark: SparkSession, key: tuple, build) -> dict[str, DataFrame]:
    per_session = _BOUND.setdefault(spark, {})
    if key not in per_session:
        per_session[key] = build()
    return dict(per_session[key])


def open_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Roles of the OPEN template."""
    return _memo(spark, ("open", sf_dir), lambda: _open_tables(spark, sf_dir))


def _open_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    nation = _read(spark, sf_dir, "nation").selectExpr(
        "concat('C', lpad(cast(n_nationkey AS string), 2, '0')) AS carrier_cd",
        "n_name AS carrier_nm",
        "CASE WHEN n_regionkey IN (1, 2) THEN 'GCS' ELSE 'EXT' END AS data_source_cd",
        "CASE WHEN n_regionkey = 2 THEN '0001' ELSE '0000' END AS carrier_office_cd",
    )
    region = _read(spark, sf_dir, "region").selectExpr(
        "concat('C', lpad(cast(r_regionkey AS string), 2, '0')) AS carrier_cd",
        "r_name AS carrier_nm",
        "'GCS' AS data_source_cd",
        "'0000' AS carrier_office_cd",
    )
    return {
        "claim": _project(_read(spark, sf_dir, "orders"), CLAIM_EXPRS),
        "claim_header": _project(_read(spark, sf_dir, "customer"), HEADER_EXPRS),
        "posting": _project(_read(spark, sf_dir, "lineitem"), POSTING_EXPRS),
        "carrier_a": nation.unionByName(region),
    }


def _values_sql(rows, schema: T.StructType) -> str:
    def lit(v, t):
        if v is None:
            return f"CAST(NULL AS {t.simpleString()})"
        return str(v) if isinstance(v, int) else sql_literal(v)

    fields = schema.fields
    body = ", ".join("(" + ", ".join(lit(v, f.dataType) for v, f in zip(r, fields)) + ")" for r in rows)
    return f"SELECT * FROM VALUES {body} AS t({', '.join(f.name for f in fields)})"


def inline_table(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A small literal table as an inline VALUES relation (a JVM-side local scan)."""
    return spark.sql(_values_sql(rows, schema))


def crosswalk_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The invented crosswalk, code-set and exclusion inputs."""
    return {
        "action_xwalk": inline_table(spark, ACTION_XWALK, XWALK_SCHEMA),
        "carrier_xwalk1": inline_table(spark, CARRIER_XWALK1, XWALK_SCHEMA),
        "carrier_xwalk2": inline_table(spark, CARRIER_XWALK2, XWALK_SCHEMA),
        "denial_code_set": inline_table(spark, DENIAL_CODE_SET, CODE_SET_SCHEMA),
        "action_exclusion": inline_table(spark, [(c,) for c in ACTION_EXCLUSION], CODE_SCHEMA),
    }


def denied_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Roles of the DENIED template (crosswalk inputs included)."""
    return _memo(spark, ("denied", sf_dir), lambda: _denied_tables(spark, sf_dir))


def _denied_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    supplier = _read(spark, sf_dir, "supplier")
    carriers = supplier.selectExpr(
        "concat('S', cast(s_suppkey AS string)) AS carrier_cd",
        "s_name AS carrier_nm",
        "CASE WHEN s_acctbal > 0 THEN 'Y' ELSE 'N' END AS default_ind",
    )
    # Second default row: same name for nation 0 (amounts double), another name for nation 1.
    extra = supplier.where("s_nationkey IN (0, 1)").selectExpr(
        "concat('S', cast(s_suppkey AS string)) AS carrier_cd",
        "CASE WHEN s_nationkey = 0 THEN s_name ELSE concat(s_name, ' ALT') END AS carrier_nm",
        "'Y' AS default_ind",
    )
    orders = _read(spark, sf_dir, "orders")
    denial = _project(orders, DENIAL_EXPRS)
    denial_dup = _project(orders.where("o_orderpriority = '1-URGENT'"), DENIAL_EXPRS)
    tables = {
        "claim_b": _project(_read(spark, sf_dir, "lineitem"), CLAIM_B_EXPRS),
        "carrier_b": carriers.unionByName(extra),
        "denial": denial.unionByName(denial_dup),
    }
    tables.update(crosswalk_tables(spark))
    return tables


def all_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = open_tables(spark, sf_dir)
    t.update(denied_tables(spark, sf_dir))
    return t


def lettered_projects(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The OPEN roles with letters and signs in some project codes."""
    return {**tables, "claim": tables["claim"].withColumn("project_cd", F.expr(LETTERED_PROJECT))}


def padded_carriers(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The OPEN roles with blanks after some carrier codes: claims of odd ids, carriers of odd length names."""
    claim, carriers = tables["claim"], tables["carrier_a"]
    return {
        **tables,
        "claim": claim.withColumn(
            "carrier_cd", F.expr("CASE WHEN claim_id % 2 = 1 THEN concat(carrier_cd, '   ') ELSE carrier_cd END")
        ),
        "carrier_a": carriers.withColumn(
            "carrier_cd",
            F.expr("CASE WHEN length(carrier_nm) % 2 = 1 THEN concat(carrier_cd, '  ') ELSE carrier_cd END"),
        ),
    }
