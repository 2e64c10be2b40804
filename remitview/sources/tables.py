"""Input roles of the two report templates, and how to bind them.

A report takes ``tables: dict[role, DataFrame]``.  Roles can come from a lake
(parquet / any ``spark.read`` format) or from the source databases through
Spark's JDBC reader; credentials and URLs are always the caller's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns each template reads from each role (types: see README).
OPEN_ROLES = {
    "claim": (
        "claim_id", "header_id", "ar_seq", "last_name", "first_name", "recipient_id", "icn",
        "from_dos", "thru_dos", "bill_amt", "paid_amt", "carrier_cd", "bill_dt", "rebill_dt",
        "status_cd", "source_elig_cd", "delete_ind", "contract_num", "project_cd", "bill_type_cd",
    ),
    "claim_header": ("header_id", "paid_hdr_amt", "paid_dt"),
    "posting": ("claim_id", "delete_ind", "remit_amt"),
    "carrier_a": ("carrier_cd", "carrier_nm", "data_source_cd", "carrier_office_cd"),
}

DENIED_ROLES = {
    "claim_b": (
        "ar_seq", "contract_num", "last_name", "first_name", "recipient_id", "icn", "from_dos",
        "thru_dos", "paid_dt", "bill_dt", "last_bill_dt", "bill_amt", "paid_amt", "hdr_paid_amt",
        "remit_amt", "remit_dt", "action_cd", "carrier_action_cd", "carrier_cd", "carrier_claim_ref",
        "carrier_ack_ts", "transact_status_cd", "source_elig_cd",
    ),
    "carrier_b": ("carrier_cd", "carrier_nm", "default_ind"),
    "denial": ("contract_num", "ar_seq", "action_cd1", "carrier_action_cd1", "carrier_action_cd2"),
    "action_xwalk": ("code", "priority", "description"),
    "carrier_xwalk1": ("code", "priority", "description"),
    "carrier_xwalk2": ("code", "priority", "description"),
    "denial_code_set": ("code", "set_name"),
    "action_exclusion": ("code",),
}


def _expected_types(column: str) -> tuple[str, ...] | None:
    """Type names a column may have; None for keys, whose type is the source's own."""
    if column in ("remit_dt", "carrier_ack_ts"):
        return ("date", "timestamp", "timestamp_ntz")
    if column.endswith(("_dt", "_dos")):
        return ("date",)
    if column.endswith("_amt"):
        return ("decimal",)
    if column.endswith(("_cd", "_ind", "_nm", "_name")) or column in ("icn", "contract_num", "code", "description"):
        return ("string", "char", "varchar")
    return None


def check_roles(tables: dict[str, DataFrame], roles: dict[str, tuple[str, ...]]) -> None:
    """Fail early (before any job runs) when a role or a column is missing or has a wrong type.

    A bill date with a time of day would fall out of the closed window on the
    month's last day, and floating-point money would not add up to the cent.
    """
    missing, wrong = [], []
    for role, cols in roles.items():
        if role not in tables:
            missing.append(role)
            continue
        have = {f.name: f.dataType.typeName() for f in tables[role].schema.fields}
        missing += [f"{role}.{c}" for c in cols if c not in have]
        for c in cols:
            expected = _expected_types(c)
            if c in have and expected and have[c] not in expected:
                wrong.append(f"{role}.{c} is {have[c]}, not {' or '.join(expected)}")
    if missing:
        raise ValueError(f"missing report inputs: {', '.join(missing)}")
    if wrong:
        raise ValueError(f"wrong types of report inputs: {'; '.join(wrong)}")


def padded_columns(tables: dict[str, DataFrame]) -> frozenset[str]:
    """Names of the columns that are CHAR in some role, for ``ReportConfig.padded_columns``.

    The type comes from the table in the catalog; Spark reads a CHAR column padded to its length and
    keeps the declared type beside the column. A name that is CHAR in one role and VARCHAR in another
    (a join key, say) compares padded in both, as the source does.
    """
    return frozenset(
        f.name
        for df in tables.values()
        for f in df.schema.fields
        if f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", "").startswith("char")
    )


def load_tables(
    spark: SparkSession,
    locations: dict[str, str],
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """``{role: path}`` -> ``{role: DataFrame}`` through ``spark.read``."""
    reader = spark.read.format(fmt).options(**(options or {}))
    return {role: reader.load(path) for role, path in locations.items()}


def load_jdbc_tables(
    spark: SparkSession,
    url: str,
    role_tables: dict[str, str],
    options: dict[str, str] | None = None,
    partitioning: dict[str, dict[str, str]] | None = None,
) -> dict[str, DataFrame]:
    """Bind roles to tables of a JDBC source.

    ``partitioning[role]`` may hold ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` so a large table is read by many
    tasks in parallel instead of through one connection.  Filters and the
    column selection of the report are pushed into the generated SQL.
    """
    out = {}
    for role, table in role_tables.items():
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {}))
        reader = reader.options(**((partitioning or {}).get(role, {})))
        out[role] = reader.load()
    return out
