"""First-match code crosswalks, code sets and exclusion lists.

A crosswalk is an input table ``(code, priority, description)``: one row per
branch of an ordered ``CASE WHEN code = ... THEN ...`` list, ``priority`` being
the branch position.  Resolving it once gives one row per *match key*, and a
lookup is then a left equi-join instead of a branch-by-branch CASE.

Match key: codes compare blank-padded (trailing blanks ignored, leading blanks
significant), optionally case-insensitive.  The same key is applied to the
claim column and the table, so padded, shadowed and case-pair entries behave
as the ordered CASE does: the lowest priority wins per key.

The resolved table is bounded by the crosswalk, not by the claims. Spark
broadcasts it where its statistics, or its measured size at run time, allow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitview.functions.derive import col_


def code_key(c, case_sensitive: bool = True) -> Column:
    """Match key of a code: right-trimmed, lower-cased unless case-sensitive."""
    k = F.rtrim(col_(c))
    return k if case_sensitive else F.lower(k)


def resolve_together(sources: dict[str, DataFrame], case_sensitive: bool = True) -> DataFrame:
    """``xw_key`` and a column per crosswalk: the struct ``(p, v)`` of its first branch for the
    key, null where it has none.

    Crosswalks on the same claim column resolve to one table and so to one join.
    Ties on priority are broken by the value, so the result is deterministic.
    """
    tagged = [
        dim.where(F.col("code").isNotNull()).select(
            code_key("code", case_sensitive).alias("xw_key"),
            F.lit(name).alias("xw"),
            F.struct(F.col("priority").cast("bigint").alias("p"), F.col("description").alias("v")).alias("branch"),
        )
        for name, dim in sources.items()
    ]
    first = [F.min(F.when(F.col("xw") == F.lit(n), F.col("branch"))).alias(n) for n in sources]
    return reduce(DataFrame.unionByName, tagged).groupBy("xw_key").agg(*first)


def resolve(dim: DataFrame, case_sensitive: bool = True) -> DataFrame:
    """One row per match key: ``(xw_key, xw_value)`` of the first branch."""
    return resolve_together({"first": dim}, case_sensitive).select("xw_key", F.col("first.v").alias("xw_value"))


def code_list_as_crosswalk(codes: DataFrame) -> DataFrame:
    """``(code)`` -> ``(code, priority, description)``: membership as a crosswalk."""
    return codes.select("code", F.lit(0).alias("priority"), F.lit("").alias("description"))


def code_sets_as_crosswalk(code_set: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``(code, set_name)`` -> ``(code, priority, description=set_name)``.

    ``order`` lists the set names in the order their ``WHEN ... IN (...)``
    branches are tested; a code in two sets takes the earlier one.  The
    position of the code inside its set does not matter.
    """
    rank = F.lit(None).cast("int")
    for i, name in enumerate(order):
        rank = F.when(F.col("set_name") == F.lit(name), F.lit(i)).otherwise(rank)
    return code_set.where(F.col("set_name").isin(*order)).select(
        "code", rank.alias("priority"), F.col("set_name").alias("description")
    )


def lookup(
    df: DataFrame,
    code_col: str,
    resolved: DataFrame,
    out_col: str,
    default: str | None = None,
    case_sensitive: bool = True,
) -> DataFrame:
    """Add ``out_col`` = crosswalk value of ``df[code_col]``.

    Unmatched and null codes get ``default`` (the CASE's ELSE).  A matched
    branch whose text is null stays null.
    """
    key = f"__{out_col}_key"
    val = f"__{out_col}_val"
    side = resolved.select(F.col("xw_key").alias(key), F.col("xw_value").alias(val))
    joined = df.join(side, code_key(F.col(code_col), case_sensitive) == F.col(key), "left")
    value = F.col(val)
    if default is not None:
        value = F.when(F.col(key).isNull(), F.lit(default)).otherwise(value)
    return joined.select(*[F.col(c) for c in df.columns if c != out_col], value.alias(out_col))


def exclude_codes(
    df: DataFrame,
    code_col: str,
    codes: DataFrame,
    case_sensitive: bool = True,
) -> DataFrame:
    """``code_col NOT IN (list)``: listed codes and null codes are dropped.

    Each listed literal is one code; a literal holding a comma is not split.
    A null entry in the list is not a code and is ignored.
    """
    # No de-duplication needed: an anti join gives the same rows for repeated keys.
    keys = codes.where(F.col("code").isNotNull()).select(code_key("code", case_sensitive).alias("__ex_key"))
    kept = df.where(F.col(code_col).isNotNull())
    return kept.join(keys, code_key(F.col(code_col), case_sensitive) == F.col("__ex_key"), "left_anti")
