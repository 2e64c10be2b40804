"""Property: the resolved-crosswalk join equals an ordered first-match CASE."""

from hypothesis import given, settings
from hypothesis import strategies as st

from remitview.operators import crosswalk as X

BASE = st.sampled_from(["A1", "a1", "B", "b", "", "C/D", "E, F", " A1"])
CODE = st.tuples(BASE, st.integers(0, 2)).map(lambda t: t[0] + " " * t[1])
XWALK = st.lists(st.tuples(CODE, st.text("xyz", min_size=1, max_size=3)), min_size=1, max_size=8)
DATA = st.lists(st.one_of(st.none(), CODE), min_size=1, max_size=12)


def case_first_match(code, branches, default, case_sensitive):
    if code is None:
        return default
    key = code.rstrip(" ")
    for b, text in branches:
        bk = b.rstrip(" ")
        if (key == bk) if case_sensitive else (key.lower() == bk.lower()):
            return text
    return default


@settings(max_examples=12, deadline=None)
@given(xwalk=XWALK, data=DATA, case_sensitive=st.booleans(), default=st.sampled_from([None, "NOCOD"]))
def test_lookup_equals_ordered_case(spark, xwalk, data, case_sensitive, default):
    dim = spark.createDataFrame(
        [(c, i, t) for i, (c, t) in enumerate(xwalk)], "code string, priority int, description string"
    )
    df = spark.createDataFrame([(i, c) for i, c in enumerate(data)], "id int, code string")
    out = X.lookup(df, "code", X.resolve(dim, case_sensitive), "desc", default, case_sensitive)
    got = {r["id"]: r["desc"] for r in out.collect()}
    expected = {i: case_first_match(c, xwalk, default, case_sensitive) for i, c in enumerate(data)}
    assert got == expected


@settings(max_examples=8, deadline=None)
@given(codes=st.lists(CODE, min_size=1, max_size=6), data=DATA)
def test_exclusion_equals_not_in(spark, codes, data):
    listed = spark.createDataFrame([(c,) for c in codes], "code string")
    df = spark.createDataFrame([(i, c) for i, c in enumerate(data)], "id int, code string")
    kept = {r["id"] for r in X.exclude_codes(df, "code", listed).collect()}
    keys = {c.rstrip(" ") for c in codes}
    expected = {i for i, c in enumerate(data) if c is not None and c.rstrip(" ") not in keys}
    assert kept == expected
