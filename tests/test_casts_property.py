"""Property test: lenient casts of random numeric text agree with a
plain-Python model of the intended semantics."""

import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from scorewright.functions.casts import lenient_cast

INT_MIN, INT_MAX = -(2 ** 31), 2 ** 31 - 1

texts = st.one_of(
    st.integers(min_value=-(2 ** 40), max_value=2 ** 40).map(str),
    st.tuples(st.integers(-(10 ** 12), 10 ** 12), st.integers(0, 999)).map(lambda t: f"{t[0]}.{t[1]}"),
    st.floats(allow_nan=False, allow_infinity=False, width=64).map(repr),
    st.sampled_from(["", " ", "abc", "1e3", "+7", "-0", "0.", ".5", "1_000", "12abc", " 42 ", "--1"]),
)


def expected_int(s: str):
    t = s.strip()
    m = re.fullmatch(r"[+-]?[0-9]+", t) or re.fullmatch(r"([+-]?[0-9]+)\.[0-9]*", t)
    if not m:
        return None
    v = int(m.group(1) if m.re.groups else t)
    return v if INT_MIN <= v <= INT_MAX else None


@settings(max_examples=15, deadline=None)
@given(st.lists(texts, min_size=1, max_size=60))
def test_int_cast_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(lenient_cast(df.s, "int")).collect()]
    assert got == [expected_int(v) for v in values]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=1, max_size=60))
def test_double_text_round_trip(spark, values):
    df = spark.createDataFrame([(repr(v),) for v in values], "s string")
    got = [r[0] for r in df.select(lenient_cast(df.s, "double")).collect()]
    assert all(g == v or (math.isclose(g, v) and v == 0) for g, v in zip(got, values))
