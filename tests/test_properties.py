"""Property-based tests (hypothesis) for the column expressions and the split."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tabml.functions import DURATION_OFFSETS, band, band_labels, parse_duration
from tabml.operators.split import cutoffs

TEXT = st.text(alphabet="0123456789 :dayx-", max_size=20)


def _py_int(s: str):
    s = s.strip()
    if not s:
        return None
    body = s[1:] if s[0] in "+-" else s
    if not body.isdigit():
        return None
    return int(s)


def _py_duration(t):
    """The documented semantics: each 2-character part must parse as an integer, else the value is 0."""
    if t is None:
        return 0
    parts = [_py_int(t[p - 1 : p + 1]) for p in DURATION_OFFSETS]
    if any(v is None for v in parts):
        return 0
    return parts[0] * 3600 + parts[1] * 60 + parts[2]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=40))
def test_parse_duration_matches_python_statement(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_duration("t")).collect()]
    assert got == [_py_duration(t) for t in texts]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=6, unique=True),
       st.lists(st.one_of(st.none(), st.integers(-2000, 2000)), min_size=1, max_size=30))
def test_band_assigns_the_right_interval(spark, bounds, xs):
    bounds = sorted(bounds)
    labels = band_labels(bounds)
    df = spark.createDataFrame([(x,) for x in xs], "x int")
    got = [r[0] for r in df.select(band("x", bounds)).collect()]
    for x, g in zip(xs, got):
        if x is None:
            assert g is None
        else:
            assert g == labels[sum(1 for b in bounds if x >= b)]


@given(st.lists(st.floats(0.0, 10.0, allow_nan=False), min_size=1, max_size=6).filter(lambda w: sum(w) > 0))
def test_cutoffs_tile_the_hash_range(weights):
    ranges = cutoffs(weights)
    assert ranges[0][0] == 0 and ranges[-1][1] == 1 << 32
    assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
    assert all(lo <= hi for lo, hi in ranges)
