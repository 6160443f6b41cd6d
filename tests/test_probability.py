import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basinflow.grid import clean
from basinflow.operators import probability as P

SCHEMA = "time int, ensemble int, lat_idx int, lon_idx int, value double"


def grid(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_edges_match_numpy_and_skip_missing(spark):
    values = [3.0, 1.0, None, 7.0, 2.0, 2.5]
    hind = grid(spark, [(t, 1, 0, 0, v) for t, v in enumerate(values)])
    got = P.quantile_edges(hind).first().edges
    assert np.allclose(got, np.quantile([v for v in values if v is not None], [1 / 3, 2 / 3]))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-100, 100), min_size=1, max_size=30), st.floats(0.05, 0.95))
def test_any_quantile_is_linear(spark, values, q):
    hind = grid(spark, [(t, 1, 0, 0, v) for t, v in enumerate(values)])
    assert math.isclose(P.quantile_edges(hind, [q]).first().edges[0], np.quantile(values, q), abs_tol=1e-9)


def test_zero_forecast_is_missing_but_zero_hindcast_counts(spark):
    hind = grid(spark, [(0, e, 0, 0, float(v)) for e, v in enumerate((0, 0, 0, 3, 6, 9))])
    fc = grid(spark, [(1, e, 0, 0, float(v)) for e, v in enumerate((0, 0, 1, 8))])
    got = {r.category: r.prob for r in P.category_probability(hind, fc).collect()}
    # edges are 0 and 4: zeros are missing, so nothing is below
    assert got == {0: 0.0, 1: 0.25, 2: 0.25}


def test_missing_member_stays_in_denominator_and_all_missing_is_zero(spark):
    hind = grid(spark, [(0, e, 0, c, float(e)) for e in range(7) for c in (0, 1)])
    fc = grid(spark, [(1, e, 0, 0, float(e) if e else None) for e in range(1, 8)] + [(1, e, 0, 1, None) for e in range(1, 8)])
    rows = P.category_probability(hind, fc).collect()
    assert math.isclose(sum(r.prob for r in rows if r.lon_idx == 0), 1.0)
    assert [r.prob for r in rows if r.lon_idx == 1] == [0.0, 0.0, 0.0]


def test_bins_are_left_open_and_null_edges_count_nothing(spark):
    hind = grid(spark, [(0, e, 0, 0, float(v)) for e, v in enumerate((1, 2, 3, 4))] + [(0, 0, 0, 1, None)])
    fc = grid(spark, [(1, 0, 0, 0, 2.0), (1, 1, 0, 0, 3.0), (1, 0, 0, 1, 5.0), (1, 1, 0, 1, 5.0)])
    got = {(r.lon_idx, r.category): r.prob for r in P.category_probability(hind, fc).collect()}
    assert got[0, 0] == 0.5 and got[0, 1] == 0.5 and got[0, 2] == 0.0
    assert got[1, 0] == got[1, 1] == got[1, 2] == 0.0


def test_dominant_category_keeps_ties(spark):
    rows = [(1, 0, 0, c, v) for c, v in enumerate((50.0, 50.0, 0.0))] + [(1, 0, 1, c, 0.0) for c in range(3)]
    cube = spark.createDataFrame(rows, "time int, lat_idx int, lon_idx int, category int, value double")
    got = {(r.lon_idx, r.category): r.value for r in P.dominant_category(cube).collect()}
    assert got == {(0, 0): 50.0, (0, 1): 50.0, (0, 2): None, (1, 0): 0.0, (1, 1): 0.0, (1, 2): 0.0}
    assert P.dominant_category(cube, keep_shape=False).count() == 5


def test_thresholds_are_open_at_both_ends(spark):
    hind = grid(spark, [(0, e, 0, 0, float(e)) for e in range(4)])
    low = P.category_thresholds(hind, 0).first()
    high = P.category_thresholds(hind, 2).first()
    assert low.low == -math.inf and high.high == math.inf and low.high == 1.0 and high.low == 2.0
    with pytest.raises(ValueError):
        P.category_thresholds(hind, 3)


def test_nan_becomes_null(spark):
    df = clean(spark.createDataFrame([(float("nan"),), (1.0,)], "value double"))
    assert [r.value for r in df.collect()] == [None, 1.0]
