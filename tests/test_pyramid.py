import numpy as np
import pytest

from basinflow.operators import pyramid as P


def frame(spark, values):
    rows = [(i, j, None if np.isnan(v) else float(v)) for i, row in enumerate(values) for j, v in enumerate(row)]
    return spark.createDataFrame(rows, "lat_idx int, lon_idx int, value double")


def blocks(values, g):
    s = -(-g // 2) - 1
    v = values[s:, s:]
    n, m = v.shape[0] // g, v.shape[1] // g
    out = {}
    for i in range(n):
        for j in range(m):
            b = v[i * g : (i + 1) * g, j * g : (j + 1) * g]
            ok = np.isfinite(b).sum()
            out[i, j] = float(np.nanmean(b)) if ok >= 0.25 * g * g else None
    return out


@pytest.mark.parametrize("grain", [1, 2, 3, 4])
def test_block_mean_matches_numpy(spark, grain):
    rng = np.random.default_rng(grain)
    values = rng.normal(size=(9, 11))
    values[rng.random(values.shape) < 0.6] = np.nan
    got = {(r.lat_idx, r.lon_idx): r.value for r in P.block_mean(frame(spark, values), grain, 9, 11).collect()}
    want = blocks(values, grain)
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert (got[k] is None) == (v is None) and (v is None or abs(got[k] - v) < 1e-12)


def test_block_with_exactly_a_quarter_is_valid_and_labelled_by_its_first_cell(spark):
    values = np.full((4, 4), np.nan)
    values[0, 0] = 8.0
    rows = {(r.lat_idx, r.lon_idx): r for r in P.block_mean(frame(spark, values), 2, 4, 4).collect()}
    assert rows[0, 0].value == 8.0 and rows[1, 1].value is None and (rows[1, 1].lat_src, rows[1, 1].lon_src) == (2, 2)


def test_grains_of_the_published_grid(spark):
    got = {r.zoom: r.grain for r in P.grain_by_zoom(spark, range(10), 540, 660, 0.05).collect()}
    assert got == {0: 30, 1: 15, 2: 10, 3: 4, 4: 2, 5: 1, 6: 1, 7: 1, 8: 1, 9: 1}


def test_window_mean_matches_loops(spark):
    rng = np.random.default_rng(5)
    values = rng.normal(size=(8, 7))
    values[rng.random(values.shape) < 0.5] = np.nan
    for g in (2, 3):
        s, h = -(-g // 2) - 1, g // 2
        got = {(r.lat_idx, r.lon_idx): r.value for r in P.window_mean(frame(spark, values), g, 8, 7).collect()}
        for a, i in enumerate(range(s, 8, g)):
            for b, j in enumerate(range(s, 7, g)):
                w = values[max(0, i - h) : i + h + 1, max(0, j - h) : j + h + 1]
                ok = np.isfinite(w).sum()
                want = np.nanmean(w) if ok and ok >= 0.25 * g * g else None
                assert (got[a, b] is None) == (want is None) and (want is None or abs(got[a, b] - want) < 1e-12)


def test_zoom_map_defaults_to_grain_one(spark):
    levels = P.pyramid(frame(spark, np.arange(16.0).reshape(4, 4)), [1, 2], 4, 4)
    zooms = spark.createDataFrame([(4, 2)], "zoom int, grain int")
    assert P.at_zoom(levels, zooms, 4).count() == 4 and P.at_zoom(levels, zooms, 9).count() == 16


def test_nearest_zoom_takes_the_lower_of_two(spark):
    zooms = spark.createDataFrame([(4,), (6,)], "zoom int")
    assert P.nearest_zoom(zooms, 5).first().zoom == 4 and P.nearest_zoom(zooms, 6).first().zoom == 6
