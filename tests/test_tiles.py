import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basinflow.functions.colours import colour_table, palette_png
from basinflow.grid import axis
from basinflow.operators import tiles as T


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=12, unique=True), st.booleans(), st.lists(st.floats(-60, 60), min_size=1, max_size=10))
def test_nearest_index_takes_the_smaller_of_two(spark, coords, down, targets):
    coords = sorted(map(float, coords), reverse=down)
    got = T.nearest_index(spark.createDataFrame([(t,) for t in targets], "coord double"), axis(spark, coords)).collect()
    for r in got:
        assert coords[r.idx] == min(coords, key=lambda c: (abs(c - r.coord), c))


def test_pixels_outside_the_axes_are_missing(spark):
    grid = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)], "lat_idx int, lon_idx int, value double")
    ax = axis(spark, [0.0, 1.0])
    tile = T.regional_bounds(spark.createDataFrame([(0, 0, 0)], "z long, x long, y long"), {"lon_min": -1.0, "lon_max": 1.0, "lat_min": 0.0, "lat_max": 1.0})
    got = {(r.row, r.col): r.value for r in T.sample_nearest(grid, ax, ax, tile, 3).collect()}
    assert got == {(0, 0): None, (0, 1): 3.0, (0, 2): 4.0, (1, 0): None, (1, 1): 1.0, (1, 2): 2.0, (2, 0): None, (2, 1): 1.0, (2, 2): 2.0}


def test_bilinear_needs_all_neighbours_with_weight(spark):
    grid = spark.createDataFrame([(0, 0, 0.0), (0, 1, 10.0), (1, 0, 20.0), (1, 1, None)], "lat_idx int, lon_idx int, value double")
    ax = axis(spark, [0.0, 1.0])
    points = spark.createDataFrame([(1, 0.25, 0.0), (2, 0.5, 0.5), (3, 0.0, 1.0), (4, 2.0, 0.0)], "k int, lon double, lat double")
    got = {r.k: r.value for r in T.sample_bilinear(grid, ax, ax, points, ("k",)).collect()}
    assert got == {1: 2.5, 2: None, 3: 20.0, 4: None}


def grown(values, passes):
    out = values.copy()
    for _ in range(passes):
        base = out.copy()
        for i in range(out.shape[0]):
            for j in range(out.shape[1]):
                if np.isnan(base[i, j]):
                    for di, dj in T.NEIGHBOURS:
                        a, b = i + di, j + dj
                        if 0 <= a < out.shape[0] and 0 <= b < out.shape[1] and np.isfinite(base[a, b]):
                            out[i, j] = base[a, b]
                            break
    return out


@pytest.mark.parametrize("passes", [1, 2])
def test_thicken_matches_loops(spark, passes):
    rng = np.random.default_rng(passes)
    values = np.where(rng.random((6, 7)) < 0.15, rng.normal(size=(6, 7)), np.nan)
    rows = [(i, j, float(values[i, j])) for i in range(6) for j in range(7) if np.isfinite(values[i, j])]
    got = {(r.row, r.col): r.value for r in T.thicken(spark.createDataFrame(rows, "row int, col int, value double"), 6, 7, passes).collect()}
    want = grown(values, passes)
    assert got == {(i, j): want[i, j] for i in range(6) for j in range(7) if np.isfinite(want[i, j])}


def test_equal_limits_are_moved_apart(spark):
    px = spark.createDataFrame([(0, 0, 5.0), (0, 1, 5.0), (0, 2, None)], "row int, col int, value double")
    limits = T.stretch(px)
    assert tuple(limits.first()) == (5.0, 6.0)
    got = {r.col: r.level for r in T.colour_index(px, limits).collect()}
    assert got == {0: 0, 1: 0, 2: None}


def test_mercator_rows_run_from_the_north(spark):
    row = T.mercator_bounds(spark.createDataFrame([(4, 0, 0)], "z long, x long, y long")).first()
    assert round(row.lat_max, 2) == 85.05 and row.lat_min < row.lat_max and row.lon_min == -180.0
    flipped = T.flipped(spark.createDataFrame([(4, 0, 3)], "z long, x long, y long"), "global", False).first()
    assert flipped.y == 12


def test_png_has_one_transparent_colour():
    levels, valid = np.array([[0, 255], [7, 0]], np.uint8), np.array([[True, True], [False, True]])
    png = palette_png(levels, valid, "Blues")
    assert png[:8] == b"\x89PNG\r\n\x1a\n" and struct.unpack(">II", png[16:24]) == (2, 2)
    data = png[png.index(b"IDAT") + 4 : png.index(b"IEND") - 8]
    raw = zlib.decompress(data)
    assert raw == bytes([0, 1, 255, 0, 0, 1])
    assert (colour_table("no such scheme") == colour_table("Reds")).all()
