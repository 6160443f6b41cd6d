import math

from basinflow.operators import zonal as Z
from basinflow.queries import BASINS, basins, membership


def inside(x, y, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def test_membership_matches_ray_casting(spark):
    got = {(r.pfaf_id, r.lat_idx, r.lon_idx) for r in membership(spark).collect()}
    want = {(z, i, j) for z, ring in BASINS.items() for i in range(12) for j in range(16) if inside(-80 + 2 * j, -20 + 2 * i, ring)}
    assert got == want and {z for z, *_ in got} == {1, 2}  # the third holds no centre


def test_polygon_edges_close_an_open_ring(spark):
    assert Z.polygon_edges(basins(spark)).where("pfaf_id = 1").count() == 3


def test_staged_means_differ_from_one_mean(spark):
    rows = [("v", 4, 1, 0, 0, 10.0), ("v", 4, 1, 0, 0, 20.0), ("v", 4, 2, 0, 0, 40.0)]
    hind = spark.createDataFrame(rows, "variable string, m int, ensemble int, lat_idx int, lon_idx int, value double")
    clim = Z.monthly_climatology(hind, hind["m"], ("variable", "ensemble", "lat_idx", "lon_idx"))
    zones = spark.createDataFrame([(7, 0, 0)], "pfaf_id int, lat_idx int, lon_idx int")
    assert Z.zonal_climatology(clim, zones).first().value == 27.5


def test_stream_flow_is_the_maximum_and_missing_columns_are_null(spark):
    rows = [("Streamflow_tavg", 1, 1, 0, j, float(j)) for j in range(3)] + [("Rainf_tavg", 1, 1, 0, j, float(j)) for j in range(3)]
    grid = spark.createDataFrame(rows, "variable string, time int, ensemble int, lat_idx int, lon_idx int, value double")
    zones = spark.createDataFrame([(7, 0, j) for j in range(3)], "pfaf_id int, lat_idx int, lon_idx int")
    row = Z.wide(Z.zonal_statistics(grid, zones), ["Rainf_tavg", "Streamflow_tavg", "Qs_tavg"], ("time", "ensemble", "pfaf_id")).first()
    assert (row.Rainf_tavg, row.Streamflow_tavg, row.Qs_tavg) == (1.0, 2.0, None)


def test_upsert_keeps_both_sides_and_prefers_new_values(spark):
    old = spark.createDataFrame([("a", 1.0, 5.0), ("b", 2.0, 6.0)], "time string, x double, y double")
    new = spark.createDataFrame([("b", 9.0, 1.0), ("c", None, 2.0)], "time string, x double, z double")
    got = {r.time: (r.x, r.y, r.z) for r in Z.upserted(old, new).collect()}
    assert got == {"a": (1.0, 5.0, None), "b": (9.0, 6.0, 1.0), "c": (None, None, 2.0)}
    assert Z.upserted(None, new) is new


def test_zonal_mean_skips_missing_cells(spark):
    grid = spark.createDataFrame([("Rainf_tavg", 1, 1, 0, 0, None), ("Rainf_tavg", 1, 1, 0, 1, 4.0)], "variable string, time int, ensemble int, lat_idx int, lon_idx int, value double")
    zones = spark.createDataFrame([(7, 0, 0), (7, 0, 1), (8, 0, 0)], "pfaf_id int, lat_idx int, lon_idx int")
    got = {r.pfaf_id: r.value for r in Z.zonal_statistics(grid, zones).collect()}
    assert got == {7: 4.0, 8: None} and not math.isnan(got[7])
