import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basinflow import grid as G
from basinflow import sinks
from basinflow.functions import names as N
from basinflow.sources import arrays, catalogue, documents


def test_init_dates(spark):
    cases = {
        "ldas_fcst_2024_dec01.nc": "2024-12-01", "LDAS_fcst_2024_Dec01.nc": "2024-12-01", "ldas_fcst_20241201.nc": "2024-12-01",
        "ldas_fcst_2024_feb31.nc": None, "ldas_fcst_2024_xyz01.nc": None, "ldas_fcst_20241301.nc": None, "ldas_fcst_2024_dec01.txt": None, "other.nc": None,
    }
    df = spark.createDataFrame([(n,) for n in cases], "name string")
    got = {r.name: r.d and str(r.d) for r in df.select("name", N.init_date(F.col("name")).alias("d")).collect()}
    assert got == cases
    with pytest.raises(Exception, match="no forecast file name"):
        df.where("name = 'other.nc'").select(N.required_init_date(F.col("name"))).collect()


def test_time_requests(spark):
    times = spark.sql("SELECT * FROM VALUES (0, timestamp'2026-04-30'), (1, timestamp'2026-05-31'), (2, timestamp'2026-05-31 12:00:00') AS t(time_idx, time)")
    asked = spark.createDataFrame([(x,) for x in ("1", "-2", "2026-04-30", "'2026-05-31T12:00:00'", "2026-05-31T05:00:00", "2030-01-01")], "request string")
    got = {r.request: (r.time_idx, r.error) for r in N.resolved_times(asked, times).collect()}
    assert got["1"][0] == 1 and got["-2"][0] == -2 and got["2026-04-30"][0] == 0 and got["'2026-05-31T12:00:00'"][0] == 2
    assert got["2026-05-31T05:00:00"][1].startswith("ambiguous") and "2026-04-30, 2026-05-31" in got["2030-01-01"][1]


def test_catalogue_over_real_files(spark, tmp_path):
    for name in ("ldas_fcst_2019_apr01.nc", "ldas_fcst_20200401.nc", "ldas_fcst_2020_apr02.nc", "ldas_fcst_2022_apr01.nc", "ldas_fcst_2026_apr01.nc", "note_2026.nc"):
        (tmp_path / name).write_bytes(b"x")
    files = catalogue.forecast_files(catalogue.list_files(spark, str(tmp_path)))
    assert catalogue.latest_file(files).first().name == "ldas_fcst_2026_apr01.nc"
    assert [r.name for r in catalogue.hindcast_files(files).collect()] == ["ldas_fcst_2019_apr01.nc", "ldas_fcst_20200401.nc"]
    assert [r.path for r in catalogue.numbered_paths(spark, "f_%d.nc", 2001, 2002).collect()] == ["f_2001.nc", "f_2002.nc"]


def test_coordinates_are_found_by_name():
    assert G.find_coordinate(["longitude", "east_west"], "lon") == "east_west"
    assert G.find_profile(["time", "SoilProfile"]) == "SoilProfile" and G.find_profile(["time"]) is None
    with pytest.raises(AttributeError):
        G.find_coordinate(["x"], "lat")
    assert len(G.output_columns()) == 14 and G.output_columns()[5] == "SoilMoist_inst_lvl_0"


def test_documents(spark, tmp_path):
    text = documents.meta_document("2026_apr_tercile_prob_max_Qs_tavg", [5, 4], {4: 2, 5: 1}, G.DATA_BOUNDS, 6, 3)
    (tmp_path / "m.json").write_text(text)
    row = documents.read_meta(spark, str(tmp_path / "m.json")).first()
    assert row.zooms == [4, 5] and row.grain_map == {"4": 2, "5": 1} and row.profile_dim is None and "profile_length" not in json.loads(text)
    assert documents.read_index(spark, str(tmp_path / "none.json")).count() == 0
    polygon = {"type": "Feature", "properties": {"PFAF_ID": 62}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 0]], [[1, 0.5], [2, 0.5], [2, 1], [1, 0.5]]]}}
    many = {"type": "Feature", "properties": {"PFAF_ID": 63}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1]]], [[[5, 5], [6, 5], [6, 6]]]]}}
    (tmp_path / "z.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [polygon, many]}))
    zones = documents.read_zones(spark, str(tmp_path / "z.geojson"))
    assert sorted((r.pfaf_id, len(r.ring)) for r in zones.collect()) == [(62, 4), (62, 4), (63, 3), (63, 3)]


def test_bundle_round_trip(spark, tmp_path):
    rows = pd.DataFrame([(4, pd.Timestamp("2026-04-30"), c, p, i, j, -20.0 + i, -80.0 + j, float(c * 100 + p * 10 + i * 3 + j)) for c in range(3) for p in range(2) for i in range(2) for j in range(3)], columns=["zoom", "time", "category", "profile", "lat_idx", "lon_idx", "lat", "lon", "value"])
    rows.loc[0, "value"] = np.nan
    (tmp_path / "a_pyramid.npz").write_bytes(arrays.bundle_bytes(rows, {4: 2}))
    back = arrays.read_bundles(spark, str(tmp_path), [4, 9])
    assert back.count() == len(rows) and back.where("value IS NULL").count() == 1
    got = {(r.category, r.profile, r.lat_idx, r.lon_idx): r.value for r in back.collect()}
    assert got[2, 1, 1, 2] == 215.0
    with pytest.raises(ValueError):
        arrays.layers(np.zeros((4, 4, 1, 1)), 2, 3, None)


def test_sinks(spark, tmp_path):
    grid = spark.createDataFrame([("Qs_tavg", "2026-04-01", 1, 0, 0, 1.5), ("Rainf_tavg", "2026-04-01", 1, 0, 0, None)], "variable string, init_date string, time int, lat_idx int, lon_idx int, value double")
    sinks.write_grid(grid, str(tmp_path / "grid"))
    assert arrays.read_grid(spark, str(tmp_path / "grid"), "Qs_tavg").first().value == 1.5
    with pytest.raises(KeyError):
        arrays.read_grid(spark, str(tmp_path / "grid"), "none")
    first = spark.createDataFrame([("a", 1.0)], "time string, x double")
    sinks.upsert_table(spark, first, str(tmp_path / "t"))
    sinks.upsert_table(spark, spark.createDataFrame([("b", 2.0)], "time string, y double"), str(tmp_path / "t"))
    (tmp_path / "t").rename(tmp_path / "t.old")  # as after a failure between the renames
    sinks.upsert_table(spark, spark.createDataFrame([("b", 2.0)], "time string, y double"), str(tmp_path / "t"))
    assert not (tmp_path / "t.old").exists() and not (tmp_path / "t.new").exists()
    assert {r.time: (r.x, r.y) for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {"a": (1.0, None), "b": (None, 2.0)}
    table = spark.createDataFrame([(1, 2, 62, 0.5), (1, 1, 62, 0.25), (1, 1, 63, None)], "time int, ensemble int, pfaf_id int, Qs_tavg double")
    sinks.write_basin_csv(table, str(tmp_path / "csv"))
    assert len(list((tmp_path / "csv").glob("basin=*/*.csv"))) == 2
    assert sinks.read_basin_csv(spark, str(tmp_path / "csv"), "time int, ensemble int, pfaf_id int, Qs_tavg double").where("Qs_tavg IS NULL").count() == 1
    runs = tmp_path / "runs"
    for name in ("2025_mar_x", "2026_apr_x"):
        (runs / name).mkdir(parents=True)
    (runs / "old.json").write_text("{}")
    assert sinks.purge(spark, str(runs), "2026_apr") == ["2025_mar_x"] and sorted(p.name for p in runs.iterdir()) == ["2026_apr_x", "old.json"]
