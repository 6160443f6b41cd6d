import datetime as dt
import json
from wsgiref.util import setup_testing_defaults

import pytest

from basinflow.plans import batch
from basinflow.plans.service import Fifo, Request, TileEngine, application
from basinflow.sources.documents import meta_document

STEM = "2026_apr_tercile_prob_max_Streamflow_tavg"


@pytest.fixture(scope="module")
def engine(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("root")
    base = root / STEM
    rows = [(0, c, None, 1, i, j, float(10 * i + j + c)) for c in range(3) for i in range(4) for j in range(4) if (i, j) != (2, 2)]
    spark.createDataFrame(rows, "time_idx int, category int, profile int, grain int, lat_idx int, lon_idx int, value double").write.partitionBy("grain").parquet(str(base / "levels"))
    spark.createDataFrame([(1, n, i, float(i)) for n in ("lat", "lon") for i in range(4)], "grain int, name string, idx int, coord double").write.parquet(str(base / "axes"))
    spark.createDataFrame([(0, dt.datetime(2026, 4, 30))], "time_idx int, time timestamp").write.parquet(str(base / "times"))
    (base / f"{STEM}_meta.json").write_text(meta_document(STEM, [4, 5], {4: 1, 5: 1}, {"lon_min": 0.0, "lon_max": 3.0, "lat_min": 0.0, "lat_max": 3.0}, 1, 3))
    (root / "index.json").write_text(json.dumps({"initialization_date": "2026_apr"}))
    return TileEngine(spark, str(root), resolution=8)


def test_tile_is_sampled_and_thickened(engine):
    z0 = Request("Streamflow_tavg", "2026-04-30", 1, 0, 0, 0)
    pixels = {(r.row, r.col): r.value for r in engine.tile(z0).collect()}
    assert len(pixels) == 64 and pixels[7, 0] == 1.0 and pixels[0, 7] == 34.0
    assert all(v is not None for v in pixels.values())  # the hole is one pixel wide or two, and grown over
    assert engine.best_zoom("Streamflow_tavg", 0) == 4


def test_errors_are_those_of_the_request(engine):
    with pytest.raises(KeyError):
        engine.level_slice("Streamflow_tavg", 9, 0, 0)
    with pytest.raises(IndexError):
        engine.level_slice("Streamflow_tavg", 4, 5, 0)
    with pytest.raises(IndexError):
        engine.level_slice("Streamflow_tavg", 4, 0, 3)
    with pytest.raises(ValueError):
        engine.level_slice("Streamflow_tavg", 4, "1999-01-01", 0)


def call(app, path, query=""):
    environ, seen = {}, {}
    setup_testing_defaults(environ)
    environ |= {"PATH_INFO": path, "QUERY_STRING": query}
    body = b"".join(app(environ, lambda status, headers: seen.update(status=status, headers=dict(headers))))
    return seen["status"], seen["headers"]["Content-Type"], body


def test_routes(engine):
    app = application(engine)
    status, kind, body = call(app, "/tiles/Streamflow_tavg/0/0/4/0/0.png")
    assert status.startswith("200") and kind == "image/png" and body.startswith(b"\x89PNG")
    status, kind, body = call(app, "/tiles/Streamflow_tavg/0/0/4/0/0.png", "mode=global&tms=true")
    assert status.startswith("200") and body.startswith(b"\x89PNG")  # outside: transparent
    assert call(app, "/tiles/Streamflow_tavg/0/7/4/0/0.png")[0].startswith("500")
    assert json.loads(call(app, "/pyramid/time/Streamflow_tavg")[2]) == {"time": ["2026-04-30T00:00:00"], "count": 1}
    assert json.loads(call(app, "/pyramid/info/Streamflow_tavg")[2])["levels"][0] == {"zoom": 4, "grain": 1, "n_lat": 4, "n_lon": 4}
    assert json.loads(call(app, "/health")[2])["cached_tiles"] == 2
    call(app, "/cache/clear")
    assert json.loads(call(app, "/health")[2])["cached_tiles"] == 0


def test_saved_tiles_and_the_old_parameter(engine, tmp_path):
    app = application(engine, str(tmp_path))
    with pytest.warns(DeprecationWarning):
        status, kind, body = call(app, "/test/save_tile/Streamflow_tavg/0/0/4/0/0", "mode=regional&level=3")
    assert status.startswith("200") and kind == "text/plain" and (tmp_path / "test_tile_4_0_0.png").read_bytes().startswith(b"\x89PNG")
    assert call(app, "/test/save_tile/Streamflow_tavg/0/0/4/0/0")[0].startswith("404")  # global: outside
    assert call(app, "/test/save_tile/Streamflow_tavg/0/9/4/0/0", "mode=regional")[0].startswith("500")


def test_a_run_is_published_and_served(spark, tmp_path):
    """From grids by the batch run to the folder of the engine, and tiles from there: every tile of two zooms."""
    key = "variable string, profile int, time timestamp, ensemble int, lat_idx int, lon_idx int, value double"
    day = lambda y, m: dt.datetime(y, m, 28)
    make = lambda years: spark.createDataFrame([(v, p, day(y, m), e, i, j, float(1 + i + j + e + y % 7 + m)) for v, ps in (("Rainf_tavg", [None]), ("SoilMoist_inst", [0, 1])) for p in ps for y in years for m in (4, 5) for e in (1, 2, 3) for i in range(4) for j in range(4)], key)
    zones = spark.createDataFrame([(62, 0, 0)], "pfaf_id int, lat_idx int, lon_idx int")
    got = batch.run(make(range(2001, 2006)), make([2026]), zones, [1, 2], 4, 4)
    lat, lon = (spark.createDataFrame([(i, a + i) for i in range(4)], "idx int, coord double") for a in (-10.0, -60.0))
    stems = batch.publish_pyramids(spark, got.levels, {4: 2, 5: 1}, lat, lon, str(tmp_path), "2026_apr")
    assert stems == ["2026_apr_tercile_prob_max_Rainf_tavg", "2026_apr_tercile_prob_max_SoilMoist_inst"]
    engine = TileEngine(spark, str(tmp_path), resolution=4)
    meta = engine.meta("SoilMoist_inst")
    assert meta["profile_length"] == 2 and meta["time_len"] == 2 and meta["category_len"] == 3 and meta["data_bounds"] == {"lon_min": -60.0, "lon_max": -57.0, "lat_min": -10.0, "lat_max": -7.0}
    want = {(r.lat_idx, r.lon_idx): r.value for r in got.levels.where("variable = 'SoilMoist_inst' AND profile = 1 AND grain = 1 AND month(time) = 5 AND category = 2").collect()}
    cells = {(r.lat_idx, r.lon_idx): r.value for r in engine.level_slice("SoilMoist_inst", 5, "2026-05-28", 2, 1).collect()}
    assert cells.keys() == want.keys() and all(cells[k] == pytest.approx(v, rel=1e-6) if v is not None else cells[k] is None for k, v in want.items())
    pixels = {(r.row, r.col): r.value for r in engine.tile(Request("SoilMoist_inst", 1, 2, 5, 0, 0, profile=1)).collect()}
    assert len(pixels) == 16 and set(pixels.values()) <= set(cells.values()) | {None}
    app = application(engine)
    for z, n in ((4, 2), (5, 4)):
        info = next(x for x in json.loads(call(app, "/pyramid/info/Rainf_tavg")[2])["levels"] if x["zoom"] == z)
        assert (info["n_lat"], info["n_lon"]) == (n, n)
        for x in range(2):
            for y in range(2):
                assert call(app, f"/tiles/Rainf_tavg/0/0/{z}/{x}/{y}.png")[2].startswith(b"\x89PNG")


def test_fifo_lets_the_oldest_go():
    cache = Fifo(2)
    for k in "abc":
        cache.put(k, k)
    assert cache.get("a") is None and cache.get("c") == "c"


def test_batch_run(spark):
    key = "variable string, profile int, time timestamp, ensemble int, lat_idx int, lon_idx int, value double"
    day = lambda y: dt.datetime(y, 4, 30)
    make = lambda years, k: spark.createDataFrame([(v, None, day(y), e, i, j, float(1 + i + j + e + y % 7) * k) for v in ("Rainf_tavg", "Streamflow_tavg") for y in years for e in (1, 2, 3) for i in range(4) for j in range(4)], key)
    zones = spark.createDataFrame([(62, i, j) for i in range(2) for j in range(2)], "pfaf_id int, lat_idx int, lon_idx int")
    river = spark.createDataFrame([(i, j, int(i == j)) for i in range(4) for j in range(4)], "lat_idx int, lon_idx int, mask int")
    got = batch.run(make(range(2001, 2006), 1.0), make([2026], 1.1), zones, [1, 2], 4, 4, river)
    assert got.probability.count() == 2 * 16 * 3
    off = got.probability.where("variable = 'Streamflow_tavg' AND lat_idx != lon_idx AND value IS NOT NULL")
    assert off.count() == 0
    assert got.forecast.count() == 3 and got.forecast.columns[3:5] == ["Rainf_tavg", "Qair_f_tavg"]
    assert [r.month for r in got.climatology.collect()] == [4]
    assert got.levels.where("grain = 2").count() == 2 * 3 * 4
