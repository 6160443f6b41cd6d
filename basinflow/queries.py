"""Named queries of the raster operators over the driver's tables, with the same results in SQL.

The tables hold no rasters, so one is derived from ``lineitem`` by the same expressions in both
engines: i = l_suppkey % 12, j = l_partkey % 16, t = month(l_shipdate), e = l_linenumber, y = year(l_shipdate),
v = mean l_quantity, missing where (7 i + 3 j + t + e + y) % 13 = 0.  Years before 2000 are the
hindcast; 2000 is the forecast, which is 0 (missing, to a forecast) where (i + j + e) % 9 = 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow import grid as G
from basinflow import sinks
from basinflow.functions import names
from basinflow.operators import probability, pyramid, tiles, zonal
from basinflow.session import shared_base
from basinflow.sources import catalogue, documents
from basinflow.streaming import ingest

NLAT, NLON, MEMBERS = 12, 16, 7
LAT0, LON0, STEP = -20.0, -80.0, 2.0
BOUNDS = {"lon_min": -80.0, "lon_max": -50.0, "lat_min": -20.0, "lat_max": 2.0}
#: Three test basins: a triangle, a concave polygon, and one without a cell centre.
BASINS = {
    1: ((-80.5, -20.5), (-59.5, -20.5), (-80.5, 1.5)),
    2: ((-70.9, -10.7), (-49.3, -10.7), (-49.3, 2.3), (-60.1, -4.9), (-70.9, 2.3)),
    3: ((-79.6, -19.6), (-79.2, -19.6), (-79.2, -19.2)),
}
MERCATOR_TILES = [(z, x, y) for z in range(4) for x in range(1 << z) for y in range(1 << z)]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lat_idx, lon_idx, month, ensemble, year, value."""
    keys = {
        "lat_idx": (F.col("l_suppkey") % NLAT).cast("int"), "lon_idx": (F.col("l_partkey") % NLON).cast("int"),
        "month": F.month("l_shipdate"), "ensemble": F.col("l_linenumber").cast("int"), "year": F.year("l_shipdate"),
    }
    lines = table(spark, sf_dir, "lineitem").select(*[c.alias(k) for k, c in keys.items()], "l_quantity")
    cells = lines.groupBy(*keys).agg(F.avg("l_quantity").alias("value"))
    hole = (F.col("lat_idx") * 7 + F.col("lon_idx") * 3 + F.col("month") + F.col("ensemble") + F.col("year")) % 13 == 0
    return cells.withColumn("value", F.when(~hole, F.col("value")))


def hindcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster(spark, sf_dir).where("year < 2000")


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = (F.col("lat_idx") + F.col("lon_idx") + F.col("ensemble")) % 9 == 0
    return raster(spark, sf_dir).where("year = 2000").withColumn("value", F.when(zero & F.col("value").isNotNull(), 0.0).otherwise(F.col("value"))).withColumnRenamed("month", "time").drop("year")


RASTER = """raster AS (
  SELECT i, j, t, e, y, CASE WHEN (i * 7 + j * 3 + t + e + y) % 13 <> 0 THEN v END AS v
  FROM (SELECT CAST(l_suppkey % 12 AS INT) AS i, CAST(l_partkey % 16 AS INT) AS j, CAST(month(l_shipdate) AS INT) AS t,
               CAST(l_linenumber AS INT) AS e, CAST(year(l_shipdate) AS INT) AS y, avg(l_quantity) AS v
        FROM lineitem GROUP BY ALL)),
hind AS (SELECT * FROM raster WHERE y < 2000),
fcst AS (SELECT i, j, t, e, CASE WHEN (i + j + e) % 9 = 0 AND v IS NOT NULL THEN 0.0::DOUBLE ELSE v END AS v FROM raster WHERE y = 2000)"""
EDGES = "edges AS (SELECT i, j, quantile_cont(v, 1/3.0::DOUBLE) AS lo, quantile_cont(v, 2/3.0::DOUBLE) AS hi FROM hind GROUP BY i, j)"
PROB = """counts AS (
  SELECT f.t, f.i, f.j, sum(CASE WHEN nullif(f.v, 0) <= lo THEN 1 ELSE 0 END) AS n0,
         sum(CASE WHEN nullif(f.v, 0) > lo AND nullif(f.v, 0) <= hi THEN 1 ELSE 0 END) AS n1, sum(CASE WHEN nullif(f.v, 0) > hi THEN 1 ELSE 0 END) AS n2
  FROM fcst f JOIN edges USING (i, j) GROUP BY f.t, f.i, f.j),
prob AS (SELECT t, i, j, c, 100.0 * (n / (SELECT count(DISTINCT e) FROM fcst)::DOUBLE) AS p
         FROM (SELECT t, i, j, 0 AS c, n0 AS n FROM counts UNION ALL SELECT t, i, j, 1, n1 FROM counts UNION ALL SELECT t, i, j, 2, n2 FROM counts))"""
CELLS = "cells AS (SELECT i, j, avg(v) AS v FROM (SELECT i, j, v FROM raster WHERE e = 1) GROUP BY i, j)"
AXES = "lats AS (SELECT CAST(range AS INT) AS i, -20.0::DOUBLE + range * 2.0::DOUBLE AS lat FROM range(12)), lons AS (SELECT CAST(range AS INT) AS j, -80.0::DOUBLE + range * 2.0::DOUBLE AS lon FROM range(16))"


def basin_sql() -> str:
    rows = []
    for zone, ring in BASINS.items():
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            rows.append(f"({zone}, {x1}::DOUBLE, {y1}::DOUBLE, {x2}::DOUBLE, {y2}::DOUBLE)")
    return f"""basin_edges(pfaf_id, x1, y1, x2, y2) AS (VALUES {', '.join(rows)}),
members AS (SELECT pfaf_id, i, j FROM lats, lons, basin_edges
            WHERE (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY pfaf_id, i, j HAVING count(*) % 2 = 1)"""


BASIN = basin_sql()


def axes(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return G.regular_axis(spark, LAT0, STEP, NLAT), G.regular_axis(spark, LON0, STEP, NLON)


def basins(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(z, [{"x": float(x), "y": float(y)} for x, y in ring]) for z, ring in BASINS.items()], "pfaf_id int, ring array<struct<x: double, y: double>>")


def membership(spark: SparkSession) -> DataFrame:
    lat, lon = axes(spark)
    cells = lat.select(F.col("idx").alias("lat_idx"), F.col("coord").alias("lat")).crossJoin(lon.select(F.col("idx").alias("lon_idx"), F.col("coord").alias("lon")))
    return zonal.basin_membership(cells, zonal.polygon_edges(basins(spark)), bucket=4.0)


def one_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lat_idx, lon_idx, value: the mean over all times of the first member."""
    return raster(spark, sf_dir).where("ensemble = 1").groupBy("lat_idx", "lon_idx").agg(F.avg("value").alias("value"))


def r4(c: str = "value", to: str | None = None):
    return F.round(c, 4).alias(to or c)


# Probabilities


@query(f"WITH {RASTER}, {EDGES} SELECT i AS lat_idx, j AS lon_idx, round(lo, 4) AS low, round(hi, 4) AS high FROM edges")
def tercile_edges(spark, sf_dir):
    return probability.quantile_edges(hindcast(spark, sf_dir)).select("lat_idx", "lon_idx", F.round(F.col("edges")[0], 4).alias("low"), F.round(F.col("edges")[1], 4).alias("high"))


@query(f"WITH {RASTER}, {EDGES} SELECT i AS lat_idx, j AS lon_idx, round(hi, 4) AS low, CAST('inf' AS DOUBLE) AS high FROM edges")
def threshold_pair(spark, sf_dir):
    return probability.category_thresholds(hindcast(spark, sf_dir), 2).select("lat_idx", "lon_idx", r4("low"), "high")


@query(f"WITH {RASTER}, {EDGES}, {PROB} SELECT t AS time, i AS lat_idx, j AS lon_idx, c AS category, round(p, 4) AS value FROM prob")
def tercile_probability(spark, sf_dir):
    prob = probability.percent(probability.category_probability(hindcast(spark, sf_dir), forecast(spark, sf_dir)))
    return prob.select("time", "lat_idx", "lon_idx", "category", r4())


@query(f"""WITH {RASTER}, {EDGES}, {PROB} SELECT t AS time, i AS lat_idx, j AS lon_idx, c AS category,
round(CASE WHEN p = max(p) OVER (PARTITION BY t, i, j) THEN p END, 4) AS value FROM prob""")
def dominant_category(spark, sf_dir):
    prob = probability.percent(probability.category_probability(hindcast(spark, sf_dir), forecast(spark, sf_dir)))
    return probability.dominant_category(prob).select("time", "lat_idx", "lon_idx", "category", r4())


@query(f"WITH {RASTER} SELECT t AS time, e AS ensemble, i AS lat_idx, j AS lon_idx, round(CASE WHEN (i + 2 * j) % 5 = 0 THEN v END, 4) AS value FROM fcst")
def river_mask(spark, sf_dir):
    lat, lon = axes(spark)
    river = lat.select(F.col("idx").alias("lat_idx")).crossJoin(lon.select(F.col("idx").alias("lon_idx"))).withColumn("mask", ((F.col("lat_idx") + 2 * F.col("lon_idx")) % 5 == 0).cast("int"))
    return G.masked(forecast(spark, sf_dir), river).select("time", "ensemble", "lat_idx", "lon_idx", r4())


@query(f"WITH {RASTER}, {EDGES} SELECT count(*) AS cells, sum((lo > hi)::INT)::BIGINT AS crossed, count(lo) AS valid FROM edges")
def quantile_order(spark, sf_dir):
    edges = probability.quantile_edges(hindcast(spark, sf_dir))
    return edges.agg(F.count("*").alias("cells"), F.count_if(F.col("edges")[0] > F.col("edges")[1]).alias("crossed"), F.count("edges").alias("valid"))


# Zones


@query(f"WITH {AXES}, {BASIN} SELECT pfaf_id, i AS lat_idx, j AS lon_idx FROM members")
def basin_membership(spark, sf_dir):
    return membership(spark).select("pfaf_id", "lat_idx", "lon_idx")


@query("SELECT * FROM (VALUES (1), (2), (3)) AS z(pfaf_id)")
def zone_ids(spark, sf_dir):
    return basins(spark).select("pfaf_id").distinct()


def variables(grid: DataFrame) -> DataFrame:
    """Three variables from one grid, one of them with two levels."""
    each = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.lit(p).cast("int").alias("profile"), F.lit(float(k)).alias("k")) for v, p, k in (("Rainf_tavg", None, 1), ("SoilMoist_inst", 0, 2), ("SoilMoist_inst", 1, 3), ("Streamflow_tavg", None, 4))]))
    return grid.withColumn("w", each).select("*", "w.*").withColumn("value", F.col("value") * F.col("k")).drop("w", "k").withColumn("variable", G.value_column())


WIDE = ("Rainf_tavg", "SoilMoist_inst_lvl_0", "SoilMoist_inst_lvl_1", "Streamflow_tavg", "Tair_f_tavg")


@query(f"""WITH {RASTER}, {AXES}, {BASIN} SELECT t AS time, e AS ensemble, pfaf_id, round(avg(v), 4) AS "Rainf_tavg", round(avg(v * 2), 4) AS "SoilMoist_inst_lvl_0",
round(avg(v * 3), 4) AS "SoilMoist_inst_lvl_1", round(max(v * 4), 4) AS "Streamflow_tavg", NULL::DOUBLE AS "Tair_f_tavg" FROM fcst JOIN members USING (i, j) GROUP BY t, e, pfaf_id""")
def zonal_forecast_wide(spark, sf_dir):
    statistics = zonal.zonal_statistics(variables(forecast(spark, sf_dir)), membership(spark))
    return zonal.wide(statistics, WIDE, ("time", "ensemble", "pfaf_id")).select("time", "ensemble", "pfaf_id", *[r4(c) for c in WIDE])


@query(f"WITH {RASTER} SELECT t AS month, e AS ensemble, i AS lat_idx, j AS lon_idx, round(avg(v), 4) AS value FROM hind GROUP BY t, e, i, j")
def monthly_climatology(spark, sf_dir):
    return zonal.monthly_climatology(hindcast(spark, sf_dir), F.col("month")).select("month", "ensemble", "lat_idx", "lon_idx", r4())


@query(f"""WITH {RASTER}, {AXES}, {BASIN}, monthly AS (SELECT t, e, i, j, avg(v) AS v FROM hind GROUP BY t, e, i, j), cell AS (SELECT t, i, j, avg(v) AS v FROM monthly GROUP BY t, i, j)
SELECT t AS month, pfaf_id, round(avg(v), 4) AS "Rainf_tavg", round(max(v) * 4, 4) AS "Streamflow_tavg" FROM cell JOIN members USING (i, j) GROUP BY t, pfaf_id""")
def zonal_climatology(spark, sf_dir):
    monthly = zonal.monthly_climatology(variables(hindcast(spark, sf_dir)), F.col("month"), ("variable", "ensemble", "lat_idx", "lon_idx"))
    columns = ("Rainf_tavg", "Streamflow_tavg")
    return zonal.wide(zonal.zonal_climatology(monthly, membership(spark)), columns, ("month", "pfaf_id")).select("month", "pfaf_id", *[r4(c) for c in columns])


@query(f"WITH {RASTER} SELECT t AS time, round(avg(v), 4) AS mean, max(v) AS peak FROM fcst GROUP BY t")
def zonal_by_time(spark, sf_dir):
    grid = forecast(spark, sf_dir)
    peak = zonal.zonal_by_time(grid, maximum=True).withColumnRenamed("value", "peak")
    return zonal.zonal_by_time(grid).join(peak, "time").select("time", r4("value", "mean"), "peak")


@query(f"""WITH {RASTER}, a AS (SELECT t, round(avg(v), 4) AS "Rainf_tavg" FROM fcst WHERE t <= 8 GROUP BY t), b AS (SELECT t, round(max(v), 4) AS "Streamflow_tavg" FROM fcst WHERE t >= 5 GROUP BY t)
SELECT coalesce(a.t, b.t) AS time, "Rainf_tavg", "Streamflow_tavg" FROM a FULL OUTER JOIN b ON a.t = b.t""")
def upsert_merge(spark, sf_dir):
    grid = forecast(spark, sf_dir)
    old = zonal.zonal_by_time(grid.where("time <= 8")).select("time", r4("value", "Rainf_tavg"))
    new = zonal.zonal_by_time(grid.where("time >= 5"), maximum=True).select("time", r4("value", "Streamflow_tavg"))
    return zonal.upserted(old, new)


@query(f"""WITH {RASTER}, {AXES}, {BASIN}, monthly AS (SELECT t, e, i, j, avg(v) AS v FROM hind GROUP BY t, e, i, j), cell AS (SELECT t, i, j, avg(v) AS v FROM monthly GROUP BY t, i, j),
normal AS (SELECT t, pfaf_id, avg(v) AS n FROM cell JOIN members USING (i, j) GROUP BY t, pfaf_id), now AS (SELECT t, e, pfaf_id, avg(v) AS v FROM fcst JOIN members USING (i, j) GROUP BY t, e, pfaf_id)
SELECT pfaf_id, t AS month, e AS ensemble, round(v - n, 4) AS anomaly FROM now JOIN normal USING (t, pfaf_id)""")
def zonal_anomaly(spark, sf_dir):
    rain = lambda g: g.withColumn("variable", F.lit("Rainf_tavg"))
    monthly = zonal.monthly_climatology(rain(hindcast(spark, sf_dir)), F.col("month"), ("variable", "ensemble", "lat_idx", "lon_idx"))
    now = zonal.zonal_statistics(rain(forecast(spark, sf_dir)).withColumn("time", F.make_date(F.lit(2000), "time", F.lit(1))), membership(spark))
    return zonal.anomaly(now, zonal.zonal_climatology(monthly, membership(spark))).select("pfaf_id", "month", "ensemble", r4("anomaly"))


# Pyramids


@query("SELECT CAST(g AS INT) AS grain FROM range(1, 61) r(g) WHERE 540 % g = 0 AND 660 % g = 0")
def common_factors(spark, sf_dir):
    return pyramid.common_factors(spark, 540, 660)


@query("""WITH f AS (SELECT g FROM range(1, 61) r(g) WHERE 540 % g = 0 AND 660 % g = 0), z AS (SELECT range AS zoom FROM range(10)),
ranked AS (SELECT zoom, g, row_number() OVER (PARTITION BY zoom ORDER BY (CASE WHEN g * (111000 * 0.05::DOUBLE) >= 6371000.0::DOUBLE * 2 * pi() / pow(2, zoom) / 256 THEN 0 ELSE 1 END),
 (CASE WHEN g * (111000 * 0.05::DOUBLE) >= 6371000.0::DOUBLE * 2 * pi() / pow(2, zoom) / 256 THEN g ELSE -g END)) AS r FROM z, f)
SELECT CAST(zoom AS INT) AS zoom, CAST(g AS INT) AS grain FROM ranked WHERE r = 1""")
def grain_selection(spark, sf_dir):
    return pyramid.grain_by_zoom(spark, range(10), 540, 660, 0.05)


def block_sql(g: int) -> str:
    s = pyramid.offset(g)
    return f"""SELECT CAST(floor((i - {s}) / {g}.0) AS INT) AS lat_idx, CAST(floor((j - {s}) / {g}.0) AS INT) AS lon_idx, CASE WHEN count(v) >= {g * g * 0.25} THEN avg(v) END AS value
FROM cells WHERE i >= {s} AND j >= {s} AND floor((i - {s}) / {g}.0) < {(NLAT - s) // g} AND floor((j - {s}) / {g}.0) < {(NLON - s) // g} GROUP BY 1, 2"""


@query(f"""WITH {RASTER}, {CELLS}, b AS ({block_sql(3)}) SELECT lat_idx, lon_idx, lat_idx * 3 + 1 AS lat_src, lon_idx * 3 + 1 AS lon_src, round(value, 4) AS value FROM b""")
def block_mean(spark, sf_dir):
    return pyramid.block_mean(one_layer(spark, sf_dir), 3, NLAT, NLON).select("lat_idx", "lon_idx", "lat_src", "lon_src", r4())


@query(f"""WITH {RASTER}, {CELLS} SELECT z.zoom, p.grain, lat_idx, lon_idx, round(value, 4) AS value
FROM (SELECT 1 AS grain, i AS lat_idx, j AS lon_idx, v AS value FROM cells UNION ALL SELECT 2, * FROM ({block_sql(2)}) UNION ALL SELECT 5, * FROM ({block_sql(5)})) p
JOIN (VALUES (0, 5), (1, 2), (2, 1), (3, 1)) AS z(zoom, grain) ON p.grain = z.grain""")
def pyramid_levels(spark, sf_dir):
    zoom_grain = spark.createDataFrame([(0, 5), (1, 2), (2, 1), (3, 1)], "zoom int, grain int")
    levels = pyramid.pyramid(one_layer(spark, sf_dir), [5, 2, 1, 1], NLAT, NLON)
    return levels.join(F.broadcast(zoom_grain), "grain").select("zoom", "grain", "lat_idx", "lon_idx", r4())


@query(f"""WITH {RASTER}, g AS (SELECT t, e, i, j, v FROM fcst) SELECT t AS time, e AS profile, 1 AS grain, round(avg(v), 4) AS value FROM g GROUP BY t, e""")
def profile_mean(spark, sf_dir):
    levels = pyramid.pyramid(forecast(spark, sf_dir).withColumnRenamed("ensemble", "profile"), [1], NLAT, NLON, ("time", "profile"))
    return pyramid.profile_mean(levels, ("time", "profile", "grain")).select("time", "profile", "grain", r4())


@query(f"WITH {RASTER}, {CELLS} SELECT CAST((i - 1) / 3 AS INT) AS lat_idx, CAST((j - 1) / 3 AS INT) AS lon_idx, round(v, 4) AS value FROM cells WHERE i >= 1 AND j >= 1 AND (i - 1) % 3 = 0 AND (j - 1) % 3 = 0")
def strided_pick(spark, sf_dir):
    return pyramid.strided_pick(one_layer(spark, sf_dir), 3).select("lat_idx", "lon_idx", r4())


@query(f"""WITH {RASTER}, {CELLS}, ci AS (SELECT CAST(range AS INT) AS a FROM range(4)), cj AS (SELECT CAST(range AS INT) AS b FROM range(5))
SELECT a AS lat_idx, b AS lon_idx, round(CASE WHEN count(v) > 0 AND count(v) >= 2.25 THEN avg(v) END, 4) AS value
FROM ci, cj, cells WHERE abs(i - (1 + 3 * a)) <= 1 AND abs(j - (1 + 3 * b)) <= 1 GROUP BY a, b""")
def window_mean(spark, sf_dir):
    return pyramid.window_mean(one_layer(spark, sf_dir), 3, NLAT, NLON).select("lat_idx", "lon_idx", r4())


@query("SELECT w.wanted, arg_min(z.zoom, abs(z.zoom - w.wanted) * 100 + z.zoom) AS zoom FROM (VALUES (0), (5), (7), (12)) w(wanted), (VALUES (4), (6), (8), (9)) z(zoom) GROUP BY w.wanted")
def best_zoom(spark, sf_dir):
    zooms = spark.createDataFrame([(4,), (6,), (8,), (9,)], "zoom int")
    out = None
    for wanted in (0, 5, 7, 12):
        one = pyramid.nearest_zoom(zooms, wanted).select(F.lit(wanted).alias("wanted"), "zoom")
        out = one if out is None else out.unionByName(one)
    return out


# Tiles


@query("""WITH t(z, x, y) AS (SELECT z, x, y FROM range(4) a(z), range(8) b(x), range(8) c(y) WHERE x < pow(2, z) AND y < pow(2, z))
SELECT z, x, y, round(x / pow(2, z) * 360 - 180, 6) AS lon_min, round((x + 1) / pow(2, z) * 360 - 180, 6) AS lon_max,
 round(degrees(atan(0.5 * (exp(pi() - 2 * pi() * (y + 1) / pow(2, z)) - exp(-(pi() - 2 * pi() * (y + 1) / pow(2, z)))))), 6) AS lat_min,
 round(degrees(atan(0.5 * (exp(pi() - 2 * pi() * y / pow(2, z)) - exp(-(pi() - 2 * pi() * y / pow(2, z)))))), 6) AS lat_max FROM t""")
def mercator_bounds(spark, sf_dir):
    asked = spark.createDataFrame(MERCATOR_TILES, "z long, x long, y long")
    return tiles.mercator_bounds(asked).select("z", "x", "y", *[F.round(c, 6).alias(c) for c in tiles.BOUNDS])


@query("""WITH t(z, x, y) AS (SELECT z, x, y FROM range(4) a(z), range(8) b(x), range(8) c(y) WHERE x < pow(2, z) AND y < pow(2, z)), b AS (
SELECT z, x, y, x / pow(2, z) * 360 - 180 AS lon_min, (x + 1) / pow(2, z) * 360 - 180 AS lon_max,
 degrees(atan(0.5 * (exp(pi() - 2 * pi() * (y + 1) / pow(2, z)) - exp(-(pi() - 2 * pi() * (y + 1) / pow(2, z)))))) AS lat_min,
 degrees(atan(0.5 * (exp(pi() - 2 * pi() * y / pow(2, z)) - exp(-(pi() - 2 * pi() * y / pow(2, z)))))) AS lat_max FROM t)
SELECT z, x, CAST(pow(2, z) - 1 - y AS BIGINT) AS y FROM b WHERE NOT (lon_max < -81.975 OR lon_min > -49.025 OR lat_max < -20.975 OR lat_min > 5.975)""")
def tiles_in_bounds(spark, sf_dir):
    asked = tiles.mercator_bounds(spark.createDataFrame(MERCATOR_TILES, "z long, x long, y long"))
    return tiles.flipped(asked.where(tiles.touches()), "global", False).select("z", "x", "y")


@query("""WITH t(z, x, y) AS (SELECT z, x, y FROM range(4) a(z), range(8) b(x), range(8) c(y) WHERE x < pow(2, z) AND y < pow(2, z))
SELECT z, x, y, round(-80 + x * (30 / pow(2, z)), 6) AS lon_min, round(-80 + (x + 1) * (30 / pow(2, z)), 6) AS lon_max, round(-20 + y * (22 / pow(2, z)), 6) AS lat_min, round(-20 + (y + 1) * (22 / pow(2, z)), 6) AS lat_max FROM t""")
def regional_bounds(spark, sf_dir):
    asked = spark.createDataFrame(MERCATOR_TILES, "z long, x long, y long")
    return tiles.regional_bounds(asked, BOUNDS).select("z", "x", "y", *[F.round(c, 6).alias(c) for c in tiles.BOUNDS])


def test_tile(spark: SparkSession, z: int = 1, x: int = 1, y: int = 0) -> DataFrame:
    return tiles.regional_bounds(spark.createDataFrame([(z, x, y)], "z long, x long, y long"), BOUNDS)


PIXELS = "pix AS (SELECT CAST(r.range AS INT) AS r, CAST(c.range AS INT) AS c, -65.0::DOUBLE + c.range * 15.0::DOUBLE / 31 AS lon, -9.0::DOUBLE + r.range * (-20.0::DOUBLE + 9.0) / 31 AS lat FROM range(32) r, range(32) c)"


@query(f"WITH {PIXELS} SELECT 1::BIGINT AS z, 1::BIGINT AS x, 0::BIGINT AS y, r AS row, c AS col, round(lon, 6) AS lon, round(lat, 6) AS lat FROM pix")
def pixel_grid(spark, sf_dir):
    return tiles.pixel_grid(test_tile(spark), 32).select("z", "x", "y", "row", "col", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query(f"""WITH {AXES}, t AS (SELECT DISTINCT round(o_totalprice % 40, 2) - 25 AS coord FROM orders), d AS (SELECT coord, i, row_number() OVER (PARTITION BY coord ORDER BY abs(lat - coord), lat) AS r FROM t, lats)
SELECT coord, i AS idx FROM d WHERE r = 1""")
def nearest_index(spark, sf_dir):
    targets = table(spark, sf_dir, "orders").select((F.round(F.col("o_totalprice") % 40, 2) - 25).alias("coord")).distinct()
    return tiles.nearest_index(targets, axes(spark)[0]).select("coord", "idx")


@query(f"""WITH {RASTER}, {CELLS}, {AXES}, {PIXELS}, ri AS (SELECT r, i, row_number() OVER (PARTITION BY r ORDER BY abs(l.lat - p.lat), l.lat) AS k FROM (SELECT DISTINCT r, lat FROM pix) p, lats l),
cj AS (SELECT c, j, row_number() OVER (PARTITION BY c ORDER BY abs(l.lon - p.lon), l.lon) AS k FROM (SELECT DISTINCT c, lon FROM pix) p, lons l)
SELECT pix.r AS row, pix.c AS col, round(v, 4) AS value FROM pix LEFT JOIN (SELECT r, i FROM ri WHERE k = 1) a ON pix.r = a.r AND lat BETWEEN -20 AND 2 LEFT JOIN (SELECT c, j FROM cj WHERE k = 1) b ON pix.c = b.c AND lon BETWEEN -80 AND -50
LEFT JOIN cells ON cells.i = a.i AND cells.j = b.j""")
def tile_nearest(spark, sf_dir):
    lat, lon = axes(spark)
    return tiles.sample_nearest(one_layer(spark, sf_dir), lat, lon, test_tile(spark), 32).select("row", "col", r4())


@query(f"""WITH {RASTER}, {CELLS}, {PIXELS}, f AS (SELECT r, c, (lat + 20) / 2 AS fi, (lon + 80) / 2 AS fj FROM pix), g AS (SELECT r, c, CAST(floor(fi) AS INT) AS i0, CAST(floor(fj) AS INT) AS j0, fi - floor(fi) AS wi, fj - floor(fj) AS wj FROM f WHERE fi BETWEEN 0 AND 11 AND fj BETWEEN 0 AND 15),
n AS (SELECT r, c, v, w FROM (SELECT r, c, i0 + di AS i, j0 + dj AS j, (CASE WHEN di = 1 THEN wi ELSE 1 - wi END) * (CASE WHEN dj = 1 THEN wj ELSE 1 - wj END) AS w FROM g, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) d(di, dj)) k LEFT JOIN cells USING (i, j) WHERE w > 1e-12)
SELECT pix.r AS row, pix.c AS col, round(m.v, 4) AS value FROM pix LEFT JOIN (SELECT r, c, CASE WHEN count(*) = count(v) THEN sum(v * w) END AS v FROM n GROUP BY r, c) m ON pix.r = m.r AND pix.c = m.c""")
def tile_bilinear(spark, sf_dir):
    lat, lon = axes(spark)
    points = tiles.pixel_grid(test_tile(spark), 32).select("row", "col", "lon", "lat")
    return tiles.sample_bilinear(one_layer(spark, sf_dir), lat, lon, points, ("row", "col")).select("row", "col", r4())


SPARSE = f"{RASTER}, {CELLS}, sparse AS (SELECT i AS r, j AS c, v FROM cells WHERE v > (SELECT quantile_cont(v, 0.95::DOUBLE) FROM cells))"
GROW = """(SELECT r, c, v FROM (SELECT r, c, v, row_number() OVER (PARTITION BY r, c ORDER BY p) AS k FROM (
 SELECT r, c, v, -1 AS p FROM {0} UNION ALL SELECT r - di, c - dj, v, p FROM {0}, (VALUES (1, 1, 0), (1, 0, 1), (1, -1, 2), (0, 1, 3), (0, -1, 4), (-1, 1, 5), (-1, 0, 6), (-1, -1, 7)) o(di, dj, p)
 WHERE r - di BETWEEN 0 AND 11 AND c - dj BETWEEN 0 AND 15)) WHERE k = 1)"""


@query(f"WITH {SPARSE}, one AS {GROW.format('sparse')}, two AS {GROW.format('one')} SELECT r AS row, c AS col, round(v, 4) AS value FROM two")
def thicken(spark, sf_dir):
    """The twentieth of cells with the largest values, as rivers among land, grown twice."""
    layer = one_layer(spark, sf_dir)
    limit = layer.agg(F.percentile("value", 0.95).alias("limit"))
    sparse = layer.crossJoin(F.broadcast(limit)).where("value > limit").select(F.col("lat_idx").alias("row"), F.col("lon_idx").alias("col"), "value")
    return tiles.thicken(sparse, NLAT, NLON, passes=2).select("row", "col", r4())


@query(f"""WITH {RASTER}, {CELLS}, {AXES} SELECT CAST(round_even((-9.0 - lat) / 11.0 * 4, 0) AS INT) AS row, CAST(round_even((lon + 65.0) / 15.0 * 5, 0) AS INT) AS col, round(max(v), 4) AS value
FROM cells JOIN lats USING (i) JOIN lons USING (j) WHERE v IS NOT NULL AND lat BETWEEN -21 AND -8 AND lon BETWEEN -66 AND -49
 AND round_even((-9.0 - lat) / 11.0 * 4, 0) BETWEEN 0 AND 4 AND round_even((lon + 65.0) / 15.0 * 5, 0) BETWEEN 0 AND 5 GROUP BY 1, 2""")
def scatter_max(spark, sf_dir):
    lat, lon = axes(spark)
    tile = {"lon_min": -65.0, "lon_max": -50.0, "lat_min": -20.0, "lat_max": -9.0}
    return tiles.scatter_max(one_layer(spark, sf_dir), lat, lon, tile, 5, 6).select("row", "col", r4())


@query(f"WITH {RASTER} SELECT t AS time, round(quantile_cont(v, 0.02::DOUBLE), 4) AS vmin, round(quantile_cont(v, 0.98::DOUBLE), 4) AS vmax FROM fcst GROUP BY t")
def stretch_percentiles(spark, sf_dir):
    return tiles.stretch(forecast(spark, sf_dir), ("time",)).select("time", r4("vmin"), r4("vmax"))


@query(f"""WITH {RASTER}, f AS (SELECT i, j, t, e, v FROM fcst), s AS (SELECT i, j, t, e, CASE WHEN v IS NOT NULL THEN least(greatest((v - 5) / 40, 0), 1) END AS share FROM f)
SELECT i AS lat_idx, j AS lon_idx, t AS time, e AS ensemble, round(share, 4) AS share, CASE WHEN share IS NOT NULL THEN CAST(least(floor(share * 256), 255) AS INT) END AS level FROM s""")
def colour_levels(spark, sf_dir):
    grid = forecast(spark, sf_dir)
    return tiles.colour_index(grid, tiles.stretch(grid, (), 5.0, 45.0)).select("lat_idx", "lon_idx", "time", "ensemble", r4("share"), "level")


@query("SELECT CAST(2 AS INT) AS z, x, y, round(-80 + x * 7.5::DOUBLE, 6) AS lon_min, round(-20 + y * 5.5::DOUBLE, 6) AS lat_min FROM range(4) a(x), range(4) b(y)")
def mosaic(spark, sf_dir):
    every = tiles.regional_bounds(tiles.all_tiles(spark, 2), BOUNDS)
    return every.select("z", "x", "y", F.round("lon_min", 6).alias("lon_min"), F.round("lat_min", 6).alias("lat_min"))


@query()
def tile_png(spark, sf_dir):
    """row counts and the size of an image; no SQL makes PNG files."""
    import pandas as pd

    from basinflow.functions.colours import palette_png

    lat, lon = axes(spark)
    pixels = tiles.sample_nearest(one_layer(spark, sf_dir), lat, lon, test_tile(spark), 64)
    coloured = tiles.colour_index(pixels, tiles.stretch(pixels)).withColumn("tile", F.lit("1/1/0"))

    def encode(rows: pd.DataFrame) -> pd.DataFrame:
        frame = rows.pivot(index="row", columns="col", values="level")
        return pd.DataFrame({"tile": [rows["tile"].iloc[0]], "png": [palette_png(frame.fillna(0).to_numpy(), frame.notna().to_numpy(), "Reds")]})

    return coloured.groupBy("tile").applyInPandas(encode, "tile string, png binary")


# Catalogue


NAMES = """files AS (SELECT DISTINCT CASE WHEN o_orderkey % 5 = 0 THEN 'ldas_fcst_' || strftime(o_orderdate, '%Y%m%d') || '.nc'
 WHEN o_orderkey % 7 = 0 THEN 'LDAS_fcst_' || strftime(o_orderdate, '%Y_%b%d') || '.nc' WHEN o_orderkey % 11 = 0 THEN 'ldas_fcst_2024_feb31.nc' WHEN o_orderkey % 13 = 0 THEN 'other_' || strftime(o_orderdate, '%Y') || '.nc'
 ELSE 'ldas_fcst_' || strftime(o_orderdate, '%Y_') || lower(strftime(o_orderdate, '%b%d')) || '.nc' END AS name FROM orders)"""
PARSED = """parsed AS (SELECT name, CAST(coalesce(try_strptime(lower(regexp_extract(name, '(?i)^ldas_fcst_(\\d{4}_[a-z]{3}\\d{2})\\.nc$', 1)), '%Y_%b%d'),
 try_strptime(regexp_extract(name, '(?i)^ldas_fcst_(\\d{8})\\.nc$', 1), '%Y%m%d')) AS DATE) AS init FROM files)"""
CATALOGUE = f"{NAMES}, {PARSED}, known AS (SELECT name, init FROM parsed WHERE init IS NOT NULL AND starts_with(name, 'ldas_fcst_'))"


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    name = (
        F.when(key % 5 == 0, F.concat(F.lit("ldas_fcst_"), F.date_format(day, "yyyyMMdd"), F.lit(".nc")))
        .when(key % 7 == 0, F.concat(F.lit("LDAS_fcst_"), F.date_format(day, "yyyy_MMMdd"), F.lit(".nc")))
        .when(key % 11 == 0, F.lit("ldas_fcst_2024_feb31.nc"))
        .when(key % 13 == 0, F.concat(F.lit("other_"), F.date_format(day, "yyyy"), F.lit(".nc")))
        .otherwise(F.concat(F.lit("ldas_fcst_"), F.lower(F.date_format(day, "yyyy_MMMdd")), F.lit(".nc")))
    )
    return table(spark, sf_dir, "orders").select(name.alias("name")).distinct()


def files_with_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.forecast_files(file_names(spark, sf_dir).withColumn("mtime", F.lit(0)))


@query(f"WITH {NAMES}, {PARSED} SELECT name, init FROM parsed")
def parse_init_date(spark, sf_dir):
    return file_names(spark, sf_dir).select("name", names.init_date(F.col("name")).alias("init"))


@query(f"WITH {CATALOGUE} SELECT name, init FROM known ORDER BY init DESC, name DESC LIMIT 1")
def latest_file(spark, sf_dir):
    return catalogue.latest_file(files_with_dates(spark, sf_dir)).select("name", "init")


@query(f"WITH {CATALOGUE} SELECT name, init FROM known WHERE year(init) < 2021 AND day(init) = 1 AND month(init) = (SELECT month(max(init)) FROM known)")
def hindcast_files(spark, sf_dir):
    return catalogue.hindcast_files(files_with_dates(spark, sf_dir)).select("name", "init")


@query("SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y_') || lower(strftime(o_orderdate, '%b')) AS tag FROM orders")
def init_tag(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), names.init_tag(F.col("o_orderdate")).alias("tag")).distinct()


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS time, CAST(month(ts) AS INT) AS month FROM events")
def iso_time(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", names.iso(F.col("ts")).alias("time"), F.month("ts").alias("month"))


@query("""WITH entries AS (SELECT DISTINCT strftime(o_orderdate, '%Y_') || lower(strftime(o_orderdate, '%b')) || CASE WHEN o_orderkey % 3 = 0 THEN '_meta.json' ELSE '_run' END AS name FROM orders)
SELECT name FROM entries WHERE NOT contains(name, '1998_jul') AND NOT ends_with(name, '.json')""")
def purge_list(spark, sf_dir):
    name = F.concat(names.init_tag(F.col("o_orderdate")), F.when(F.col("o_orderkey") % 3 == 0, "_meta.json").otherwise("_run"))
    return sinks.purge_list(table(spark, sf_dir, "orders").select(name.alias("name")).distinct(), "1998_jul").select("name")


TIMES = "times AS (SELECT CAST(row_number() OVER (ORDER BY d, h) - 1 AS INT) AS k, d, h FROM (SELECT DISTINCT CAST(ts AS DATE) AS d, CASE WHEN day(ts) % 5 = 0 THEN hour(ts) // 12 * 12 ELSE 0 END AS h FROM events))"
REQUESTS = ("3", "-1", " '2024-01-07' ", "2024-01-10", "2024-01-10T12:00:00", "2024-01-08T00:00:00", "1999-01-01", "2024-01-09T23:59:59")


@query(f"""WITH {TIMES}, iso AS (SELECT k, strftime(d, '%Y-%m-%d') || 'T' || lpad(CAST(h AS VARCHAR), 2, '0') || ':00:00' AS s FROM times),
asked AS (SELECT request, trim(request, ' ''') AS q FROM (VALUES ('3'), ('-1'), (' ''2024-01-07'' '), ('2024-01-10'), ('2024-01-10T12:00:00'), ('2024-01-08T00:00:00'), ('1999-01-01'), ('2024-01-09T23:59:59')) v(request)),
found AS (SELECT request, q, (SELECT min(k) FROM iso WHERE s = q) AS exact, (SELECT count(*) FROM iso WHERE s[:10] = q[:10]) AS n, (SELECT min(k) FROM iso WHERE s[:10] = q[:10]) AS day FROM asked)
SELECT request, CASE WHEN regexp_full_match(q, '-*\\d+') THEN CAST(q AS INT) WHEN exact IS NOT NULL THEN exact WHEN n = 1 THEN day END AS time_idx,
 NOT regexp_full_match(q, '-*\\d+') AND exact IS NULL AND n > 1 AS ambiguous FROM found""")
def time_selector(spark, sf_dir):
    day, hour = F.to_date("ts"), F.when(F.dayofmonth("ts") % 5 == 0, F.floor(F.hour("ts") / 12) * 12).otherwise(0)
    stamps = table(spark, sf_dir, "events").select((day.cast("timestamp") + F.make_dt_interval(hours=hour.cast("int"))).alias("time")).distinct()
    from pyspark.sql import Window

    times = stamps.select((F.row_number().over(Window.orderBy("time")) - 1).alias("time_idx"), "time")
    asked = spark.createDataFrame([(r,) for r in REQUESTS], "request string")
    return names.resolved_times(asked, times).select("request", "time_idx", F.coalesce(F.startswith("error", F.lit("ambiguous")), F.lit(False)).alias("ambiguous"))


@query(f"WITH {TIMES} SELECT list_sort(list(DISTINCT strftime(d, '%Y-%m-%d')))::VARCHAR[] AS days FROM times")
def available_dates(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(F.array_sort(F.collect_set(F.substring(names.iso(F.col("ts")), 1, 10))).alias("days"))


@query("""WITH folders AS (SELECT DISTINCT strftime(o_orderdate, '%Y_') || lower(strftime(o_orderdate, '%b')) || CASE WHEN o_orderkey % 2 = 0 THEN '_tercile_prob_max_' ELSE '_tercile_probability_max_' END || CASE o_orderkey % 3 WHEN 0 THEN 'Rainf_tavg' WHEN 1 THEN 'Qs_tavg' ELSE 'Evap_tavg' END AS name FROM orders)
SELECT variable, CASE WHEN contains(variable, '_tercile_') THEN variable ELSE coalesce((SELECT min(name) FROM folders WHERE ends_with(name, '_tercile_prob_max_' || variable) OR ends_with(name, '_tercile_probability_max_' || variable)), '2026_apr_tercile_prob_max_' || variable) END AS stem
FROM (VALUES ('Rainf_tavg'), ('Qs_tavg'), ('Tair_f_tavg'), ('2025_may_tercile_prob_max_Qs_tavg')) v(variable)""")
def stem_resolve(spark, sf_dir):
    key = F.col("o_orderkey")
    variable = F.when(key % 3 == 0, "Rainf_tavg").when(key % 3 == 1, "Qs_tavg").otherwise("Evap_tavg")
    name = F.concat(names.init_tag(F.col("o_orderdate")), F.when(key % 2 == 0, "_tercile_prob_max_").otherwise("_tercile_probability_max_"), variable)
    folders = table(spark, sf_dir, "orders").select(name.alias("name")).distinct()
    asked = spark.createDataFrame([("Rainf_tavg",), ("Qs_tavg",), ("Tair_f_tavg",), ("2025_may_tercile_prob_max_Qs_tavg",)], "variable string")
    return names.stems(asked, folders, "2026_apr").select("variable", "stem")


@query("SELECT event_id, md5('tile_' || event_type || '_' || user_id) AS key FROM events")
def cache_key(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", names.cache_key(F.lit("tile"), F.col("event_type"), F.col("user_id")).alias("key"))


@query("""SELECT * FROM (VALUES ('a.npz', 4, 'a.npz'), ('a.npz', 9, 'a.npz'), ('{"4":"b4.npz","5":"b5.npz"}', 4, 'b4.npz'), ('{"4":"b4.npz","5":"b5.npz"}', 9, NULL)) t(files, zoom, name)""")
def bundle_names(spark, sf_dir):
    rows = spark.createDataFrame([("a.npz",), ('{"4":"b4.npz","5":"b5.npz"}',)], "files string")
    each = [rows.select("files", F.lit(z).alias("zoom"), documents.bundle_name(z).alias("name")) for z in (4, 9)]
    return each[0].unionByName(each[1])


# Selection and diagnostics


@query(f"WITH {RASTER} SELECT i AS lat_idx, j AS lon_idx, round(v, 4) AS value FROM fcst WHERE t = 3 AND e = 2")
def level_slice(spark, sf_dir):
    return pyramid.layer(forecast(spark, sf_dir), time=3, ensemble=2).select("lat_idx", "lon_idx", r4())


@query(f"WITH {RASTER} SELECT y AS year, t AS month, count(*) AS cells, count(v) AS valid FROM raster WHERE y IN (1996, 1997, 2000) GROUP BY y, t")
def combine_files(spark, sf_dir):
    grid = raster(spark, sf_dir)
    parts = [grid.where(f"year = {y}") for y in (1996, 1997, 2000)]
    return G.combine(parts).groupBy("year", "month").agg(F.count("*").alias("cells"), F.count("value").alias("valid"))


@query(f"WITH {RASTER} SELECT t AS month, count(*) AS cells, count(*) - count(v) AS missing, round((count(*) - count(v)) / count(*)::DOUBLE, 4) AS missing_share FROM raster GROUP BY t")
def valid_share(spark, sf_dir):
    return G.valid_share(raster(spark, sf_dir), "month").select("month", "cells", "missing", r4("missing_share"))


@query("""WITH a AS (SELECT l_returnflag AS name, CAST(l_linenumber AS INT) AS idx, round(avg(l_extendedprice), 2) AS coord FROM lineitem GROUP BY 1, 2), d AS (SELECT name, coord - lag(coord) OVER (PARTITION BY name ORDER BY idx) AS s FROM a)
SELECT name, round(abs(avg(s)), 4) AS spacing FROM d GROUP BY name""")
def grid_spacing(spark, sf_dir):
    axis = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("name"), F.col("l_linenumber").cast("int").alias("idx")).agg(F.round(F.avg("l_extendedprice"), 2).alias("coord"))
    return G.grid_spacing(axis, "name").select("name", r4("spacing"))


@query("SELECT n_regionkey AS name, min(c_acctbal) AS lo, max(c_acctbal) AS hi, count(*) AS size FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def axis_extent(spark, sf_dir):
    axis = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return G.axis_extent(axis.select(F.col("n_regionkey").alias("name"), F.col("c_acctbal").alias("coord")), "name")


@query("SELECT count(*) AS n, round(avg(value), 4) AS mean, min(value) AS fastest, max(value) AS slowest, round(sum(value), 2) AS total, event_type FROM events GROUP BY event_type")
def latency_summary(spark, sf_dir):
    v = F.col("value")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg(v), 4).alias("mean"), F.min(v).alias("fastest"), F.max(v).alias("slowest"), F.round(F.sum(v), 2).alias("total"))


# Streaming


@query("SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS day, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def stream_daily_means(spark, sf_dir):
    """The events table read as a stream to its end, in windows of a day; state and results are in the shared folder."""
    import uuid

    path = f"{shared_base(spark)}/stream/{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "events").schema
    stream = ingest.table_stream(spark, f"{sf_dir}/events.parquet", schema.simpleString()[7:-1].replace(":", " "))
    means = ingest.windowed_means(stream, "ts", "1 day", "40 days", "event_type")
    each = lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/out")
    ingest.run_available(means, f"{path}/state", each, "complete").awaitTermination()
    return spark.read.parquet(f"{path}/out").select("event_type", F.col("w.start").cast("timestamp_ntz").alias("day"), "n", F.round("total", 2).alias("total"))
