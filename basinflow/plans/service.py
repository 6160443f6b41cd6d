"""The request engine: tiles and metadata of published pyramids.

A pyramid is a Parquet folder ``{root}/{stem}/levels`` (time_idx, category, profile, grain, lat_idx,
lon_idx, value) with ``axes`` (grain, name, idx, coord), ``times`` (time_idx, time) and ``{stem}_meta.json``.
"""

from __future__ import annotations

import json
import time as clock
import warnings
from collections import OrderedDict
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinflow.functions.colours import palette_png
from basinflow.functions.names import iso, resolved_times, stems
from basinflow.operators import pyramid, tiles
from basinflow.sinks import folder_entries, write_bytes
from basinflow.sources.documents import read_index, read_meta


@dataclass(frozen=True)
class Request:
    """A tile request with its defaults."""

    variable: str
    time: str | int
    category: int
    z: int
    x: int
    y: int
    colormap: str = "Reds"
    vmin: float | None = None
    vmax: float | None = None
    profile: int = 0
    mode: str = "regional"
    tms: bool = False
    cache: bool = True


@dataclass
class Fifo:
    """A bounded cache that lets the oldest entry go."""

    size: int
    entries: OrderedDict = field(default_factory=OrderedDict)

    def get(self, key):
        return self.entries.get(key)

    def put(self, key, value) -> None:
        if key not in self.entries and len(self.entries) >= self.size:
            self.entries.popitem(last=False)
        self.entries[key] = value


class TileEngine:
    """Answers requests for one root folder."""

    def __init__(self, spark: SparkSession, root: str, resolution: int = 256) -> None:
        self.spark, self.root, self.resolution = spark, root.rstrip("/"), resolution
        self.metas, self.images = Fifo(1), Fifo(50)
        self.stems: dict[str, str] = {}  # by variable, until the caches are cleared

    def stem(self, variable: str) -> str:
        if variable in self.stems:
            return self.stems[variable]
        index = read_index(self.spark, f"{self.root}/index.json").first()
        asked = self.spark.createDataFrame([(variable,)], "variable string")
        found = stems(asked, folder_entries(self.spark, self.root), index and index[0]).first()
        if found is None or found.stem is None:
            raise FileNotFoundError(f"no pyramid for {variable} in {self.root}")
        self.stems[variable] = found.stem
        return found.stem

    def meta(self, variable: str) -> dict:
        stem = self.stem(variable)
        known = self.metas.get(stem)
        if known is None:
            row = read_meta(self.spark, f"{self.root}/{stem}/{stem}_meta.json").first()
            if row is None:
                raise FileNotFoundError(f"no metadata for {stem}")
            known = row.asDict(recursive=True)
            self.metas.put(stem, known)
        return known

    def best_zoom(self, variable: str, wanted: int) -> int:
        there = sorted(self.meta(variable)["zooms"] or [])
        if not there:
            raise KeyError(f"no zoom levels for {variable}")
        return min(there, key=lambda z: (abs(z - wanted), z))

    def times(self, variable: str) -> DataFrame:
        """time_idx and time (ISO) of a pyramid."""
        return self.spark.read.parquet(f"{self.root}/{self.stem(variable)}/times").select("time_idx", iso(F.col("time")).alias("time")).orderBy("time_idx")

    def time_index(self, variable: str, wanted: str | int) -> int:
        table = self.spark.read.parquet(f"{self.root}/{self.stem(variable)}/times")
        got = resolved_times(self.spark.createDataFrame([(str(wanted),)], "request string"), table).first()
        if got.time_idx is None:
            raise ValueError(got.error)
        return got.time_idx

    def level_slice(self, variable: str, z: int, time: str | int, category: int, profile: int = 0) -> DataFrame:
        """lat_idx, lon_idx, value of one layer; filters reach the scan, so one partition is read.

        KeyError for a zoom, IndexError for a time, category or profile that is not there.
        """
        meta = self.meta(variable)
        if z not in meta["zooms"]:
            raise KeyError(f"zoom {z} is not among {meta['zooms']}")
        index = self.time_index(variable, time)
        for name, value, size in (("time", index, meta["time_len"]), ("category", category, meta["category_len"]), *((("profile", profile, meta["profile_length"]),) if meta["profile_dim"] else ())):
            if not 0 <= value < size:
                raise IndexError(f"{name} {value} is out of range 0..{size - 1}")
        rows = self.spark.read.parquet(f"{self.root}/{meta['stem']}/levels")
        return pyramid.layer(rows, grain=self.grain(variable, z), time_idx=index, category=category, **({"profile": profile} if meta["profile_dim"] else {}))

    def grain(self, variable: str, z: int) -> int:
        return (self.meta(variable)["grain_map"] or {}).get(str(z), 1)

    def axis(self, variable: str, z: int, name: str) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.root}/{self.stem(variable)}/axes")
        return rows.where((F.col("grain") == self.grain(variable, z)) & (F.col("name") == name)).select("idx", "coord")

    def bounds(self, request: Request) -> DataFrame:
        tile = self.spark.createDataFrame([(request.z, request.x, request.y)], "z int, x long, y long")
        tile = tiles.flipped(tile, request.mode, request.tms)
        if request.mode == "global":
            return tiles.mercator_bounds(tile).where(tiles.touches(self.meta(request.variable)["data_bounds"]))
        return tiles.regional_bounds(tile, self.meta(request.variable)["data_bounds"])

    def tile(self, request: Request) -> DataFrame:
        """row, col, value of every pixel; no rows for a global tile outside the data."""
        z = self.best_zoom(request.variable, request.z)
        grid = self.level_slice(request.variable, z, request.time, request.category, request.profile)
        lat, lon = self.axis(request.variable, z, "lat"), self.axis(request.variable, z, "lon")
        pixels = tiles.sample_nearest(grid, lat, lon, self.bounds(request), self.resolution).select("row", "col", "value")
        if "streamflow" in request.variable.lower() and self.grain(request.variable, z) == 1:
            grown = tiles.thicken(pixels, self.resolution, self.resolution)
            pixels = pixels.select("row", "col").join(grown, ["row", "col"], "left")
        return pixels

    def tile_png(self, request: Request) -> bytes:
        """The tile as a palette image; transparent where values are missing, all of it outside the data."""
        known = self.images.get(request) if request.cache else None
        if known is not None:
            return known
        pixels = self.tile(request)
        coloured = tiles.colour_index(pixels, tiles.stretch(pixels, (), request.vmin, request.vmax)).toPandas()
        levels, valid = np.zeros((self.resolution,) * 2, np.uint8), np.zeros((self.resolution,) * 2, bool)
        there = coloured["level"].notna()
        at = (coloured.loc[there, "row"], coloured.loc[there, "col"])
        levels[at], valid[at] = coloured.loc[there, "level"], True
        image = palette_png(levels, valid, request.colormap)
        if request.cache:
            self.images.put(request, image)
        return image

    def save_tile(self, request: Request, path: str) -> int:
        """The image of a request to a file; its size."""
        image = self.tile_png(request)
        write_bytes(self.spark, image, path)
        return len(image)

    def pyramid_info(self, variable: str) -> DataFrame:
        """zoom, grain, rows, columns of each zoom."""
        meta = self.meta(variable)
        sizes = self.spark.read.parquet(f"{self.root}/{meta['stem']}/axes").groupBy("grain").pivot("name", ["lat", "lon"]).count()
        zooms = self.spark.createDataFrame([(z, self.grain(variable, z)) for z in meta["zooms"]], "zoom int, grain int")
        return zooms.join(sizes, "grain", "left").select("zoom", "grain", F.col("lat").alias("n_lat"), F.col("lon").alias("n_lon")).orderBy("zoom")

    def clear_cache(self) -> None:
        self.stems.clear()
        self.metas.entries.clear()
        self.images.entries.clear()

    def health(self) -> dict:
        return {"status": "ok", "cached_tiles": len(self.images.entries), "cached_pyramids": len(self.metas.entries)}


def application(engine: TileEngine, saved: str | None = None):
    """The engine as a WSGI application: /tiles, /test/save_tile, /pyramid/info, /pyramid/time, /cache/clear, /health.

    ``/test/save_tile`` writes the image of a tile (in global mode unless told otherwise) to the folder ``saved``.
    """
    from urllib.parse import parse_qs, unquote

    def answer(environ, start):
        parts = [unquote(p) for p in environ["PATH_INFO"].strip("/").split("/")]
        query = {k: v[-1] for k, v in parse_qs(environ.get("QUERY_STRING", "")).items()}
        status, kind, began = "200 OK", "application/json", clock.time()
        if "level" in query:
            warnings.warn("the parameter level is no longer used; profile names the depth", DeprecationWarning, stacklevel=2)

        def asked(parts: list[str], mode: str) -> Request:
            limits = {k: float(query[k]) for k in ("vmin", "vmax") if k in query}
            flags = {k: query[k].lower() == "true" for k in ("tms", "cache") if k in query}
            texts = {"mode": mode} | {k: query[k] for k in ("colormap", "mode") if k in query}
            return Request(parts[0], parts[1], *map(int, parts[2:]), profile=int(query.get("profile", 0)), **limits, **flags, **texts)

        try:
            if parts[0] == "tiles" and len(parts) == 7 and parts[6].endswith(".png"):
                kind = "text/plain"  # of an error
                body, kind = engine.tile_png(asked([*parts[1:6], parts[6][:-4]], "regional")), "image/png"
            elif parts[:2] == ["test", "save_tile"] and len(parts) == 8:
                kind = "text/plain"
                request = asked(parts[2:], "global")
                if engine.bounds(request).isEmpty():
                    status, body = "404 Not Found", b"the tile lies outside the data"
                else:
                    path = f"{saved or engine.root + '/saved'}/test_tile_{request.z}_{request.x}_{request.y}.png"
                    body = f"{engine.save_tile(request, path)} bytes saved to {path}".encode()
            elif parts[:2] == ["pyramid", "info"] and len(parts) == 3:
                meta = engine.meta(parts[2])
                body = json.dumps({"zooms": meta["zooms"], "data_bounds": meta["data_bounds"], "files": meta["files"], "levels": [r.asDict() for r in engine.pyramid_info(parts[2]).collect()]}).encode()
            elif parts[:2] == ["pyramid", "time"] and len(parts) == 3:
                listed = [r.time for r in engine.times(parts[2]).collect()]
                body = json.dumps({"time": listed, "count": len(listed)}).encode()
            elif parts == ["cache", "clear"]:
                engine.clear_cache()
                body = json.dumps({"status": "cleared"}).encode()
            elif parts == ["health"]:
                body = json.dumps(engine.health()).encode()
            else:
                status, body = "404 Not Found", json.dumps({"error": "no such path"}).encode()
        except Exception as error:  # a request's failure is its answer
            status = "500 Internal Server Error"
            body = str(error).encode() if kind == "text/plain" else json.dumps({"error": str(error)}).encode()
        start(status, [("Content-Type", kind), ("Access-Control-Allow-Origin", "*"), ("X-Seconds", f"{clock.time() - began:.3f}")])
        return [body]

    return answer
