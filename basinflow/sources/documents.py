"""JSON documents: pyramid metadata, the run index and zones."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

META_SCHEMA = (
    "stem string, zooms array<int>, dtype string, files string, grain_map map<string,int>, "
    "data_bounds struct<lon_min:double,lon_max:double,lat_min:double,lat_max:double>, "
    "time_len int, category_len int, profile_dim string, profile_length int"
)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    """Metadata documents; ``files`` stays text, an object or a plain name."""
    return read_json(spark, path, META_SCHEMA)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """initialization_date of the run index; no rows if the file is missing."""
    try:
        return read_json(spark, path, "initialization_date string").where("initialization_date IS NOT NULL")
    except AnalysisException:
        return spark.createDataFrame([], "initialization_date string")


def bundle_name(zoom: int, files: Column | str = "files") -> Column:
    """The bundle of a zoom: by zoom where ``files`` is an object, else its one name; NULL if the object lacks the zoom."""
    column = F.col(files) if isinstance(files, str) else files
    of_zoom = F.get_json_object(column, f"$['{int(zoom)}']")
    return F.when(F.startswith(F.trim(column), F.lit("{")), of_zoom).otherwise(column)


def zoom_grain(meta: DataFrame) -> DataFrame:
    """stem, zoom, grain of each entry of the metadata's map."""
    return meta.select("stem", F.explode("grain_map").alias("zoom", "grain")).withColumn("zoom", F.col("zoom").cast("int"))


def read_zones(spark: SparkSession, path: str, zone: str = "PFAF_ID") -> DataFrame:
    """pfaf_id and ring (array of x, y) of every polygon of a GeoJSON file; each part of a multi-polygon is a row.

    Outer rings and holes are rows alike: parity of crossings treats holes as outside.
    """
    schema = f"features array<struct<properties: struct<{zone}: bigint>, geometry: struct<type: string, coordinates: string>>>"
    features = read_json(spark, path, schema).select(F.explode("features").alias("f"))
    kind = F.col("f.geometry.type")
    polygon = F.from_json(F.when(kind == "Polygon", F.col("f.geometry.coordinates")), "array<array<array<double>>>")
    several = F.from_json(F.when(kind == "MultiPolygon", F.col("f.geometry.coordinates")), "array<array<array<array<double>>>>")
    rings = F.when(kind == "Polygon", polygon).otherwise(F.flatten(several))
    points = lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return features.select(F.col(f"f.properties.{zone}").cast("int").alias("pfaf_id"), F.explode(rings).alias("r")).select("pfaf_id", points("r").alias("ring"))


def meta_document(stem: str, zooms: list[int], grains: dict[int, int], bounds: dict[str, float], times: int, categories: int, profile: str | None = None, levels: int | None = None) -> str:
    """The metadata of a pyramid as JSON text."""
    document = {
        "stem": stem, "zooms": sorted(zooms), "dtype": "float32", "files": f"{stem}_pyramid.npz",
        "grain_map": {str(z): int(grains[z]) for z in sorted(zooms)}, "data_bounds": bounds,
        "time_len": times, "category_len": categories, "profile_dim": profile,
    }
    if profile is not None:
        document["profile_length"] = levels
    return json.dumps(document, indent=2)
