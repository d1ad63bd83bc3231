"""GPX and GeoJSON documents as rows of geometries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.functions import wkt

# Positions are read as text, so that every digit of the file survives
POINT = "STRUCT<_lat: STRING, _lon: STRING>"
GPX = f"""
    trk ARRAY<STRUCT<name: STRING, trkseg: ARRAY<STRUCT<trkpt: ARRAY<{POINT}>>>>>,
    rte ARRAY<STRUCT<name: STRING, rtept: ARRAY<{POINT}>>>,
    wpt ARRAY<STRUCT<_lat: STRING, _lon: STRING, name: STRING>>
"""
FEATURES = "features ARRAY<STRUCT<properties: MAP<STRING, STRING>, geometry: STRING>>"


def read_documents(spark: SparkSession, pattern: str, charset: str = "UTF-8") -> DataFrame:
    """Whole text files: (file, text), without a byte order mark."""
    raw = spark.read.format("binaryFile").load(pattern)
    return raw.select(
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.regexp_replace(F.decode("content", charset), "^\ufeff", "").alias("text"),
    )


def read_gpx(spark: SparkSession, pattern: str, charset: str = "UTF-8") -> DataFrame:
    """Tracks, routes and waypoints of GPX files in any namespace: (file, type, name, wkt).

    Lines with fewer than two positions are no lines: a track or route without any has empty text.
    """
    options = {"ignoreNamespace": "true", "mode": "FAILFAST"}
    parsed = read_documents(spark, pattern, charset).select(
        "file", F.from_xml("text", GPX, options).alias("gpx")
    )

    def text(point: Column) -> Column:
        return wkt.position(point["_lon"], point["_lat"])

    def texts(points: Column) -> Column:
        return F.transform(F.coalesce(points, F.array().cast(f"ARRAY<{POINT}>")), text)

    def row(kind: str, name: Column, geometry: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), name.alias("name"), geometry.alias("wkt"))

    segment = f"ARRAY<STRUCT<trkpt: ARRAY<{POINT}>>>"
    tracks = F.transform("gpx.trk", lambda t: row("Track", t["name"], wkt.track_wkt(
        F.transform(F.coalesce(t["trkseg"], F.array().cast(segment)), lambda s: texts(s["trkpt"])))))
    routes = F.transform("gpx.rte", lambda r: row("Route", r["name"], wkt.line_wkt(texts(r["rtept"]))))
    waypoints = F.transform("gpx.wpt", lambda w: row("Waypoint", w["name"], wkt.point_wkt(text(w))))
    kind = "ARRAY<STRUCT<type: STRING, name: STRING, wkt: STRING>>"
    none = F.array().cast(kind)
    rows = F.concat(*[F.coalesce(c.cast(kind), none) for c in (tracks, routes, waypoints)])
    return parsed.select("file", F.inline(rows))


def read_geojson(spark: SparkSession, pattern: str, **properties: str) -> DataFrame:
    """Features of FeatureCollections: (file, one column per asked property, geometry as JSON).

    ``properties`` maps a column to the property it takes: ``iso="ISO3166-1-Alpha-3"``.
    """
    asked = properties or {"name": "name"}
    features = read_documents(spark, pattern).select(
        "file", F.inline(F.from_json("text", FEATURES, {"mode": "FAILFAST"})["features"])
    )
    return features.select(
        "file", *[F.col("properties")[p].alias(c) for c, p in asked.items()], "geometry"
    )
