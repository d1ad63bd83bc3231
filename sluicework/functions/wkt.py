"""Geometry as text: WKT and GeoJSON to a nested struct and back.

A geometry is ``struct<kind, srid, parts: array<array<array<struct<x, y>>>>>``: polygons (or one
group) of rings (or lines) of positions. Positions stay text, so that every digit survives.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITION = "struct<x:string,y:string>"
PARTS = f"array<array<array<{POSITION}>>>"

# GeoJSON type names and their WKT keywords.
GEOJSON_KINDS = {
    "Point": "POINT",
    "MultiPoint": "MULTIPOINT",
    "LineString": "LINESTRING",
    "MultiLineString": "MULTILINESTRING",
    "Polygon": "POLYGON",
    "MultiPolygon": "MULTIPOLYGON",
}


def position(x: Column, y: Column) -> Column:
    return F.concat(x.cast("string"), F.lit(" "), y.cast("string"))


def point_wkt(text: Column) -> Column:
    return F.concat(F.lit("POINT ("), text, F.lit(")"))


def line_wkt(positions: Column) -> Column:
    """One line of position texts; fewer than two positions give the empty text."""
    return F.when(
        F.size(positions) > 1,
        F.concat(F.lit("LINESTRING "), _bracketed(positions)),
    ).otherwise(F.lit(""))


def track_wkt(segments: Column) -> Column:
    """Several lines of position texts. Segments with fewer than two positions are dropped."""
    lines = F.transform(F.filter(segments, lambda s: F.size(s) > 1), _bracketed)
    return (
        F.when(F.size(lines) > 1,
               F.concat(F.lit("MULTILINESTRING ("), F.array_join(lines, ", "), F.lit(")")))
        .when(F.size(lines) == 1, F.concat(F.lit("LINESTRING "), F.element_at(lines, 1)))
        .otherwise(F.lit(""))
    )


def _bracketed(positions: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(positions, ", "), F.lit(")"))


def parse_wkt(text: Column, srid: int = 4326, strict: bool = True) -> Column:
    """WKT to the nested struct. Empty text and ``… EMPTY`` have no parts; NULL stays NULL.

    Anything else that is not two-dimensional WKT of a known kind is an error, or NULL if not
    ``strict``.
    """
    kind = F.upper(F.regexp_extract(text, r"^\s*([A-Za-z]+)", 1))
    body = F.regexp_extract(text, r"(?s)\((.*)\)", 1)
    groups = F.when(
        kind == "MULTIPOLYGON", F.split(body, r"\)\s*\)\s*,\s*\(\s*\(")
    ).otherwise(F.array(body))
    rings = F.transform(groups, lambda g: F.split(g, r"\)\s*,\s*\("))
    parts = F.transform(rings, lambda rs: F.transform(rs, _positions))
    empty = F.array().cast(PARTS)
    bare = F.trim(text) == ""
    none = bare | text.rlike(rf"(?i)^\s*({_KINDS})\s+EMPTY\s*$")
    geometry = F.struct(
        kind.alias("kind"), F.lit(srid).alias("srid"), F.when(none, empty).otherwise(parts).alias("parts"))
    wrong = F.lit(None) if not strict else F.raise_error(F.concat(F.lit("not WKT: "), F.left(text, F.lit(80))))
    return F.when(
        text.isNotNull(),
        F.when(none | _well_formed(text, kind, parts), geometry).otherwise(wrong.cast(geometry_type())),
    )


def geometry_type() -> str:
    return f"struct<kind:string,srid:int,parts:{PARTS}>"


_KINDS = "|".join(GEOJSON_KINDS.values())
NUMBER = r"[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?"


def _well_formed(text: Column, kind: Column, parts: Column) -> Column:
    """Whether the brackets nest as the kind asks and every position is two numbers."""
    # Positions become p, lists of what is alike become one letter, from the inside out
    shape = F.regexp_replace(F.regexp_replace(text, r"(?i)^\s*[A-Z]+", ""), r"\s", "")
    shape = F.regexp_replace(shape, r"[^(),]+", "p")
    for inner, outer in (("p", "r"), ("r", "t"), ("t", "v")):
        shape = F.regexp_replace(shape, rf"\({inner}[{inner},]*+\)", outer)
    fits = (
        F.when(kind.isin("POINT", "LINESTRING"), shape == "r")
        .when(kind == "MULTIPOINT", shape.isin("r", "t"))
        .when(kind.isin("POLYGON", "MULTILINESTRING"), shape == "t")
        .otherwise((kind == "MULTIPOLYGON") & (shape == "v"))
    )
    positions = F.flatten(F.flatten(parts))
    pairs = F.forall(positions, lambda p: F.coalesce(p["x"].rlike(f"^{NUMBER}$") & p["y"].rlike(f"^{NUMBER}$"), F.lit(False)))
    return fits & pairs & ((kind != "POINT") | (F.size(positions) == 1))


def _positions(ring: Column) -> Column:
    bare = F.trim(F.regexp_replace(ring, r"[()]", " "))
    return F.transform(F.split(bare, r"\s*,\s*"), _xy)


def _xy(text: Column) -> Column:
    # A third coordinate stays with the second, where it is no number
    halves = F.split(F.trim(text), r"\s+", 2)
    return F.struct(F.get(halves, 0).alias("x"), F.get(halves, 1).alias("y"))


def to_wkt(geometry: Column) -> Column:
    """The inverse of ``parse_wkt``."""
    kind, parts = geometry["kind"], geometry["parts"]
    rings = F.transform(parts, lambda g: F.array_join(F.transform(g, _ring_text), ", "))
    flat = F.array_join(rings, ", ")
    grouped = F.array_join(
        F.transform(rings, lambda g: F.concat(F.lit("("), g, F.lit(")"))), ", "
    )
    points = _ring_text(F.flatten(F.flatten(parts)))
    body = F.when(kind == "MULTIPOINT", points).when(kind.isin("POINT", "LINESTRING"), flat).otherwise(
        F.concat(F.lit("("), F.when(kind == "MULTIPOLYGON", grouped).otherwise(flat), F.lit(")"))
    )
    return F.when(
        F.size(parts) == 0,
        F.when(kind == "", F.lit("")).otherwise(F.concat(kind, F.lit(" EMPTY"))),
    ).otherwise(F.concat(kind, F.lit(" "), body))


def _ring_text(ring: Column) -> Column:
    return _bracketed(F.transform(ring, lambda p: F.concat(p["x"], F.lit(" "), p["y"])))


def point_count(geometry: Column) -> Column:
    return F.size(F.flatten(F.flatten(geometry["parts"])))


def is_empty(geometry: Column) -> Column:
    return geometry.isNull() | (point_count(geometry) == 0)


def parse_geojson(text: Column, srid: int = 4326) -> Column:
    """A GeoJSON geometry to the nested struct; its depth depends on its type."""
    name = F.get_json_object(text, "$.type")
    coordinates = F.get_json_object(text, "$.coordinates")

    def nested(depth: int) -> Column:
        kind = "string"
        for _ in range(depth):
            kind = f"array<{kind}>"
        return F.from_json(coordinates, kind, {"mode": "FAILFAST"})

    def xy(pair: Column) -> Column:
        return F.struct(F.get(pair, 0).alias("x"), F.get(pair, 1).alias("y"))

    def line(pairs: Column) -> Column:
        return F.transform(pairs, xy)

    def lines(rings: Column) -> Column:
        return F.transform(rings, line)

    kind = F.lit(None).cast("string")
    for json_name, keyword in GEOJSON_KINDS.items():
        kind = F.when(name == json_name, F.lit(keyword)).otherwise(kind)
    unknown = F.concat(F.lit("unknown geometry type: "), F.coalesce(name, F.lit("none")))
    parts = (
        F.when(name == "Point", F.array(F.array(F.array(xy(nested(1))))))
        .when(name.isin("LineString", "MultiPoint"), F.array(F.array(line(nested(2)))))
        .when(name.isin("Polygon", "MultiLineString"), F.array(lines(nested(3))))
        .when(name == "MultiPolygon", F.transform(nested(4), lines))
        .otherwise(F.raise_error(unknown).cast(PARTS))
    )
    return F.when(
        text.isNotNull(),
        F.struct(kind.alias("kind"), F.lit(srid).alias("srid"), parts.alias("parts")),
    )
