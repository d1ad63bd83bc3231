"""Geometry text made from the embeddings: every two numbers are one position."""

from pyspark.sql import functions as F

from sluicework.functions import text, wkt
from sluicework.plans.registry import query

KINDS = 6


def shaped(t):
    """Embeddings as lists of position texts, whole and in two halves."""
    def number(i):
        return F.floor(F.element_at("embedding", i).cast("double") * 1000)

    pairs = F.sequence(F.lit(1), F.size("embedding"), F.lit(2))
    positions = F.transform(pairs, lambda i: wkt.position(number(i), number(i + 1)))
    half = F.floor(F.size("positions") / 2).cast("int")
    return t.embeddings.select("vec_id", "label", positions.alias("positions")).select(
        "vec_id",
        F.pmod("label", F.lit(KINDS)).alias("kind"),
        "positions",
        F.array(
            F.slice("positions", F.lit(1), half),
            F.slice("positions", half + 1, F.size("positions")),
        ).alias("halves"),
    )


def as_wkt(t):
    positions, halves = F.col("positions"), F.col("halves")
    first = F.element_at(positions, 1)
    rings = F.concat_ws(", ", F.transform(halves, lambda h: F.concat(F.lit("("), F.array_join(h, ", "), F.lit(")"))))
    return shaped(t).select(
        "vec_id",
        F.when(F.col("kind") == 0, wkt.point_wkt(first))
        .when(F.col("kind") == 1, wkt.line_wkt(positions))
        .when(F.col("kind") == 2, wkt.track_wkt(halves))
        .when(F.col("kind") == 3, wkt.track_wkt(F.array(F.array(first), positions)))
        .when(F.col("kind") == 4, F.concat(F.lit("MULTIPOLYGON ((("), F.array_join(positions, ", "),
                                           F.lit(")), ("), rings, F.lit("))")))
        .otherwise(wkt.track_wkt(F.array(F.array(first)))).alias("wkt"),
    )


POSITIONS = """p AS (
    SELECT vec_id, label % 6 AS kind, n, i,
           CAST(floor(CAST(embedding[2 * i + 1] AS DOUBLE) * 1000) AS BIGINT) || ' ' ||
           CAST(floor(CAST(embedding[2 * i + 2] AS DOUBLE) * 1000) AS BIGINT) AS xy
    FROM (SELECT *, len(embedding) // 2 AS n, unnest(range(len(embedding) // 2)) AS i FROM embeddings)),
  s AS (
    SELECT vec_id, kind, max(n) AS n, string_agg(xy, ', ' ORDER BY i) AS pts,
           string_agg(xy, ', ' ORDER BY i) FILTER (WHERE i < n // 2) AS a,
           string_agg(xy, ', ' ORDER BY i) FILTER (WHERE i >= n // 2) AS b,
           max(xy) FILTER (WHERE i = 0) AS first
    FROM p GROUP BY vec_id, kind),
  w AS (
    SELECT vec_id, kind, n,
           CASE kind WHEN 0 THEN 'POINT (' || first || ')'
                     WHEN 1 THEN 'LINESTRING (' || pts || ')'
                     WHEN 2 THEN 'MULTILINESTRING ((' || a || '), (' || b || '))'
                     WHEN 3 THEN 'LINESTRING (' || pts || ')'
                     WHEN 4 THEN 'MULTIPOLYGON (((' || pts || ')), ((' || a || '), (' || b || ')))'
                     ELSE '' END AS wkt
    FROM s)"""
COUNT = "CASE kind WHEN 0 THEN 1 WHEN 4 THEN 2 * n WHEN 5 THEN 0 ELSE n END"


@query("wkt_build", f"WITH {POSITIONS} SELECT vec_id, wkt FROM w")
def wkt_build(t):
    return as_wkt(t)


@query(
    "wkt_parse",
    f"""WITH {POSITIONS}
        SELECT vec_id, CASE kind WHEN 0 THEN 'POINT' WHEN 2 THEN 'MULTILINESTRING'
                                 WHEN 4 THEN 'MULTIPOLYGON' WHEN 5 THEN '' ELSE 'LINESTRING' END AS kind,
               4326 AS srid, CASE kind WHEN 4 THEN 2 WHEN 5 THEN 0 ELSE 1 END AS n_groups,
               wkt AS text_again
        FROM w""",
)
def wkt_parse(t):
    parsed = as_wkt(t).select("vec_id", wkt.parse_wkt(F.col("wkt")).alias("g"))
    return parsed.select(
        "vec_id", F.col("g.kind").alias("kind"), F.col("g.srid").alias("srid"),
        F.size("g.parts").alias("n_groups"), wkt.to_wkt(F.col("g")).alias("text_again"),
    )


@query(
    "wkt_points",
    f"""WITH {POSITIONS}
        SELECT vec_id, CAST({COUNT} AS INTEGER) AS n_points,
               CAST(CASE WHEN wkt = '' THEN 0 ELSE length(wkt) - length(replace(wkt, ',', '')) + 1 END
                    AS INTEGER) AS n_in_text,
               {COUNT} = 0 AS empty
        FROM w""",
)
def wkt_points(t):
    """Parsed points against the commas of the text, and which geometries are empty."""
    parsed = as_wkt(t).withColumn("g", wkt.parse_wkt(F.col("wkt")))
    return parsed.select(
        "vec_id", wkt.point_count(F.col("g")).alias("n_points"),
        F.when(F.col("wkt") == "", 0).otherwise(text.occurrences(F.col("wkt"), ",") + 1).alias("n_in_text"),
        wkt.is_empty(F.col("g")).alias("empty"),
    )


@query(
    "geojson_points",
    """SELECT vec_id, 'MULTIPOINT (' || vec_id || ' ' || label || ', ' || label || ' ' || vec_id || ')' AS wkt,
              2 AS n_points FROM embeddings""",
)
def geojson_points(t):
    """GeoJSON geometries as text and by their points, read back from that text."""
    first, second = F.col("vec_id").cast("string"), F.col("label").cast("string")
    coordinates = F.concat(F.lit("[["), first, F.lit(", "), second, F.lit("], ["), second, F.lit(", "), first, F.lit("]]"))
    text = F.concat(F.lit('{"type": "MultiPoint", "coordinates": '), coordinates, F.lit("}"))
    written = t.embeddings.select("vec_id", wkt.to_wkt(wkt.parse_geojson(text)).alias("wkt"))
    return written.withColumn("n_points", wkt.point_count(wkt.parse_wkt(F.col("wkt"))))
