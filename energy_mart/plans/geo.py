"""Zones: WKT text to vertex rows, boxes and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from energy_mart.functions.geo import SRID, with_lon_lat
from energy_mart.functions.text import zone_label
from energy_mart.operators import quality
from energy_mart.session import materialise, spread

PART_BREAK = r"\)\s*\)\s*,\s*\(\s*\("
RING_BREAK = r"\)\s*,\s*\("
RING_BODY = r"([-+0-9.eE,\s]+)[)\s]*$"


_NUMBER = r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:E[-+]?[0-9]+)?"
# What is left of a well-formed text when points, then rings, then polygons are each written as one letter.
_SHAPES = ("POINTr", "POLYGONs", "MULTIPOLYGON(s)")


def _shape(wkt: Column) -> Column:
    """The text with its points, rings and polygons folded into letters, in passes that are linear in its length."""
    out = F.regexp_replace(F.upper(F.trim(wkt)), rf"{_NUMBER}\s+{_NUMBER}(?=\s*[,)])", "p")
    out = F.regexp_replace(F.regexp_replace(out, r"\s+", ""), "(?<=p),p", "")
    out = F.regexp_replace(F.regexp_replace(out, r"\(p\)", "r"), "(?<=r),r", "")
    return F.regexp_replace(F.regexp_replace(out, r"\(r\)", "s"), "(?<=s),s", "")


def zone_reason(wkt: Column) -> Column:
    """Why a geometry text cannot be read: the first rule that it breaks, null if none. Later rules are not looked at."""
    shape, point = _shape(wkt), F.upper(F.trim(wkt)).startswith("POINT")
    rings = F.transform(F.regexp_extract_all(wkt, F.lit(r"\(([^()]*)\)"), F.lit(1)), lambda r: F.split(r, ","))
    pair = lambda p: F.transform(F.split(F.trim(p), r"\s+"), lambda n: n.try_cast("double"))
    opened = F.exists(rings, lambda r: pair(F.element_at(r, 1)) != pair(F.element_at(r, -1)))
    few = F.exists(rings, lambda r: F.size(r) < 4)
    # A point has one pair of numbers.
    return (
        F.when(wkt.isNull(), "no geometry")
        .when(~shape.isin(*_SHAPES) | (point & wkt.contains(",")), "not a geometry")
        .when(~point & opened, "a ring that is not closed")
        .when(~point & few, "a ring of fewer than four points")
    )


def split_zones(zones: DataFrame, wkt: str = "coordenadas") -> tuple[DataFrame, DataFrame]:
    """(zones whose whole geometry can be read, the others with their reasons).

    Judging a text takes many passes over it, so rows are dealt over all tasks first, as a small file is one
    task otherwise, and judged once: the reasons are settled, and both sides read them.
    """
    reasons = F.array_compact(F.array(zone_reason(F.col(wkt))))
    marked = materialise(spread(zones).withColumn(quality.REASONS, reasons))
    good = F.size(quality.REASONS) == 0
    return marked.filter(good).drop(quality.REASONS), marked.filter(~good)


def zone_vertices(zones: DataFrame, key: str = "id_objecto", wkt: str = "coordenadas") -> DataFrame:
    """Rows (key, part, ring, vertex, x, y, lon, lat), all counted from 0.

    Of the zones that ``split_zones`` accepts: a zone comes with all its points or not at all.
    """
    parts = split_zones(zones, wkt)[0].select(
        key, F.posexplode(F.split(wkt, PART_BREAK)).alias("part", "part_text")
    )
    rings = parts.select(
        key, "part", F.posexplode(F.split("part_text", RING_BREAK)).alias("ring", "ring_text")
    )
    body = F.trim(F.regexp_extract("ring_text", RING_BODY, 1))
    points = rings.select(
        key, "part", "ring", F.posexplode(F.split(body, r"\s*,\s*")).alias("vertex", "point")
    )
    pair = F.split(F.trim("point"), r"\s+")
    placed = points.select(
        key, "part", "ring", "vertex",
        F.try_element_at(pair, F.lit(1)).try_cast("double").alias("x"),
        F.try_element_at(pair, F.lit(2)).try_cast("double").alias("y"),
    ).filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    return with_lon_lat(placed, "x", "y", "lon", "lat")


def zone_boxes(zones: DataFrame, key: str = "id_objecto", wkt: str = "coordenadas") -> DataFrame:
    """Rows (key, vertices, parts, lon_min, lon_max, lat_min, lat_max)."""
    return zone_vertices(zones, key, wkt).groupBy(key).agg(
        F.count(F.lit(1)).alias("vertices"),
        (F.max("part") + 1).alias("parts"),
        F.min("lon").alias("lon_min"),
        F.max("lon").alias("lon_max"),
        F.min("lat").alias("lat_min"),
        F.max("lat").alias("lat_max"),
    )


def zone_records(zones: DataFrame) -> DataFrame:
    """What a map shows for each zone: operator, zone text, description, rounded area."""
    srid = F.col("srid") if "srid" in zones.columns else F.lit(None).cast("int")
    return zones.select(
        "id_objecto",
        "operador",
        zone_label(F.col("operador")).alias("zona"),
        "descripcion",
        F.round(F.col("area").cast("double"), 2).alias("area"),
        F.coalesce(srid, F.lit(SRID)).alias("srid"),
    )
