"""Geometry on plain columns: distances, well-known text, headings, GeoJSON.

Everything compiles to Catalyst expressions; no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonflow.functions.codes import cases
from tonflow.functions.numbers import col

# --- Fixed values -----------------------------------------------------------------
EARTH_RADIUS_M = 6_371_000.0
KNOTS_TO_MS = 1.852 * (1000.0 / 3600.0)
NORTHBOUND = "utara"
SOUTHBOUND = "selatan"
# --- end of fixed values ------------------------------------------------------------


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres."""
    lat1, lon1, lat2, lon2 = map(col, (lat1, lon1, lat2, lon2))
    rise = F.sin(F.radians(lat2 - lat1) / 2)
    run = F.sin(F.radians(lon2 - lon1) / 2)
    chord = rise * rise + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * run * run
    return 2.0 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def segment_distance_m(lat, lon, lat_a, lon_a, lat_b, lon_b) -> Column:
    """Distance from a point to a segment: foot found in degrees, measured in metres."""
    lat, lon, lat_a, lon_a, lat_b, lon_b = map(col, (lat, lon, lat_a, lon_a, lat_b, lon_b))
    dy, dx = lat_b - lat_a, lon_b - lon_a
    squared = dx * dx + dy * dy
    along = F.coalesce(
        F.try_divide((lon - lon_a) * dx + (lat - lat_a) * dy, squared), F.lit(0.0)
    )
    along = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    return haversine_m(lat, lon, lat_a + along * dy, lon_a + along * dx)


def line_points(wkt: Column | str) -> Column:
    """``LINESTRING (lon lat, ...)`` as an array of (lat, lon); NULL without brackets."""
    inside = F.regexp_extract(col(wkt), r"(?s)\((.*)\)", 1)
    pairs = F.split(F.when(inside != "", inside), ",")

    def point(pair: Column) -> Column:
        numbers = F.split(F.trim(pair), r"\s+")
        return F.struct(
            F.get(numbers, F.lit(1)).try_cast("double").alias("lat"),
            F.get(numbers, F.lit(0)).try_cast("double").alias("lon"),
        )

    return F.transform(pairs, point)


def line_segments(points: Column | str) -> Column:
    """Consecutive points as (a, b); a one-point line is one segment of no length."""
    points = col(points)
    last = F.greatest(F.size(points) - 1, F.lit(1))
    return F.transform(
        F.slice(points, F.lit(1), last),
        lambda p, i: F.struct(p.alias("a"), F.coalesce(F.get(points, i + 1), p).alias("b")),
    )


def line_distance_m(lat, lon, wkt: Column | str) -> Column:
    """Distance in metres from a point to the nearest part of a line; NULL if unusable."""
    lat, lon = col(lat), col(lon)
    return F.array_min(
        F.transform(
            line_segments(line_points(wkt)),
            lambda s: segment_distance_m(
                lat, lon, s["a"]["lat"], s["a"]["lon"], s["b"]["lat"], s["b"]["lon"]
            ),
        )
    )


def polygon_text(*parts) -> Column:
    """Polygon text whose coordinates an import spread over several columns."""
    first, *rest = map(col, parts)
    tail = [F.coalesce(p.cast("string"), F.lit("")) for p in rest]
    return F.concat(first, *tail, F.lit("))"))


def polygon_ring(wkt: Column | str) -> Column:
    """``POLYGON ((lat lon, ...))`` as a closed ring of ``[lon, lat]``.

    Blanks and commas both separate numbers.  NULL for fewer than three points or when any
    entry is not a number.
    """
    inner = F.regexp_replace(F.regexp_replace(col(wkt), r"^\s*POLYGON\s*\(\(", ""), r"\)\)", "")
    words = F.filter(F.split(F.trim(inner), r"[\s,]+"), lambda w: w != "")
    numbers = F.transform(words, lambda w: w.try_cast("double"))
    n = F.floor(F.size(numbers) / 2).cast("int")
    ring = F.when(
        n > 2,
        F.transform(
            F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
            lambda i: F.array(F.get(numbers, i * 2 + 1), F.get(numbers, i * 2)),
        ),
    )
    closed = F.when(F.get(ring, F.lit(0)) == F.element_at(ring, -1), ring).otherwise(
        F.concat(ring, F.slice(ring, 1, 1))
    )
    return F.when(~F.exists(ring, lambda p: p[0].isNull() | p[1].isNull()), closed)


def polygon_feature(ring: Column | str, **properties) -> Column:
    """One GeoJSON Feature as JSON text."""
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(col(ring)).alias("coordinates"))
    props = F.struct(*[col(v).alias(k) for k, v in properties.items()])
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"), props.alias("properties"), geometry.alias("geometry")
        )
    )


def heading_group(course: Column | str) -> Column:
    """North- or southbound by compass course; NULL outside 0 to 360.

    Due east (90) and due west (270) count as northbound.
    """
    c = col(course)
    return F.when(c.between(0, 90) | c.between(270, 360), NORTHBOUND).when(
        c.between(90, 270), SOUTHBOUND
    )


def travel_order(course, lat, lon) -> tuple[Column, Column]:
    """Sort keys that put vehicles on one road in driving order, rearmost first.

    Along an axis the first key is the coordinate that grows ahead; in between, latitude
    signed by heading, then longitude signed by heading.
    """
    c, lat, lon = map(col, (course, lat, lon))
    first = cases(
        [
            (c == 90, lon),
            (c == 270, -lon),
            (c.between(90, 270), -lat),
            (c.between(0, 360), lat),
        ]
    )
    second = cases([(c.between(0, 180), lon), (c.between(180, 360), -lon)])
    return first, second


def seconds_to_contact(gap_m, speed_behind, speed_ahead) -> Column:
    """Time until the follower reaches the leader (speeds in knots); NULL unless it gains."""
    closing = col(speed_behind) - col(speed_ahead)
    return F.when(closing > 0, F.round(F.try_divide(col(gap_m), closing * KNOTS_TO_MS), 0))
