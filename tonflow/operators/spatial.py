"""Points against lines as an equi-join on grid cells.

Comparing every point with every line needs the product of both tables.  Here each line
segment lists the grid cells it passes within the tolerance of, each point knows its own
cell, and only points and segments of the same cell are joined and measured exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonflow.functions import geo
from tonflow.functions.numbers import col

# --- Fixed values -----------------------------------------------------------------
LANE_TOLERANCE_M = 4.4
# --- end of fixed values ------------------------------------------------------------

METRES_PER_DEGREE = 111_194.9  # of latitude, on the sphere the distances use
CELL_DEGREES = 0.001


def cell(value: Column | str, size: float = CELL_DEGREES) -> Column:
    return F.floor(col(value) / F.lit(size))


def lane_cells(
    lanes: DataFrame,
    wkt: str,
    tolerance_m: float = LANE_TOLERANCE_M,
    max_latitude: float = 85.0,
    size: float = CELL_DEGREES,
) -> DataFrame:
    """Lanes exploded to (segment, grid cell); linear in segment length.

    A segment is cut column by column of the grid; in each column only the rows between
    the latitudes it has there, widened by the tolerance, are listed.  A lane beyond
    ``max_latitude`` is refused, as its cells would grow without bound towards the pole.
    """
    keep = [c for c in lanes.columns if c != wkt]
    segments = lanes.select(
        *keep, F.posexplode(geo.line_segments(geo.line_points(wkt))).alias("_seg", "_s")
    ).select(
        *keep,
        "_seg",
        F.col("_s.a.lat").alias("_lat_a"),
        F.col("_s.a.lon").alias("_lon_a"),
        F.col("_s.b.lat").alias("_lat_b"),
        F.col("_s.b.lon").alias("_lon_b"),
    )
    segments = segments.where(
        "_lat_a IS NOT NULL AND _lon_a IS NOT NULL AND _lat_b IS NOT NULL AND _lon_b IS NOT NULL"
    )
    pad_lat = tolerance_m * 1.01 / METRES_PER_DEGREE
    # A degree of longitude shrinks towards the poles.
    widest = F.greatest(F.abs("_lat_a"), F.abs("_lat_b")) + pad_lat
    beyond = F.raise_error(F.lit(f"lane beyond latitude {max_latitude}")).cast("double")
    pad_lon = F.when(widest <= max_latitude, F.lit(pad_lat) / F.cos(F.radians(widest))).otherwise(beyond)
    west = F.least("_lon_a", "_lon_b") - pad_lon
    east = F.greatest("_lon_a", "_lon_b") + pad_lon
    columns = segments.withColumn(
        "_cx", F.explode(F.sequence(cell(west, size), cell(east, size)))
    )
    run = F.col("_lon_b") - F.col("_lon_a")
    rise = F.col("_lat_b") - F.col("_lat_a")

    def latitude_at(lon: Column) -> Column:
        along = F.coalesce(F.try_divide(lon - F.col("_lon_a"), run), F.lit(0.0))
        return F.col("_lat_a") + rise * F.least(F.lit(1.0), F.greatest(F.lit(0.0), along))

    left, right = F.col("_cx") * size - pad_lon, (F.col("_cx") + 1) * size + pad_lon
    # A vertical segment has all its latitudes in the column.
    upright = run == 0
    low = F.when(upright, F.least("_lat_a", "_lat_b")).otherwise(
        F.least(latitude_at(left), latitude_at(right))
    )
    high = F.when(upright, F.greatest("_lat_a", "_lat_b")).otherwise(
        F.greatest(latitude_at(left), latitude_at(right))
    )
    rows = F.sequence(cell(low - pad_lat, size), cell(high + pad_lat, size))
    return columns.withColumn("_cy", F.explode(rows))


def near_lanes(
    points: DataFrame,
    cells: DataFrame,
    lat: str,
    lon: str,
    tolerance_m: float = LANE_TOLERANCE_M,
    size: float = CELL_DEGREES,
) -> DataFrame:
    """Points with every lane segment within the tolerance, and the distance in metres.

    No broadcast is forced: Spark picks one when the lane cells are measured to be small,
    and splits a crowded cell on the point side otherwise.
    """
    placed = points.withColumns({"_cx": cell(lon, size), "_cy": cell(lat, size)})
    measured = placed.join(cells, ["_cx", "_cy"]).withColumn(
        "lane_dist_m",
        geo.segment_distance_m(lat, lon, "_lat_a", "_lon_a", "_lat_b", "_lon_b"),
    )
    return measured.where(F.col("lane_dist_m") <= tolerance_m).drop(
        "_cx", "_cy", "_lat_a", "_lon_a", "_lat_b", "_lon_b"
    )


def one_lane_each(
    matches: DataFrame,
    point_columns: Sequence[str],
    lane_name: str,
    lane_columns: Sequence[str],
    pick: str = "name",
) -> DataFrame:
    """One lane per point: first by name (the established rule) or nearest by distance."""
    by = {
        "name": F.struct(F.col(lane_name), F.col("lane_dist_m")),
        "distance": F.struct(F.col("lane_dist_m"), F.col(lane_name)),
    }[pick]
    chosen = F.min_by(F.struct(*lane_columns, "lane_dist_m"), by).alias("_lane")
    return matches.groupBy(*point_columns).agg(chosen).select(*point_columns, "_lane.*")


def lane_index(cells: DataFrame, lane_columns: Sequence[str]) -> DataFrame:
    """Lane cells folded to one row per grid cell, holding the segments that pass it.

    A cell is about a hundred metres wide, so a row lists the few roads crossing there; its
    size depends on the road network, never on the number of positions.
    """
    segment = F.struct(*lane_columns, "_lat_a", "_lon_a", "_lat_b", "_lon_b")
    return cells.groupBy("_cx", "_cy").agg(F.collect_set(segment).alias("_lanes"))


def with_lane(
    points: DataFrame,
    index: DataFrame,
    lat: str,
    lon: str,
    lane_name: str,
    lane_columns: Sequence[str],
    tolerance_m: float = LANE_TOLERANCE_M,
    pick: str = "name",
    size: float = CELL_DEGREES,
) -> DataFrame:
    """Points within the tolerance of a lane, each with one lane; no grouping of points.

    The choice among several lanes happens inside the row, so positions are only shuffled
    if the index is too large to broadcast.  Works on streams (the index is static).
    """
    placed = points.withColumns({"_cx": cell(lon, size), "_cy": cell(lat, size)})

    def measured(s: Column) -> Column:
        away = geo.segment_distance_m(lat, lon, s["_lat_a"], s["_lon_a"], s["_lat_b"], s["_lon_b"])
        named, far = s[lane_name].alias("_named"), away.alias("lane_dist_m")
        rest = [s[c].alias(c) for c in lane_columns]
        return F.struct(named, far, *rest) if pick == "name" else F.struct(far, named, *rest)

    def within_box(s: Column) -> Column:
        """Cheap test in degrees; leaves few segments to measure."""
        y, x, pad = col(lat), col(lon), F.col("_pad")
        north = (y >= F.least(s["_lat_a"], s["_lat_b"]) - pad) & (
            y <= F.greatest(s["_lat_a"], s["_lat_b"]) + pad
        )
        east = (x >= F.least(s["_lon_a"], s["_lon_b"]) - pad) & (
            x <= F.greatest(s["_lon_a"], s["_lon_b"]) + pad
        )
        return north & east

    # One margin for both directions: that of longitude, the larger one.
    furthest = F.least(F.abs(col(lat)) + 0.01, F.lit(89.0))
    pad = F.lit(tolerance_m * 1.02 / METRES_PER_DEGREE) / F.cos(F.radians(furthest))
    candidates = F.filter(
        F.transform(F.filter("_lanes", within_box), measured),
        lambda s: s["lane_dist_m"] <= tolerance_m,
    )
    return (
        placed.join(index, ["_cx", "_cy"])
        .withColumn("_pad", pad)
        .withColumn("_lane", F.array_min(candidates))
        .where("_lane IS NOT NULL")
        .select(*points.columns, *[F.col(f"_lane.{c}").alias(c) for c in lane_columns],
                F.col("_lane.lane_dist_m").alias("lane_dist_m"))
    )
