"""Vehicle positions: lanes, spacing between trucks, latest positions, geofences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonflow.functions import codes, geo, numbers, text, times
from tonflow.operators import spatial
from tonflow.operators.ordered import previous_row, running_total
from tonflow.operators.windows import first_per_key, top_per_key
from tonflow.sources.session import cut_lineage

# --- Fixed values -----------------------------------------------------------------
PAIR_WINDOW = "5 seconds"
ROLLUP_WINDOW = "5 minutes"
SAME_LANE, OTHER_LANE = "Sejalur", "Beda Jalur"
LANE_COLUMNS = ("lane_id", "jalur", "jalur_arah")
EXPECTATIONS = {
    "paired_trucks_present": "truk IS NOT NULL AND truk_depan IS NOT NULL",
    "non_negative_jarak": "jarak IS NULL OR jarak >= 0",
}
# --- end of fixed values ------------------------------------------------------------

#: Stretch of road within which trucks are put in order at once: about 110 m.
CELL_DEGREES = 0.001

POSITION_COLUMNS = (
    "id", "deviceid", "truk", "devicetime", "latitude", "longitude", "speed", "course",
    "grup_arah", "geofenceids",
)


def lane_table(lanes: DataFrame) -> DataFrame:
    return lanes.select(
        F.col("id").cast("string").alias("lane_id"),
        F.col("nama_jalur").alias("jalur"),
        F.col("arah").cast("string").alias("jalur_arah"),
        "koordinat_jalur",
    )


def lane_lookup(lanes: DataFrame, tolerance_m: float = spatial.LANE_TOLERANCE_M) -> DataFrame:
    """Grid index of the lanes, ready for :func:`located_positions`."""
    cells = spatial.lane_cells(lane_table(lanes), "koordinat_jalur", tolerance_m)
    return spatial.lane_index(cells, LANE_COLUMNS)


def typed_positions(raw: DataFrame) -> DataFrame:
    types = {
        "id": "long", "deviceid": "long", "devicetime": "timestamp", "latitude": "double",
        "longitude": "double", "speed": "double", "course": "double",
    }
    return raw.select(
        *[F.col(c).try_cast(t).alias(c) for c, t in types.items()], "geofenceids", "valid"
    )


def valid_positions(positions: DataFrame) -> DataFrame:
    return positions.where(
        (F.col("valid") == 1)
        & F.col("latitude").between(-90.0, 90.0)
        & F.col("longitude").between(-180.0, 180.0)
    )


def named_positions(positions: DataFrame, devices: DataFrame) -> DataFrame:
    """Truck name from the device list, else the device number; heading group."""
    known = devices.select(F.col("id").cast("long").alias("deviceid"), F.col("name").alias("_name"))
    return positions.join(known, "deviceid", "left").select(
        "id", "deviceid",
        F.coalesce("_name", F.col("deviceid").cast("string")).alias("truk"),
        "devicetime", "latitude", "longitude", "speed", "course",
        geo.heading_group("course").alias("grup_arah"),
        "geofenceids",
    )


def located_positions(
    positions: DataFrame,
    devices: DataFrame,
    lane_idx: DataFrame,
    tolerance_m: float = spatial.LANE_TOLERANCE_M,
    pick: str = "name",
) -> DataFrame:
    """Valid positions on a lane, with truck, heading and lane.  Stateless."""
    named = named_positions(valid_positions(positions), devices)
    return spatial.with_lane(
        named, lane_idx, "latitude", "longitude", "jalur", LANE_COLUMNS, tolerance_m, pick
    )


def driving_order(positions: DataFrame) -> DataFrame:
    first, second = geo.travel_order("course", "latitude", "longitude")
    return positions.withColumns({"sort_key_1": first, "sort_key_2": second})


def road_cell(degrees: float = CELL_DEGREES) -> Column:
    """Number of a stretch of road; grows along the driving order (without a place: the first)."""
    return F.coalesce(F.floor(F.col("sort_key_1") / F.lit(degrees)), F.lit(-(2**40)))


TRUCK_FIELDS = (
    "sort_key_1", "sort_key_2", "truk", "id", "speed", "latitude", "longitude",
    "devicetime", "grup_arah", "geofenceids", "jalur",
)


def pair_columns(behind: str = "behind", ahead: str = "ahead") -> list[Column]:
    """What is reported of two trucks that follow each other."""
    b, a = (lambda f: F.col(f"{behind}.{f}")), (lambda f: F.col(f"{ahead}.{f}"))
    return [
        b("truk").alias("truk"),
        a("truk").alias("truk_depan"),
        F.when(b("jalur") != a("jalur"), OTHER_LANE).otherwise(SAME_LANE).alias("sejalur"),
        b("jalur").alias("jalur"),
        a("jalur").alias("jalur2"),
        F.round("_gap", 0).alias("jarak"),
        geo.seconds_to_contact("_gap", b("speed"), a("speed")).alias("jarak_waktu"),
        F.round(b("speed"), 1).alias("speed"),
        F.round(a("speed"), 1).alias("speed2"),
        b("latitude").alias("lat"),
        a("latitude").alias("lat2"),
        b("longitude").alias("lon"),
        a("longitude").alias("lon2"),
        b("devicetime").alias("devicetime"),
        b("grup_arah").alias("grup_arah"),
        b("id").cast("string").alias("truk_id"),
        a("id").cast("string").alias("truk_depan_id"),
        text.group_prefix(b("truk")).alias("grup_truk"),
        b("geofenceids").alias("geofenceids"),
    ]


def measured_pairs(pairs: DataFrame) -> DataFrame:
    """Distance (once per pair) and the columns derived from it."""
    gap = geo.haversine_m(
        "behind.latitude", "behind.longitude", "ahead.latitude", "ahead.longitude"
    )
    return pairs.withColumn("_gap", gap).select(*pair_columns())


def with_geofences(pairs: DataFrame, geofences: DataFrame) -> DataFrame:
    """One row per pair and geofence it is in; pairs outside all geofences fall away."""
    known = geofences.select(
        F.col("id").cast("long").alias("_fence"), F.col("name").alias("geofence_name")
    )
    return (
        pairs.withColumn("_fence", F.explode(text.id_list("geofenceids")))
        .join(known, "_fence")
        .drop("_fence")
    )


def truck_pairs(located: DataFrame, one_per_truck: bool = False) -> DataFrame:
    """Trucks that follow each other in the same five seconds and direction (batch form).

    All positions count, so a truck that reports twice can be paired with itself; with
    ``one_per_truck`` only a truck's last position of the window does.
    """
    rows = driving_order(located).withColumn("_window", F.window("devicetime", PAIR_WINDOW)["start"])
    if one_per_truck:
        rows = top_per_key(
            rows, ["_window", "jalur_arah", "truk"], [F.desc("devicetime"), F.desc("id")], 1
        )
    order = ["sort_key_1", "sort_key_2", "truk", "id"]
    followed = previous_row(rows, ["_window", "jalur_arah"], order, TRUCK_FIELDS, road_cell(), "behind")
    pairs = followed.where("behind IS NOT NULL").select("behind", F.struct(*TRUCK_FIELDS).alias("ahead"))
    return measured_pairs(pairs)


def vehicle_spacing(
    positions: DataFrame,
    devices: DataFrame,
    lanes: DataFrame,
    geofences: DataFrame | None = None,
    one_per_truck: bool = False,
    pick: str = "name",
) -> DataFrame:
    """Spacing and time to contact of following trucks, per geofence when those are given."""
    located = located_positions(typed_positions(positions), devices, lane_lookup(lanes), pick=pick)
    pairs = truck_pairs(located, one_per_truck)
    return pairs if geofences is None else with_geofences(pairs, geofences)


# --- rollups ------------------------------------------------------------------------


def with_labels(spacing: DataFrame, missing: str | None = None) -> DataFrame:
    """KM marker, quarter of the day, weekday and week of each spacing row.

    ``missing`` labels rows without a time; the default keeps the labels a NULL hour or
    weekday falls through to in a CASE without an explicit branch.
    """
    labels = (
        (times.quarter_day("devicetime"), times.day_name("devicetime"))
        if missing is None
        else (times.quarter_day("devicetime", missing), times.day_name("devicetime", missing))
    )
    return spacing.withColumns(
        {
            "KM": codes.km_marker("geofence_name"),
            "Interval": labels[0],
            "Hari": labels[1],
            "week_of_year": times.week_label("devicetime"),
        }
    )


ROLLUPS = {
    "gps": (["Interval", "Hari", "week_of_year"], ["jarak_waktu", "jarak"]),
    "km": (["KM", "Hari", "week_of_year"], ["jarak_waktu"]),
    "group": (["grup_truk_name", "Hari", "week_of_year"], ["jarak_waktu"]),
}


def _rollup_input(labelled: DataFrame, kind: str) -> DataFrame:
    if kind == "km":
        return labelled.where(F.trim("KM") != "")
    if kind == "group":
        return labelled.withColumnRenamed("grup_truk", "grup_truk_name").where("grup_truk_name IS NOT NULL")
    return labelled


def _averages(measures: Sequence[str]) -> list[Column]:
    return [numbers.steady(F.avg(m), 6).alias(f"rerata_{m}") for m in measures]


def windowed_rollup(labelled: DataFrame, kind: str, per_pair: bool = False) -> DataFrame:
    """Five-minute averages by labels (``gps``, ``km`` or ``group``), batch or stream.

    Rows are per pair and geofence, so a pair in two geofences counts twice; ``per_pair``
    counts it once (batch only).
    """
    keys, measures = ROLLUPS[kind]
    rows = _rollup_input(labelled, kind)
    if per_pair:
        kept = [*keys, "devicetime", "truk_id", "truk_depan_id", *measures]
        rows = rows.select(*dict.fromkeys(kept)).distinct()
    grouped = rows.groupBy(F.window("devicetime", ROLLUP_WINDOW).alias("_w"), *keys)
    return grouped.agg(*_averages(measures)).select(
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        *keys,
        *[f"rerata_{m}" for m in measures],
    )


def overall_rollup(labelled: DataFrame, kind: str) -> DataFrame:
    """Averages by labels over all time; as a stream it needs complete or update output."""
    keys, measures = ROLLUPS[kind]
    return _rollup_input(labelled, kind).groupBy(*keys).agg(*_averages(measures))


# --- map data -----------------------------------------------------------------------


def latest_positions(positions: DataFrame, devices: DataFrame) -> DataFrame:
    """Where each device was last seen, with a status colour; devices never seen are left out."""
    last = first_per_key(
        positions, ["deviceid"], [F.desc_nulls_last("servertime"), F.desc_nulls_last("id")]
    ).where("latitude IS NOT NULL AND longitude IS NOT NULL")
    seen = last.select(
        F.col("deviceid").alias("device_id"),
        "latitude", "longitude", "speed",
        F.col("servertime").alias("last_update"),
        "address",
    )
    known = devices.select(
        F.col("id").alias("device_id"),
        F.col("name").alias("device_name"),
        "status", "category",
        codes.status_colour("status").alias("color_hex"),
    )
    return known.join(seen, "device_id")


def geofence_polygons(geofences: DataFrame) -> DataFrame:
    """Polygons as closed rings; their text may be spread over several columns."""
    spread = [c for c in ("attributes", "calendarid", "geotype", "group_name") if c in geofences.columns]
    rows = geofences.where(F.col("area").startswith("POLYGON"))
    ring = geo.polygon_ring(geo.polygon_text("area", *spread))
    return rows.select("id", "name", "description", ring.alias("ring")).where("ring IS NOT NULL")


def geofence_features(polygons: DataFrame) -> DataFrame:
    """One GeoJSON Feature per row; written as text this is a GeoJSON sequence."""
    described = polygons.withColumn("description", F.coalesce("description", F.lit("")))
    return described.select(
        "id",
        geo.polygon_feature("ring", id="id", name="name", description="description").alias("feature"),
    )


def feature_collections(features: DataFrame, by: Column) -> DataFrame:
    """A FeatureCollection per group (map tile, site); choose groups that fit one document."""
    joined = F.concat_ws(",", F.transform(F.sort_array(F.collect_list(F.struct("id", "feature"))), lambda f: f["feature"]))
    document = F.concat(F.lit('{"type":"FeatureCollection","features":['), joined, F.lit("]}"))
    return features.groupBy(by.alias("tile")).agg(document.alias("collection"))


def map_documents(
    features: DataFrame, lon: str, lat: str, max_bytes: int = 1 << 20, id: str = "id", feature: str = "feature", depth: int = 18
) -> DataFrame:
    """FeatureCollections that fit a byte bound, however many features lie close together.

    The world is quartered again and again; a tile is split as long as its features (with a comma
    each) take more than ``max_bytes``, so tiles are small where features crowd.  A tile of the
    last ``depth`` that is still too large is cut into numbered documents in the order of ids; a
    document then takes at most the bound and the one feature that crosses it.  Columns: ``tile``
    (level/x/y), ``document`` (from 0), ``features``, ``collection``.

    Sizes are summed per place and level before the shuffle, and running sums go over dealt slots
    (:func:`tonflow.operators.ordered.running_total`), so no task holds more than one document.
    """
    side = float(2**depth)

    def cell(value: Column, span: float) -> Column:
        return F.greatest(F.least(F.floor((value + span / 2) / span * side), F.lit(2**depth - 1)), F.lit(0))

    rows = features.select(
        F.col(id).alias("id"), F.col(feature).alias("feature"), cell(F.col(lon), 360.0).alias("x"), cell(F.col(lat), 180.0).alias("y")
    ).withColumn("bytes", F.octet_length("feature") + 1)
    places = cut_lineage(rows.groupBy("x", "y").agg(F.sum("bytes").alias("bytes")))
    levels = places.select("x", "y", "bytes", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"))
    # Places within a tile share the leading bits of their numbers.
    scale = F.pow(F.lit(2.0), F.lit(depth) - F.col("level"))
    levels = levels.withColumns({"tx": F.floor(F.col("x") / scale), "ty": F.floor(F.col("y") / scale)})
    tiles = levels.groupBy("level", "tx", "ty").agg(F.sum("bytes").alias("total"))
    fitting = tiles.where((F.col("total") <= max_bytes) | (F.col("level") == depth)).select("level", "tx", "ty")
    first = (
        levels.join(fitting, ["level", "tx", "ty"])
        .groupBy("x", "y")
        .agg(F.min(F.struct("level", "tx", "ty")).alias("t"))
        .select("x", "y", F.concat_ws("/", "t.level", "t.tx", "t.ty").alias("tile"))
    )
    placed = running_total(rows.join(first, ["x", "y"]), ["id"], "bytes", ["tile"], "end")
    document = F.floor((F.col("end") - F.col("bytes")) / F.lit(max_bytes))
    grouped = placed.groupBy("tile", document.alias("document")).agg(
        F.count(F.lit(1)).alias("features"), F.sort_array(F.collect_list(F.struct("id", "feature"))).alias("_all")
    )
    joined = F.concat_ws(",", F.transform("_all", lambda f: f["feature"]))
    text_of = F.concat(F.lit('{"type":"FeatureCollection","features":['), joined, F.lit("]}"))
    return grouped.select("tile", "document", "features", text_of.alias("collection"))
