"""Spacing on hand-made positions, and streams against their batch form."""

from datetime import datetime, timedelta

from tonflow.plans import speed, tracking
from tonflow.streaming import StreamLog, event_time, file_stream, spacing_stream, speed_stream, to_files, watched

T0 = datetime(2026, 7, 1, 8, 0, 0)
POSITION = (
    "id long, deviceid long, devicetime timestamp, servertime timestamp, latitude double, longitude double,"
    " speed double, course double, geofenceids string, valid int, address string"
)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def position(i, device, second, lat, speed_kn, lon=115.0, course=0.0, fences="[1]", valid=1):
    return (i, device, at(second), at(second), lat, lon, speed_kn, course, fences, valid, "x")


ROWS = [
    position(1, 10, 0, -3.4990, 20.0), position(2, 10, 2, -3.4988, 20.0),  # same truck twice
    position(3, 11, 1, -3.4980, 10.0, fences="[1, 2]"), position(4, 12, 3, -3.4970, 15.0, fences="[]"),
    position(5, 13, 1, -3.4975, 9.0, lon=115.001),  # off the road
    position(6, 14, 1, -3.4975, 9.0, valid=0),
    position(7, 10, 60, -3.4900, 20.0), position(8, 11, 61, -3.4890, 10.0), position(9, 11, 600, -3.48, 10.0),
]
DEVICES = [(10, "GEC 1", "online", "truck"), (11, "KMB 2", "offline", "truck")]
LANES = [("1", "A", "N", "LINESTRING (115.0 -3.5, 115.0 -3.4)")]
FENCES = [(1, "KM 1 x"), (2, "KM 2.5 y")]


def tables(spark):
    return (
        spark.createDataFrame(ROWS, POSITION),
        spark.createDataFrame(DEVICES, "id long, name string, status string, category string"),
        spark.createDataFrame(LANES, "id string, nama_jalur string, arah string, koordinat_jalur string"),
        spark.createDataFrame(FENCES, "id long, name string"),
    )


def test_pairs_follow_in_driving_order(spark):
    positions, devices, lanes, fences = tables(spark)
    pairs = tracking.vehicle_spacing(positions, devices, lanes, one_per_truck=True).orderBy("devicetime").collect()
    assert [(r["truk"], r["truk_depan"]) for r in pairs] == [("KMB 2", "12"), ("GEC 1", "KMB 2"), ("GEC 1", "KMB 2")]
    assert pairs[0]["jarak_waktu"] is None  # the follower is slower
    assert pairs[1]["jarak"] == 89.0 and pairs[1]["jarak_waktu"] == round(88.96 / (10 * 1.852 / 3.6))
    fenced = tracking.vehicle_spacing(positions, devices, lanes, fences, one_per_truck=True)
    assert sorted(r["geofence_name"] for r in fenced.collect()) == ["KM 1 x", "KM 1 x", "KM 1 x", "KM 2.5 y"]
    raw = tracking.vehicle_spacing(positions, devices, lanes, one_per_truck=False)
    assert ("GEC 1", "GEC 1") in {(r["truk"], r["truk_depan"]) for r in raw.collect()}


def test_latest_position_and_colour(spark):
    positions, devices, *_ = tables(spark)
    got = {r["device_name"]: (r["latitude"], r["color_hex"]) for r in tracking.latest_positions(positions, devices).collect()}
    assert got == {"GEC 1": (-3.49, "#00FF00"), "KMB 2": (-3.48, "#FF0000")}


def test_stream_emits_closed_windows_and_drops_late_rows(spark, tmp_path):
    positions, devices, lanes, _ = tables(spark)
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    positions.coalesce(1).write.parquet(folder)

    def drain():
        stream = spacing_stream(file_stream(spark, folder, positions.schema), devices, lanes)
        to_files(stream, out, state).awaitTermination()
        return sorted((r["truk"], r["truk_depan"], r["jarak"]) for r in spark.read.parquet(out).collect())

    batch = tracking.vehicle_spacing(positions, devices, lanes).collect()
    first = drain()
    assert first == sorted((r["truk"], r["truk_depan"], r["jarak"]) for r in batch)
    # Both trucks again in a window that closed long ago: dropped by the watermark.
    late = spark.createDataFrame([position(20, 10, 5, -3.45, 5.0), position(21, 11, 6, -3.44, 5.0)], POSITION)
    late.coalesce(1).write.mode("append").parquet(folder)
    assert drain() == first


def test_stateless_stream_equals_batch(spark, tmp_path):
    rows = [
        (1, "T", "gec", "ACTUAL", v, "2026-07-01 06:00:00", "2026-07-01 07:00:00", "2026-07-01 06:30:00")
        for v in (None, -1.0, 6.99, 7.0, 10.0, 10.01)
    ] + [(2, "T", None, "ACTUAL", 8.0, "2026-07-01 06:00:00", None, None)]
    schema = (
        "id long, truck string, code string, status_trx_wim string, average_speed double,"
        " timestamp_in_local string, timestamp_out_local string, timestamp_gross_local string"
    )
    df = spark.createDataFrame(rows, schema)
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    df.write.parquet(folder)
    to_files(speed_stream(file_stream(spark, folder, df.schema)), out, state).awaitTermination()
    pick = lambda f: sorted((str(r["average_speed"]), r["speed_category"], r["is_compliant"]) for r in f.collect())
    assert pick(spark.read.parquet(out)) == pick(speed.closing_silver(df))
    assert {r["average_speed"]: r["is_compliant"] for r in speed.closing_silver(df).collect()} == {
        None: 0, 6.99: 0, 7.0: 1, 10.0: 1, 10.01: 0,
    }


def test_times_without_zone_can_be_watermarked(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2026-01-01 00:00:00' AS t")
    assert dict(event_time(df, "t").dtypes)["t"] == "timestamp"


def test_map_documents_keep_their_bound(spark):
    """Half of the features stand at one place, the others apart."""
    rows = [(i, "f" * 90, 115.0 if i % 2 else i * 0.01, -3.5 if i % 2 else 10.0) for i in range(400)]
    features = spark.createDataFrame(rows, "id long, feature string, lon double, lat double")
    got = tracking.map_documents(features, "lon", "lat", max_bytes=1000).collect()
    assert sum(r["features"] for r in got) == 400
    assert all(r["features"] * 91 <= 1000 + 91 for r in got) and max(r["document"] for r in got) > 10
    ends = len('{"type":"FeatureCollection","features":[]}')
    assert all(len(r["collection"]) == ends + r["features"] * 91 - 1 for r in got)
    assert tracking.map_documents(features.limit(0), "lon", "lat").count() == 0


def test_stream_log_counts_missed_expectations(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.range(10).repartition(1).write.parquet(folder)
    log = StreamLog(spark, str(tmp_path / "log"))
    assert log.expectations().count() == 0 and log.late().count() == 0
    spark.streams.addListener(log)
    try:
        rows = watched(file_stream(spark, folder, "id long"), "ids", {"small": "id < 7", "even": "id % 2 = 0"})
        log.run(to_files(rows, out, state))
    finally:
        spark.streams.removeListener(log)
    assert {(r["expectation"], r["rows"], r["missed"]) for r in log.expectations().collect()} == {("ids.small", 10, 3), ("ids.even", 10, 5)}
    assert spark.read.parquet(out).count() == 10
