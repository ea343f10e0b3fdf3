"""Column builders on hand-made values."""

import math
from datetime import date, datetime

from pyspark.sql import functions as F

from tonflow.functions import codes, geo, numbers, text, times


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column.alias("x")).collect()]


def test_timestamps_in_every_layout(spark):
    cases = {
        "6/1/26 6:02": datetime(2026, 6, 1, 6, 2),
        "6/1/26 16:02:30": datetime(2026, 6, 1, 16, 2, 30),
        "12/31/2026 06:02": datetime(2026, 12, 31, 6, 2),
        "6/1/2026 6:02:30": datetime(2026, 6, 1, 6, 2, 30),
        "2026-06-24 06:25:05": datetime(2026, 6, 24, 6, 25, 5),
        " 2026-06-24 06:25:05.376713 ": datetime(2026, 6, 24, 6, 25, 5, 376713),
        "2026-06-24 06:25:05.376713+08": datetime(2026, 6, 23, 22, 25, 5, 376713),
        "2026-06-24 06:25:05.376713+08:00": datetime(2026, 6, 23, 22, 25, 5, 376713),
        "": None,
        "\\N": None,
        "13/45/2026 6:02": None,
        "soon": None,
        None: None,
    }
    got = values(spark, [(k,) for k in cases], "s string", times.parse_any("s"))
    assert got == list(cases.values())


def test_iso_timestamps(spark):
    got = values(
        spark,
        [("2026-06-24T06:25:05.123Z",), ("2026-06-24T06:25:05Z",), ("2026-06-24 06:25:05",), ("x",)],
        "s string",
        times.parse_iso("s"),
    )
    second = datetime(2026, 6, 24, 6, 25, 5)
    assert got == [second.replace(microsecond=123000), second, second, None]


def test_markers_booleans_numbers(spark):
    rows = [("\\N",), ("null",), (" NaN ",), ("",), ("None",), (" x ",), (None,)]
    assert values(spark, rows, "s string", text.present("s")) == [None] * 5 + ["x", None]
    rows = [("T",), (" yes ",), ("0",), ("No",), ("maybe",), (None,)]
    assert values(spark, rows, "s string", text.to_boolean("s")) == [True, True, False, False, None, None]
    rows = [("1,234.5",), ("abc",), ("",), (None,)]
    assert values(spark, rows, "s string", numbers.to_double("s")) == [1234.5, None, None, None]
    assert values(spark, rows, "s string", numbers.number_or_zero("s")) == [0.0, 0.0, 0.0, 0.0]
    big = "123456789012345678"
    assert values(spark, [(big,), ("12,000",), ("1.5",)], "s string", numbers.to_long("s")) == [int(big), 12000, None]


def test_dump_markers_only(spark):
    df = spark.createDataFrame([("\\N", 1), (" \\N ", 2), ("null", None)], "a string, b int")
    assert [tuple(r) for r in text.blank_dump_markers(df).collect()] == [(None, 1), (None, 2), ("null", None)]


def test_rounding_does_not_depend_on_noise(spark):
    rows = [(1.0005,), (1.0004999999999997,), (-1.0005,), (2.0,)]
    assert values(spark, rows, "x double", numbers.steady("x", 3)) == [1.001, 1.001, -1.001, 2.0]


def test_percent_needs_a_positive_whole(spark):
    rows = [(1.0, 4.0), (1.0, 0.0), (1.0, -2.0), (None, 4.0), (1.0, None)]
    assert values(spark, rows, "a double, b double", numbers.percent("a", "b")) == [25.0, None, None, None, None]


def test_production_day_and_shift(spark):
    rows = [(datetime(2026, 7, 1, h, m),) for h, m in ((5, 59), (6, 0), (17, 59), (18, 0))] + [(None,)]
    days = values(spark, rows, "t timestamp", times.production_date("t"))
    assert days == [date(2026, 6, 30)] + [date(2026, 7, 1)] * 3 + [None]
    assert values(spark, rows, "t timestamp", times.shift_label("t")) == ["Malam", "Pagi", "Pagi", "Malam", "Malam"]
    assert values(spark, rows, "t timestamp", times.shift_label("t", missing=None))[-1] is None


def test_labels(spark):
    rows = [(datetime(2024, 12, 30, 5, 59),), (datetime(2024, 6, 2, 18, 0),), (None,)]
    assert values(spark, rows, "t timestamp", times.week_label("t")) == ["2024-W01", "2024-W22", None]
    assert values(spark, rows, "t timestamp", times.week_label("t", iso_year=True)) == ["2025-W01", "2024-W22", None]
    assert values(spark, rows, "t timestamp", times.day_name("t")) == ["Senin", "Minggu", "Sabtu"]
    assert values(spark, rows, "t timestamp", times.day_name("t", "Unknown"))[-1] == "Unknown"
    assert values(spark, rows, "t timestamp", times.quarter_day("t")) == ["00:00-05:59", "18:00-23:59", "18:00-23:59"]
    assert values(spark, rows, "t timestamp", times.quarter_day("t", "Unknown"))[-1] == "Unknown"


def test_durations(spark):
    a, b = datetime(2026, 1, 1, 10, 0), datetime(2026, 1, 1, 10, 30, 30)
    rows = [(a, b), (b, a), (None, b)]
    schema = "s timestamp, e timestamp"
    assert values(spark, rows, schema, times.elapsed_minutes("e", "s")) == [30.5, None, None]
    assert values(spark, rows, schema, times.signed_minutes("e", "s")) == [30.5, -30.5, None]


def test_place_codes(spark):
    names = ["ROM A1 EXTEND", "rom a2p", "ROM A3 GH", "PIT C APL", "ROM-A3", "ROM-B1", "YARD", None]
    got = values(spark, [(n,) for n in names], "s string", codes.rom_code("s"))
    assert got == ["ROM-A1", "ROM-A2", "ROM-A3", "PIT-C-APL", "ROM-A3", "UNKNOWN", "UNKNOWN", "UNKNOWN"]
    names = ["SITE CP 7", "CP-2B", "north stockpile", "PORT EAST", "x", None]
    got = values(spark, [(n,) for n in names], "s string", codes.destination_code("s"))
    assert got == ["CP-7", "CP-2B", "NORTH-STOCKPILE", "PORT-BIB", "UNKNOWN", "UNKNOWN"]
    names = ["ROM A1", "Pit C", "NORTH STOCKPILE", "cp 3", None]
    got = values(spark, [(n,) for n in names], "s string", codes.node_code("s"))
    assert got == ["ROM-A1", "UNRESOLVED", "NORTH-STOCKPILE", "CP-3", "UNRESOLVED"]


def test_small_text_helpers(spark):
    rows = [("Auto stock mutation for TMR 0003",), ("manual",), (None,)]
    assert values(spark, rows, "s string", codes.truck_in_remark("s")) == ["TMR 0003", None, None]
    assert values(spark, [("KM 3.5 x",), ("KM 11",), ("Gate",)], "s string", codes.km_marker("s")) == ["3.5", "11", ""]
    assert values(spark, [("[1, 2]",), ("[]",), ("[a,3]",), (None,)], "s string", text.id_list("s")) == [[1, 2], [], [3], []]
    parts = text.code_parts("s", ["a", "b", "c", "d"])
    row = spark.createDataFrame([("RA1.SEAM2",)], "s string").select(*parts).first()
    assert tuple(row) == ("RA1", "SEAM2", None, None)
    assert values(spark, [("CP-2A",), ("cp 7",)], "s string", codes.plant_short_name("s")) == ["CP2A", "CP7"]


def test_json_array_in_prose(spark):
    rows = [
        ('```json\n[{"rank": 1, "title": "A"}, {"rank": 2}]\n```',),
        ("nothing here",),
        ("[]",),
        ('x [{"rank": "bad"}] y',),
    ]
    got = values(spark, rows, "s string", text.json_array_in("s"))
    assert [r["rank"] for r in got[0]] == [1, 2] and got[0][0]["title"] == "A"
    assert got[1] is None and got[2] is None


def haversine(lat1, lon1, lat2, lon2):
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2
    a += math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6_371_000.0 * math.asin(math.sqrt(min(1.0, a)))


def test_distances(spark):
    wkt = "LINESTRING (115.0 -3.5, 115.001 -3.499, 115.002 -3.5)"
    rows = [(-3.4995, 115.0005, wkt), (-3.5, 115.01, wkt), (-3.5, 115.0, "LINESTRING (115.001 -3.5)"), (-3.5, 115.0, "bad")]
    got = values(spark, rows, "lat double, lon double, w string", geo.line_distance_m("lat", "lon", "w"))
    assert abs(got[0]) < 1e-6
    assert abs(got[1] - haversine(-3.5, 115.01, -3.5, 115.002)) < 1e-6
    assert abs(got[2] - haversine(-3.5, 115.0, -3.5, 115.001)) < 1e-6
    assert got[3] is None


def test_headings_and_order(spark):
    rows = [(c,) for c in (0.0, 45.0, 90.0, 135.0, 180.0, 225.0, 270.0, 300.0, 360.0, 361.0, None)]
    got = values(spark, rows, "c double", geo.heading_group("c"))
    assert got == ["utara", "utara", "utara", "selatan", "selatan", "selatan", "utara", "utara", "utara", None, None]
    first, second = geo.travel_order("c", F.lit(2.0), F.lit(5.0))
    assert values(spark, rows, "c double", first) == [2, 2, 5, -2, -2, -2, -5, 2, 2, None, None]
    assert values(spark, rows, "c double", second) == [5, 5, 5, 5, 5, -5, -5, -5, -5, None, None]


def test_time_to_contact(spark):
    rows = [(100.0, 20.0, 10.0), (100.0, 10.0, 20.0), (100.0, 10.0, 10.0), (None, 20.0, 10.0)]
    got = values(spark, rows, "g double, b double, a double", geo.seconds_to_contact("g", "b", "a"))
    assert got == [round(100 / (10 * 1.852 / 3.6)), None, None, None]


def test_polygons(spark):
    ring = "POLYGON ((1 2, 3 4, 5 6))"
    closed = [[2.0, 1.0], [4.0, 3.0], [6.0, 5.0], [2.0, 1.0]]
    rows = [(ring,), ("POLYGON ((1 2 3 4 5 6 1 2))",), ("POLYGON ((1 2, 3 4))",), ("POLYGON ((1 2, 3 x, 5 6))",)]
    assert values(spark, rows, "w string", geo.polygon_ring("w")) == [closed, closed, None, None]
