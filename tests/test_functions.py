from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanfeat.functions import bins, geoexpr, missing, packed, timeexpr


def test_split_packed_pieces(spark, rows):
    df = spark.createDataFrame(
        [(1, "010,1,N,+0012,5"), (2, "abc,1"), (3, ""), (4, None), (5, "-0043,9,V,x,")],
        "id int, WND string",
    )
    out = packed.split_packed(df, {"WND": packed.WEATHER_LAYOUTS["WND"]})
    assert "WND" not in out.columns
    assert rows(out) == [
        (1, 10, "1", "N", 12, "5"),
        (2, None, "1", None, None, None),
        (3, None, None, None, None, None),
        (4, None, None, None, None, None),
        (5, -43, "9", "V", None, ""),
    ]


@pytest.mark.parametrize("sep", ["|", ".", "::", ";", "\\", "^"])
def test_split_packed_separators_are_literal(spark, rows, sep):
    df = spark.createDataFrame([(f"1{sep}x",)], "p string")
    out = packed.split_packed(df, {"p": [("n", "int"), ("t", "string")]}, sep)
    assert rows(out) == [(1, "x")]


def test_fixed_width(spark, rows):
    df = spark.createDataFrame([("ABE   40.65 x",), ("ORD",)], "value string")
    layout = [("iata", 1, 3, "string"), ("lat", 6, 6, "double"), ("flag", 13, 1, "string")]
    assert rows(packed.parse_fixed_width(df, layout)) == [("ABE", 40.65, "x"), ("ORD", None, None)]


def test_json_fields_missing_extra_malformed(spark, rows):
    df = spark.createDataFrame([(1, '{"a": 2, "zz": 1}'), (2, "{"), (3, "{}"), (4, None)], "id int, j string")
    assert rows(packed.json_fields(df, "j", "a long, b string"), "id", "a", "b") == [
        (1, 2, None),
        (2, None, None),
        (3, None, None),
        (4, None, None),
    ]


def test_hour_bins(spark, rows):
    hours = [0, 5, 6, 9, 10, 14, 15, 20, 21, 23, None]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hours)], "i int, h int")
    out = df.select("i", bins.bin_by_edges(F.col("h"), bins.DAY_PART_LAST_HOURS).alias("b"))
    assert [b for _, b in rows(out)] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4, None]


def test_flags_and_labels(spark, rows):
    df = spark.createDataFrame([(15,), (16,), (None,)], "x int")
    out = df.select(
        "x",
        bins.flag_in(F.col("x"), [16]),
        bins.flag_range(F.col("x"), 15, 16),
        bins.threshold_label(F.col("x"), 15),
        bins.threshold_label(F.col("x"), 15, strict=False),
    )
    assert rows(out) == [(15, 0, 1, 0, 1), (16, 1, 0, 1, 1), (None, 0, 0, None, None)]


def test_clock_to_ts(spark):
    day = datetime(2024, 2, 28, 17)
    df = spark.createDataFrame([(day, c) for c in (0, 5, 930, 2359, 2400, 2401, 1275, None)], "d timestamp_ntz, c int")
    got = [r[0] for r in df.select(timeexpr.clock_to_ts(F.col("d"), F.col("c"))).collect()]
    base = datetime(2024, 2, 28)
    assert got == [
        base,
        base + timedelta(minutes=5),
        base + timedelta(hours=9, minutes=30),
        base + timedelta(hours=23, minutes=59),
        datetime(2024, 2, 29),
        None,
        None,
        None,
    ]


def test_roll_after_and_blocks(spark):
    a, b = datetime(2024, 1, 1, 23), datetime(2024, 1, 1, 1)
    row = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz").select(
        timeexpr.roll_after(F.col("a"), F.col("b")),
        timeexpr.hour_block(F.col("b")),
        timeexpr.minutes_after_midnight(F.col("a")),
    ).first()
    assert tuple(row) == (datetime(2024, 1, 2, 1), "0100-0159", 1380)


def test_to_utc_uses_each_rows_zone(spark):
    noon = datetime(2024, 7, 1, 12)
    df = spark.createDataFrame([(noon, "America/New_York"), (noon, "Asia/Tokyo")], "t timestamp_ntz, z string")
    got = [r[0] for r in df.select(timeexpr.to_utc(F.col("t"), F.col("z"))).collect()]
    assert got == [datetime(2024, 7, 1, 16), datetime(2024, 7, 1, 3)]


def test_micros_round_trip(spark):
    t = datetime(1969, 12, 31, 23, 59, 59, 999999)
    row = spark.createDataFrame([(t,)], "t timestamp_ntz").select(
        timeexpr.micros("t").alias("u"), timeexpr.from_micros(timeexpr.micros("t")).alias("t")
    ).first()
    assert row.u == -1 and row.t == t


def test_parse_day(spark):
    df = spark.createDataFrame([("20190304",), ("nope",), (None,)], "d string")
    assert [r[0] for r in df.select(timeexpr.parse_day(F.col("d"))).collect()] == [
        datetime(2019, 3, 4),
        None,
        None,
    ]


def test_missing_and_quality(spark, rows):
    nan = float("nan")
    df = spark.createDataFrame(
        [(1, 9999.0, "1"), (2, nan, "2"), (3, None, None), (4, 5.0, "5")], "id int, v double, q string"
    )
    assert rows(missing.sentinel_to_null(df, {"v": [9999.0]}), "id", "v") == [(1, None), (2, None), (3, None), (4, 5.0)]
    assert rows(missing.valid_rows(df, {"v": [9999.0]}), "id") == [(4,)]
    good = df.select("id", missing.good_quality(F.col("q"), ["2", "3"]).alias("g"))
    assert rows(good) == [(1, True), (2, False), (3, False), (4, True)]


def test_haversine_known_pair_and_antipode(spark):
    # Chicago O'Hare to Atlanta is about 606 miles; the argument order matters
    row = spark.range(1).select(
        geoexpr.haversine_miles(F.lit(41.9742), F.lit(-87.9073), F.lit(33.6407), F.lit(-84.4277)).alias("a"),
        geoexpr.haversine_miles(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("b"),
        geoexpr.eastward_flag(F.lit(-87.9), F.lit(-84.4)).alias("e"),
    ).first()
    assert abs(row.a - 606) < 2
    assert abs(row.b - 12436.8) < 1
    assert row.e == 1


def test_rescale_and_key(spark, rows):
    df = spark.createDataFrame([(10, "a", None), (25, "a", "b")], "t int, x string, y string")
    out = packed.rescale(df, {"t": 0.1}).select("t", packed.composite_key(F.col("x"), F.col("y")).alias("k"))
    assert rows(out) == [(1.0, None), (2.5, "ab")]


def test_lookback_bounds(spark):
    t = datetime(2024, 1, 10)
    out = timeexpr.lookback_bounds(
        spark.createDataFrame([(t,)], "t timestamp_ntz"), "t", timedelta(hours=2), timedelta(hours=50)
    ).first()
    assert (out.ts_min, out.ts_max) == (t - timedelta(hours=50), t - timedelta(hours=2))
