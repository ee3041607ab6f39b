from datetime import datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from spanfeat.operators import spans

H = timedelta(hours=1)
US = timedelta(microseconds=1)
T0 = datetime(2024, 1, 10, 12)


def asof(spark, left, right, **kw):
    l = spark.createDataFrame(left, "id int, k string, ts timestamp_ntz")
    r = spark.createDataFrame(right, "k string, ts timestamp_ntz, v double")
    out = spans.asof_join(l, r, "k", "ts", "ts", {"a": F.avg("v"), "m": F.min("v")}, **kw)
    return {(x.id): (x.matched_ts, x.a, x.m) for x in out.collect()}, out


def test_asof_bounds_are_inclusive(spark):
    left = [(1, "a", T0), (2, "b", T0), (3, "c", T0), (4, "d", T0)]
    right = [
        ("a", T0 - 2 * H, 1.0),
        ("b", T0 - 50 * H, 2.0),
        ("c", T0 - 2 * H + US, 3.0),
        ("d", T0 - 50 * H - US, 4.0),
    ]
    got, _ = asof(spark, left, right)
    assert got[1] == (T0 - 2 * H, 1.0, 1.0)
    assert got[2] == (T0 - 50 * H, 2.0, 2.0)
    assert got[3] == (None, None, None)
    assert got[4] == (None, None, None)


def test_asof_combines_ties_and_keeps_every_left_row(spark):
    left = [(1, "a", T0), (1, "a", T0), (2, None, T0), (3, "a", None), (4, "zz", T0)]
    right = [
        ("a", T0 - 3 * H, 1.0),
        ("a", T0 - 3 * H, 4.0),
        ("a", T0 - 9 * H, 100.0),
        (None, T0 - 3 * H, 7.0),
        ("a", None, 8.0),
    ]
    got, out = asof(spark, left, right)
    assert out.count() == 5
    assert got[1] == (T0 - 3 * H, 2.5, 1.0)
    assert got[2] == got[3] == got[4] == (None, None, None)


def test_asof_null_payload_of_latest_reading_is_not_skipped(spark):
    got, _ = asof(spark, [(1, "a", T0)], [("a", T0 - 3 * H, None), ("a", T0 - 5 * H, 9.0)])
    assert got[1] == (T0 - 3 * H, None, None)


def brute_asof(left, right, lo, hi):
    out = {}
    for i, k, t in left:
        hits = [(s, v) for kk, s, v in right if kk == k and t - hi <= s <= t - lo]
        if not hits:
            out[i] = (None, None, None)
            continue
        at = max(s for s, _ in hits)
        vals = [v for s, v in hits if s == at]
        out[i] = (at, pytest.approx(sum(vals) / len(vals)), min(vals))
    return out


@pytest.mark.parametrize("chunk", [None, timedelta(minutes=7), timedelta(days=3)])
@pytest.mark.parametrize("seed", [1, 2])
def test_asof_equals_brute_force_with_a_hot_key(spark, seed, chunk):
    rnd = Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "c", "d"]

    def moment():
        return T0 + timedelta(minutes=rnd.randrange(0, 60 * 24 * 9, 13))

    left = [(i, rnd.choice(keys), moment()) for i in range(300)]
    right = [(rnd.choice(keys), moment(), float(rnd.randrange(100))) for _ in range(200)]
    got, out = asof(spark, left, right, chunk=chunk)
    assert out.count() == len(left)
    assert got == brute_asof(left, right, 2 * H, 50 * H)


def test_asof_different_key_names_and_extra_columns(spark):
    l = spark.createDataFrame([(1, "x", T0, "keep me")], "id int, st string, at timestamp, note string")
    r = spark.createDataFrame([("x", T0 - 5 * H, 3)], "station string, seen timestamp, v int")
    out = spans.asof_join(l, r, [("st", "station")], "at", "seen", {"v": F.max("v")}, matched_ts=None)
    assert out.columns == ["id", "st", "at", "note", "v"]
    assert out.first()["v"] == 3


def test_asof_roles_equal_single_joins(spark, rows):
    rnd = Random(11)
    t = [T0 + timedelta(minutes=rnd.randrange(0, 9000, 17)) for _ in range(200)]
    left = spark.createDataFrame(
        [(i, rnd.choice("abc"), rnd.choice(["a", "b", "d", None]), t[i]) for i in range(100)],
        "id int, o string, d string, ts timestamp_ntz",
    )
    right = spark.createDataFrame(
        [(rnd.choice("abd"), t[100 + i], float(i)) for i in range(100)], "k string, ts timestamp_ntz, v double"
    )
    both = spans.asof_join_roles(left, right, {"O": "o", "D": "d"}, "k", "ts", "ts", {"v": F.avg("v")})
    assert both.columns == ["id", "o", "d", "ts", "O_MAX_DATE", "v_O", "D_MAX_DATE", "v_D"]
    for role, key in (("O", "o"), ("D", "d")):
        one = spans.asof_join(left, right, [(key, "k")], "ts", "ts", {"v": F.avg("v")})
        assert rows(both, "id", f"{role}_MAX_DATE", f"v_{role}") == rows(one, "id", "matched_ts", "v")


def so_far(spark, events, lag=2 * H, **kw):
    df = spark.createDataFrame(events, "id int, k string, ts timestamp_ntz, late int")
    out = spans.events_so_far(df, "k", "ts", F.col("late") == 1, lag, "n", **kw)
    assert out.count() == len(events)
    return {r.id: r.n for r in out.collect()}


def test_events_so_far_edges(spark):
    day = datetime(2024, 1, 10)
    got = so_far(
        spark,
        [
            (1, "a", day + 6 * H, 1),
            (2, "a", day + 8 * H, 1),  # exactly two hours later counts
            (3, "a", day + 8 * H - US, 1),
            (4, "a", day + 23 * H, 0),
            (5, "a", day + 25 * H, 0),  # cut-off falls on the day before
            (6, "a", day + 27 * H, 0),
            (7, None, day + 20 * H, 1),
            (8, None, day + 23 * H, 1),
            (9, "a", None, 1),
            (10, "a", day + 8 * H, 0),  # tie at one instant
        ],
    )
    assert got == {1: 0, 2: 1, 3: 0, 4: 3, 5: 0, 6: 0, 7: 0, 8: 0, 9: 0, 10: 1}


@pytest.mark.parametrize("chunk", [timedelta(minutes=5), timedelta(hours=1), timedelta(days=1)])
def test_events_so_far_equals_brute_force(spark, chunk):
    rnd = Random(5)
    events = [
        (i, rnd.choice(["hot", "hot", "a", "b"]), datetime(2024, 1, 10) + timedelta(minutes=rnd.randrange(0, 4320, 11)), rnd.randrange(2))
        for i in range(400)
    ]
    got = so_far(spark, events, chunk=chunk)
    for i, k, t, _ in events:
        want = sum(
            1 for _, kk, s, late in events if late and kk == k and s.date() == t.date() and s <= t - 2 * H
        )
        assert got[i] == want


def test_hub_events_same_for_all_rows_of_an_instant(spark, rows):
    day = datetime(2024, 1, 10)
    df = spark.createDataFrame(
        [
            (1, "h1", day + H, 1),
            (2, "h2", day + 2 * H, 1),
            (3, "z", day + H, 1),
            (4, "z", day + 4 * H, 0),
            (5, "q", day + 4 * H, 0),
            (6, "q", day + 3 * H + timedelta(seconds=30), 0),
        ],
        "id int, k string, ts timestamp_ntz, late int",
    )
    hubs = spark.createDataFrame([("h1",), ("h2",), ("h1",)], "k string")
    out = spans.hub_events_so_far(df, hubs, "k", "ts", F.col("late") == 1, 2 * H, "n")
    assert rows(out, "id", "n") == [(1, 0), (2, 0), (3, 0), (4, 2), (5, 2), (6, 1)]


def test_chunk_must_divide_a_day(spark):
    with pytest.raises(ValueError):
        so_far(spark, [(1, "a", T0, 1)], chunk=timedelta(minutes=7))


def test_overlapping_intervals(spark, rows):
    d = datetime(2024, 1, 1)
    day = timedelta(days=1)
    data = [
        (1, "a", d, d + 400 * day),
        (2, "a", d + 10 * day, d + 11 * day),
        (3, "a", d + 399 * day, d + 399 * day),
        (4, "a", d + 400 * day, d + 500 * day),
        (5, "a", d + 501 * day, d + 502 * day),
        (6, "b", d, d),
        (7, "b", d, d),
        (8, None, d, d + day),
        (9, "a", None, d),
    ]
    df = spark.createDataFrame(data, "id int, k string, b timestamp_ntz, e timestamp_ntz")
    out = spans.overlapping_intervals(df, "k", "b", "e", "id")
    assert rows(out, "id", "overlaps") == [
        (1, 0), (2, 1), (3, 1), (4, 1), (5, 0), (6, 0), (7, 1), (8, 0), (9, 0),
    ]


def test_range_flag_list_and_table_agree_and_keep_rows(spark, rows):
    d = datetime(2024, 1, 1)
    ranges = [(d, d + 30 * H), (d + 20 * H, d + 40 * H), (d + 90 * H, d + 90 * H)]
    df = spark.createDataFrame(
        [(i, d + i * H) for i in range(-2, 100)] + [(1000, None)], "id int, ts timestamp_ntz"
    )
    table = spark.createDataFrame(ranges, "begin timestamp_ntz, end timestamp_ntz")
    by_list = rows(spans.range_flag(df, "ts", ranges), "id", "in_range")
    by_table = rows(spans.range_flag(df, "ts", table), "id", "in_range")
    want = [(i, int(0 <= i <= 40 or i == 90)) for i in range(-2, 100)] + [(1000, 0)]
    assert by_list == by_table == want


def test_no_ranges(spark, rows):
    df = spark.createDataFrame([(1, T0)], "id int, ts timestamp_ntz")
    assert rows(spans.range_flag(df, "ts", []), "in_range") == [(0,)]


def test_session_zone_is_checked(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError):
            asof(spark, [(1, "a", T0)], [])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
