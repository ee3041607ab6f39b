from datetime import datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from spanfeat import plans
from spanfeat.operators import geo, impute
from spanfeat.operators.impute import ImputationModel, Measure

T = datetime(2024, 1, 1, 10)
BAD = ("2", "3", "6", "7")
SCHEMA = "id int, st string, ts timestamp_ntz, v double, q string"


def fill(spark, data, bridge, extra=None):
    df = spark.createDataFrame(data, SCHEMA)
    b = spark.createDataFrame(bridge, "station_id string, neighbor_id string")
    out = impute.impute_neighbors(df, b, "st", "ts", [Measure("v", "q", (9999.0,))], ["id", "st", "ts"])
    return {r.id: r.v for r in out.collect()}, out


def test_neighbour_rules(spark):
    m = timedelta(minutes=1)
    data = [
        (1, "a", T, 10.0, "1"),  # good: kept
        (2, "a", T + m, 11.0, "2"),  # present but bad: absent
        (3, "a", T + 2 * m, 9999.0, "1"),  # sentinel: mean of self's and b's good readings
        (4, "a", T + 3 * m, None, None),  # null, quality null: same mean
        (5, "a", T + 4 * m, 12.0, None),  # quality unknown: absent
        (6, "b", T + 30 * m, 20.0, "1"),
        (7, "b", T + 61 * m, None, "1"),  # nothing in its hour
        (8, "c", T, 99.0, "1"),  # c is nobody's neighbour
        (9, "far", T, 5.0, "1"),  # outside the bridge
    ]
    bridge = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "a"), ("c", "c")]
    got, _ = fill(spark, data, bridge)
    assert got == {1: 10.0, 3: 15.0, 4: 15.0, 6: 20.0, 8: 99.0}


def test_exact_duplicates_collapse(spark):
    data = [(1, "a", T, 10.0, "1"), (1, "a", T, 10.0, "1"), (2, "a", T, None, "1"), (2, "a", T, None, "1")]
    _, out = fill(spark, data, [("a", "a")])
    assert out.count() == 2


def test_one_pass_equals_union_form(spark):
    rnd = Random(3)
    stations = list("abcdef")
    bridge = {(s, s) for s in stations} | {tuple(rnd.sample(stations, 2)) for _ in range(12)}
    bridge |= {(b, a) for a, b in bridge}
    data = [
        (
            i,
            rnd.choice(["a"] * 4 + stations),
            T + timedelta(minutes=rnd.randrange(300)),
            rnd.choice([9999.0, None, float(rnd.randrange(50)), float(rnd.randrange(50))]),
            rnd.choice(["1", "1", "5", "2", None]),
        )
        for i in range(300)
    ]
    got, _ = fill(spark, data, list(bridge))

    def hour(t):
        return t.replace(minute=0)

    def good(v, q):
        return v is not None and v != 9999.0 and q is not None and q not in BAD

    want = {}
    for i, st, ts, v, q in data:
        if good(v, q):
            want[i] = v
        elif v is None or v == 9999.0:
            around = [
                x for _, s, t, x, y in data if (st, s) in bridge and hour(t) == hour(ts) and good(x, y)
            ]
            if around:
                want[i] = sum(around) / len(around)
    assert got == pytest.approx(want)


def test_two_measures_keep_rows_with_either(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", T, 1.0, None), (2, "a", T, None, 4.0), (3, "b", T, None, None)],
        "id int, st string, ts timestamp_ntz, v double, w double",
    )
    bridge = spark.createDataFrame([("a", "a"), ("b", "b")], "station_id string, neighbor_id string")
    out = impute.impute_neighbors(df, bridge, "st", "ts", [Measure("v"), Measure("w", out="W")], ["id"])
    assert rows(out, "id", "v", "W") == [(1, 1.0, 4.0), (2, 1.0, 4.0)]


def test_neighborhood_stats(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", T, 10.0), (2, "b", T, 20.0), (3, "b", T, None), (4, "x", T, 2.0)],
        "id int, st string, ts timestamp_ntz, v double",
    )
    bridge = spark.createDataFrame(
        [("a", "a"), ("a", "b"), ("a", "x"), ("b", "b")], "station_id string, neighbor_id string"
    )
    out = impute.neighborhood_stats(df, bridge, "st", "ts", {"v": {"avg": "av", "min": "lo"}}, ["id"])
    assert rows(out, "id", "av", "lo") == [(1, 32 / 3, 2.0), (2, 20.0, 20.0), (3, None, None)]


def test_fill_chain_has_no_nulls(spark, tmp_path):
    train = spark.createDataFrame(
        [("a", "b", 1.0, None), ("a", "c", None, 4.0), ("b", "b", 5.0, 6.0)],
        "o string, d string, x_o double, x_d double",
    )
    stats = spark.createDataFrame([("a", 10.0), ("b", 20.0)], "st string, x double")
    model = ImputationModel("st", {"o": {"x_o": "x"}, "d": {"x_d": "x"}}).fit(train, stats)
    # means of the filled training rows: x_o = (1 + 10 + 5) / 3, x_d = (20 + 4 + 6) / 3
    new = spark.createDataFrame(
        [(1, "a", "zz", None, None), (2, "zz", "b", None, None), (3, "a", "a", 0.5, 0.25), (4, None, None, None, 1.0)],
        "id int, o string, d string, x_o double, x_d double",
    )
    want = {1: (10.0, 10.0), 2: (16 / 3, 20.0), 3: (0.5, 0.25), 4: (16 / 3, 1.0)}
    out = model.transform(new)
    assert out.columns == new.columns
    assert {r.id: (r.x_o, r.x_d) for r in out.collect()} == want
    model.save(str(tmp_path / "m"))
    again = ImputationModel("st", model.roles).load(spark, str(tmp_path / "m"))
    assert {r.id: (r.x_o, r.x_d) for r in again.transform(new).collect()} == want


def test_all_null_column_stays_null_when_never_seen(spark):
    train = spark.createDataFrame([("a", None)], "k string, x double")
    model = ImputationModel("k", {"k": {"x": "m"}}).fit(
        train, impute.fit_group_stats(train, "k", {"m": F.avg("x")})
    )
    assert model.transform(train).first()["x"] is None


def test_places_give_the_same_fill_as_sensors(spark):
    rnd = Random(7)
    spots = [(40.0, -75.0), (40.2, -75.1), (44.0, -80.0)]
    points = spark.createDataFrame(
        [(f"s{i}", *spots[0 if i < 6 else rnd.randrange(3)]) for i in range(10)], "st string, lat double, lon double"
    )
    df = spark.createDataFrame(
        [
            (i, f"s{rnd.randrange(10)}", T + timedelta(minutes=rnd.randrange(200)), rnd.choice([None, float(rnd.randrange(40))]), "1")
            for i in range(150)
        ],
        SCHEMA,
    )

    def filled(frame, places, key):
        bridge = geo.radius_neighbors(places, key, "lat", "lon", 50.0).select(
            F.col(key).alias("station_id"), "neighbor_id"
        )
        out = impute.impute_neighbors(frame, bridge, key, "ts", [Measure("v", "q")], ["id"])
        return {r.id: r.v for r in out.collect()}

    at = geo.colocated(points, "st", "lat", "lon")
    places = at.select("place", "lat", "lon").distinct()
    assert places.count() == 3
    by_place = filled(df.join(at.select("st", "place"), "st"), places, "place")
    assert by_place == pytest.approx(filled(df, points, "st"))


@pytest.mark.parametrize("cell_rows", [3, 2000])
def test_surroundings_equal_the_neighbour_list(spark, rows, monkeypatch, cell_rows):
    monkeypatch.setattr(geo.met_within, "__defaults__", (cell_rows, geo.MET_WIDTH))
    rnd = Random(3)
    spots = [(i, 40 + rnd.uniform(-1, 1), -100 + rnd.uniform(-1, 1)) for i in range(30)]
    spots += [(30 + i, rnd.uniform(-1, 1), rnd.choice([-1, 1]) * 179.9) for i in range(5)]
    spots += [(35 + i, 89.9, rnd.uniform(-180, 180)) for i in range(4)] + [(39, 89.9, None), (40, None, None), (41, float("nan"), 3.0)]
    stations = spark.createDataFrame(spots, "station_id int, lat double, lon double")
    # station 99 is not listed; an unknown instant has no neighbours
    data = [
        (k, rnd.choice([*range(42), 99]), rnd.choice([T, T + timedelta(hours=1), None]),
         rnd.choice([None, float(rnd.randrange(90))]), rnd.choice(["1", "2"]))
        for k in range(400)
    ]
    df = spark.createDataFrame(data, SCHEMA.replace("st string", "st int"))
    clean = stations.withColumn("lat", F.when(~F.isnan("lat"), F.col("lat")))
    bridge = geo.radius_neighbors(clean, "station_id", "lat", "lon", 40.0)
    places = impute.Surroundings(stations, 40.0)
    fills = [impute.impute_neighbors(df, b, "st", "ts", [Measure("v", "q")], ["id", "st", "ts"]) for b in (bridge, places)]
    assert rows(fills[0], "id", "v") == rows(fills[1], "id", "v")
    spec = {"v": {"avg": "av", "min": "lo"}}
    stats = [impute.neighborhood_stats(df, b, "st", "ts", spec, ["id"]) for b in (bridge, places)]
    assert rows(stats[0], "id", "av", "lo") == rows(stats[1], "id", "av", "lo")


@pytest.mark.parametrize("name", ["impute_neighbors", "neighborhood_stats", "impute_three_phase"])
def test_no_list_of_station_pairs_is_made(spark, monkeypatch, name):
    """Its pairs grow with the square of the stations."""

    def refuse(*_):
        raise AssertionError("pairs of stations were listed")

    monkeypatch.setattr(geo, "radius_neighbors", refuse)
    assert plans.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
