"""The whole path on a small made-up fixture, checked against plain Python."""

from datetime import datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from spanfeat.operators import geo, graph
from spanfeat.plans import features
from spanfeat.session import staged

AIRPORTS = [  # IATA, usaf, wban, lat, lon, zone
    ("AAA", "000001", "00001", 40.0, -75.0, "America/New_York"),
    ("BBB", "000002", "00002", 41.9, -87.9, "America/Chicago"),
    ("CCC", "000003", "00003", 33.9, -118.4, "America/Los_Angeles"),
]
EXTRA = ("000009", "00009", 40.2, -75.1)  # station next to AAA without an airport
START = datetime(2017, 12, 20)


def weather_rows():
    rnd = Random(1)
    out = []
    for day_hour in range(24 * 40):
        for usaf, wban, lat, lon in [a[1:5] for a in AIRPORTS] + [EXTRA]:
            if usaf == "000003":
                continue  # CCC never reports: phases two and three
            speed = rnd.choice(["0010", "0020", "9999", "0035"])
            quality = rnd.choice(["1", "1", "5", "2"])
            out.append(
                (
                    usaf + wban,
                    START + timedelta(hours=day_hour, minutes=rnd.randrange(60)),
                    "4",
                    lat,
                    lon,
                    "10",
                    "st " + usaf,
                    rnd.choice(["FM-15", "FM-16"]),
                    "KXXX",
                    "V020",
                    f"120,{quality},N,{speed},{quality}",
                    "00300,1,9,N",
                    "016000,1,N,1",
                    "+0012,1",
                    "-0043,1",
                    "10120,1",
                )
            )
    return out


WEATHER_SCHEMA = (
    "STATION string, DATE timestamp_ntz, SOURCE string, LATITUDE double, LONGITUDE double, ELEVATION string, "
    "NAME string, REPORT_TYPE string, CALL_SIGN string, QUALITY_CONTROL string, WND string, CIG string, VIS string, "
    "TMP string, DEW string, SLP string"
)


def flight_rows():
    rnd = Random(2)
    out = []
    for i in range(240):
        o, d = rnd.sample([a[0] for a in AIRPORTS], 2)
        day = START + timedelta(days=rnd.randrange(1, 38))
        dep = rnd.randrange(24) * 100 + rnd.randrange(60)
        arr = (dep // 100 + 3) % 24 * 100 + dep % 100
        out.append((i, day.strftime("%Y-%m-%d"), f"N{rnd.randrange(6)}", o, d, dep, arr, rnd.randrange(2), 100.0 + rnd.randrange(60)))
    return out


@pytest.fixture(scope="module")
def flow(spark):
    weather = spark.createDataFrame(weather_rows(), WEATHER_SCHEMA)
    stations = spark.createDataFrame(
        [(u, w, "US", "20100101", "20991231") for _, u, w, *_ in AIRPORTS]
        + [(*EXTRA[:2], "US", "20100101", "20991231"), ("000007", "00007", "CA", "20100101", "20991231")],
        "usaf string, wban string, country string, begin string, end string",
    )
    flights = spark.createDataFrame(
        flight_rows(),
        "id int, FL_DATE string, TAIL_NUM string, ORIGIN string, DEST string, CRS_DEP_TIME int, CRS_ARR_TIME int, "
        "DEP_DEL15 int, CRS_ELAPSED_TIME double",
    )
    zones = spark.createDataFrame([(a[0], a[5]) for a in AIRPORTS], "IATA string, tz string")
    timed = features.flight_times(flights, zones)
    ranks = graph.pagerank(graph.edge_weights(flights, "ORIGIN", "DEST"))
    meta = spark.createDataFrame(
        [(a[0], a[1] + a[2], "name " + a[0], a[3], a[4]) for a in AIRPORTS],
        "IATA string, STATION string, NAME string, lat double, lon double",
    ).join(ranks.select(F.col("node").alias("IATA"), F.col("rank").alias("pagerank")), "IATA")
    places = spark.createDataFrame(
        [(a[1] + a[2], a[3], a[4]) for a in AIRPORTS] + [(EXTRA[0] + EXTRA[1], *EXTRA[2:])],
        "station_id string, lat double, lon double",
    )
    bridge = staged(geo.radius_neighbors(places, "station_id", "lat", "lon", 50.0))
    imputed = staged(features.impute_weather(features.clean_weather(weather, stations), bridge))
    hubs = spark.createDataFrame([("BBB",)], "ORIGIN string")
    cuts = [datetime(2018, 1, 8), datetime(2018, 1, 16)]
    holidays = [(datetime(2017, 12, 24), datetime(2018, 1, 2))]
    table = features.feature_table(timed, meta, imputed, bridge, hubs, holidays, cuts)
    return timed.toPandas(), imputed.toPandas(), table.toPandas()


def test_every_flight_once_and_no_gaps(flow):
    timed, _, table = flow
    assert len(table) == len(timed) == 240 and table["id"].is_unique
    weather = [f"{n}_{r}" for n in features.METRIC_NAMES for r in ("ORIGIN", "DEST")]
    assert table[[*weather, "DELAYS_SO_FAR", "NETWORK_CONGESTION", "ORIGIN_PR", "DEST_PR"]].notna().all().all()
    assert set(table["split"]) == {"train", "validation", "test"}


def test_arrival_is_after_departure(flow):
    _, _, table = flow
    assert (table["DEST_UTC"] >= table["ORIGIN_UTC"]).all()


def test_delays_and_congestion(flow):
    _, _, t = flow
    lag = timedelta(hours=2)
    for r in t.itertuples():
        past = t[(t["DEP_DEL15"] == 1) & (t["ORIGIN_UTC"] <= r.ORIGIN_UTC - lag) & (t["ORIGIN_UTC"].dt.date == r.ORIGIN_UTC.date())]
        assert r.DELAYS_SO_FAR == (past["TAIL_NUM"] == r.TAIL_NUM).sum()
        assert r.NETWORK_CONGESTION == (past["ORIGIN"] == "BBB").sum()


def test_volume_and_route_difference(flow):
    _, _, t = flow
    train = t[t["split"] == "train"]
    for r in t.itertuples():
        dep = ((t["ORIGIN"] == r.ORIGIN) & (t["ORIGIN_UTC"].dt.date == r.ORIGIN_UTC.date())).sum()
        arr = ((t["DEST"] == r.ORIGIN) & (t["DEST_UTC"].dt.date == r.ORIGIN_UTC.date())).sum()
        assert r.ORIGIN_FLIGHT_COUNT == dep + arr
        mean = train[(train["ORIGIN"] == r.ORIGIN) & (train["DEST"] == r.DEST)]["CRS_ELAPSED_TIME"].mean()
        assert r.CRS_ELAPSED_TIME_AVG_DIFF == pytest.approx(r.CRS_ELAPSED_TIME - mean)
        assert r.WEST_TO_EAST == int({"AAA": 3, "BBB": 2, "CCC": 1}[r.DEST] > {"AAA": 3, "BBB": 2, "CCC": 1}[r.ORIGIN])


def test_held_out_weather_is_the_latest_plain_reading(flow):
    _, w, t = flow
    held = t[(t["split"] != "train") & (t["ORIGIN"] == "BBB")]
    assert len(held) > 5
    for r in held.itertuples():
        known = w[
            (w["STATION"] == "00000200002")
            & (w["DATE"] <= r.ORIGIN_UTC - timedelta(hours=2))
            & (w["DATE"] >= r.ORIGIN_UTC - timedelta(hours=50))
        ]
        at = known["DATE"].max()
        assert r.ORIGIN_MAX_DATE == at
        reading = known[known["DATE"] == at]["WND_SPEED"].mean()
        if reading == reading:
            assert r.AVG_WND_SPEED_ORIGIN == pytest.approx(reading)


def test_station_without_reports_gets_the_training_mean(flow):
    _, _, t = flow
    silent = t[t["ORIGIN"] == "CCC"]["AVG_WND_SPEED_ORIGIN"]
    assert silent.nunique() == 1
    train = t[(t["split"] == "train") & (t["ORIGIN"] != "CCC")]
    assert silent.iloc[0] == pytest.approx(train["AVG_WND_SPEED_ORIGIN"].mean())
