"""Measure merging and the three imputation phases, on events read as sensor readings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.timeexpr import instant
from ..operators import impute
from ..operators.splits import slice_between
from ..session import settle, staged
from .catalog import miles_sql, query, table

# Readings: every user is a station; sentinels and quality codes sit at fixed places.
# Values are whole hundredths, so that sums do not depend on the order of addition.
READINGS_SQL = """
    obs AS (SELECT event_id, user_id AS station, ts,
              CASE WHEN event_id % 7 = 0 THEN 9999e0 ELSE round(value * 100) END AS v, (event_id % 10)::VARCHAR AS vq,
              CASE WHEN event_id % 11 = 0 THEN 999e0 WHEN event_id % 13 = 0 THEN NULL
                   ELSE round(value * 100) * 2 + 1 END AS w,
              CASE WHEN event_id % 17 <> 0 THEN (event_id % 9)::VARCHAR END AS wq
            FROM events)
"""
STATIONS_SQL = """
    st AS (SELECT DISTINCT user_id AS id, 30e0 + (user_id * 7919 % 1009) / 200e0 AS lat,
                  -100e0 + (user_id * 104729 % 2003) / 400e0 AS lon FROM events),
    bridge AS MATERIALIZED (SELECT a.id AS station_id, b.id AS neighbor_id FROM st a, st b
               WHERE a.id = b.id OR {miles} <= 25)
""".format(miles=miles_sql("a", "b"))

# Per station and hour the sum and number of good readings; these are spread over the
# neighbour list, and a missing reading looks up the mean of its own station and hour.
FILLED_SQL = """
    marked AS (SELECT event_id, station, ts, date_trunc('hour', ts) AS hour,
                 coalesce(v = 9999, TRUE) AS no_v, coalesce(w = 999, TRUE) AS no_w,
                 CASE WHEN v <> 9999 AND vq NOT IN ('2', '3', '6', '7') THEN v END AS good_v,
                 CASE WHEN w <> 999 AND wq NOT IN ('2', '3', '6', '7') THEN w END AS good_w FROM obs),
    sums AS (SELECT station, hour, sum(good_v) AS sv, count(good_v) AS nv, sum(good_w) AS sw, count(good_w) AS nw
             FROM marked GROUP BY station, hour),
    means AS MATERIALIZED (SELECT station_id, hour, sum(sv) / nullif(sum(nv), 0) AS mv, sum(sw) / nullif(sum(nw), 0) AS mw
              FROM sums, bridge WHERE neighbor_id = station GROUP BY station_id, hour),
    filled AS MATERIALIZED (SELECT event_id, station, ts, hour,
                CASE WHEN no_v THEN (SELECT mv FROM means WHERE station_id = station AND means.hour = marked.hour)
                     ELSE good_v END AS v,
                CASE WHEN no_w THEN (SELECT mw FROM means WHERE station_id = station AND means.hour = marked.hour)
                     ELSE good_w END AS w FROM marked)
"""

MEASURES = [
    impute.Measure("v", "vq", (9999.0,)),
    impute.Measure("w", "wq", (999.0,)),
]
TRAIN_END = datetime(2024, 1, 21)


def readings(spark, folder):
    e, hundredths = F.col("event_id"), F.round(F.col("value") * 100)
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("station"),
        "ts",
        F.when(e % 7 == 0, 9999.0).otherwise(hundredths).alias("v"),
        (e % 10).cast("string").alias("vq"),
        F.when(e % 11 == 0, 999.0)
        .when(e % 13 == 0, None)
        .otherwise(hundredths * 2 + 1)
        .alias("w"),
        F.when(e % 17 != 0, (e % 9).cast("string")).alias("wq"),
    )


def surroundings(spark, folder):
    """Every station with all others within 25 miles."""
    u = F.col("user_id")
    stations = (
        table(spark, folder, "events")
        .select("user_id")
        .distinct()
        .select(
            u.alias("station_id"),
            (30.0 + F.pmod(u * 7919, F.lit(1009)) / 200.0).alias("lat"),
            (-100.0 + F.pmod(u * 104729, F.lit(2003)) / 400.0).alias("lon"),
        )
    )
    return impute.Surroundings(settle(stations), 25.0)


def neighbour_filled(spark, folder):
    """Phase one on both measures, and the neighbourhoods it used."""
    bridge = surroundings(spark, folder)
    filled = impute.impute_neighbors(
        readings(spark, folder), bridge, "station", "ts", MEASURES, keep=["event_id", "station", "ts"]
    )
    return filled, bridge


@query(
    "impute_neighbors",
    f"""
    WITH {READINGS_SQL}, {STATIONS_SQL}, {FILLED_SQL}
    SELECT event_id, station, round(v, 6) AS v, round(w, 6) AS w FROM filled WHERE coalesce(v, w) IS NOT NULL
    """,
)
def impute_neighbors(spark, folder):
    filled, _ = neighbour_filled(spark, folder)
    return filled.select(
        "event_id", "station", F.round("v", 6).alias("v"), F.round("w", 6).alias("w")
    )


@query(
    "neighborhood_stats",
    f"""
    WITH {READINGS_SQL}, {STATIONS_SQL}, {FILLED_SQL},
    known AS (FROM filled WHERE coalesce(v, w) IS NOT NULL),
    levels AS (SELECT station, hour, sum(v) AS sv, count(v) AS nv, min(v) AS lv, sum(w) AS sw, count(w) AS nw
               FROM known GROUP BY station, hour),
    around AS (SELECT station_id, hour, sum(sv) / nullif(sum(nv), 0) AS av, min(lv) AS lv,
                      sum(sw) / nullif(sum(nw), 0) AS aw FROM levels, bridge WHERE neighbor_id = station
               GROUP BY station_id, hour)
    SELECT event_id, CASE WHEN v IS NOT NULL THEN round(av, 6) END AS avg_v,
           CASE WHEN v IS NOT NULL THEN round(lv, 6) END AS min_v,
           CASE WHEN w IS NOT NULL THEN round(aw, 6) END AS avg_w
    FROM known, around WHERE station = station_id AND known.hour = around.hour
    """,
)
def neighborhood_stats(spark, folder):
    filled, bridge = neighbour_filled(spark, folder)
    out = impute.neighborhood_stats(
        staged(filled, "imputed"),
        bridge,
        "station",
        "ts",
        {"v": {"avg": "avg_v", "min": "min_v"}, "w": {"avg": "avg_w"}},
        keep=["event_id"],
    )
    return out.select("event_id", *[F.round(c, 6).alias(c) for c in ("avg_v", "min_v", "avg_w")])


def cleaned(spark, folder):
    """Readings with sentinels as nulls; every third station has none at all in training."""
    known = (F.col("event_id") % 7 != 0) & (
        (F.col("station") % 3 != 0) | (F.col("ts") >= instant(TRAIN_END))
    )
    return readings(spark, folder).select(
        "event_id", "station", "ts", F.when(known, F.col("v")).alias("v"), F.when(known, F.col("v")).alias("low")
    )


CLEANED_SQL = """
    obs AS (SELECT event_id, user_id AS station, ts, CASE WHEN event_id % 7 <> 0
              AND (user_id % 3 <> 0 OR ts >= TIMESTAMP '2024-01-21') THEN round(value * 100) END AS v FROM events),
    fit AS (SELECT station, avg(v) AS a, min(v) AS m FROM obs WHERE ts < TIMESTAMP '2024-01-21' GROUP BY station)
"""


@query(
    "impute_group_mean",
    f"""
    WITH {CLEANED_SQL}
    SELECT event_id, round(coalesce(v, a), 6) AS v, round(coalesce(v, m), 6) AS low
    FROM obs LEFT JOIN fit ON obs.station = fit.station
    """,
)
def impute_group_mean(spark, folder):
    rows = cleaned(spark, folder)
    fitted = impute.fit_group_stats(
        slice_between(rows, "ts", end=TRAIN_END), "station", {"avg_v": F.avg("v"), "min_v": F.min("v")}
    )
    out = impute.fill_from(rows, fitted, "station", "station", {"v": "avg_v", "low": "min_v"})
    return out.select("event_id", F.round("v", 6).alias("v"), F.round("low", 6).alias("low"))


@query(
    "impute_global_mean",
    f"""
    WITH {CLEANED_SQL}, g AS (SELECT avg(v) AS a FROM obs WHERE ts < TIMESTAMP '2024-01-21')
    SELECT event_id, round(coalesce(v, a), 6) AS v FROM obs, g
    """,
)
def impute_global_mean(spark, folder):
    rows = cleaned(spark, folder)
    means = impute.fit_global_stats(slice_between(rows, "ts", end=TRAIN_END), ["v"])
    return impute.fill_global(rows, means, ["v"]).select("event_id", F.round("v", 6).alias("v"))


@query(
    "impute_three_phase",
    f"""
    WITH {READINGS_SQL}, {STATIONS_SQL}, {FILLED_SQL},
    fit AS (SELECT station, avg(v) AS av, avg(w) AS aw FROM filled
            WHERE ts < TIMESTAMP '2024-01-21' AND station % 4 <> 0 GROUP BY station),
    two AS (SELECT event_id, filled.ts, coalesce(v, av) AS v, coalesce(w, aw) AS w
            FROM filled LEFT JOIN fit ON filled.station = fit.station),
    g AS (SELECT avg(v) AS gv, avg(w) AS gw FROM two WHERE ts < TIMESTAMP '2024-01-21')
    SELECT event_id, round(coalesce(v, gv), 6) AS v, round(coalesce(w, gw), 6) AS w FROM two, g
    """,
)
def impute_three_phase(spark, folder):
    """Neighbours, then station means, then global means; some stations are unseen in training."""
    filled, _ = neighbour_filled(spark, folder)
    rows = (
        readings(spark, folder)
        .select("event_id", "station", "ts")
        .join(staged(filled, "imputed").select("event_id", "v", "w"), "event_id", "left")
    )
    train = slice_between(rows, "ts", end=TRAIN_END)
    fitted = impute.fit_group_stats(
        train.filter(F.pmod("station", F.lit(4)) != 0),
        "station",
        {"avg_v": F.avg("v"), "avg_w": F.avg("w")},
    )
    model = impute.ImputationModel("station", {"station": {"v": "avg_v", "w": "avg_w"}})
    out = model.fit(train, fitted).transform(rows)
    return out.select("event_id", F.round("v", 6).alias("v"), F.round("w", 6).alias("w"))
