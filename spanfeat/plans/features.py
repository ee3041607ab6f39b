"""From raw flights and hourly weather to null-free, time-split feature tables.

Each step takes and returns frames, so a caller may persist any of them with
``sources.writers.checkpoint_stage`` and go on from the stored copy.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bins, packed, timeexpr
from ..functions.geoexpr import eastward_flag
from ..operators import impute, joins, spans, stats
from ..operators.impute import ImputationModel, Measure
from ..operators.quality import exclude_flagged
from ..operators.skew import spread_join
from ..operators.splits import slice_between, temporal_split
from ..session import staged

# Descriptive columns that identify a weather row.
WEATHER_KEYS = (
    "YEAR",
    "MONTH",
    "DAY_OF_MONTH",
    "STATION",
    "DATE",
    "SOURCE",
    "LATITUDE",
    "LONGITUDE",
    "ELEVATION",
    "NAME",
    "REPORT_TYPE",
    "CALL_SIGN",
    "QUALITY_CONTROL",
    "country",
)
# Reading, quality column, missing-value code and output name per measure.
WEATHER_MEASURES = (
    Measure("WND_Speed", "WND_Speed_Qlty", (9999,), "WND_SPEED"),
    Measure("CIG_Height", "CIG_Qlty", (99999,), "CIG_HEIGHT"),
    Measure("VIS_Dis", "VIS_Qlty", (999999,), "VIS_DIS"),
    Measure("TMP_Degree", "TMP_Qlty", (9999,), "TMP_DEGREE"),
    Measure("DEW_Degree", "DEW_Qlty", (9999,), "DEW_DEGREE"),
    Measure("SLP_Pressure", "SLP_Qlty", (99999,), "SLP_PRESSURE"),
)
# Statistics kept per measure.
WEATHER_METRICS = {
    "WND_SPEED": {"avg": "AVG_WND_SPEED"},
    "CIG_HEIGHT": {"avg": "AVG_CIG_HEIGHT", "min": "MIN_CIG_HEIGHT"},
    "VIS_DIS": {"avg": "AVG_VIS_DIS", "min": "MIN_VIS_DIS"},
    "TMP_DEGREE": {"avg": "AVG_TMP_DEG"},
    "DEW_DEGREE": {"avg": "AVG_DEW_DEG"},
    "SLP_PRESSURE": {"avg": "AVG_SLP"},
}
METRIC_NAMES = tuple(n for kinds in WEATHER_METRICS.values() for n in kinds.values())


def _metric(kind: str, col: str) -> Column:
    return {"avg": F.avg, "min": F.min}[kind](col)


def clean_weather(
    weather: DataFrame, stations: DataFrame, country: str = "US", active_only: bool = True
) -> DataFrame:
    """Date parts, hour block, stations of one country, and split packed readings.

    ``active_only=False`` skips the test that the station was active, for periods
    beyond the end dates of the station list.
    """
    dims = stations.filter(F.col("country") == country).select(
        packed.composite_key(F.col("usaf"), F.col("wban")).alias("STATION"),
        "country",
        timeexpr.parse_day(F.col("begin")).alias("_begin"),
        timeexpr.parse_day(F.col("end")).alias("_end"),
    )
    dated = weather.withColumns(
        {
            "YEAR": F.year("DATE"),
            "MONTH": F.month("DATE"),
            "DAY_OF_MONTH": F.dayofmonth("DATE"),
            "HOUR_BLOCK": timeexpr.hour_block(F.col("DATE")),
        }
    )
    if active_only:
        joined = joins.validity_join(dated, dims, "STATION", "DATE", "_begin", "_end", timedelta(hours=24))
    else:
        joined = dated.join(dims, "STATION")
    layouts = {c: v for c, v in packed.WEATHER_LAYOUTS.items() if c in weather.columns}
    return packed.split_packed(joined.drop("_begin", "_end"), layouts)


def impute_weather(cleaned: DataFrame, bridge: DataFrame) -> DataFrame:
    """Phase one for all measures at once."""
    return impute.impute_neighbors(
        cleaned, bridge, "STATION", "DATE", WEATHER_MEASURES, [k for k in WEATHER_KEYS if k in cleaned.columns]
    )


def smooth_weather(imputed: DataFrame, bridge: DataFrame) -> DataFrame:
    """Mean and minimum over each station's neighbours in the same hour."""
    keys = [k for k in WEATHER_KEYS if k in imputed.columns]
    return impute.neighborhood_stats(imputed, bridge, "STATION", "DATE", WEATHER_METRICS, keys)


def plain_weather(imputed: DataFrame) -> DataFrame:
    """Imputed readings under the names of the smoothed metrics, for held-out slices."""
    keys = [k for k in WEATHER_KEYS if k in imputed.columns]
    return imputed.select(
        *keys, *[F.col(c).alias(n) for c, kinds in WEATHER_METRICS.items() for n in kinds.values()]
    )


def flight_times(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Local and UTC times of both ends, from the flight date, clock numbers and airport zones.

    ``airports`` has IATA and tz; flights of unknown airports are dropped.
    """
    zoned = flights
    for role in ("ORIGIN", "DEST"):
        zones = airports.select(F.col("IATA").alias(role), F.col("tz").alias(f"{role}_TZ"))
        zoned = zoned.join(zones, role)
    day = F.to_timestamp_ntz(F.col("FL_DATE").cast("string"))
    timed = zoned.withColumn("ORIGIN_TS", timeexpr.clock_to_ts(day, F.col("CRS_DEP_TIME"))).withColumn(
        "ORIGIN_UTC", timeexpr.to_utc(F.col("ORIGIN_TS"), F.col("ORIGIN_TZ"))
    )
    arrival = timeexpr.clock_to_ts(day, F.col("CRS_ARR_TIME"))
    return (
        timed.withColumns({"DEST_TS": arrival, "DEST_UTC": timeexpr.to_utc(arrival, F.col("DEST_TZ"))})
        .withColumns(
            {
                "DEST_TS": F.when(F.col("DEST_UTC") < F.col("ORIGIN_UTC"), F.col("DEST_TS") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("DEST_TS")),
                "DEST_UTC": timeexpr.roll_after(F.col("ORIGIN_UTC"), F.col("DEST_UTC")),
            }
        )
        .withColumns(
            {
                "DEP_HOUR": F.hour("ORIGIN_TS"),
                "DEP_MIN": F.minute("ORIGIN_TS"),
                "ARR_HOUR": F.hour("DEST_TS"),
                "ARR_MIN": F.minute("DEST_TS"),
            }
        )
    )


def attach_stations(flights: DataFrame, airport_meta: DataFrame) -> DataFrame:
    """Station, coordinates and PageRank of both airports; unknown airports drop the flight."""
    named = airport_meta.select(
        "IATA",
        F.col("STATION"),
        F.col("NAME").alias("STATION_NAME"),
        F.col("pagerank").alias("PR"),
        F.col("lon").alias("LON"),
    )
    return joins.join_roles(
        flights,
        named,
        "IATA",
        {"ORIGIN": "ORIGIN_", "DEST": "DEST_"},
        ["STATION", "STATION_NAME", "PR", "LON"],
        how="inner",
    )


def attach_weather(
    flights: DataFrame,
    weather: DataFrame,
    min_lag: timedelta = timedelta(hours=2),
    max_age: timedelta = timedelta(hours=50),
) -> DataFrame:
    """Latest weather known before departure at both ends, one output row per flight."""
    out = timeexpr.lookback_bounds(
        flights, "ORIGIN_UTC", min_lag, max_age, "ORIGIN_UTC_ADJ_MIN", "ORIGIN_UTC_ADJ_MAX"
    )
    return spans.asof_join_roles(
        out,
        weather,
        {"ORIGIN": "ORIGIN_STATION", "DEST": "DEST_STATION"},
        "STATION",
        "ORIGIN_UTC",
        "DATE",
        {n: _metric(kind, n) for kinds in WEATHER_METRICS.values() for kind, n in kinds.items()},
        min_lag,
        max_age,
    )


def flight_features(
    flights: DataFrame,
    hubs: DataFrame,
    holidays: Sequence[tuple[datetime, datetime]] | DataFrame,
    train_end: datetime,
) -> DataFrame:
    """Time-window, calendar and route features.

    ``hubs`` lists the central airports in a column ORIGIN. Route means are taken on
    flights before ``train_end``; flights of routes unseen there get difference 0.
    """
    volume = stats.daily_volume(
        flights, {"departures": ("ORIGIN", "ORIGIN_UTC"), "arrivals": ("DEST", "DEST_UTC")}
    ).withColumn("_flights", F.col("departures") + F.col("arrivals"))
    out = flights.withColumns(
        {"_ORIGIN_DAY": F.to_date("ORIGIN_UTC"), "_DEST_DAY": F.to_date("DEST_UTC")}
    )
    for role in ("ORIGIN", "DEST"):
        side = volume.select(
            F.col("entity").alias(role),
            F.col("day").alias(f"_{role}_DAY"),
            F.col("_flights").alias(f"{role}_FLIGHT_COUNT"),
        )
        out = spread_join(out, side, [role, f"_{role}_DAY"], how="left")
    out = out.drop("_ORIGIN_DAY", "_DEST_DAY")

    late = F.col("DEP_DEL15") == 1
    out = spans.events_so_far(out, "TAIL_NUM", "ORIGIN_UTC", late, out="DELAYS_SO_FAR")
    out = spans.hub_events_so_far(out, hubs, "ORIGIN", "ORIGIN_UTC", late, out="NETWORK_CONGESTION")
    train = slice_between(flights, "ORIGIN_UTC", end=train_end)
    out = stats.group_mean_diff(
        out, ["ORIGIN", "DEST"], "CRS_ELAPSED_TIME", "CRS_ELAPSED_TIME_AVG_DIFF", train
    )
    out = spans.range_flag(out, "ORIGIN_UTC", holidays, "HOLIDAY_WEEK", "HOLIDAY_WEEK_BEGIN", "HOLIDAY_WEEK_END")
    minutes = timeexpr.minutes_after_midnight
    out = out.withColumns(
        {
            "CRS_ELAPSED_TIME_AVG_DIFF": F.coalesce("CRS_ELAPSED_TIME_AVG_DIFF", F.lit(0.0)),
            "WEST_TO_EAST": eastward_flag(F.col("ORIGIN_LON"), F.col("DEST_LON")),
            "MINUTES_AFTER_MIDNIGHT_ORIGIN": minutes(F.col("ORIGIN_UTC")),
            "MINUTES_AFTER_MIDNIGHT_DEST": minutes(F.col("DEST_UTC")),
            "DEP_HOUR_BIN": bins.bin_by_edges(F.col("DEP_HOUR"), bins.DAY_PART_LAST_HOURS),
            "ARR_HOUR_BIN": bins.bin_by_edges(F.col("ARR_HOUR"), bins.DAY_PART_LAST_HOURS),
        }
    )
    return out.withColumns(
        {
            "IS_MORNING_FLIGHT": bins.flag_in(F.col("DEP_HOUR_BIN"), [bins.MORNING_BIN]),
            "IS_EVENING_FLIGHT": bins.flag_in(F.col("DEP_HOUR_BIN"), [bins.EVENING_BIN]),
            "IS_EARLY_MORNING_FLIGHT": bins.flag_range(F.col("MINUTES_AFTER_MIDNIGHT_ORIGIN"), 0, 360),
        }
    )


def weather_model(train_flights: DataFrame, train_weather: DataFrame) -> ImputationModel:
    """Phases two and three, fitted on training flights and training weather."""
    station_stats = impute.fit_group_stats(
        train_weather,
        "STATION",
        {n: _metric(kind, c) for c, kinds in WEATHER_METRICS.items() for kind, n in kinds.items()},
    )
    roles = {
        f"{role}_STATION": {f"{n}_{role}": n for n in METRIC_NAMES} for role in ("ORIGIN", "DEST")
    }
    return ImputationModel("STATION", roles).fit(train_flights, station_stats)


def feature_table(
    flights: DataFrame,
    airport_meta: DataFrame,
    weather_imputed: DataFrame,
    bridge: DataFrame,
    hubs: DataFrame,
    holidays: Sequence[tuple[datetime, datetime]] | DataFrame,
    cuts: Sequence[datetime],
    smooth_held_out: bool = False,
) -> DataFrame:
    """All flights that took place, with features, a ``split`` column and no missing weather.

    Training flights see smoothed weather, held-out flights unsmoothed weather unless
    ``smooth_held_out`` is set. Everything fitted is fitted on flights before the
    first cut. Tables used more than once are staged in the shared folder.
    """
    flights = exclude_flagged(flights, [c for c in ("CANCELLED", "DIVERTED") if c in flights.columns])
    imputed = staged(weather_imputed, "weather_imputed")
    smoothed = staged(smooth_weather(imputed, bridge), "weather_metrics")
    featured = flight_features(attach_stations(flights, airport_meta), hubs, holidays, cuts[0])
    split = staged(temporal_split(featured, "ORIGIN_UTC", cuts), "flights")
    held_out_weather = smoothed if smooth_held_out else plain_weather(imputed)
    train = attach_weather(split.filter(F.col("split") == "train"), smoothed)
    held_out = attach_weather(split.filter(F.col("split") != "train"), held_out_weather)
    joined = staged(train.unionByName(held_out), "joined")
    model = weather_model(
        joined.filter(F.col("split") == "train"), slice_between(imputed, "DATE", end=cuts[0])
    )
    return model.transform(joined)
