"""Look-back joins, running counts, date expressions and time-ordered splits."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ..functions import bins, timeexpr
from ..operators import quality, spans, splits, stats
from .catalog import query, table

# Readings of one instant count as one; the latest is found first and then checked for age.
VIEWS_SQL = """
    views AS (SELECT user_id, ts, avg(value) AS mean, min(value) AS low FROM events
              WHERE event_type = 'view' GROUP BY user_id, ts)
"""
ASOF_SQL = f"""
    WITH {VIEWS_SQL}, latest AS (
      SELECT e.*, v.ts AS seen, v.mean, v.low, coalesce(v.ts >= e.ts - INTERVAL 50 HOUR, FALSE) AS fresh
      FROM events e ASOF LEFT JOIN views v ON v.user_id = e.user_id AND v.ts <= e.ts - INTERVAL 2 HOUR
      WHERE e.event_type = 'purchase')
    SELECT event_id, user_id, ts, value, CASE WHEN fresh THEN seen END AS view_ts,
           CASE WHEN fresh THEN round(mean, 6) END AS avg_view, CASE WHEN fresh THEN low END AS min_view
    FROM latest
    """


@query("asof_lookback", ASOF_SQL)
def asof_lookback(spark, folder):
    """Latest view of the same user 2 to 50 hours before each purchase."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value", "event_type")
    purchases = events.filter(F.col("event_type") == "purchase").drop("event_type")
    views = events.filter(F.col("event_type") == "view")
    return spans.asof_join(
        purchases,
        views,
        "user_id",
        "ts",
        "ts",
        {"avg_view": F.avg("value"), "min_view": F.min("value")},
        timedelta(hours=2),
        timedelta(hours=50),
        matched_ts="view_ts",
    ).withColumn("avg_view", F.round("avg_view", 6))


@query(
    "asof_two_roles",
    f"""
    WITH {VIEWS_SQL}, buys AS (
      SELECT event_id, ts, ts - INTERVAL 2 HOUR AS upto, ts - INTERVAL 50 HOUR AS since, user_id,
             (user_id * 7 + 3) % (SELECT count(DISTINCT user_id) FROM events) AS peer
      FROM events WHERE event_type = 'purchase')
    SELECT event_id, CASE WHEN own.ts >= since THEN own.ts END AS own_ts,
           CASE WHEN own.ts >= since THEN round(own.mean, 6) END AS value_own,
           CASE WHEN other.ts >= since THEN other.ts END AS peer_ts,
           CASE WHEN other.ts >= since THEN round(other.mean, 6) END AS value_peer
    FROM buys ASOF LEFT JOIN views own ON own.user_id = buys.user_id AND own.ts <= upto
    ASOF LEFT JOIN views other ON other.user_id = peer AND other.ts <= upto
    """,
)
def asof_two_roles(spark, folder):
    """Latest view of the buyer and of a fixed other user, from one scan of the views."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value", "event_type")
    size = events.agg(F.count_distinct("user_id")).first()[0]
    purchases = events.filter(F.col("event_type") == "purchase").select(
        "event_id", "ts", "user_id", F.pmod(F.col("user_id") * 7 + 3, F.lit(size)).alias("peer")
    )
    out = spans.asof_join_roles(
        purchases,
        events.filter(F.col("event_type") == "view"),
        {"own": "user_id", "peer": "peer"},
        "user_id",
        "ts",
        "ts",
        {"value": F.avg("value")},
        matched_ts="{role}_ts",
    )
    return out.select(
        "event_id",
        "own_ts",
        F.round("value_own", 6).alias("value_own"),
        "peer_ts",
        F.round("value_peer", 6).alias("value_peer"),
    )


@query(
    "lookback_bounds",
    """
    SELECT event_id, ts - INTERVAL 50 HOUR AS ts_min, ts - INTERVAL 2 HOUR AS ts_max FROM events
    """,
)
def lookback_bounds(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts")
    return timeexpr.lookback_bounds(events, "ts", timedelta(hours=2), timedelta(hours=50)).drop("ts")


@query(
    "events_so_far",
    """
    SELECT e.event_id, e.user_id, count(x.event_id) AS errors_so_far
    FROM events e LEFT JOIN events x ON x.user_id = e.user_id AND x.event_type = 'error'
      AND date_trunc('day', x.ts) = date_trunc('day', e.ts) AND x.ts <= e.ts - INTERVAL 2 HOUR
    GROUP BY e.event_id, e.user_id
    """,
)
def events_so_far(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type")
    return spans.events_so_far(
        events, "user_id", "ts", F.col("event_type") == "error", out="errors_so_far"
    ).select("event_id", "user_id", "errors_so_far")


@query(
    "hub_events_so_far",
    """
    WITH hubs AS (SELECT user_id FROM events GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 10),
         x AS (SELECT event_id, ts FROM events WHERE event_type = 'error' AND user_id IN (FROM hubs))
    SELECT e.event_id, count(x.event_id) AS congestion
    FROM events e LEFT JOIN x ON date_trunc('day', x.ts) = date_trunc('day', e.ts)
      AND x.ts <= e.ts - INTERVAL 2 HOUR
    GROUP BY e.event_id
    """,
)
def hub_events_so_far(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type")
    hubs = (
        events.groupBy("user_id")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "user_id")
        .limit(10)
        .select("user_id")
    )
    return spans.hub_events_so_far(
        events, hubs, "user_id", "ts", F.col("event_type") == "error", out="congestion"
    ).select("event_id", "congestion")


@query(
    "overlapping_intervals",
    """
    SELECT a.o_orderkey, CASE WHEN EXISTS (
        SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey
          AND (b.o_orderdate < a.o_orderdate OR (b.o_orderdate = a.o_orderdate AND b.o_orderkey < a.o_orderkey))
          AND b.o_orderdate + INTERVAL 30 DAY >= a.o_orderdate) THEN 1 ELSE 0 END AS overlaps
    FROM orders a
    """,
)
def overlapping_intervals(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("until")
    )
    return spans.overlapping_intervals(
        orders, "o_custkey", "o_orderdate", "until", "o_orderkey"
    ).select("o_orderkey", "overlaps")


# Three calendar ranges, two of which overlap.
SEASONS = [
    (datetime(1996, 12, 20), datetime(1997, 1, 5)),
    (datetime(1997, 1, 1), datetime(1997, 2, 15)),
    (datetime(1999, 7, 1), datetime(1999, 9, 30)),
]


@query(
    "calendar_range_flag",
    """
    SELECT o_orderkey, CASE WHEN
      o_orderdate BETWEEN TIMESTAMP '1996-12-20' AND TIMESTAMP '1997-01-05'
      OR o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-02-15'
      OR o_orderdate BETWEEN TIMESTAMP '1999-07-01' AND TIMESTAMP '1999-09-30' THEN 1 ELSE 0 END AS in_season
    FROM orders
    """,
)
def calendar_range_flag(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return spans.range_flag(orders, "o_orderdate", SEASONS, "in_season").drop("o_orderdate")


@query(
    "calendar_range_table",
    """
    WITH r AS (SELECT TIMESTAMP '1995-01-01' + INTERVAL 1 DAY * ((s_suppkey * 131) % 2400)::INT AS b,
                      TIMESTAMP '1995-01-01' + INTERVAL 1 DAY * ((s_suppkey * 131) % 2400 + s_suppkey % 5)::INT AS e
               FROM supplier)
    SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM r WHERE o_orderdate BETWEEN b AND e)
      THEN 1 ELSE 0 END AS in_range
    FROM orders
    """,
)
def calendar_range_table(spark, folder):
    first_day = F.pmod(F.col("s_suppkey") * 131, F.lit(2400)).cast("int")
    epoch = timeexpr.instant(datetime(1995, 1, 1))
    ranges = table(spark, folder, "supplier").select(
        (epoch + F.make_dt_interval(first_day)).alias("begin"),
        (epoch + F.make_dt_interval(first_day + F.pmod("s_suppkey", F.lit(5)).cast("int"))).alias("end"),
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return spans.range_flag(orders, "o_orderdate", ranges, "in_range").drop("o_orderdate")


@query(
    "date_parts",
    """
    SELECT event_id, year(ts)::INT AS year, month(ts)::INT AS month, day(ts)::INT AS day_of_month,
           hour(ts)::INT AS hour FROM events
    """,
)
def date_parts(spark, folder):
    return timeexpr.date_parts(table(spark, folder, "events").select("event_id", "ts"), "ts").drop("ts")


@query(
    "hour_block",
    """
    SELECT event_id, lpad(hour(ts)::VARCHAR, 2, '0') || '00-' || lpad(hour(ts)::VARCHAR, 2, '0') || '59' AS block
    FROM events
    """,
)
def hour_block(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", timeexpr.hour_block(F.col("ts")).alias("block")
    )


@query(
    "hour_bins",
    """
    WITH b AS (SELECT event_id, CASE WHEN hour(ts) < 6 THEN 0 WHEN hour(ts) <= 9 THEN 1
                 WHEN hour(ts) <= 14 THEN 2 WHEN hour(ts) <= 20 THEN 3 ELSE 4 END AS hour_bin FROM events)
    SELECT event_id, hour_bin, (hour_bin = 1)::INT AS is_morning, (hour_bin = 3)::INT AS is_evening FROM b
    """,
)
def hour_bins(spark, folder):
    binned = table(spark, folder, "events").select(
        "event_id", bins.bin_by_edges(F.hour("ts"), bins.DAY_PART_LAST_HOURS).alias("hour_bin")
    )
    return binned.withColumns(
        {
            "is_morning": bins.flag_in(F.col("hour_bin"), [bins.MORNING_BIN]),
            "is_evening": bins.flag_in(F.col("hour_bin"), [bins.EVENING_BIN]),
        }
    )


@query(
    "early_flag",
    """
    SELECT event_id, CASE WHEN hour(ts) * 60 + minute(ts) < 360 THEN 1 ELSE 0 END AS is_early FROM events
    """,
)
def early_flag(spark, folder):
    minutes = timeexpr.minutes_after_midnight(F.col("ts"))
    return table(spark, folder, "events").select(
        "event_id", bins.flag_range(minutes, 0, 360).alias("is_early")
    )


@query(
    "minutes_after_midnight",
    "SELECT event_id, (hour(ts) * 60 + minute(ts))::INT AS minutes FROM events",
)
def minutes_after_midnight(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", timeexpr.minutes_after_midnight(F.col("ts")).alias("minutes")
    )


@query(
    "clock_to_ts",
    """
    SELECT event_id, date_trunc('minute', ts) AS start_ts, date_trunc('minute', ts + INTERVAL 3 HOUR) AS end_ts
    FROM events
    """,
)
def clock_to_ts(spark, folder):
    """Rebuild start and end instants from a date and HHMM numbers (midnight written as 2400)."""

    def clock(ts):
        return F.hour(ts) * 100 + F.minute(ts)

    midnight = clock(F.col("ts")) == 0
    day_before = F.col("ts") - F.expr("INTERVAL 1 DAY")
    start = timeexpr.clock_to_ts(
        F.when(midnight, day_before).otherwise(F.col("ts")),
        F.when(midnight, 2400).otherwise(clock(F.col("ts"))),
    )
    later = F.col("ts") + F.expr("INTERVAL 3 HOURS")
    return (
        table(spark, folder, "events")
        .select("event_id", "ts", start.alias("start_ts"), clock(later).alias("end_clock"))
        .select(
            "event_id",
            "start_ts",
            timeexpr.roll_after(
                F.col("start_ts"), timeexpr.clock_to_ts(F.col("ts"), F.col("end_clock"))
            ).alias("end_ts"),
        )
    )


@query(
    "local_to_utc",
    """
    SELECT o_orderkey, ((o_orderdate + INTERVAL 12 HOUR) AT TIME ZONE
      CASE o_custkey % 3 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago'
      ELSE 'America/Los_Angeles' END) AT TIME ZONE 'UTC' AS utc_ts
    FROM orders
    """,
)
def local_to_utc(spark, folder):
    zones = F.array(*map(F.lit, ("America/New_York", "America/Chicago", "America/Los_Angeles")))
    zone = F.get(zones, F.pmod("o_custkey", F.lit(3)).cast("int"))
    noon = F.col("o_orderdate") + F.expr("INTERVAL 12 HOURS")
    return table(spark, folder, "orders").select(
        "o_orderkey", timeexpr.to_utc(noon, zone).alias("utc_ts")
    )


@query(
    "threshold_label",
    """
    SELECT l_orderkey, l_linenumber, l_shipdate,
           (date_diff('day', o_orderdate, l_shipdate) > 15)::INT AS late
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def threshold_label(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    delay = F.date_diff("l_shipdate", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_shipdate", bins.threshold_label(delay, 15).alias("late")
    )


@query("hour_histogram", "SELECT hour(ts)::INT AS hour, count(*) AS n FROM events GROUP BY 1")
def hour_histogram(spark, folder):
    return stats.hour_histogram(table(spark, folder, "events"), "ts")


@query(
    "coverage_profile",
    """
    WITH d AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1, 2),
         u AS (SELECT user_id, floor(avg(n))::BIGINT AS obs_per_day FROM d GROUP BY 1)
    SELECT obs_per_day, count(*) AS entities, (obs_per_day >= 3)::INT AS complete FROM u GROUP BY 1
    """,
)
def coverage_profile(spark, folder):
    return quality.coverage_profile(table(spark, folder, "events"), "user_id", "ts", expected=3)


@query(
    "temporal_split",
    """
    SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train'
      WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'validation' ELSE 'test' END AS split FROM orders
    """,
)
def temporal_split(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return splits.temporal_split(
        orders, "o_orderdate", [datetime(1999, 1, 1), datetime(2000, 1, 1)]
    ).drop("o_orderdate")


@query(
    "rolling_splits",
    """
    SELECT o_orderkey, fold::INT AS fold, CASE WHEN year(o_orderdate) = fold THEN 'test' ELSE 'train' END AS role
    FROM orders, range(1998, 2002) f(fold)
    WHERE year(o_orderdate) BETWEEN fold - 3 AND fold
    """,
)
def rolling_splits(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return splits.rolling_splits(orders, "o_orderdate", 1998, 2001, 3).drop("o_orderdate")


@query(
    "entity_quarter_slice",
    """
    SELECT o_orderkey, o_orderpriority, o_orderdate FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND year(o_orderdate) = 1998 AND quarter(o_orderdate) = 1
    """,
)
def entity_quarter_slice(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return splits.entity_quarter_slice(
        orders, "o_orderpriority", ["1-URGENT", "2-HIGH"], "o_orderdate", 1998, 1
    )
