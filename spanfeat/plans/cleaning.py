"""Packed fields, null profiles, outliers and loss reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import packed
from ..functions.missing import sentinel_to_null as to_null
from ..functions.missing import valid_rows as keep_valid
from ..operators import quality
from .catalog import query, table


@query(
    "split_packed",
    """
    SELECT l_orderkey, CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_linenumber::DOUBLE END AS line_no,
           l_returnflag AS flag,
           CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_quantity END AS qty,
           CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_linestatus END AS status
    FROM lineitem
    """,
)
def split_packed(spark, folder):
    """Lines packed with commas, some with a non-numeric piece, some cut short."""
    first = F.when(F.col("l_linenumber") % 4 == 0, "x").otherwise(F.col("l_linenumber").cast("string"))
    tail = F.when(
        F.col("l_linenumber") % 5 != 0,
        F.concat(F.lit(",+00"), F.col("l_quantity").cast("int"), F.lit(","), "l_linestatus"),
    ).otherwise("")
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", F.concat(first, F.lit(","), "l_returnflag", tail).alias("line")
    )
    layout = [("line_no", "int"), ("flag", "string"), ("qty", "int"), ("status", "string")]
    pieces = packed.split_packed(lines, {"line": layout})
    return pieces.withColumns({c: F.col(c).cast("double") for c in ("line_no", "qty")})


@query(
    "json_fields",
    "SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k, NULL::VARCHAR AS missing_key FROM events",
)
def json_fields(spark, folder):
    events = table(spark, folder, "events").select("event_id", "props")
    return packed.json_fields(events, "props", "k long, missing_key string").drop("props")


@query(
    "rescale",
    """
    SELECT l_orderkey, l_linenumber, round(l_quantity * 0.1, 6) AS l_quantity,
           round(l_extendedprice * 0.01, 6) AS l_extendedprice FROM lineitem
    """,
)
def rescale(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    out = packed.rescale(lines, {"l_quantity": 0.1, "l_extendedprice": 0.01})
    return out.withColumns({c: F.round(c, 6) for c in ("l_quantity", "l_extendedprice")})


def patchy(spark, folder):
    """Events with missing entries at fixed places: null, NaN and missing text."""
    e = F.col("event_id")
    return table(spark, folder, "events").select(
        "event_id",
        "ts",
        F.when(e % 3 != 0, F.col("value")).alias("a"),
        F.when(e % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("b"),
        F.when(e % 7 != 0, F.col("event_type")).alias("kind"),
        F.when(e % 10 == 0, F.col("value")).alias("rare"),
    )


PATCHY_SQL = """
    patchy AS (SELECT event_id, ts, CASE WHEN event_id % 3 <> 0 THEN value END AS a,
                      CASE WHEN event_id % 5 <> 0 THEN value END AS b,
                      CASE WHEN event_id % 7 <> 0 THEN event_type END AS kind,
                      CASE WHEN event_id % 10 = 0 THEN value END AS rare FROM events)
"""

PATCHY_COLUMNS = ("event_id", "ts", "a", "b", "kind", "rare")


@query(
    "null_profile",
    f"WITH {PATCHY_SQL} "
    + " UNION ALL ".join(
        f"SELECT count(*) AS total, '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM patchy"
        for c in PATCHY_COLUMNS
    ),
)
def null_profile(spark, folder):
    return quality.null_profile(patchy(spark, folder))


@query(
    "missing_by_period",
    f"WITH {PATCHY_SQL}, d AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM patchy) "
    + " UNION ALL ".join(
        f"SELECT day, count(*) AS total, '{c}' AS \"column\", count(*) - count({c}) AS nulls, "
        f"round((count(*) - count({c})) / count(*)::DOUBLE, 6) AS share FROM d GROUP BY day"
        for c in ("a", "b", "kind", "rare")
    ),
)
def missing_by_period(spark, folder):
    daily = patchy(spark, folder).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    profile = quality.null_profile(daily, ["a", "b", "kind", "rare"], by="day")
    return profile.withColumn("share", F.round(F.col("nulls") / F.col("total"), 6))


@query(
    "drop_sparse_columns",
    f"WITH {PATCHY_SQL} SELECT event_id, a, kind FROM patchy",
)
def drop_sparse_columns(spark, folder):
    return quality.drop_sparse_columns(patchy(spark, folder).drop("ts", "b"), 0.8)


@query(
    "drop_null_rows",
    f"""
    WITH {PATCHY_SQL}
    SELECT event_id, a, b, kind FROM patchy WHERE a IS NOT NULL AND b IS NOT NULL AND kind IS NOT NULL
    """,
)
def drop_null_rows(spark, folder):
    return quality.drop_null_rows(patchy(spark, folder).drop("ts", "rare"))


@query(
    "loss_report",
    f"""
    WITH {PATCHY_SQL}, c AS (
      SELECT count(*) AS n, count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL AND kind IS NOT NULL) AS m
      FROM patchy)
    SELECT n AS rows_before, m AS rows_after, n - m AS rows_lost, round(100e0 * (n - m) / n, 6) AS rows_lost_pct,
           1::BIGINT AS columns_lost, round(100e0 / 6, 6) AS columns_lost_pct FROM c
    """,
)
def loss_report(spark, folder):
    before = patchy(spark, folder)
    after = quality.drop_null_rows(quality.drop_sparse_columns(before, 0.8))
    return quality.loss_report(before, after)


@query(
    "filter_outliers",
    """
    WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3
               FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem, q
    WHERE l_extendedprice BETWEEN q1 - 0.2 * (q3 - q1) AND q3 + 0.2 * (q3 - q1)
    """,
)
def filter_outliers(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return quality.filter_outliers(lines, "l_extendedprice", iqr_k=0.2)


@query(
    "sentinel_to_null",
    """
    SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS reading FROM events
    """,
)
def sentinel_to_null(spark, folder):
    reading = F.when(F.col("event_id") % 7 == 0, F.lit(9999.0)).otherwise(F.col("value"))
    events = table(spark, folder, "events").select("event_id", reading.alias("reading"))
    return to_null(events, {"reading": [9999.0]})


@query(
    "valid_readings",
    "SELECT event_id, value AS reading FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0",
)
def valid_readings(spark, folder):
    e = F.col("event_id")
    reading = (
        F.when(e % 7 == 0, F.lit(9999.0)).when(e % 11 == 0, F.lit(None)).otherwise(F.col("value"))
    )
    events = table(spark, folder, "events").select("event_id", reading.alias("reading"))
    return keep_valid(events, {"reading": [9999.0]})
