"""Scans, views, joins, grouped statistics and set operations."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..functions.packed import parse_fixed_width
from ..functions.timeexpr import parse_day
from ..operators import joins, ordering, quality, stats
from ..sources import readers
from .catalog import query, table

PROFILED = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query(
    "scan_profile",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, {n}::BIGINT AS n_cols FROM {t}"
        for t, n in zip(PROFILED, (2, 3, 5, 4, 6, 6, 11, 6, 5, 3, 3, 2, 3, 4), strict=True)
    ),
)
def scan_profile(spark, folder):
    return readers.scan_profile({t: table(spark, folder, t) for t in PROFILED})


@query(
    "scan_limit",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
)
def scan_limit(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return readers.head_of_table(orders, [F.desc("o_totalprice"), "o_orderkey"], 5)


@query(
    "sql_view_filter",
    """
    SELECT c_nationkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
    FROM orders, customer
    WHERE o_custkey = c_custkey AND c_mktsegment = 'BUILDING' AND o_orderdate >= TIMESTAMP '1998-01-01'
    GROUP BY c_nationkey
    """,
)
def sql_view_filter(spark, folder):
    views = {f"{t}_view": table(spark, folder, t) for t in ("orders", "customer")}
    return readers.query_view(
        spark,
        views,
        """
        SELECT c_nationkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
        FROM orders_view, customer_view
        WHERE o_custkey = c_custkey AND c_mktsegment = :segment
          AND o_orderdate >= to_timestamp_ntz(:since)
        GROUP BY c_nationkey
        """,
        segment="BUILDING",
        since="1998-01-01 00:00:00",
    )


@query("fixed_width_parse", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def fixed_width_parse(spark, folder):
    lines = table(spark, folder, "supplier").select(
        F.format_string("%10d%-25s%4d%14.2f", "s_suppkey", "s_name", "s_nationkey", "s_acctbal").alias(
            "value"
        )
    )
    layout = [
        ("s_suppkey", 1, 10, "long"),
        ("s_name", 11, 25, "string"),
        ("s_nationkey", 36, 4, "int"),
        ("s_acctbal", 40, 14, "double"),
    ]
    return parse_fixed_width(lines, layout)


@query(
    "composite_key_join",
    """
    SELECT c_custkey, n_name FROM customer JOIN nation
      ON c_nationkey || '-' || (c_custkey % 5) = n_nationkey || '-' || n_regionkey
    WHERE n_regionkey <> 4
    """,
)
def composite_key_join(spark, folder):
    customers = table(spark, folder, "customer").select(
        "c_custkey",
        F.concat("c_nationkey", F.lit("-"), F.pmod("c_custkey", F.lit(5))).alias("place"),
    )
    return joins.composite_key_join(
        customers,
        table(spark, folder, "nation"),
        "place",
        [F.col("n_nationkey"), F.lit("-"), F.col("n_regionkey")],
        F.col("n_regionkey") != 4,
    ).select("c_custkey", "n_name")


@query(
    "validity_join",
    """
    SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 366 DAY
    """,
)
def validity_join(spark, folder):
    orders = table(spark, folder, "orders")
    active = orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_orderdate",
        F.date_format("o_orderdate", "yyyyMMdd").alias("begin_text"),
        F.date_format(F.date_add("o_orderdate", 365), "yyyyMMdd").alias("end_text"),
    ).withColumns({"begin": parse_day(F.col("begin_text")), "end": parse_day(F.col("end_text"))})
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return joins.validity_join(
        lines, active, "l_orderkey", "l_shipdate", "begin", "end", timedelta(hours=24)
    ).select("l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate")


@query(
    "unmatched_keys",
    "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def unmatched_keys(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.unmatched(orders, lines, "o_orderkey")


@query(
    "role_dimension_join",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, nc.n_name AS cust_n_name, ns.n_name AS supp_n_name
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation nc ON c_nationkey = nc.n_nationkey
    LEFT JOIN nation ns ON s_nationkey = ns.n_nationkey
    """,
)
def role_dimension_join(spark, folder):
    return joins.join_roles(
        trips(spark, folder),
        table(spark, folder, "nation"),
        "n_nationkey",
        {"c_nationkey": "cust_", "s_nationkey": "supp_"},
        ["n_name"],
    ).select("l_orderkey", "l_linenumber", "l_suppkey", "cust_n_name", "supp_n_name")


def trips(spark, folder):
    """Lines with the customer's and the supplier's nation."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    lines = table(spark, folder, "lineitem")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )


@query(
    "full_outer_merge",
    """
    WITH a AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, sum(value) AS clicks FROM events
               WHERE event_type = 'click' GROUP BY 1, 2),
         b AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, sum(value) AS views FROM events
               WHERE event_type = 'view' GROUP BY 1, 2),
         c AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, sum(value) AS errors FROM events
               WHERE event_type = 'error' GROUP BY 1, 2),
         ab AS (SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.day, b.day) AS day, clicks, views
                FROM a FULL JOIN b ON a.user_id = b.user_id AND a.day = b.day)
    SELECT coalesce(ab.user_id, c.user_id) AS user_id, coalesce(ab.day, c.day) AS day,
           round(clicks, 4) AS clicks, round(views, 4) AS views, round(errors, 4) AS errors
    FROM ab FULL JOIN c ON ab.user_id = c.user_id AND ab.day = c.day
    """,
)
def full_outer_merge(spark, folder):
    events = table(spark, folder, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))

    def measured(kind: str, name: str):
        return (
            events.filter(F.col("event_type") == kind)
            .groupBy("user_id", "day")
            .agg(F.round(F.sum("value"), 4).alias(name))
        )

    frames = {n: measured(k, n) for k, n in (("click", "clicks"), ("view", "views"), ("error", "errors"))}
    return joins.full_outer_merge(frames, ["user_id", "day"])


@query(
    "semi_join_distinct",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
    """,
)
def semi_join_distinct(spark, folder):
    urgent = (
        table(spark, folder, "orders")
        .filter(F.col("o_orderpriority") == "1-URGENT")
        .select(F.col("o_custkey").alias("c_custkey"))
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    return joins.matched(customers, ordering.distinct_values(urgent, "c_custkey"), "c_custkey")


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_keys(spark, folder):
    return quality.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dedupe_keys",
    """
    SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS price, min(l_shipdate) AS first_ship,
           count(*) AS copies
    FROM lineitem GROUP BY 1, 2
    """,
)
def dedupe_keys(spark, folder):
    return quality.dedupe_keys(
        table(spark, folder, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        {
            "price": F.max("l_extendedprice"),
            "first_ship": F.min("l_shipdate"),
            "copies": F.count("*"),
        },
    )


@query(
    "group_stats",
    """
    SELECT l_suppkey, round(avg(l_quantity), 6) AS avg_l_quantity, min(l_quantity) AS min_l_quantity,
           round(avg(round(l_extendedprice * 100)), 6) AS avg_cents, min(l_discount) AS min_l_discount
    FROM lineitem GROUP BY l_suppkey
    """,
)
def group_stats(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("cents", F.round(F.col("l_extendedprice") * 100))
    out = stats.group_stats(
        lines, "l_suppkey", {"l_quantity": ["avg", "min"], "cents": ["avg"], "l_discount": ["min"]}
    )
    return out.withColumns({c: F.round(c, 6) for c in ("avg_l_quantity", "avg_cents")})


@query(
    "route_diff",
    """
    WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity, c_nationkey, s_nationkey FROM lineitem
               JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
               JOIN supplier ON l_suppkey = s_suppkey)
    SELECT l_orderkey, l_linenumber, c_nationkey, s_nationkey,
           round(l_quantity - avg(l_quantity) OVER (PARTITION BY c_nationkey, s_nationkey), 6) AS quantity_diff
    FROM t
    """,
)
def route_diff(spark, folder):
    routes = trips(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_quantity", "c_nationkey", "s_nationkey"
    )
    out = stats.group_mean_diff(routes, ["c_nationkey", "s_nationkey"], "l_quantity", "quantity_diff")
    return out.drop("l_quantity").withColumn("quantity_diff", F.round("quantity_diff", 6))


@query(
    "frequency",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n,
           round(count(*) / (SELECT count(*) FROM lineitem)::DOUBLE, 6) AS share
    FROM lineitem GROUP BY 1, 2
    """,
)
def frequency(spark, folder):
    out = stats.frequency(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"])
    return out.withColumn("share", F.round("share", 6))


@query(
    "label_rate",
    """
    SELECT o_orderpriority, count(*) AS n,
           sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS positives,
           round(avg(CASE WHEN o_orderstatus = 'F' THEN 1e0 ELSE 0e0 END), 6) AS rate
    FROM orders GROUP BY o_orderpriority
    """,
)
def label_rate(spark, folder):
    orders = table(spark, folder, "orders").withColumn("label", (F.col("o_orderstatus") == "F").cast("int"))
    return stats.label_rate(orders, "o_orderpriority", "label").withColumn("rate", F.round("rate", 6))


@query(
    "daily_volume",
    """
    WITH t AS (SELECT s_nationkey, l_shipdate, c_nationkey, o_orderdate FROM lineitem
               JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
               JOIN supplier ON l_suppkey = s_suppkey),
         r AS (SELECT s_nationkey AS nation, strftime(l_shipdate, '%Y-%m-%d') AS day, 1 AS d, 0 AS a FROM t
               UNION ALL SELECT c_nationkey, strftime(o_orderdate, '%Y-%m-%d'), 0, 1 FROM t)
    SELECT nation, day, sum(d)::BIGINT AS departures, sum(a)::BIGINT AS arrivals FROM r GROUP BY 1, 2
    """,
)
def daily_volume(spark, folder):
    return stats.daily_volume(
        trips(spark, folder),
        {"departures": ("s_nationkey", "l_shipdate"), "arrivals": ("c_nationkey", "o_orderdate")},
        entity="nation",
    ).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "top_k",
    "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20",
)
def top_k(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    return ordering.top_k(customers, [F.desc("c_acctbal"), F.asc("c_custkey")], 20)


@query(
    "union_distinct",
    """
    SELECT c_nationkey AS nation, c_custkey % 10 AS bucket FROM customer
    UNION SELECT s_nationkey, s_suppkey % 10 FROM supplier
    """,
)
def union_distinct(spark, folder):
    return ordering.union_distinct(*_nation_buckets(spark, folder))


@query(
    "union_all",
    """
    SELECT c_nationkey AS nation, c_custkey % 10 AS bucket FROM customer
    UNION ALL SELECT s_nationkey, s_suppkey % 10 FROM supplier
    """,
)
def union_all(spark, folder):
    return ordering.union_all(*_nation_buckets(spark, folder))


def _nation_buckets(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("nation"), F.pmod("c_custkey", F.lit(10)).alias("bucket")
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.pmod("s_suppkey", F.lit(10)).alias("bucket")
    )
    return customers, suppliers
