"""Sources and sinks on the driver's tables: every query writes to scratch storage and reads back."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..operators import graph, joins, metrics, quality, spans
from ..session import scratch
from ..sources import readers, writers
from ..sources.stages import StageRegistry, content_key
from .catalog import query, table
from .evaluation import JUDGED_SQL, judged
from .spatial import BETWEENNESS_SQL, pagerank_ctes, routes


@query("gzipped_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def gzipped_csv(spark, folder):
    """Customers through gzipped CSV files with a header."""
    path = scratch(spark, "csv")
    customers = table(spark, folder, "customer")
    customers.write.option("header", True).option("compression", "gzip").csv(path)
    return readers.load_csv(spark, path, customers.schema)


@query(
    "prediction_files",
    f"WITH {JUDGED_SQL} SELECT label::DOUBLE AS label, pred::DOUBLE AS raw, score AS probability FROM j",
)
def prediction_files(spark, folder):
    """Scored orders through the file of predictions."""
    path = scratch(spark, "predictions")
    chances = array_to_vector(F.array(1 - F.col("score"), F.col("score")))
    scored = judged(spark, folder).select("label", F.col("pred").cast("double").alias("prediction"), chances.alias("probability"))
    writers.save_predictions(scored, path, "label")
    return readers.load_predictions(spark, path)


@query(
    "stage_round_trip",
    "SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate)::INT AS order_year FROM orders",
)
def stage_round_trip(spark, folder):
    """Orders as a stage partitioned by year, found again by its key."""
    stages = StageRegistry(spark, scratch(spark, "stages"), "orders")
    source = f"{folder}/orders.parquet"

    def build():
        orders = table(spark, folder, "orders")
        return orders.select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("order_year"))

    key = content_key(spark, [source], columns=4)
    stages.stage("orders", key, build, partition_by=["order_year"])
    return stages.stage("orders", key, build, partition_by=["order_year"])


@query(
    "run_log",
    f"""
    WITH {JUDGED_SQL}, t AS (SELECT c AS threshold, count(*) FILTER (label = 1 AND score >= c) AS tp,
        count(*) FILTER (label = 0 AND score >= c) AS fp, count(*) FILTER (label = 1 AND score < c) AS fn,
        count(*) AS n FROM j, (VALUES (0.3), (0.5), (0.7)) v(c) GROUP BY c)
    SELECT 'cut-' || threshold AS run_id, 'validation' AS stage, round((n - fp - fn) / n::DOUBLE, 6) AS accuracy,
           round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) AS f1, n::DOUBLE AS seconds FROM t
    """,
)
def run_log(spark, folder):
    """Three thresholds as three runs in the log, compared in one table; rows stand for seconds."""
    path = scratch(spark, "runs")
    rows = judged(spark, folder)
    n = rows.count()
    for cut in (0.3, 0.5, 0.7):
        found = rows.withColumn("pred", (F.col("score") >= cut).cast("int"))
        report = metrics.binary_report(found, "label", "pred").first()
        measured = {m: round(report[m], 6) for m in ("accuracy", "f1")}
        writers.log_run(spark, path, f"cut-{cut}", "validation", float(n), measured)
    return writers.compare_runs(spark, path, ["accuracy", "f1"])


@query(
    "exclude_flagged",
    """
    SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_orderkey % 11 <> 0 AND (l_partkey % 3 = 0 OR l_linenumber <> 7)
    """,
)
def exclude_flagged(spark, folder):
    """Lines without those flagged as cancelled or diverted; a third of the second flag is missing."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").withColumns(
        {
            "cancelled": (F.col("l_orderkey") % 11 == 0).cast("int"),
            "diverted": F.when(F.col("l_partkey") % 3 != 0, (F.col("l_linenumber") == 7).cast("int")),
        }
    )
    return quality.exclude_flagged(lines, ["cancelled", "diverted"]).select("l_orderkey", "l_linenumber")


@query(
    "local_rows",
    "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def local_rows(spark, folder):
    """Nations with their region's name from a short literal table."""
    regions = table(spark, folder, "region").select("r_regionkey", "r_name")
    local = readers.from_rows(spark, [tuple(r) for r in regions.collect()], regions.schema)  # five regions
    return table(spark, folder, "nation").join(local, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


TRAIN_END = datetime(1999, 1, 1)


@query(
    "rank_features",
    f"""
    WITH {pagerank_ctes("WHERE l_shipdate < TIMESTAMP '1999-01-01'")}
    SELECT l_orderkey, l_linenumber, round(o.rank, 9) AS ORIGIN_PR, round(d.rank, 9) AS DEST_PR
    FROM lineitem LEFT JOIN ranks o ON o.node = l_suppkey
    LEFT JOIN ranks d ON d.node = l_partkey % (SELECT count(*) FROM supplier)
    WHERE l_shipdate >= TIMESTAMP '1999-01-01'
    """,
)
def rank_features(spark, folder):
    """PageRank of the trips before the cut, as features of both ends of the trips after it."""
    past = routes(spark, folder, F.col("l_shipdate") < F.lit(TRAIN_END))
    ranks = graph.pagerank(graph.edge_weights(past, "src", "dst"), tol=1e-12)
    later = routes(spark, folder, F.col("l_shipdate") >= F.lit(TRAIN_END), "l_orderkey", "l_linenumber")
    roles = {"src": "ORIGIN_", "dst": "DEST_"}
    out = joins.join_roles(later, ranks.withColumnRenamed("rank", "PR"), "node", roles, ["PR"])
    return out.select("l_orderkey", "l_linenumber", *[F.round(c, 9).alias(c) for c in ("ORIGIN_PR", "DEST_PR")])


@query(
    "central_congestion",
    f"""
    WITH hubs AS (SELECT node FROM ({BETWEENNESS_SQL}) ORDER BY betweenness DESC, node LIMIT 10),
         n AS (SELECT count(*) AS k FROM supplier),
         x AS (SELECT ts FROM events, n WHERE event_type = 'error' AND user_id % k IN (SELECT node FROM hubs))
    SELECT e.event_id, count(x.ts) AS congestion
    FROM events e LEFT JOIN x ON date_trunc('day', x.ts) = date_trunc('day', e.ts) AND x.ts <= e.ts - INTERVAL 2 HOUR
    GROUP BY e.event_id
    """,
)
def central_congestion(spark, folder):
    """Errors so far at the ten most central nodes of the trip graph."""
    size = table(spark, folder, "supplier").count()
    scores = graph.betweenness(routes(spark, folder)).withColumn("betweenness", F.round("betweenness", 6))
    hubs = scores.orderBy(F.desc("betweenness"), "node").limit(10).select("node")
    events = table(spark, folder, "events").select(
        "event_id", "ts", "event_type", F.pmod("user_id", F.lit(size)).alias("node")
    )
    return spans.hub_events_so_far(
        events, hubs, "node", "ts", F.col("event_type") == "error", out="congestion"
    ).select("event_id", "congestion")
