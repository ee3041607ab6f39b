"""Scaling, encodings, classifiers and their evaluation, on orders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import learning, logit, metrics, stats, tree
from ..operators.splits import slice_between
from ..session import staged
from ..streaming import scoring
from .catalog import query, table

LINE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "standardize",
    "WITH s AS (SELECT "
    + ", ".join(f"avg({c}) AS a_{c}, stddev_samp({c}) AS s_{c}" for c in LINE_COLUMNS)
    + " FROM lineitem) SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round(({c} - a_{c}) / s_{c}, 6) AS {c}_std" for c in LINE_COLUMNS)
    + " FROM lineitem, s",
)
def standardize(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *LINE_COLUMNS)
    out = stats.standardize(lines, LINE_COLUMNS)
    return out.select(
        "l_orderkey", "l_linenumber", *[F.round(f"{c}_std", 6).alias(f"{c}_std") for c in LINE_COLUMNS]
    )


@query(
    "pairwise_products",
    """
    SELECT l_orderkey, l_linenumber, round(l_quantity * l_extendedprice, 4) AS l_quantity_x_l_extendedprice,
           round(l_quantity * l_discount, 4) AS l_quantity_x_l_discount,
           round(l_extendedprice * l_discount, 4) AS l_extendedprice_x_l_discount
    FROM lineitem
    """,
)
def pairwise_products(spark, folder):
    cols = LINE_COLUMNS[:3]
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *cols)
    out = stats.pairwise_products(lines, cols).drop(*cols)
    return out.withColumns({c: F.round(c, 4) for c in out.columns if "_x_" in c})


@query(
    "correlation_pairs",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for i, a in enumerate(LINE_COLUMNS)
        for b in LINE_COLUMNS[i + 1 :]
    ),
)
def correlation_pairs(spark, folder):
    out = stats.correlation_pairs(table(spark, folder, "lineitem"), LINE_COLUMNS)
    return out.withColumn("corr", F.round("corr", 6))


@query(
    "class_weights",
    """
    WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)
    SELECT o_orderstatus, n, round((sum(n) OVER ()) / ((count(*) OVER ()) * n)::DOUBLE, 6) AS class_weight FROM c
    """,
)
def class_weights(spark, folder):
    out = stats.class_weights(table(spark, folder, "orders"), "o_orderstatus")
    return out.withColumn("class_weight", F.round("class_weight", 6))


def judged(spark, folder):
    """Orders with a label, a fixed score with ties, and the thresholded prediction."""
    score = F.pmod(F.col("o_orderkey") * 37, F.lit(101)) / 100.0
    return (
        table(spark, folder, "orders")
        .select(
            "o_orderkey",
            "o_orderpriority",
            (F.col("o_orderstatus") == "F").cast("int").alias("label"),
            score.alias("score"),
        )
        .withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    )


JUDGED_SQL = """
    j AS (SELECT o_orderkey, o_orderpriority, (o_orderstatus = 'F')::INT AS label,
                 (o_orderkey * 37 % 101) / 100e0 AS score,
                 ((o_orderkey * 37 % 101) / 100e0 >= 0.5)::INT AS pred FROM orders)
"""


@query(
    "confusion_matrix",
    f"WITH {JUDGED_SQL} SELECT label, pred, count(*) AS n FROM j GROUP BY label, pred",
)
def confusion_matrix(spark, folder):
    return metrics.confusion(judged(spark, folder), "label", "pred")


@query(
    "binary_report",
    f"""
    WITH {JUDGED_SQL}, c AS (SELECT count(*) FILTER (label = 1 AND pred = 1) AS tp,
      count(*) FILTER (label = 0 AND pred = 1) AS fp, count(*) FILTER (label = 1 AND pred = 0) AS fn,
      count(*) FILTER (label = 0 AND pred = 0) AS tn FROM j)
    SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn)::DOUBLE, 6) AS accuracy,
           round(tp / (tp + fp)::DOUBLE, 6) AS precision, round(tp / (tp + fn)::DOUBLE, 6) AS recall,
           round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) AS f1 FROM c
    """,
)
def binary_report(spark, folder):
    out = metrics.binary_report(judged(spark, folder), "label", "pred")
    return out.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1")})


@query(
    "classification_report",
    f"""
    WITH {JUDGED_SQL}, k AS (SELECT c::VARCHAR AS class, c, count(*) FILTER (label = c AND pred = c)::DOUBLE AS tp,
        count(*) FILTER (label = c) AS support, count(*) FILTER (pred = c) AS guessed
      FROM j, (VALUES (0), (1)) v(c) GROUP BY c),
    p AS (SELECT class, tp / guessed AS precision, tp / support AS recall,
                 2 * tp / (guessed + support) AS f1, support, tp FROM k),
    r AS (SELECT class, precision, recall, f1, support FROM p
      UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), sum(support) FROM p
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM p
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                sum(f1 * support) / sum(support), sum(support) FROM p)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
           support::BIGINT AS support FROM r
    """,
)
def classification_report(spark, folder):
    out = metrics.class_report(judged(spark, folder), "label", "pred")
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "auc_exact",
    f"""
    WITH {JUDGED_SQL}, p AS (SELECT score, count(*) AS n FROM j WHERE label = 1 GROUP BY score),
    m AS (SELECT score, count(*) AS n FROM j WHERE label = 0 GROUP BY score),
    t AS (SELECT (SELECT sum(n) FROM p)::BIGINT AS pos, (SELECT sum(n) FROM m)::BIGINT AS neg),
    w AS (SELECT sum(p.n * m.n * CASE WHEN p.score > m.score THEN 1e0 WHEN p.score = m.score THEN 0.5e0 ELSE 0 END)
            AS wins FROM p, m),
    a AS (SELECT p.score, p.n, (SELECT sum(x.n) FROM p x WHERE x.score >= p.score) AS tp,
                 (SELECT coalesce(sum(x.n), 0) FROM m x WHERE x.score >= p.score) AS fp FROM p)
    SELECT pos AS positives, neg AS negatives, round(wins / pos / neg, 6) AS auc_roc,
           round((SELECT sum(n * tp / (tp + fp)::DOUBLE) FROM a) / pos, 6) AS auc_pr FROM t, w
    """,
)
def auc_exact(spark, folder):
    out = metrics.auc_exact(judged(spark, folder), "label", "score")
    return out.withColumns({c: F.round(c, 6) for c in ("auc_roc", "auc_pr")})


@query(
    "roc_points",
    f"""
    WITH {JUDGED_SQL}, s AS (SELECT DISTINCT score FROM j), t AS (SELECT count(*) FILTER (label = 1) AS p,
      count(*) FILTER (label = 0) AS n FROM j)
    SELECT s.score AS threshold, count(*) FILTER (label = 1) AS tp, count(*) FILTER (label = 0) AS fp,
           round(count(*) FILTER (label = 1) / any_value(p)::DOUBLE, 6) AS tpr,
           round(count(*) FILTER (label = 0) / any_value(n)::DOUBLE, 6) AS fpr
    FROM s JOIN j ON j.score >= s.score, t GROUP BY s.score
    """,
)
def roc_points(spark, folder):
    out = metrics.roc_points(judged(spark, folder), "label", "score")
    return out.withColumns({c: F.round(c, 6) for c in ("tpr", "fpr")})


@query(
    "error_rate_by",
    f"""
    WITH {JUDGED_SQL}
    SELECT o_orderpriority, count(*) AS n, count(*) FILTER (label = 0 AND pred = 1) AS false_pos,
           count(*) FILTER (label = 1 AND pred = 0) AS false_neg,
           round(count(*) FILTER (label = 0 AND pred = 1) / count(*)::DOUBLE, 6) AS false_pos_share,
           round(count(*) FILTER (label = 1 AND pred = 0) / count(*)::DOUBLE, 6) AS false_neg_share
    FROM j GROUP BY o_orderpriority
    """,
)
def error_rate_by(spark, folder):
    out = metrics.error_rate_by(judged(spark, folder), "label", "pred", "o_orderpriority")
    return out.withColumns({c: F.round(c, 6) for c in ("false_pos_share", "false_neg_share")})


NUMERIC = ("price", "day", "balance")
CATEGORICAL = ("o_orderpriority", "c_mktsegment")
CUT = datetime(1999, 1, 1)


def order_features(spark, folder):
    """Orders with customer attributes; the label is a large order of a solvent customer."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    orders = table(spark, folder, "orders")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        "o_orderdate",
        (F.col("o_totalprice") / 1000.0).alias("price"),
        F.dayofyear("o_orderdate").cast("double").alias("day"),
        (F.col("c_acctbal") / 1000.0).alias("balance"),
        *CATEGORICAL,
        ((F.col("o_totalprice") / 1000.0 + 10 * F.col("c_acctbal") / 1000.0) > 350.0)
        .cast("int")
        .alias("label"),
    )


def weighted_training(spark, folder):
    """Training rows with class weights; a stage table, since fitting reads them many times."""
    train = staged(slice_between(order_features(spark, folder), "o_orderdate", end=CUT), "train")
    return stats.with_class_weights(train, stats.class_weights(train, "label"), "label")


@query(
    "encoded_features",
    """
    WITH f AS (SELECT o_orderkey, o_orderpriority AS p, c_mktsegment AS m, o_totalprice / 1000e0 AS price
               FROM orders JOIN customer ON o_custkey = c_custkey),
    cp AS (SELECT p, row_number() OVER (ORDER BY count(*) DESC, p) - 1 AS i FROM f GROUP BY p),
    cm AS (SELECT m, row_number() OVER (ORDER BY count(*) DESC, m) - 1 AS i FROM f GROUP BY m)
    SELECT o_orderkey, round(price, 6) AS price, cp.i::INT AS priority_slot, cm.i::INT AS segment_slot,
           (1 + (SELECT count(*) FROM cp) + (SELECT count(*) FROM cm))::INT AS width
    FROM f JOIN cp ON f.p = cp.p JOIN cm ON f.m = cm.m
    """,
)
def encoded_features(spark, folder):
    """Feature vectors, read back as the position of each one-hot slot."""
    rows = order_features(spark, folder).select("o_orderkey", "price", *CATEGORICAL)
    encoded = learning.build_pipeline(["price"], CATEGORICAL).fit(rows).transform(rows)
    names = learning.slot_names(encoded)
    slots = learning.vector_to_array("features")
    # each one-hot block ends with a slot for values unseen in training
    first = {c: min(i for i, n in enumerate(names) if n.startswith(f"{c}_vec")) for c in CATEGORICAL}
    size = {c: sum(n.startswith(f"{c}_vec") for n in names) for c in CATEGORICAL}

    def slot(c):
        block = F.slice("slots", first[c] + 1, size[c])
        return F.array_position(block, F.lit(1.0)).cast("int") - 1

    wide = encoded.withColumn("slots", slots)
    unseen = sum(n.endswith("__unknown") for n in names)
    return wide.select(
        "o_orderkey",
        F.round(F.element_at("slots", 1), 6).alias("price"),
        slot("o_orderpriority").alias("priority_slot"),
        slot("c_mktsegment").alias("segment_slot"),
        (F.size("slots") - unseen).alias("width"),
    )


REG = 0.01


def fitted_logistic(train):
    return logit.fit_logit(train, NUMERIC, CATEGORICAL, "label", "class_weight", reg=REG)


def _scored(model, rows):
    out = learning.score(model, rows, ["o_orderkey", "label"])
    return out.select(
        "o_orderkey", "label", "prediction", F.round(F.get("probabilities", F.lit(1)), 6).alias("probability")
    )


# Newton steps that the SQL takes from zero; the last ones change nothing any more.
NEWTON_STEPS = 9
SLOTS = 14  # intercept, three numbers and twice five categories


def _newton_sql(t: int) -> str:
    """Weights after step ``t`` from those before it, by elimination on the normal equations."""
    return f"""
    q{t} AS MATERIALIZED (SELECT id, w, y, 1 / (1 + exp(-eta)) AS p FROM train JOIN
        (SELECT id, sum(v * b) AS eta FROM slots JOIN b{t} USING (j) GROUP BY id) USING (id)),
    h{t} AS (SELECT x.j AS i, z.j AS j, sum(x.v * z.v * w * p * (1 - p)) / any_value(mass)
               + CASE WHEN x.j = z.j AND x.j > 0 THEN {REG} ELSE 0 END AS v
             FROM slots x JOIN slots z USING (id) JOIN q{t} USING (id), total GROUP BY x.j, z.j
             UNION ALL
             SELECT s.j, {SLOTS}, sum(s.v * w * (y - p)) / any_value(mass)
               - CASE WHEN s.j > 0 THEN {REG} * any_value(b) ELSE 0 END
             FROM slots s JOIN q{t} USING (id) JOIN b{t} USING (j), total GROUP BY s.j),
    e{t}(k, i, j, v) AS (SELECT -1, i, j, v FROM h{t}
      UNION ALL
      SELECT a.k + 1, a.i, a.j, CASE WHEN a.i = a.k + 1 THEN a.v / p.v ELSE a.v - c.v * r.v / p.v END
      FROM e{t} a JOIN e{t} p ON p.i = a.k + 1 AND p.j = a.k + 1
        JOIN e{t} c ON c.i = a.i AND c.j = a.k + 1 JOIN e{t} r ON r.i = a.k + 1 AND r.j = a.j
      WHERE a.k < {SLOTS - 1}),
    b{t + 1} AS MATERIALIZED (SELECT b{t}.j, b + v AS b FROM b{t}
      JOIN e{t} ON e{t}.i = b{t}.j AND e{t}.j = {SLOTS} AND k = {SLOTS - 1}),"""


def _wide_sql(rows: str) -> str:
    """Slots 1 and up of the design in long form: (id, j, v)."""
    return f"""
      SELECT id, 1 AS j, price AS v FROM {rows} UNION ALL SELECT id, 2, day FROM {rows}
      UNION ALL SELECT id, 3, balance FROM {rows}
      UNION ALL SELECT id, 3 + r, (priority = name)::INT FROM {rows}, priorities
      UNION ALL SELECT id, 8 + r, (segment = name)::INT FROM {rows}, segments"""


FITTED_SQL = (
    f"""
    WITH RECURSIVE f AS (
      SELECT o_orderkey AS id, o_orderdate < DATE '1999-01-01' AS early, o_totalprice / 1000 AS price,
             dayofyear(o_orderdate)::DOUBLE AS day, c_acctbal / 1000 AS balance,
             o_orderpriority AS priority, c_mktsegment AS segment,
             (o_totalprice / 1000 + 10 * c_acctbal / 1000 > 350)::INT AS y
      FROM orders JOIN customer ON o_custkey = c_custkey),
    past AS (FROM f WHERE early), later AS (FROM f WHERE NOT early),
    priorities AS (SELECT DISTINCT priority AS name, dense_rank() OVER (ORDER BY priority) AS r FROM past),
    segments AS (SELECT DISTINCT segment AS name, dense_rank() OVER (ORDER BY segment) AS r FROM past),
    train AS MATERIALIZED (SELECT id, y, (count(*) OVER ()) / (2 * count(*) OVER (PARTITION BY y))::DOUBLE AS w FROM past),
    total AS (SELECT sum(w) AS mass FROM train),
    wide AS MATERIALIZED ({_wide_sql('past')}),
    scale AS MATERIALIZED (SELECT j, avg(v) AS m, stddev_samp(v) AS s FROM wide GROUP BY j),
    slots AS MATERIALIZED (SELECT id, j, (v - m) / s AS v FROM wide JOIN scale USING (j) UNION ALL SELECT id, 0, 1 FROM past),
    b0 AS (SELECT DISTINCT j, 0e0 AS b FROM slots),"""
    + "".join(_newton_sql(t) for t in range(NEWTON_STEPS))
)


def _score_sql(rows: str) -> str:
    """(id, p): probability of every row under the fitted weights."""
    last = f"b{NEWTON_STEPS}"
    return f"""
    scored AS (SELECT id, 1 / (1 + exp(-(sum((v - m) / s * b) + (SELECT b FROM {last} WHERE j = 0)))) AS p
               FROM ({_wide_sql(rows)}) JOIN scale USING (j) JOIN {last} USING (j) GROUP BY id)"""


LOGIT_SQL = f"""
    {FITTED_SQL} {_score_sql('later')}
    SELECT id AS o_orderkey, y AS label, (p > 0.5)::INT AS prediction, round(p, 6) AS probability
    FROM scored JOIN later USING (id)
    """


@query("lr_scores", LOGIT_SQL)
def lr_scores(spark, folder):
    """Class-weighted logistic regression, trained before the cut, scored after it."""
    model = fitted_logistic(weighted_training(spark, folder))
    return _scored(model, slice_between(order_features(spark, folder), "o_orderdate", begin=CUT))


TREE_NUMERIC, TREE_CATEGORICAL = ("quantity", "l_tax", "l_discount"), ("l_returnflag", "l_linestatus")


@query(
    "tree_root_split",
    """
    WITH f AS (SELECT CASE WHEN l_orderkey % 7 <> 0 OR l_quantity <= 20 THEN l_quantity END AS q, l_tax, l_discount,
                      l_returnflag, l_linestatus, (l_quantity + 3 * l_linenumber > 35)::INT AS y FROM lineitem),
    cells(feature, num, cat, w, wy) AS (
      SELECT 0, q, NULL, count(*), sum(y) FROM f GROUP BY q
      UNION ALL SELECT 1, l_tax, NULL, count(*), sum(y) FROM f GROUP BY l_tax
      UNION ALL SELECT 2, l_discount, NULL, count(*), sum(y) FROM f GROUP BY l_discount
      UNION ALL SELECT 3, NULL, l_returnflag, count(*), sum(y) FROM f GROUP BY l_returnflag
      UNION ALL SELECT 4, NULL, l_linestatus, count(*), sum(y) FROM f GROUP BY l_linestatus),
    held AS (SELECT *, CASE WHEN feature >= 3 THEN round(wy / w, 9) END AS rate FROM cells
             WHERE num IS NOT NULL OR cat IS NOT NULL),
    upto AS (SELECT feature, num, row_number() OVER o AS place, count(*) OVER p AS n, sum(w) OVER o AS lw,
               sum(wy) OVER o AS lwy, sum(w) OVER p AS hw, sum(wy) OVER p AS hwy, list(cat) OVER o AS cats
             FROM held WINDOW p AS (PARTITION BY feature), o AS (PARTITION BY feature ORDER BY num, rate, cat)),
    gone AS (SELECT feature, w AS mw, wy AS mwy FROM cells WHERE num IS NULL AND cat IS NULL),
    tried AS (SELECT u.*, d AS default_left, coalesce(mw, 0) AS mw, lw + CASE WHEN d THEN coalesce(mw, 0) ELSE 0 END AS a,
                lwy + CASE WHEN d THEN coalesce(mwy, 0) ELSE 0 END AS ay,
                hw + coalesce(mw, 0) AS t, hwy + coalesce(mwy, 0) AS ty
              FROM upto u LEFT JOIN gone USING (feature), (VALUES (TRUE), (FALSE)) v(d) WHERE place < n),
    scored AS (SELECT *, round((2 * ty * (t - ty) / t - 2 * ay * (a - ay) / a
                 - CASE WHEN t > a THEN 2 * (ty - ay) * (t - a - ty + ay) / (t - a) ELSE 0 END) / t, 9) AS gain FROM tried)
    SELECT ['quantity', 'l_tax', 'l_discount', 'l_returnflag', 'l_linestatus'][feature + 1] AS feature, num AS threshold,
           CASE WHEN feature >= 3 THEN array_to_string(list_sort(cats), ',') END AS left_values, default_left, gain,
           a::DOUBLE AS left_weight, (t - a)::DOUBLE AS right_weight
    FROM scored WHERE gain > 0 AND (mw > 0 OR default_left = (a >= t - a))
    ORDER BY gain DESC, feature, place, default_left DESC LIMIT 1
    """,
)
def tree_root_split(spark, folder):
    """First split for late lines of large orders; every seventh order lacks its larger quantities."""
    known = (F.col("l_orderkey") % 7 != 0) | (F.col("l_quantity") <= 20)
    lines = table(spark, folder, "lineitem").select(
        F.when(known, F.col("l_quantity")).alias("quantity"),
        *TREE_NUMERIC[1:],
        *TREE_CATEGORICAL,
        (F.col("l_quantity") + 3 * F.col("l_linenumber") > 35).cast("int").alias("label"),
    )
    model = tree.fit_tree(lines, TREE_NUMERIC, TREE_CATEGORICAL, "label", max_depth=1, bins=64)
    return model.to_frame(spark).drop("node")


@query("rf_scores")
def rf_scores(spark, folder):
    """Class-weighted random forest, trained before the cut, scored after it."""
    estimator = learning.forest("label", "class_weight", numTrees=10, maxDepth=5)
    model = learning.build_pipeline(NUMERIC, CATEGORICAL, estimator).fit(weighted_training(spark, folder))
    return _scored(model, slice_between(order_features(spark, folder), "o_orderdate", begin=CUT))


@query(
    "score_requests",
    f"""
    {FITTED_SQL}
    asked AS (SELECT id, CASE WHEN id % 4 = 0 THEN (SELECT avg(price) FROM past) ELSE price END AS price, day, balance,
                CASE WHEN id % 5 = 0 THEN (SELECT priority FROM past GROUP BY priority ORDER BY count(*) DESC, priority LIMIT 1)
                     ELSE priority END AS priority, segment FROM later),
    {_score_sql('asked')}
    SELECT id AS o_orderkey, (id % 4 = 0)::INT + (id % 5 = 0)::INT AS n_filled, 'Success' AS status,
           (p > 0.5)::INT AS pred, round(1 - p, 6) AS probability_0, round(p, 6) AS probability_1 FROM scored
    """,
)
def score_requests(spark, folder):
    """JSON requests made from later orders, some fields missing, filled and scored."""
    train = weighted_training(spark, folder)
    model = fitted_logistic(train)
    defaults = scoring.training_defaults(train, NUMERIC, CATEGORICAL)
    later = slice_between(order_features(spark, folder), "o_orderdate", begin=CUT)
    absent = F.col("o_orderkey") % 4 == 0
    lines = later.select(
        "o_orderkey",
        F.to_json(
            F.struct(
                F.when(~absent, F.col("price")).alias("price"),
                "day",
                "balance",
                F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
                "c_mktsegment",
            )
        ).alias("value"),
    )
    schema = "price double, day double, balance double, o_orderpriority string, c_mktsegment string"
    requests = scoring.parse_requests(lines, "value", schema)
    out = scoring.score_requests(requests, defaults, model, ["o_orderkey"])
    return out.withColumns({c: F.round(c, 6) for c in ("probability_0", "probability_1")})
