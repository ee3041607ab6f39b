import json
from datetime import datetime
from itertools import combinations
from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanfeat.operators import learning, logit, metrics, splits, stats, tree
from spanfeat.sources import readers, writers
from spanfeat.streaming import scoring

# label, origin, dest, departure hour, arrival hour, temperature (two are missing)
TOY = [
    (0.0, "ATL", "ORD", 8, 9, -4.390625),
    (0.0, "ATL", "ORD", 8, 9, 151.23295454545453),
    (0.0, "ATL", "ORD", 21, 22, None),
    (1.0, "ATL", "ORD", 21, 22, 187.9034090909091),
    (0.0, "ATL", "ORD", 13, 14, 252.6086956521739),
    (1.0, "ATL", "ORD", 6, 7, 220.31944444444446),
    (0.0, "ORD", "ATL", 18, 21, 314.2142857142857),
    (1.0, "ORD", "ATL", 18, 21, 285.17083333333335),
    (1.0, "ORD", "ATL", 9, 12, None),
    (0.0, "ORD", "ATL", 20, 23, 266.3333333333333),
    (0.0, "ORD", "ATL", 12, 15, 190.712),
    (0.0, "ORD", "ATL", 6, 9, 21.32089552238806),
]


def test_toy_tree_with_missing_values(spark):
    df = readers.from_rows(spark, TOY, "label double, origin string, dest string, dep int, arr int, temp double")
    num = ["dep", "arr", "temp"]
    marked = learning.mark_missing(df, num)
    model = learning.tree_with_missing(num, ["origin", "dest"], "label", maxDepth=5).fit(marked)
    scored = model.transform(marked)
    right = scored.filter("prediction = label").count()
    assert right >= 10  # the majority class has 8
    assert model.stages[-1].numClasses == 2 and model.stages[-1].depth <= 5


@pytest.fixture(scope="module")
def data(spark):
    rnd = Random(5)
    rows = []
    for i in range(600):
        x, z = rnd.gauss(0, 1), rnd.gauss(0, 1)
        color = rnd.choice(["red", "green", "blue"])
        y = int(2 * x + (1.5 if color == "red" else 0) + rnd.gauss(0, 0.3) > 1.2)
        rows.append((i, datetime(2015 + i % 4, 1 + i % 12, 1), x, z, color, y))
    return spark.createDataFrame(rows, "id int, ts timestamp_ntz, x double, z double, color string, label int")


def test_weighted_logistic_beats_majority(spark, data):
    weighted = stats.with_class_weights(data, stats.class_weights(data, "label"), "label")
    pipeline = learning.build_pipeline(["x", "z"], ["color"], learning.logistic("label", "class_weight"), scale=True)
    model = pipeline.fit(weighted)
    scored = learning.score(model, weighted, ["id", "label"])
    assert scored.columns == ["id", "label", "prediction", "probabilities"]
    majority = max(data.filter("label = 0").count(), data.filter("label = 1").count()) / data.count()
    assert metrics.binary_report(scored, "label", "prediction").first().accuracy > majority
    assert scored.filter("probabilities[0] + probabilities[1] not between 0.999999 and 1.000001").isEmpty()
    names = learning.slot_names(learning.build_pipeline(["x", "z"], ["color"]).fit(data).transform(data))
    assert names[:2] == ["x", "z"] and {"color_vec_red", "color_vec_blue"} <= set(names)


def test_newton_solves_the_weighted_problem(spark, data):
    """Equal to the optimum that an independent solver in NumPy finds, with and without penalty."""
    weighted = stats.with_class_weights(data, stats.class_weights(data, "label"), "label").repartition(5)
    rows_ = weighted.orderBy("id").collect()
    colors = sorted({r.color for r in rows_})
    x = np.array([[r.x, r.z, *[float(r.color == c) for c in colors]] for r in rows_])
    x = np.column_stack([np.ones(len(x)), (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)])
    y, w = np.array([r.label for r in rows_]), np.array([r.class_weight for r in rows_])
    for reg in (0.0, 0.01, 1.0):
        model = logit.fit_logit(weighted, ["x", "z"], ["color"], "label", "class_weight", reg=reg)
        ridge = np.array([0.0] + [reg] * 5)
        b = np.zeros(6)
        for _ in range(60):
            p = 1 / (1 + np.exp(-x @ b))
            h = (x * (w * p * (1 - p))[:, None]).T @ x / w.sum() + np.diag(ridge)
            b += np.linalg.pinv(h, rcond=1e-12) @ (x.T @ (w * (y - p)) / w.sum() - ridge * b)
        p = 1 / (1 + np.exp(-x @ b))
        scored = weighted.select("id", model.probability().alias("p")).orderBy("id").collect()
        assert [r.p for r in scored] == pytest.approx(p.tolist(), abs=1e-8)
        assert model.change < 1e-6 and model.steps < 20
    unseen = spark.createDataFrame([(0.0, 0.0, "purple")], "x double, z double, color string")
    assert unseen.select(model.probability().alias("p")).first().p == pytest.approx(1 / (1 + np.exp(-model.intercept)))
    out = model.transform(unseen).first()
    assert out.prediction in (0.0, 1.0) and len(out.probability) == 2
    assert model.coefficients(unseen).count() == 6


def test_newton_refuses_what_it_cannot_fit(spark, data):
    with pytest.raises(RuntimeError, match="no convergence"):
        logit.fit_logit(data.withColumn("y", (F.col("x") > 0).cast("int")), ["x"], [], "y", max_steps=12)
    with pytest.raises(ValueError, match="lack"):
        logit.fit_logit(data.withColumn("x", F.when(F.col("id") > 3, F.col("x"))), ["x"], [], "label")
    with pytest.raises(ValueError, match="no rows"):
        logit.fit_logit(data.limit(0), ["x"], [], "label")


TOY_SCHEMA = "label double, origin string, dest string, dep int, arr int, temp double"


def test_tree_learns_where_missing_values_go(spark):
    df = readers.from_rows(spark, TOY, TOY_SCHEMA)
    model = tree.fit_tree(df, ["dep", "arr", "temp"], ["origin", "dest"], "label", max_depth=5)
    scored = model.transform(df)
    assert scored.filter("prediction = label").count() == 12
    assert sum(model.importances().values()) == pytest.approx(1.0)
    late = df.withColumn("temp", F.when(F.col("temp") < 200, F.col("temp")))
    late = late.withColumn("label", (F.col("temp").isNull() | (F.col("temp") > 150)).cast("double"))
    root = tree.fit_tree(late, ["temp"], [], "label", max_depth=1).splits[1]
    assert not root.default_left and 21 < root.threshold < 22  # missing on the right, with the high ones


def brute_split(rows_, numeric):
    """Best root split by trying all thresholds, all subsets and both sides for the missing."""
    best = (0.0,)

    def gini(part):
        n, p = len(part), sum(r[-1] for r in part)
        return 2 * p * (n - p) / n if n else 0.0

    for f in range(len(rows_[0]) - 1):
        values = sorted({r[f] for r in rows_ if r[f] is not None})
        sides = [set(values[: k + 1]) for k in range(len(values) - 1)]
        if f >= numeric:
            sides = [set(c) for k in range(1, len(values)) for c in combinations(values, k)]
        for left_values in sides:
            for default in (True, False):
                left = [r for r in rows_ if (default if r[f] is None else r[f] in left_values)]
                right = [r for r in rows_ if not (default if r[f] is None else r[f] in left_values)]
                best = max(best, ((gini(rows_) - gini(left) - gini(right)) / len(rows_),))
    return best[0]


def test_root_split_is_the_best_of_all(spark):
    rnd = Random(3)
    for _ in range(3):
        rows_ = [
            (rnd.choice([None, 1.0, 2.0, 3.0, 4.0]), rnd.choice([None, *"abcde"]), rnd.randrange(2)) for _ in range(60)
        ]
        df = spark.createDataFrame(rows_, "n double, c string, y int")
        root = tree.fit_tree(df, ["n"], ["c"], "y", max_depth=1).splits[1]
        assert root.gain == pytest.approx(brute_split(rows_, 1), abs=1e-8)


def test_tree_without_a_split(spark):
    df = spark.createDataFrame([(1.0, 1), (1.0, 0), (None, 1)], "n double, y int")
    model = tree.fit_tree(df.filter("n = 1"), ["n"], [], "y")
    assert model.splits == {} and df.select(model.probability().alias("p")).distinct().count() == 1
    with pytest.raises(ValueError, match="no rows"):
        tree.fit_tree(df.limit(0), ["n"], [], "y")


def test_exact_auc_agrees_with_binned_evaluator(spark, data):
    model = learning.build_pipeline(["x"], [], learning.logistic("label")).fit(data)
    out = model.transform(data)
    flat = out.select("label", learning.vector_to_array("probability")[1].alias("p"))
    exact = metrics.auc_exact(flat, "label", "p").first()
    assert learning.areas(out, "label")["auc_roc"] == pytest.approx(exact.auc_roc, abs=1e-3)


def test_forest_is_reproducible_and_importances_add_up(spark, data):
    weighted = stats.with_class_weights(data, stats.class_weights(data, "label"), "label")
    pipeline = learning.build_pipeline(["x", "z"], ["color"], learning.forest("label", "class_weight", numTrees=5, maxDepth=4))
    a, b = pipeline.fit(weighted), pipeline.fit(weighted)
    assert a.stages[-1].toDebugString == b.stages[-1].toDebugString
    table = learning.importance_table(a, a.transform(weighted), ["x", "z", "color"], {"x": "weather"})
    got = {r.feature: r.importance for r in table.collect()}
    assert set(got) == {"x", "z", "color"} and sum(got.values()) == pytest.approx(1.0)
    assert max(got, key=got.get) == "x"
    shares = {r.feature_group: r.share for r in learning.group_shares(table, 2).collect()}
    assert sum(shares.values()) == pytest.approx(1.0)


def test_coefficients_and_interactions(spark, data):
    pipeline = learning.build_pipeline(["x", "z"], ["color"], learning.logistic("label"), interactions=[("x", "z")])
    model = pipeline.fit(data)
    table = learning.coefficients_table(model, model.transform(data))
    slots = [r.slot for r in table.collect()]
    assert slots[0] == "(intercept)" and "x" in slots and any("color_vec_red" in s for s in slots)
    assert len(slots) == 1 + model.stages[-1].coefficients.size


def test_unseen_category_gets_its_own_slot(spark, data):
    model = learning.build_pipeline(["x"], ["color"], learning.logistic("label")).fit(data)
    odd = data.limit(1).withColumn("color", F.lit("violet"))
    assert model.transform(odd).count() == 1


def test_time_series_search(spark, data):
    folds = splits.rolling_splits(data, "ts", 2017, 2018, 2)

    def make(reg):
        return learning.build_pipeline(["x", "z"], ["color"], learning.logistic("label", regParam=reg))

    out = learning.time_series_search(folds, make, {"reg": [0.0, 0.5]}, "label").collect()
    assert {(r.fold, r.params) for r in out} == {(y, str({"reg": g})) for y in (2017, 2018) for g in (0.0, 0.5)}
    assert all(0.5 < r.auc_roc <= 1 for r in out)


REQUEST = {
    "DELAYS_SO_FAR": 1,
    "MINUTES_AFTER_MIDNIGHT_ORIGIN": 330,
    "MINUTES_AFTER_MIDNIGHT_DEST": 380,
    "NETWORK_CONGESTION": 4012,
    "AVG_VIS_DIS_ORIGIN": 15288.5,
    "DEST_PR": 0.0078058,
    "ORIGIN_PR": 0.0012741,
    "AVG_DEW_DEG_ORIGIN": 156,
    "CRS_ELAPSED_TIME": 50,
    "AVG_WND_SPEED_ORIGIN": 26,
    "AVG_WND_SPEED_DEST": 34.75,
    "QUARTER": 1,
    "DEP_HOUR_BIN": 3,
    "ARR_HOUR_BIN": 3,
    "IS_EARLY_MORNING_FLIGHT": 0,
}


@pytest.fixture(scope="module")
def served(spark):
    """A model on the request's own features, trained on made-up flights."""
    rnd = Random(6)
    num, cat = learning.DELAY_NUMERIC, learning.DELAY_CATEGORICAL
    rows = [
        (*[REQUEST[c] * rnd.uniform(0.5, 1.5) for c in num], *[str(rnd.randrange(4)) for _ in cat], rnd.randrange(2))
        for _ in range(200)
    ]
    schema = ", ".join([f"{c} double" for c in num] + [f"{c} string" for c in cat] + ["label int"])
    train = spark.createDataFrame(rows, schema)
    model = learning.build_pipeline(num, cat, learning.logistic("label", regParam=0.1)).fit(train)
    return scoring.training_defaults(train, num, cat), model


def request_lines():
    partial = {k: v for k, v in REQUEST.items() if k not in ("DEST_PR", "QUARTER")}
    extra = {**REQUEST, "SEATS": 200, "ARR_HOUR_BIN": 77}
    return [(1, json.dumps(REQUEST)), (2, json.dumps(partial)), (3, json.dumps(extra)), (4, "{not json"), (5, "{}")]


def test_batch_requests(spark, served):
    defaults, model = served
    lines = spark.createDataFrame(request_lines(), "id int, value string")
    out = scoring.score_requests(scoring.parse_requests(lines, "value", scoring.REQUEST_SCHEMA), defaults, model, ["id"])
    got = {r.id: r for r in out.collect()}
    assert [got[i].n_filled for i in (1, 2, 3, 4, 5)] == [0, 2, 0, None, 15]
    assert [got[i].status for i in (1, 2, 3, 4, 5)] == ["Success"] * 3 + ["Error", "Success"]
    assert got[4].pred is got[4].probability_0 is got[4].probability_1 is None
    for r in (got[i] for i in (1, 2, 3, 5)):
        assert r.probability_0 + r.probability_1 == pytest.approx(1.0) and r.pred == int(r.probability_1 > 0.5)
    texts = {r.id: json.loads(r.answer) for r in scoring.answers(out, ["id"]).collect()}
    assert texts[1]["data"] == {"pred": got[1].pred, "probabilities": [got[1].probability_0, got[1].probability_1]}
    assert texts[4] == {"status": "Error"}


def test_unreadable_requests(spark):
    texts = [
        (1, '{"a": 1, "b": "x"}'), (2, '[{"a": 1}, {"a": 2}]'), (3, "no json"), (4, None), (5, '{"a": "word"}'),
        (6, "[]"), (7, '[{"a": 1}, 5]'), (8, "17"), (9, ""), (10, "{}"),
    ]
    lines = spark.createDataFrame(texts, "id int, value string")
    got = sorted(tuple(r) for r in scoring.parse_requests(lines, "value", "a double, b string").select("id", "a", "problem").collect())
    read = [(i, a) for i, a, p in got if p is None]
    assert read == [(1, 1.0), (2, 1.0), (2, 2.0), (10, None)]
    assert {i: p for i, a, p in got if p is not None} == {3: "no json", 4: "no text", 5: '{"a": "word"}', 7: '[{"a": 1}, 5]', 8: "17", 9: ""}


def test_stream_equals_batch(spark, served, tmp_path):
    defaults, model = served
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id int, value string"
    lines = spark.createDataFrame(request_lines(), schema)
    lines.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    dead, ck = str(tmp_path / "dead"), str(tmp_path / "ck")

    def start():
        q = scoring.score_stream(stream, "value", scoring.REQUEST_SCHEMA, defaults, model, sink, ck, ["id"], dead_letters=dead)
        assert q.awaitTermination(120) and q.exception() is None

    start()
    batch = scoring.score_requests(scoring.parse_requests(lines, "value", scoring.REQUEST_SCHEMA), defaults, model, ["id"])
    want = sorted(map(str, batch.collect()))
    assert sorted(map(str, spark.read.parquet(sink).drop("batch_id").collect())) == want
    assert [(r.id, r.problem) for r in spark.read.parquet(dead).collect()] == [(4, "{not json")]
    # a batch whose commit was lost is replayed and overwrites itself
    commits = sorted((tmp_path / "ck" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last = commits[-1]
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    start()
    assert sorted(map(str, spark.read.parquet(sink).drop("batch_id").collect())) == want
    assert spark.read.parquet(dead).count() == 1


def test_predictions_and_run_log_round_trip(spark, data, tmp_path):
    model = learning.build_pipeline(["x"], [], learning.logistic("label")).fit(data)
    scored = model.transform(data)
    path = str(tmp_path / "pred")
    writers.save_predictions(scored, path, "label")
    back = readers.load_predictions(spark, path)
    assert back.count() == 600 and back.dtypes == [("label", "double"), ("raw", "double"), ("probability", "double")]
    runs = str(tmp_path / "runs")
    writers.log_run(spark, runs, "lr", "validation", 1.5, {"f1": 0.3, "accuracy": 0.6})
    writers.log_run(spark, runs, "rf", "validation", 9.0, {"f1": 0.4})
    table = {r.run_id: r for r in writers.compare_runs(spark, runs, ["f1", "accuracy"]).collect()}
    assert (table["lr"].f1, table["lr"].accuracy, table["lr"].seconds) == (0.3, 0.6, 1.5)
    assert table["rf"].accuracy is None


def test_tree_reads_rows_alike_once(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(tree, "staged", lambda df, label: kept.append(df.count()) or df)
    rows_in = [(float(k % 3), "ab"[k % 2], int(k % 3 == 2)) for k in range(600)]
    df = spark.createDataFrame(rows_in, "x double, c string, y int")
    model = tree.fit_tree(df, ["x"], ["c"], "y", max_depth=1)
    assert kept == [6]
    s = model.splits[1]
    assert (s.feature, s.threshold, s.left_weight, s.right_weight) == ("x", 1.0, 400.0, 200.0)
