"""Joins, quality, ordering, statistics, splits and metrics on small frames."""

from datetime import datetime, timedelta
from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanfeat.functions.timeexpr import parse_day
from spanfeat.operators import gramian, joins, metrics, ordering, quality, splits, stats
from spanfeat.operators.skew import spread_join


def test_validity_join_bounds_and_overlaps(spark, rows):
    day = datetime(2019, 3, 4)
    facts = spark.createDataFrame(
        [(1, "s", day + timedelta(hours=24)), (2, "s", day + timedelta(hours=24, microseconds=1)), (3, "t", day), (4, "u", day)],
        "id int, st string, ts timestamp_ntz",
    )
    dims = spark.createDataFrame(
        [("s", "20190101", "20190304", "x"), ("t", "20190101", "20190401", "y"), ("t", "20190304", "20190401", "z"), ("u", "bad", "20190401", "w")],
        "st string, b string, e string, name string",
    ).withColumns({"begin": parse_day(F.col("b")), "end": parse_day(F.col("e"))})
    inner = joins.validity_join(facts, dims, "st", "ts", "begin", "end")
    assert rows(inner, "id", "name") == [(1, "x"), (3, "y"), (3, "z")]
    left = joins.validity_join(facts, dims, "st", "ts", "begin", "end", how="left")
    assert rows(left, "id", "name") == [(1, "x"), (2, None), (3, "y"), (3, "z"), (4, None)]


def test_validity_join_against_brute_force(spark):
    """Periods from seconds to years, open ends, nulls, repeated rows and empty periods."""
    rnd = Random(8)
    t0 = datetime(2020, 1, 1)
    dims, facts = [], []
    for i in range(120):
        begin = t0 + timedelta(seconds=rnd.randrange(5 * 365 * 86400))
        end = begin + timedelta(seconds=rnd.choice([-200000, 0, 5, 3600, 86400, 10**6, 10**8]))
        dims.append((rnd.choice("ab"), None if i == 7 else begin, None if i == 8 else end, i))
    for i in range(300):
        facts.append((i // 2, rnd.choice(["a", "b", "c", None]), None if i == 9 else t0 + timedelta(seconds=rnd.randrange(6 * 365 * 86400))))
    d = spark.createDataFrame(dims, "st string, begin timestamp_ntz, end timestamp_ntz, dim int")
    f = spark.createDataFrame(facts, "id int, st string, ts timestamp_ntz")
    grace = timedelta(hours=24)
    hits = [
        (i, n) for i, st, ts in facts for k, b, e, n in dims
        if st == k and None not in (ts, b, e) and b <= ts <= e + grace
    ]
    inner = joins.validity_join(f, d, "st", "ts", "begin", "end")
    assert inner.columns == ["id", "st", "ts", "begin", "end", "dim"]
    assert sorted((r.id, r.dim) for r in inner.collect()) == sorted(hits)
    left = joins.validity_join(f, d, "st", "ts", "begin", "end", how="left")
    matched = {i for i, _ in hits}
    alone = sum(1 for i, st, ts in facts if not any(st == k and None not in (ts, b, e) and b <= ts <= e + grace for k, b, e, _ in dims))
    got = left.collect()
    assert sorted((r.id, r.dim) for r in got if r.dim is not None) == sorted(hits)
    assert sum(r.dim is None for r in got) == alone and matched


def test_validity_join_of_one_key_with_many_periods(spark):
    """Ten thousand periods and facts on one key: candidates stay near the results, far from all pairs."""
    day = timedelta(days=1)
    t0 = datetime(2000, 1, 1)
    dims = spark.createDataFrame([("k", t0 + i * day, t0 + (i + 1) * day, i) for i in range(10_000)], "st string, begin timestamp_ntz, end timestamp_ntz, dim int")
    facts = spark.createDataFrame([("k", t0 + timedelta(hours=11) + i * day) for i in range(10_000)], "st string, ts timestamp_ntz")
    out = joins.validity_join(facts, dims, "st", "ts", "begin", "end", timedelta(0))
    assert out.count() == 10_000
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "_fact_chunk" in plan
    level = joins._chunk_level(F.lit(86_400_000_000)).alias("l")
    width = 2 ** spark.range(1).select(level).first()[0]
    per_chunk = width / 86_400_000_000 + 1
    assert per_chunk < 3  # periods of a chunk that a fact meets


def test_join_roles(spark, rows):
    f = spark.createDataFrame([(1, "A", "B"), (2, "A", "Q")], "id int, o string, d string")
    dim = spark.createDataFrame([("A", "s1", 1.0), ("B", "s2", 2.0)], "iata string, st string, pr double")
    out = joins.join_roles(f, dim, "iata", {"o": "ORIGIN_", "d": "DEST_"}, ["st", "pr"])
    assert rows(out, "id", "ORIGIN_st", "DEST_st", "DEST_pr") == [(1, "s1", "s2", 2.0), (2, "s1", None, None)]
    assert joins.join_roles(f, dim, "iata", {"o": "o_", "d": "d_"}, ["st"], "inner").count() == 1


def test_full_outer_merge_null_keys(spark, rows):
    a = spark.createDataFrame([(1, "x", 1.0), (2, None, 2.0)], "k int, c string, a double")
    b = spark.createDataFrame([(1, "x", 5.0), (2, None, 6.0), (3, "z", 7.0)], "k int, c string, b double")
    safe = joins.full_outer_merge({"a": a, "b": b}, ["k", "c"])
    assert rows(safe, "k", "a", "b") == [(1, 1.0, 5.0), (2, 2.0, 6.0), (3, None, 7.0)]
    plain = joins.full_outer_merge({"a": a, "b": b}, ["k", "c"], null_safe=False)
    want = sorted(map(str, a.join(b, ["k", "c"], "full").select("k", "c", "a", "b").collect()))
    assert sorted(map(str, plain.select("k", "c", "a", "b").collect())) == want


@pytest.mark.parametrize("null_safe", [True, False])
def test_full_outer_merge_keeps_repeated_keys(spark, null_safe):
    a = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0), (3, None), (None, 9.0)], "k int, a double")
    b = spark.createDataFrame([(1, 5.0), (1, 6.0), (1, 6.0), (4, 7.0), (4, None), (None, 8.0)], "k int, b double")
    c = spark.createDataFrame([(1, 0.5), (4, 0.25), (5, 0.125)], "k int, c double")
    got = joins.full_outer_merge({"a": a, "b": b, "c": c}, ["k"], null_safe=null_safe)
    if null_safe:
        same = lambda x, y: x["k"].eqNullSafe(y["k"])
        ab = a.join(b, same(a, b), "full").select(F.coalesce(a["k"], b["k"]).alias("k"), "a", "b")
        want = ab.join(c, same(ab, c), "full").select(F.coalesce(ab["k"], c["k"]).alias("k"), "a", "b", "c")
    else:
        want = a.join(b, "k", "full").join(c, "k", "full")
    assert sorted(map(str, got.select("k", "a", "b", "c").collect())) == sorted(map(str, want.select("k", "a", "b", "c").collect()))


def test_with_one_row_is_strict(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    one = spark.createDataFrame([(7, "x")], "a int, b string")
    assert rows(joins.with_one_row(df, one)) == [(1, 7, "x"), (2, 7, "x")]
    with pytest.raises(Exception, match="(?i)more than one row|SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        joins.with_one_row(df, one.unionAll(one)).collect()


def test_semi_and_anti_do_not_multiply(spark, rows):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(joins.matched(a, b, "k")) == [(1,)]
    assert rows(joins.unmatched(a, b, "k")) == [(2,), (None,)]


def test_null_profile_types(spark, rows):
    nan = float("nan")
    df = spark.createDataFrame(
        [("a", nan, "abc", 1, datetime(2020, 1, 1)), ("a", None, None, None, None), ("b", 2.0, "x", 3, None)],
        "g string, d double, s string, i int, t timestamp_ntz",
    )
    assert rows(quality.null_profile(df), "column", "nulls", "total") == [
        ("d", 2, 3), ("g", 0, 3), ("i", 1, 3), ("s", 1, 3), ("t", 2, 3),
    ]
    by = quality.null_profile(df, ["d", "t"], by="g")
    assert rows(by, "g", "column", "nulls", "total") == [("a", "d", 2, 2), ("a", "t", 1, 2), ("b", "d", 0, 1), ("b", "t", 1, 1)]


def test_sparse_columns_outliers_and_loss(spark, rows):
    df = spark.createDataFrame([(i, float(i), None if i else 1.0) for i in range(10)], "id int, x double, thin double")
    kept = quality.drop_sparse_columns(df, 0.8)
    assert kept.columns == ["id", "x"]
    assert quality.drop_sparse_columns(df, 0.9).columns == df.columns
    inside = quality.filter_outliers(kept, "x", low=2, high=7)
    assert inside.count() == 6
    report = quality.loss_report(df, inside).first()
    assert (report.rows_lost, report.rows_lost_pct, report.columns_lost) == (4, 40.0, 1)
    assert report.columns_lost_pct == pytest.approx(33.333333)
    published = quality.loss_report(spark.range(31_746_841), spark.range(31_171_199)).first()
    assert published.rows_lost == 575_642 and round(published.rows_lost_pct, 4) == 1.8132


def test_exclude_flagged(spark, rows):
    df = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (3, None, 0), (4, 0, 1)], "id int, c int, d int")
    assert rows(quality.exclude_flagged(df, ["c", "d"]), "id") == [(1,), (3,)]


@pytest.mark.parametrize("n", [1, 2, 7, 400])
def test_exact_quantiles_match_numpy(spark, n):
    rnd = Random(n)
    vals = [round(rnd.gauss(0, 3), 1) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    assert ordering.exact_quantiles(df, "v", probs) == pytest.approx(list(np.quantile(vals, probs)))
    assert ordering.exact_quantiles(df.filter("v > 1e9"), "v", [0.5]) == [None]


def test_quantile_brackets_keep_few_values(spark):
    df = spark.range(200_000).select(F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("double").alias("v"))
    n, brackets = ordering.quantile_brackets(df, [0.25, 0.75])
    kept = df.filter(" OR ".join(f"v BETWEEN {a} AND {b}" for a, b in brackets)).count()
    assert n == 200_000 and 0 < kept < 0.01 * n
    vals = [r.v for r in df.collect()]
    assert ordering.exact_quantiles(df, "v", [0.25, 0.75]) == pytest.approx(list(np.quantile(vals, [0.25, 0.75])))


def test_quantiles_survive_a_wrong_bracket(spark, monkeypatch):
    df = spark.createDataFrame([(float(v),) for v in range(50)], "v double")
    monkeypatch.setattr(ordering, "quantile_brackets", lambda values, probs, accuracy: (50, [(40.0, 45.0)] * len(probs)))
    assert ordering.exact_quantiles(df, "v", [0.1, 0.85]) == pytest.approx([4.9, 41.65])


def test_pair_moments_in_tiles(spark):
    """Tiles and passes give what one block gives; nulls and NaN are absent, means may be large."""
    rnd = np.random.default_rng(3)
    x = rnd.standard_normal((300, 7)) + 1e7
    x[:, 3] += 2 * x[:, 1]
    x[rnd.random(x.shape) < 0.1] = np.nan
    x[:, 5] = 4.0
    cols = [f"c{i}" for i in range(7)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) and k % 2 else float(v) for v in r) for k, r in enumerate(x)], ", ".join(f"{c} double" for c in cols))
    for tile, limit in ((128, 1 << 20), (3, 1 << 20), (2, 1)):
        got = {(r.i, r.j): r for r in gramian.pair_moments(df.repartition(5), cols, tile, limit).collect()}
        assert len(got) == 21
        for (i, j), r in got.items():
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i] - x[both, i].mean(), x[both, j] - x[both, j].mean()
            assert r.n == both.sum() and r.mean_i == pytest.approx(x[both, i].mean())
            assert (r.sxx, r.syy, r.sxy) == pytest.approx(((a * a).sum(), (b * b).sum(), (a * b).sum()), rel=1e-6, abs=1e-6)
    found = {(r.a, r.b): r["corr"] for r in stats.correlation_pairs(df, cols).collect()}
    assert found["c4", "c5"] is None and found["c1", "c3"] == pytest.approx(np.ma.corrcoef(np.ma.masked_invalid(x[:, 1]), np.ma.masked_invalid(x[:, 3]))[0, 1], abs=1e-6)


def test_918_columns(spark):
    """As many features as the delay model had after encoding."""
    wide = spark.range(60).select(*[F.rand(seed=i).alias(f"c{i}") for i in range(918)])
    out = stats.correlation_pairs(wide, wide.columns)
    assert out.count() == 918 * 917 // 2


def test_spread_join_with_a_hot_key(spark, rows):
    """Half of all rows on one key, broadcasts off: no task has much more than its fair part."""
    data = [(k, "hot" if k % 2 else f"s{k % 97}" if k % 6 else None) for k in range(8000)]
    many = spark.createDataFrame(data, "id int, st string").repartition(6)
    few = spark.createDataFrame([("hot", 1), ("s2", 2), ("s4", 3), ("none", 4)], "key string, x int")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for how in ("inner", "left", "left_semi", "left_anti"):
            got = spread_join(many, few, "st", few_keys="key", how=how)
            want = many.join(few, F.col("st") == F.col("key"), how).drop("key")
            assert got.columns == want.columns and rows(got) == rows(want)
        out = spread_join(many.hint("merge"), few.hint("merge"), "st", few_keys="key", how="left")
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 8000 / 6 and out.count() == 8000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ordered_prefix(spark):
    rnd = Random(4)
    data = [(k, rnd.randrange(10), rnd.random()) for k in rnd.sample(range(10_000), 500)]
    df = spark.createDataFrame(data, "k int, a int, b double")
    out = {r.k: (r.a_before, r.b_before) for r in ordering.ordered_prefix(df, "k", ["a", "b"]).collect()}
    a = b = 0
    for k, x, y in sorted(data):
        assert out[k] == (a, pytest.approx(b))
        a, b = a + x, b + y


def test_group_mean_diff_and_train_slice(spark, rows):
    df = spark.createDataFrame([("a", "b", 1.0), ("a", "b", 3.0), ("c", "b", 5.0)], "o string, d string, x double")
    assert rows(stats.group_mean_diff(df, ["o", "d"], "x", "diff"), "diff") == [(-1.0,), (0.0,), (1.0,)]
    train = df.filter("x < 2")
    assert rows(stats.group_mean_diff(df, ["o", "d"], "x", "diff", train), "diff") == [(0.0,), (2.0,), (None,)]


def test_daily_volume(spark, rows):
    t = datetime(2024, 1, 1, 23)
    df = spark.createDataFrame(
        [("A", "B", t, t + timedelta(hours=2)), ("A", "C", t, t), ("B", None, t, t)],
        "o string, d string, dep timestamp_ntz, arr timestamp_ntz",
    )
    out = stats.daily_volume(df, {"departures": ("o", "dep"), "arrivals": ("d", "arr")})
    got = rows(out.withColumn("day", F.date_format("day", "dd")), "entity", "day", "departures", "arrivals")
    assert got == [("A", "01", 2, 0), ("B", "01", 1, 0), ("B", "02", 0, 1), ("C", "01", 0, 1)]


def test_scaling_and_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, 4.0, 7.0), (4.0, 8.0, 7.0)], "a double, b double, c double")
    out = stats.standardize(df, ["a", "c"]).collect()
    assert sum(r.a_std for r in out) == pytest.approx(0) and {r.c_std for r in out} == {0.0}
    pairs = stats.correlation_pairs(df, ["a", "b", "c"])
    assert {(r.a, r.b): r["corr"] for r in pairs.collect()}[("a", "b")] == pytest.approx(1.0)
    assert stats.drop_collinear(pairs, ["a", "b", "c"], 0.9) == ["a", "c"]
    assert stats.pairwise_products(df, ["a", "b"]).first()["a_x_b"] == 2.0


def test_class_weights(spark, rows):
    df = spark.createDataFrame([(0,)] * 8 + [(1,)] * 2, "y int")
    w = stats.class_weights(df, "y")
    assert rows(w) == [(0, 8, 0.625), (1, 2, 2.5)]
    weighted = stats.with_class_weights(df, w, "y")
    assert weighted.agg(F.sum("class_weight")).first()[0] == pytest.approx(10)


def test_splits(spark, rows):
    ts = [datetime(2017, 12, 31, 23), datetime(2018, 1, 1), datetime(2019, 1, 1), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "id int, ts timestamp_ntz")
    out = splits.temporal_split(df, "ts", [datetime(2018, 1, 1), datetime(2019, 1, 1)])
    assert rows(out, "id", "split") == [(0, "train"), (1, "validation"), (2, "test"), (3, None)]
    folds = splits.rolling_splits(df, "ts", 2018, 2019, 1)
    assert rows(folds, "id", "fold", "role") == [(0, 2018, "train"), (1, 2018, "test"), (1, 2019, "train"), (2, 2019, "test")]
    plan = splits.slice_between(df, "ts", datetime(2018, 1, 1), datetime(2019, 1, 1))
    assert rows(plan, "id") == [(1,)]


def test_year_slice_reaches_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(1, datetime(2018, 5, 1))], "id int, ts timestamp_ntz")
    df.write.parquet(str(tmp_path / "t"))
    read = splits.slice_between(spark.read.parquet(str(tmp_path / "t")), "ts", datetime(2018, 1, 1), datetime(2019, 1, 1))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_entity_quarter_slice_year_end(spark, rows):
    df = spark.createDataFrame(
        [(1, "Chicago", datetime(2015, 12, 31)), (2, "Atlanta", datetime(2016, 1, 1)), (3, "Reno", datetime(2015, 11, 1))],
        "id int, city string, ts timestamp_ntz",
    )
    assert rows(splits.entity_quarter_slice(df, "city", ["Chicago", "Atlanta"], "ts", 2015, 4), "id") == [(1,)]


def scored(spark, data):
    return spark.createDataFrame(data, "label int, pred int, score double")


def test_report_arithmetic(spark):
    # a published report: support 25073 / 5360, recall 0.60 / 0.62
    data = spark.createDataFrame(
        [(0, 0, 15044), (0, 1, 10029), (1, 0, 2037), (1, 1, 3323)], "label int, pred int, n int"
    ).select("label", "pred", F.explode(F.sequence(F.lit(1), "n")))
    rep = {r["class"]: r for r in metrics.class_report(data, "label", "pred").collect()}
    assert [round(rep["0"][c], 2) for c in ("precision", "recall", "f1")] == [0.88, 0.60, 0.71]
    assert [round(rep["1"][c], 2) for c in ("precision", "recall", "f1")] == [0.25, 0.62, 0.36]
    assert rep["0"].support == 25073 and rep["1"].support == 5360
    assert round(rep["accuracy"].f1, 2) == 0.60 and rep["weighted avg"].support == 30433
    one = metrics.binary_report(data, "label", "pred").first()
    assert one.f1 == pytest.approx(rep["1"].f1) and one.accuracy == pytest.approx(rep["accuracy"].f1)


def test_class_never_predicted(spark, rows):
    df = scored(spark, [(0, 0, 0.1), (1, 0, 0.2)])
    rep = {r["class"]: r for r in metrics.class_report(df, "label", "pred").collect()}
    assert (rep["1"].precision, rep["1"].recall, rep["1"].f1) == (0.0, 0.0, 0.0)
    assert rows(metrics.confusion(df, "label", "pred")) == [(0, 0, 1), (0, 1, 0), (1, 0, 1), (1, 1, 0)]


def test_auc_ties_and_single_class(spark):
    tied = metrics.auc_exact(scored(spark, [(0, 0, 0.5), (1, 1, 0.5), (1, 1, 0.5)]), "label", "score").first()
    assert tied.auc_roc == 0.5
    assert metrics.auc_exact(scored(spark, [(1, 1, 0.5)]), "label", "score").first().auc_roc is None
    perfect = metrics.auc_exact(scored(spark, [(0, 0, 0.1), (1, 1, 0.9)]), "label", "score").first()
    assert (perfect.auc_roc, perfect.auc_pr) == (1.0, 1.0)


def test_auc_and_roc_equal_pair_counting(spark):
    rnd = Random(8)
    data = [(rnd.randrange(2), 0, round(rnd.random(), 2)) for _ in range(300)]
    df = scored(spark, data)
    pos = [s for y, _, s in data if y]
    neg = [s for y, _, s in data if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert metrics.auc_exact(df, "label", "score").first().auc_roc == pytest.approx(wins / len(pos) / len(neg))
    for r in metrics.roc_points(df, "label", "score").collect():
        assert r.tp == sum(p >= r.threshold for p in pos) and r.fp == sum(n >= r.threshold for n in neg)
    assert metrics.roc_points(df, "label", "score", bins=4).count() <= 5


def test_error_rate_by(spark, rows):
    df = spark.createDataFrame([(0, 1, "x"), (0, 0, "x"), (1, 0, "y")], "label int, pred int, b string")
    out = metrics.error_rate_by(df, "label", "pred", "b")
    assert rows(out, "b", "n", "false_pos", "false_neg", "false_pos_share") == [("x", 2, 1, 0, 0.5), ("y", 1, 0, 1, 0.0)]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="nope"):
        joins.validity_join(spark.range(1), spark.range(1), "nope", "ts", "b", "e")
