import math
from collections import deque
from random import Random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanfeat.functions.geoexpr import haversine_miles
from spanfeat.operators import geo, graph, pyramid

R = 3958.7613


def miles(a, b):
    (la1, lo1), (la2, lo2) = a, b
    p1, p2 = math.radians(la1), math.radians(la2)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lo2 - lo1) / 2) ** 2
    return 2 * R * math.asin(math.sqrt(min(1.0, h)))


def neighbours(spark, pts, radius):
    df = spark.createDataFrame(pts, "id int, lat double, lon double")
    return geo.radius_neighbors(df, "id", "lat", "lon", radius)


def brute(pts, radius):
    where = {i: (la, lo) for i, la, lo in pts}
    return {(a, b) for a in where for b in where if a == b or miles(where[a], where[b]) <= radius}


@pytest.mark.parametrize("radius", [50.0, 700.0, 9000.0])
@pytest.mark.parametrize("area", ["globe", "poles", "date line", "crowd"])
def test_grid_equals_brute_force(spark, area, radius):
    rnd = Random(area)
    draw = {
        "globe": lambda: (rnd.uniform(-90, 90), rnd.uniform(-180, 180)),
        "poles": lambda: (rnd.choice([-1, 1]) * rnd.uniform(88, 90), rnd.uniform(-180, 180)),
        "date line": lambda: (rnd.uniform(-3, 3), (rnd.uniform(-2, 2) + 360) % 360 - 180),
        "crowd": lambda: (40.0 + rnd.choice([0, 0, rnd.uniform(-1, 1)]), -100.0),
    }[area]
    pts = [(i, *draw()) for i in range(80)] + [(200, 90.0, 0.0), (201, -90.0, 10.0), (202, 0.0, 180.0), (203, 0.0, -180.0)]
    got = neighbours(spark, pts, radius).collect()
    assert {(r.id, r.neighbor_id) for r in got} == brute(pts, radius)
    assert len(got) == len(brute(pts, radius))
    where = {i: (la, lo) for i, la, lo in pts}
    for r in got:
        assert r.dist == pytest.approx(miles(where[r.id], where[r.neighbor_id]), abs=1e-6)


def test_crowded_cell_is_split(spark, monkeypatch):
    pts = [(i, 40 + i * 1e-4, -100.0) for i in range(60)]
    df = spark.createDataFrame(pts, "_id int, _lat double, _lon double")
    targets = df.toDF("_tid", "_tlat", "_tlon")
    assert geo._within(df, targets, 50.0, cell_rows=7).count() == 3600


def test_self_first_and_isolated_points(spark, rows):
    out = neighbours(spark, [(1, 10.0, 10.0), (0, 10.0, 10.0), (2, 50.0, 50.0), (3, None, 1.0)], 50.0)
    assert rows(out, "id", "neighbor_id", "rank") == [
        (0, 0, 1), (0, 1, 2), (1, 0, 2), (1, 1, 1), (2, 2, 1), (3, 3, 1),
    ]
    assert rows(geo.neighbor_counts(out, "id")) == [(0, 2), (1, 2), (2, 1), (3, 1)]


def test_nearest_label(spark):
    rnd = Random(1)
    refs = [(f"z{i:02d}", rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for i in range(12)]
    pts = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(60)] + [(99, None, 0.0)]
    p = spark.createDataFrame(pts, "id int, lat double, lon double")
    r = spark.createDataFrame(refs, "tz string, la double, lo double")
    out = geo.nearest_label(p, r, "lat", "lon", "tz", "la", "lo")
    got = {x.id: (x.label, x.dist) for x in out.collect()}
    assert len(got) == 61 and got[99] == (None, None)
    for i, la, lo in pts[:-1]:
        d, name = min((miles((la, lo), (a, o)), n) for n, a, o in refs)
        assert got[i][0] == name and got[i][1] == pytest.approx(d, abs=1e-6)


@pytest.mark.parametrize("extra", [0, 300])
def test_nearest_label_at_midpoints(spark, extra):
    rnd = Random(4)
    spots = [(round(rnd.uniform(-60, 60), 3), round(rnd.uniform(-170, 170), 3)) for _ in range(40)]
    refs = [(f"r{k:02d}{side}", la, lo + (0.5 if side == "a" else -0.5)) for k, (la, lo) in enumerate(spots) for side in "ba"]
    refs += [(f"zz{k:03d}", 85.0, -179.0 + k) for k in range(extra)]
    p = spark.createDataFrame([(k, la, lo) for k, (la, lo) in enumerate(spots)], "id int, lat double, lon double")
    r = spark.createDataFrame(refs, "tz string, la double, lo double")
    got = {x.id: x.label for x in geo.nearest_label(p, r, "lat", "lon", "tz", "la", "lo").collect()}
    for k, (la, lo) in enumerate(spots):
        assert got[k] == min((round(miles((la, lo), (a, o)), 9), n) for n, a, o in refs)[1]


@pytest.mark.parametrize("area,radius", [("globe", 0.0), ("globe", 700.0), ("globe", 13000.0), ("poles", 50.0), ("poles", 9000.0), ("date line", 50.0), ("crowd", 50.0)])
def test_range_counts_equal_brute_force(spark, area, radius):
    rnd = Random(area)
    draw = {
        "globe": lambda: (rnd.uniform(-90, 90), rnd.uniform(-180, 180)),
        "poles": lambda: (rnd.choice([-1, 1]) * rnd.uniform(88, 90), rnd.uniform(-180, 180)),
        "date line": lambda: (rnd.uniform(-3, 3), (rnd.uniform(-2, 2) + 360) % 360 - 180),
        "crowd": lambda: (40.0 + rnd.choice([0, 0, rnd.uniform(-1, 1)]), -100.0),
    }[area]
    pts = [(i, *draw()) for i in range(150)] + [(200, 90.0, 0.0), (201, -90.0, 10.0), (202, 0.0, 180.0), (203, 0.0, -180.0)]
    pts += [(300, None, 1.0), (301, float("nan"), 1.0), (302, float("inf"), 1.0)]
    df = spark.createDataFrame(pts, "id int, lat double, lon double")
    got = {r.id: r.n_neighbors for r in geo.range_counts(df, "id", "lat", "lon", radius).collect()}
    where = {i: (la, lo) for i, la, lo in pts if i < 300}
    want = {a: sum(miles(where[a], where[b]) <= radius or a == b for b in where) for a in where}
    assert got == want | {300: 1, 301: 1, 302: 1}


def test_range_counts_compare_few_places(spark):
    """Whole cells are counted by their total: ten times the points take far less than a hundred times the pairs."""
    rnd = Random(2)
    work = []
    for n in (1_000, 10_000):
        pts = spark.createDataFrame([(rnd.uniform(40, 42), rnd.uniform(-100, -98)) for _ in range(n)], "lat double, lon double")
        places = pyramid.with_axes(pts.distinct().withColumn("m", F.lit(1)))
        seen = []
        total = pyramid.counts_within(places, 50.0, pair_rows=64, probe=seen.append).agg(F.sum("n")).first()[0]
        work.append((sum(seen), total))
    assert work[1][1] > 80 * work[0][1]  # pairs within reach
    assert work[1][0] < 35 * work[0][0] and work[1][0] < work[1][1] / 4


@pytest.mark.parametrize("place", ["dense city", "empty ocean"])
def test_nearest_label_looks_at_few_candidates(spark, place):
    rnd = Random(3)
    refs = [(f"r{k:04d}", rnd.uniform(40, 40.3), rnd.uniform(-100, -99.7)) for k in range(700)]
    if place == "dense city":
        pts = [(rnd.uniform(40, 40.3), rnd.uniform(-100, -99.7)) for _ in range(100)]
    else:
        pts = [(rnd.uniform(-60, 0), rnd.uniform(0, 170)) for _ in range(100)]
    spots = pyramid.with_axes(spark.createDataFrame(refs, "label string, lat double, lon double"))
    places = pyramid.with_axes(spark.createDataFrame(pts, "lat double, lon double"))
    seen = []
    got = {(r.lat, r.lon): (r.label, r.dist) for r in pyramid.nearest(places, spots, probe=seen.append).collect()}
    assert max(seen) <= pyramid.CANDIDATES
    for la, lo in pts:
        d, name = min((round(miles((la, lo), (a, o)), 9), n) for n, a, o in refs)
        assert got[la, lo][0] == name and got[la, lo][1] == pytest.approx(d, abs=1e-6)


def test_places_that_are_no_numbers(spark):
    rows_ = [(0, float("nan"), 0.0), (1, 0.0, float("inf")), (2, 0.0, 0.5)]
    p = spark.createDataFrame(rows_, "id int, lat double, lon double")
    r = spark.createDataFrame([("a", float("nan"), 0.0), ("b", 0.0, 0.0)], "tz string, la double, lo double")
    got = {x.id: x.label for x in geo.nearest_label(p, r, "lat", "lon", "tz", "la", "lo").collect()}
    assert got == {0: None, 1: None, 2: "b"}
    assert p.select(haversine_miles(F.col("lat"), F.col("lon"), F.lit(0.0), F.lit(0.0)).alias("d")).filter("d IS NOT NULL").count() == 1


def test_nearest_label_without_refs(spark, rows):
    p = spark.createDataFrame([(1, 0.0, 0.0)], "id int, lat double, lon double")
    r = spark.createDataFrame([], "tz string, la double, lo double")
    assert rows(geo.nearest_label(p, r, "lat", "lon", "tz", "la", "lo"), "id", "label") == [(1, None)]


def power_iteration(edges, d=0.85, rounds=300):
    nodes = sorted({n for s, t, _ in edges for n in (s, t)})
    out = {n: sum(w for s, _, w in edges if s == n) for n in nodes}
    r = dict.fromkeys(nodes, 1 / len(nodes))
    for _ in range(rounds):
        lost = sum(r[n] for n in nodes if not out[n])
        r = {
            n: (1 - d) / len(nodes)
            + d * lost / len(nodes)
            + d * sum(r[s] * w / out[s] for s, t, w in edges if t == n)
            for n in nodes
        }
    return r


GRAPHS = {
    "dangling": [(1, 2, 3.0), (2, 3, 1.0), (1, 3, 1.0), (4, 1, 2.0)],
    "two parts and loops": [(1, 2, 1.0), (2, 1, 1.0), (3, 3, 2.0), (3, 4, 1.0), (4, 3, 5.0), (1, 2, 4.0)],
    "single loop": [(1, 1, 1.0)],
    "chain": [(i, i + 1, 1.0) for i in range(60)],
    "hub": [(0, i, float(i)) for i in range(1, 30)] + [(i, 0, 1.0) for i in range(1, 30, 2)],
}


@pytest.mark.parametrize("name,edge_rows", [*[(g, 10_000) for g in GRAPHS], ("hub", 4), ("dangling", 1)])
def test_pagerank(spark, name, edge_rows):
    e = spark.createDataFrame(GRAPHS[name], "src int, dst int, weight double")
    got = {r.node: r["rank"] for r in graph.pagerank(e, tol=1e-10, edge_rows=edge_rows, rounds_per_cut=6).collect()}
    assert got == pytest.approx(power_iteration(GRAPHS[name]), abs=1e-10)
    assert sum(got.values()) == pytest.approx(1.0)


def test_pagerank_of_nothing(spark):
    e = spark.createDataFrame([], "src int, dst int, weight double")
    assert graph.pagerank(e).count() == 0


def brandes(edges, directed):
    nodes = sorted({n for e in edges for n in e[:2]})
    adj = {n: set() for n in nodes}
    for s, t, *_ in edges:
        if s != t:
            adj[s].add(t)
            if not directed:
                adj[t].add(s)
    score = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        dist, sigma, order, pred, todo = {s: 0}, {s: 1.0}, [], {n: [] for n in nodes}, deque([s])
        while todo:
            v = todo.popleft()
            order.append(v)
            for w in adj[v]:
                if w not in dist:
                    dist[w], sigma[w] = dist[v] + 1, 0.0
                    todo.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    pred[w].append(v)
        delta = dict.fromkeys(nodes, 0.0)
        for w in reversed(order):
            for v in pred[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                score[w] += delta[w]
    n = len(nodes)
    scale = 1 / ((n - 1) * (n - 2)) if n > 2 else 1.0
    return {k: v * scale for k, v in score.items()}


@pytest.mark.parametrize("directed", [True, False])
@pytest.mark.parametrize("edge_rows,batch", [(10_000, 10_000), (2, 8)])
def test_betweenness(spark, directed, edge_rows, batch):
    rnd = Random(9)
    edges = [(rnd.randrange(14), rnd.randrange(14)) for _ in range(30)] + [(20, 21), (21, 22), (3, 3), (1, 2), (1, 2)]
    e = spark.createDataFrame(edges, "src int, dst int")
    out = graph.betweenness(e, directed=directed, edge_rows=edge_rows, sources_per_batch=batch)
    assert {r.node: r.betweenness for r in out.collect()} == pytest.approx(brandes(edges, directed), abs=1e-9)


def test_sample_size_and_pairs(spark):
    assert graph.path_sample_size(0.1, 0.1, 10) == math.ceil(50 * (3 + 1 + math.log(10)))
    nodes = spark.createDataFrame([(f"n{i}",) for i in range(7)], "node string")
    pairs = graph.sample_pairs(nodes, 7, 4200, seed=3).collect()
    assert len(pairs) == 4200 and all(p.source != p.target for p in pairs)
    count = {}
    for p in pairs:
        count[p.source, p.target] = count.get((p.source, p.target), 0) + 1
    assert len(count) == 42 and all(50 < c < 160 for c in count.values())


def test_sampled_betweenness_stays_within_its_bound(spark):
    """A hundred seeds at once: the largest error of at least 95 is below epsilon (delta 0.05)."""
    rnd = Random(11)
    edges = [(rnd.randrange(16), rnd.randrange(16)) for _ in range(40)] + [(16, 17), (17, 1), (2, 16)]
    e = spark.createDataFrame(edges, "src int, dst int")
    exact = brandes(edges, True)
    n, epsilon = len(exact), 0.15
    links = graph._Links(e, True, 10_000)
    stretch = n / (n - 2)
    count = graph.path_sample_size(epsilon / stretch, 0.05, graph._vertex_bound(links))
    nodes = sorted(exact)
    rows_ = [(k, *rnd.sample(nodes, 2)) for k in range(100 * count)]
    draws = spark.createDataFrame(rows_, "sample long, source int, target int")
    hits = graph._draw_paths(links, draws, seed=5)
    table = hits.groupBy((F.col("sample") / count).cast("int").alias("seed"), "node").count().collect()
    got = {(r.seed, r.node): r["count"] * stretch / count for r in table}
    worst = [max(abs(exact[k] - got.get((s, k), 0.0)) for k in exact) for s in range(100)]
    assert sum(w <= epsilon for w in worst) >= 95
    mean = {k: sum(got.get((s, k), 0.0) for s in range(100)) / 100 for k in exact}
    assert mean == pytest.approx(exact, abs=0.02)  # every path of a pair is as likely


@pytest.mark.parametrize("directed", [True, False])
def test_betweenness_sampled(spark, directed):
    edges = [(i, (i + 1) % 12) for i in range(12)] + [(0, 6), (3, 20)]
    e = spark.createDataFrame(edges, "src int, dst int")
    out = graph.betweenness_sampled(e, epsilon=0.05, directed=directed, seed=2, sources_per_batch=7 if directed else 100)
    assert {r.node: r.betweenness for r in out.collect()} == pytest.approx(brandes(edges, directed), abs=0.05)


def test_edge_weights(spark, rows):
    trips = [("ABE", "ATL")] * 3 + [("ABE", "CLT"), ("ATL", "ABE")]
    df = spark.createDataFrame(trips, "o string, d string")
    assert rows(graph.edge_weights(df, "o", "d", "count")) == [("ABE", "ATL", 3), ("ABE", "CLT", 1), ("ATL", "ABE", 1)]


def test_neighbour_lists_shuffle_points_only(spark):
    """No side of the search goes through the driver, and pairs are ranked where they are made."""
    points = spark.range(500).select("id", (F.col("id") / 300).alias("lat"), (F.col("id") / 200).alias("lon"))
    plan = geo.radius_neighbors(points, "id", "lat", "lon", 50.0)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [_band" not in plan and "SortMergeJoin [_band" in plan
    search = plan[plan.index("Window") : plan.index("SortMergeJoin")]
    assert "Exchange" not in search


def test_neighbour_lists_of_split_cells(spark, rows, monkeypatch):
    pts = [(i, 40 + (i % 20) * 1e-3, -100.0) for i in range(60)] + [(60, None, 1.0), (None, 40.0, -100.0)]
    whole = rows(neighbours(spark, pts, 0.5))
    monkeypatch.setattr(geo, "CELL_ROWS", 7)
    monkeypatch.setattr(geo, "PAIR_ROWS", 100)
    assert rows(neighbours(spark, pts, 0.5)) == whole
    assert {(a, b) for a, b, *_ in whole} == brute([p for p in pts if None not in p], 0.5) | {(60, 60), (None, None)}


@pytest.mark.parametrize("directed", [True, False])
def test_betweenness_in_many_tiles(spark, monkeypatch, directed):
    monkeypatch.setattr(graph, "TILE", 8)
    monkeypatch.setattr(graph, "STRIPE", 2)
    monkeypatch.setattr(graph, "BLOCK", 5)
    rnd = Random(4)
    edges = [(f"n{rnd.randrange(40)}", f"n{rnd.randrange(40)}") for _ in range(70)]
    e = spark.createDataFrame(edges, "src string, dst string")
    out = graph.betweenness(e, directed=directed)
    assert {r.node: r.betweenness for r in out.collect()} == pytest.approx(brandes(edges, directed), abs=1e-9)


def test_betweenness_of_a_dense_graph_forms_no_rows_per_path(spark, monkeypatch):
    """A source and an edge never meet as a row: no walk along edge rows is made."""

    def refuse(*_):
        raise AssertionError("rows per source and edge were made")

    monkeypatch.setattr(graph._Links, "walk", refuse)
    e = spark.range(60).withColumnRenamed("id", "src").crossJoin(spark.range(60).withColumnRenamed("id", "dst"))
    e = e.filter((F.col("src") * 7 + F.col("dst") * 3) % 4 != 0)
    out = graph.betweenness(e)
    pairs = [tuple(r) for r in e.collect()]
    assert {r.node: r.betweenness for r in out.collect()} == pytest.approx(brandes(pairs, True), abs=1e-9)


@pytest.mark.parametrize("sending, wanting, edges", [(0.01, 1.0, 0.3), (1.0, 0.01, 0.3), (1.0, 1.0, 0.3), (0.0, 1.0, 0.3), (1.0, 1.0, 0.0)])
def test_values_move_along_a_tile_without_blas(monkeypatch, sending, wanting, edges):
    monkeypatch.setattr(graph, "SLICE", 50)
    r = np.random.default_rng(5)
    cells = r.random((90, 90)) < edges
    send = np.where(r.random((40, 90)) < sending, r.random((40, 90)), 0.0)
    wanted = r.random((40, 90)) < wanting
    got = graph._tile_step()(send, wanted, *np.nonzero(cells))
    assert got.shape == send.shape
    assert got[wanted] == pytest.approx((send @ cells.astype(float))[wanted], abs=1e-12)


def test_a_task_holds_a_bounded_number_of_edges(spark):
    """Five million edges get at least ten tasks, whatever the session's number of partitions."""
    assert graph._tasks(spark.range(5_000_000)) >= 10


def test_pagerank_edges_are_packed(spark):
    """A round works on chunks of edges, and its rows are sums per end instead of single edges."""
    rng = np.random.default_rng(3)
    pairs = {(int(a), int(b)) for a, b in rng.integers(0, 2 * graph.CELLS, (6000, 2)) // [1, 400]}
    edges = [(a, b, float(rng.random())) for a, b in sorted(pairs)]
    df = spark.createDataFrame(edges, "_src long, _dst long, _share double")
    packed, parts = graph._pack_edges(df, 1000)
    chunks = packed.toArrow().to_pylist()
    assert sum(r.parts for r in parts.collect()) >= len(chunks) and len(chunks) <= 8
    assert sum(len(c["share"]) // 8 for c in chunks) == len(edges)
    left = rng.standard_normal(2 * graph.CELLS)
    columns = ["row", "least", "nodes", "at", "share", "starts", "to"]
    for c in chunks:
        run = left[c["row"] * graph.CELLS : (c["row"] + 1) * graph.CELLS]
        c["nodes"] = [{"at": k, "rank": 0.0, "left": float(x)} for k, x in enumerate(run)]
        c["least"] = 0.0
    table = pa.Table.from_pylist([{k: c[k] for k in columns} for c in chunks])
    sums = [(r["id"], r["left"]) for b in graph._send(table.to_batches()) for r in b.to_pylist()]
    want = dict.fromkeys((b for _, b, _ in edges), 0.0)
    for a, b, share in edges:
        want[b] += share * left[a]
    got = dict.fromkeys(want, 0.0)
    for to, x in sums:
        got[to] += x
    assert len(sums) < len(edges) / 10 and got == pytest.approx(want)


def test_betweenness_reads_edges_in_files_of_bounded_size(spark, monkeypatch, tmp_path):
    """Lists, those of a hub too, are cut, and no task meets all edges or all pairs at once."""
    monkeypatch.setattr(graph, "TILE", 8)
    monkeypatch.setattr(graph, "STRIPE", 2)
    pairs = sorted({(0, k) for k in range(1, 90)} | {(k, (k * k) % 90) for k in range(90)})
    links = spark.createDataFrame(pairs, "s long, t long")
    files = graph._write_lists(links, "s", "t", str(tmp_path / "lists"))
    assert sum(f[4] for f in files) == len(pairs) and max(f[4] for f in files) <= 3 * 16
    lists = graph._Lists(str(tmp_path / "lists"), files)
    read = [(s, t) for nodes, counts, far in lists.read(np.ones(90, bool)) for s, t in zip(np.repeat(nodes, counts).tolist(), far.tolist())]
    assert sorted(read) == pairs
    assert lists.sizes(90).tolist() == [sum(s == k for s, _ in pairs) for k in range(90)]
    assert sum(len(far) for _, _, far in lists.read(np.arange(90) == 50)) <= 3 * 16
    monkeypatch.setattr(graph, "PAIRS", 200)  # two sources a block
    out = graph.betweenness(links.toDF("src", "dst"))
    assert {r.node: r.betweenness for r in out.collect()} == pytest.approx(brandes(pairs, True), abs=1e-9)
