"""Weighted directed graphs as edge tables: PageRank and betweenness.

Edges of a node with very many neighbours are split into parts keyed by
(node, part); the node's state is repeated once per part. No task holds all edges of
a hub, and the repeated state stays below nodes + edges / EDGE_ROWS. PageRank packs its
edges in chunks of bounded size instead.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.checks import require_columns
from ..session import cut_lineage, discard, scratch, settle, staged
from .ordering import ordered_prefix
from .skew import spread_join

# Edges of one node beyond this count are split into several parts.
EDGE_ROWS = 10_000
# Edges of a task that scans the graph every round, at most about.
TASK_EDGES = 500_000
# Numbers of nodes whose edges are packed together; a place among them fits 16 bits.
CELLS = 1 << 14
# Exact betweenness: edges of a tile, tiles of a file of edges, sources of a block at most.
TILE, STRIPE, BLOCK = 262_144, 4, 256
# Pairs of a source and a node that a block holds, unless one source has more.
PAIRS = 1 << 21
# Pairs of a source and an edge that are worked on at once, one by one; such a pair costs
# about ONE_BY_ONE times as much as one in a row of sources.
SLICE, ONE_BY_ONE = 1 << 17, 8


def edge_weights(df: DataFrame, src: str, dst: str, weight: str = "weight") -> DataFrame:
    """Number of trips per (src, dst)."""
    return df.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst")).agg(
        F.count("*").alias(weight)
    )


def _crowded(edges: DataFrame, near: str, edge_rows: int) -> DataFrame:
    """Nodes with more than ``edge_rows`` edges on their ``near`` end, with a part count."""
    return settle(
        edges.groupBy(F.col(near).alias("node"))
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > edge_rows)
        .select("node", F.ceil(F.col("_n") / edge_rows).cast("int").alias("_parts"))
    )


def _lanes(edges: DataFrame, near: str, far: str, crowded: DataFrame) -> DataFrame:
    """Edges as (node, _part, _to, other columns): edges of crowded nodes get a part number."""
    named = edges.withColumnsRenamed({near: "node", far: "_to"})
    return (
        named.join(crowded, "node", "left")
        .withColumn("_part", F.pmod(F.xxhash64("_to"), F.coalesce("_parts", F.lit(1))).cast("int"))
        .drop("_parts")
    )


def _visit(state: DataFrame, crowded: DataFrame) -> DataFrame:
    """Repeat the state of a crowded node once per part."""
    return (
        state.join(crowded, "node", "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
        .drop("_parts")
    )


def _tasks(edges: DataFrame) -> int:
    """Tasks for a table that is scanned every round, by its measured number of edges.

    The session's shuffle setting, but not below 100 thousand edges per task for small
    graphs and not above ``TASK_EDGES`` for large ones, which bounds what a task sorts and keeps.
    """
    n = edges.count()
    usual = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(usual, -(-n // 100_000)), -(-n // TASK_EDGES))


def _pack_edges(numbered: DataFrame, edge_rows: int) -> tuple[DataFrame, DataFrame]:
    """Edges (_src, _dst, _share) as packed chunks (row, part, at, share, starts, to), and (row, parts).

    A row is a run of ``CELLS`` numbers of source nodes; its edges are dealt over parts by
    their end, at most about ``edge_rows`` in each. Edges of a chunk are in order of their
    end: ``to`` holds each end once, ``starts`` its first edge, ``at`` the source's place in
    the row.
    """

    def pack(key, pdf):
        pdf = pdf.sort_values("_dst")
        dst = pdf["_dst"].to_numpy()
        starts = np.flatnonzero(np.append(True, dst[1:] != dst[:-1]))
        packed = [pdf["at"].to_numpy(np.uint16), pdf["_share"].to_numpy(), starts.astype(np.int32), dst[starts]]
        return pd.DataFrame([(*key, *(x.tobytes() for x in packed))], columns=["row", "part", "at", "share", "starts", "to"])

    placed = numbered.select(F.expr(f"_src div {CELLS}").alias("row"), (F.col("_src") % CELLS).cast("int").alias("at"), "_dst", "_share")
    parts = staged(placed.groupBy("row").agg(F.ceil(F.count("*") / edge_rows).cast("int").alias("parts")), "parts")
    dealt = placed.join(parts, "row").withColumn("part", F.pmod(F.xxhash64("_dst"), "parts").cast("int")).drop("parts")
    chunks = dealt.groupBy("row", "part").applyInPandas(
        pack, "row long, part int, at binary, share binary, starts binary, to binary"
    )
    return chunks, parts


def _send(batches):
    """(id, rank, left) after a round, to be added up per id.

    ``nodes`` holds the state of a row of nodes. Without a chunk they add to their rank what
    they send, which is any residual above ``least``; a chunk carries it to the ends of its
    edges, added up per end.
    """
    for batch in batches:
        for row, least, nodes, at, share, starts, to in zip(*batch.columns):
            places, rank, left = (nodes.values.field(c).to_numpy() for c in ("at", "rank", "left"))
            send = np.where(np.abs(left) > least.as_py(), left, 0.0)
            if not to.is_valid:
                ids, rank, left = row.as_py() * CELLS + places.astype(np.int64), rank + send, left - send
            else:
                all_sends = np.zeros(CELLS)
                all_sends[places] = send
                carried = np.frombuffer(share.as_buffer()) * all_sends[np.frombuffer(at.as_buffer(), np.uint16)]
                sums = np.add.reduceat(carried, np.frombuffer(starts.as_buffer(), np.int32))
                ids, left = np.frombuffer(to.as_buffer(), np.int64)[sums != 0], sums[sums != 0]
                rank = np.zeros(len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(rank), pa.array(left)], names=["id", "rank", "left"])


def pagerank(
    edges: DataFrame,
    damping: float = 0.85,
    tol: float = 1e-9,
    weight: str = "weight",
    edge_rows: int = TASK_EDGES,
    rounds_per_cut: int = 2,
) -> DataFrame:
    """Weighted PageRank as (node, rank); ranks sum to 1 and are off by at most ``tol`` in sum.

    Mass of nodes without out-edges is spread evenly: the linear system is solved without it
    and the result normalised, which has the same solution. The solution starts from even
    ranks and their residuals, which have both signs. In every round only nodes whose
    residual exceeds a tenth of the mean size add it to their rank and send it on along
    their edges. The sum of all sizes, divided by 1 - damping, bounds the error, and the
    rounds end when it is small enough, so no number of rounds is asked for. Per cut of the
    lineage three sums reach the driver.

    Nodes are numbered and edges packed once, in chunks of at most about ``edge_rows``; in a
    round a chunk is one row, and only its sums per end are shuffled.
    """
    require_columns(edges, ["src", "dst", weight])
    if not 1e-13 <= tol < 1:
        raise ValueError("tol must lie between 1e-13 and 1")
    summed = staged(
        edges.filter((F.col(weight) > 0) & F.col("src").isNotNull() & F.col("dst").isNotNull())
        .groupBy("src", "dst")
        .agg(F.sum(weight).cast("double").alias("_w")),
        "edges",
    )
    ends = summed.groupBy(F.col("src").alias("node")).agg(F.sum("_w").alias("_out"))
    ends = ends.unionAll(summed.select("dst", F.lit(0.0)).distinct())
    nodes = staged(
        ends.groupBy("node").agg(F.sum("_out").alias("_out")).withColumn("id", F.monotonically_increasing_id()), "nodes"
    )
    n = nodes.count()
    if n == 0:
        return nodes.select("node", F.lit(0.0).alias("rank"))
    starts = nodes.select(F.col("node").alias("src"), F.col("id").alias("_src"), "_out")
    stops = nodes.select(F.col("node").alias("dst"), F.col("id").alias("_dst"))
    numbered = spread_join(spread_join(summed, starts, "src"), stops, "dst")
    packed, parts = _pack_edges(numbered.select("_src", "_dst", (F.lit(damping) * F.col("_w") / F.col("_out")).alias("_share")), edge_rows)
    # chunks keep one layout and order for all rounds
    tasks = min(_tasks(summed), parts.agg(F.sum("parts")).first()[0])
    chunks = packed.repartition(tasks, "row", "part").sortWithinPartitions("row", "part").persist()

    def push(state: DataFrame, least: float) -> DataFrame:
        """One round: (id, rank, left), where left is the residual. The state is read once."""
        place = F.struct((F.col("id") % CELLS).cast("int").alias("at"), "rank", "left")
        rows = (
            state.groupBy(F.expr(f"id div {CELLS}").alias("row"))
            .agg(F.collect_list(place).alias("nodes"), F.max(F.abs("left")).alias("most"))
            .join(parts, "row", "left")
            .withColumn("parts", F.when(F.col("most") > least, F.coalesce("parts", F.lit(0))).otherwise(0))
            # part -1 has no chunk
            .withColumn("part", F.explode(F.sequence(F.lit(-1), F.col("parts") - 1)))
            .withColumn("least", F.lit(float(least)))
        )
        done = (
            rows.join(chunks, ["row", "part"], "left")
            .filter((F.col("part") < 0) | F.col("to").isNotNull())  # a part may have no edges
            .select("row", "least", "nodes", "at", "share", "starts", "to")
            .mapInArrow(_send, "id long, rank double, left double")
        )
        return done.groupBy("id").agg(F.sum("rank").alias("rank"), F.sum("left").alias("left"))

    # even ranks, sent on once, leave (1 - damping) / n less what was taken
    even = nodes.select("id", F.lit(0.0).alias("rank"), F.lit(1.0 / n).alias("left"))
    state = cut_lineage(push(even, 0.0).withColumn("left", F.col("left") + F.lit((1 - damping) / n - 1.0 / n)))
    while True:
        # only proportions count, so the even part may grow or shrink: residuals are brought to mean 0
        mean = state.agg(F.avg("left")).first()[0]
        state = state.withColumn("left", F.col("left") - F.lit(mean))
        size, mass = state.agg(F.sum(F.abs("left")), F.sum("rank")).first()
        if 2 * size / (1 - damping) <= tol * mass:
            break
        for _ in range(rounds_per_cut):
            state = push(state, size / (10 * n))
        state = cut_lineage(state)
    chunks.unpersist()
    return nodes.join(state, "id").select("node", (F.col("rank") / F.lit(mass)).alias("rank"))


class _Links:
    """A simple graph with both edge layouts and its nodes, each staged once."""

    def __init__(self, edges: DataFrame, directed: bool, edge_rows: int):
        require_columns(edges, ["src", "dst"])
        links = edges.select("src", "dst").filter(F.col("src") != F.col("dst"))
        ends = edges.select(F.col("src").alias("node")).unionAll(edges.select("dst")).dropna()
        if not directed:
            links = links.unionAll(links.select(F.col("dst"), F.col("src")))
        links = cut_lineage(links.distinct())
        self.spark, self.directed = edges.sparkSession, directed
        self.nodes = cut_lineage(ends.distinct())
        self.n = self.nodes.count()
        self.out, self.into = (
            (cut_lineage(_lanes(links, near, far, crowded)), crowded)
            for near, far, crowded in (
                (near, far, _crowded(links, near, edge_rows))
                for near, far in (("src", "dst"), ("dst", "src"))
            )
        )

    def walk(self, state: DataFrame, layout: tuple, value: str) -> DataFrame:
        """Move a value along the edges and add it up per (source, reached node)."""
        lanes, crowded = layout
        return (
            _visit(state, crowded)
            .join(lanes, ["node", "_part"])
            .groupBy("source", F.col("_to").alias("node"))
            .agg(F.sum(value).alias(value))
        )

    def search(self, sources: DataFrame, layout: tuple | None = None) -> tuple[str, int]:
        """Breadth-first search from all sources at once: folder of the state table, last level.

        The state is one table (source, node, paths) with the level as its partition column.
        A level reads the rows of the level before, adds up path counts along the edges, and
        appends the pairs that the table does not hold yet.
        """
        path = scratch(self.spark, "paths")
        first = sources.select(F.col("node").alias("source"), "node", F.lit(1.0).alias("paths"))
        first.withColumn("level", F.lit(0)).write.partitionBy("level").parquet(path)
        level = 0
        while True:
            state = self.state(path, first)
            reached = self.walk(state.filter(F.col("level") == level), layout or self.out, "paths")
            fresh = reached.join(state, ["source", "node"], "left_anti")
            fresh.withColumn("level", F.lit(level + 1)).write.mode("append").partitionBy("level").parquet(path)
            if self.state(path, first).filter(F.col("level") == level + 1).isEmpty():
                return path, level
            level += 1

    def state(self, path: str, like: DataFrame) -> DataFrame:
        schema = like.select("source", "node", "paths").schema.add("level", "integer")
        return self.spark.read.schema(schema).parquet(path)


def _write_lists(links: DataFrame, near: str, far: str, folder: str) -> list[tuple]:
    """Lists of neighbours ``far`` by node ``near`` in files of bounded size; (name, first node, last, nodes, edges) of each.

    A file has a run of nodes with at most about TILE * STRIPE edges; a longer list lies in several.
    """
    limit = TILE * STRIPE

    def pack(key, pdf):
        import uuid

        from pyarrow import fs

        pdf = pdf.sort_values(["near", "far"])
        nodes, counts = np.unique(pdf["near"].to_numpy(np.int64), return_counts=True)
        store, root = fs.FileSystem.from_uri(folder)
        name = f"{key[0]}-{key[1]}-{uuid.uuid4().hex}"  # a task that runs twice leaves a file that nothing reads
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{name}") as out:
            for x in (nodes, counts.astype(np.int64), pdf["far"].to_numpy(np.int64)):
                out.write(x.tobytes())
        return pd.DataFrame([(name, nodes[0], nodes[-1], len(nodes), len(pdf))], columns=["name", "first", "last", "nodes", "edges"])

    edges = links.select(F.col(near).alias("near"), F.col(far).alias("far"))
    sizes = edges.groupBy("near").agg(F.count("*").alias("_n"))
    places = staged(
        ordered_prefix(sizes, "near", ["_n"]).select(
            "near", F.floor(F.col("_n_before") / limit).cast("long").alias("file"), F.ceil(F.col("_n") / limit).cast("int").alias("parts")
        ),
        "places",
    )
    dealt = edges.join(places, "near").select("near", "far", "file", F.pmod(F.xxhash64("far"), "parts").cast("int").alias("part"))
    made = dealt.groupBy("file", "part").applyInPandas(pack, "name string, first long, last long, nodes long, edges long")
    files = sorted((tuple(r) for r in made.collect()), key=lambda r: r[1:3])  # one row per million edges
    return files


class _Lists:
    """Lists of neighbours by node, read file by file, so that a task never holds all edges."""

    def __init__(self, folder: str, files: list[tuple]):
        from pyarrow import fs

        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.files = files

    def _read(self, name: str, count: int) -> np.ndarray:
        with self.store.open_input_file(f"{self.root}/{name}") as f:
            return np.frombuffer(f.read(8 * count), np.int64)

    def sizes(self, n: int) -> np.ndarray:
        """Edges of every node."""
        out = np.zeros(n, np.int64)
        for name, _, _, nodes, _ in self.files:
            head = self._read(name, 2 * nodes)
            out[head[:nodes]] += head[nodes:]
        return out

    def read(self, wanted: np.ndarray):
        """(nodes, list lengths, neighbours) of the files with any node that is marked."""
        before = np.append(0, np.cumsum(wanted))
        for name, first, last, nodes, edges in self.files:
            if before[last + 1] > before[first]:
                data = self._read(name, 2 * nodes + edges)
                yield data[:nodes], data[nodes : 2 * nodes], data[2 * nodes :]


def _runs(counts: np.ndarray, limit: int):
    """Slices of pairs with at most about ``limit`` edges in all."""
    ends = np.cumsum(counts)
    begin = 0
    while begin < len(counts):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield slice(begin, end)
        begin = end


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for counts[0] places, then starts[1] and so on."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _met(at: np.ndarray, n: int, nodes: np.ndarray, counts: np.ndarray):
    """Those of the sorted places ``at`` whose node has a list, as (index, first place of their column, list start, list length)."""
    columns = np.arange(at[0] // n, at[-1] // n + 1) * n
    begin, end = np.searchsorted(at, columns + nodes[0]), np.searchsorted(at, columns + nodes[-1] + 1)
    index = _spread(begin, end - begin)
    node = at[index] % n
    of = np.searchsorted(nodes, node)
    found = nodes[of] == node
    index, of = index[found], of[found]
    return index, at[index] // n * n, (np.cumsum(counts) - counts)[of], counts[of]


def _push(got, at, value, n, lists, limit):
    """Values go from the sorted places ``at`` to all neighbours. A place is column * n + node."""
    for nodes, counts, far in lists:
        index, column, start, size = _met(at, n, nodes, counts)
        for part in _runs(size, limit):
            to = far[_spread(start[part], size[part])]
            to += np.repeat(column[part], size[part])
            np.add.at(got, to, np.repeat(value[index[part]], size[part]))


def _pull(got, at, send, n, lists, limit):
    """The sorted places ``at`` take what their neighbours send."""
    for nodes, counts, far in lists:
        index, column, start, size = _met(at, n, nodes, counts)
        for part in _runs(size, limit):
            to = far[_spread(start[part], size[part])]
            to += np.repeat(column[part], size[part])
            got[at[index[part]]] += np.add.reduceat(send[to], np.cumsum(size[part]) - size[part])


def _by_rows(all_got, send, n, lists, limit):
    """Every node takes what its neighbours send, for all columns at once."""
    send = np.ascontiguousarray(send.reshape(-1, n).T)
    got, width = np.zeros_like(send), send.shape[1]
    for nodes, counts, far in lists:
        first = np.cumsum(counts) - counts
        for part in _runs(counts, max(1, limit // width)):
            # a list longer than a run is added up in pieces
            begin, end = first[part.start], first[part.stop - 1] + counts[part.stop - 1]
            if part.stop - part.start == 1:
                for k in range(begin, end, max(1, limit // width)):
                    got[nodes[part.start]] += send[far[k : min(end, k + max(1, limit // width))]].sum(axis=0)
            else:
                got[nodes[part]] += np.add.reduceat(send[far[begin:end]], first[part] - begin, axis=0)
    all_got += got.T.ravel()


def _move(got, at, value, send, wanted, n, push, pull, costs, slice_, one_by_one):
    """Add to ``got`` what goes from the places ``at`` along all edges, right at least where it is wanted.

    Of three ways the cheapest is taken: from the few places that send, to the few that want
    (``wanted()``), or by rows of all sources. None of them calls BLAS, whose speed and threads
    differ between machines. ``send`` has the values at ``at`` and is 0 elsewhere.
    """
    by_push, by_pull, by_rows = costs
    if one_by_one * min(by_push, by_pull) > by_rows:
        _by_rows(got, send, n, pull(np.ones(n, bool)), slice_)
        return
    places = at if by_push <= by_pull else wanted()
    if not len(places):
        return
    marked = np.zeros(n, bool)
    marked[places % n] = True
    if by_push <= by_pull:
        _push(got, places, value, n, push(marked), slice_)
    else:
        _pull(got, places, send, n, pull(marked), slice_)


def _tile_step():
    """The function that moves values of all sources along the edges (near, far) of one piece of a graph."""

    def moved(send: np.ndarray, wanted: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """What the edges bring from ``send``, right at least where it is ``wanted``. Both are (source, node)."""
        width, nodes = send.shape
        flat, want = send.ravel(), np.flatnonzero(wanted)
        at = np.flatnonzero(flat)

        def lists(one, two):
            rank = np.argsort(one, kind="stable")
            names, counts = np.unique(one, return_counts=True)
            return lambda marked: [(names, counts, two[rank])] if len(one) else []

        outs, ins = (np.bincount(end, minlength=nodes) for end in (near, far))
        got = np.zeros(nodes * width)
        costs = outs[at % nodes].sum(), ins[want % nodes].sum(), width * len(far)
        _move(got, at, flat[at], flat, lambda: want, nodes, lists(near, far), lists(far, near), costs, SLICE, ONE_BY_ONE)
        return got.reshape(width, nodes)

    return moved


def _debts(sources: np.ndarray, n: int, out: _Lists, into: _Lists, sizes: tuple, slice_: int, one_by_one: int) -> np.ndarray:
    """Sum over some sources of what every node is owed (Brandes), one level of all of them at a time.

    Places are column * n + node, with a column per source. Only the places of a level are
    listed; the files of edges are read again for every level that needs them.
    """
    width, (outs, ins) = len(sources), sizes
    edges = outs.sum()
    paths, send, got = (np.zeros(n * width) for _ in range(3))
    at = np.arange(width) * n + sources
    paths[at] = 1.0
    levels, left = [], ins.sum() * width
    while len(at):
        levels.append(at)
        left -= ins[at % n].sum()
        if not left:  # no edge ends at a place that is not reached yet
            break
        send[at] = paths[at]
        costs = outs[at % n].sum(), left, width * edges
        _move(got, at, paths[at], send, lambda: np.flatnonzero(paths == 0), n, out.read, into.read, costs, slice_, one_by_one)
        send[at] = 0.0
        at = np.flatnonzero((got > 0) & (paths == 0))
        paths[at] = got[at]
        got.fill(0.0)
    debt = np.zeros(n * width)
    for at, before in zip(levels[:1:-1], levels[-2:0:-1]):
        value = (1 + debt[at]) / paths[at]
        send[at] = value
        costs = ins[at % n].sum(), outs[before % n].sum(), width * edges
        _move(got, at, value, send, lambda: before, n, into.read, out.read, costs, slice_, one_by_one)
        send[at] = 0.0
        debt[before] = paths[before] * got[before]
        got.fill(0.0)
    return debt.reshape(width, n).sum(axis=0)


def betweenness(
    edges: DataFrame,
    directed: bool = True,
    normalized: bool = True,
    edge_rows: int = EDGE_ROWS,
    sources_per_batch: int = 10_000,
) -> DataFrame:
    """Share of shortest paths through each node, as (node, betweenness); exact.

    Breadth-first search from a block of sources at once, path counts forward, dependencies
    backward. Nodes are numbered and the edges lie in files of bounded size in the shared
    folder, by either end. A task has blocks of sources, one after the other: its memory
    holds the pairs of a block's sources and all nodes, at most about PAIRS or a single
    source's, and one file of edges. Only sums per node are shuffled. A crowded node's edges
    lie in several files, so ``edge_rows`` plays no role here. Weights, parallel edges and
    self loops play none. Work grows with nodes times edges at most;
    ``betweenness_sampled`` bounds it.
    """
    require_columns(edges, ["src", "dst"])
    spark = edges.sparkSession
    ends = edges.select(F.col("src").alias("node")).unionAll(edges.select("dst")).dropna().distinct()
    nodes = cut_lineage(
        ordered_prefix(ends.withColumn("_one", F.lit(1)), "node", ["_one"]).select("node", F.col("_one_before").cast("long").alias("at"))
    )
    n = nodes.count()
    links = edges.select("src", "dst").filter(F.col("src") != F.col("dst"))
    if not directed:
        links = links.unionAll(links.select(F.col("dst"), F.col("src")))
    for end, name in (("src", "s"), ("dst", "t")):
        links = links.join(nodes.select(F.col("node").alias(end), F.col("at").alias(name)), end)
    links = staged(links.select("s", "t").distinct(), "links")
    folders = [scratch(spark, "lists") for _ in range(2)]
    layouts = [(f, _write_lists(links, *way, f)) for f, way in zip(folders, (("s", "t"), ("t", "s")))]
    width = max(1, min(BLOCK, sources_per_batch, PAIRS // max(n, 1)))
    blocks = -(-n // width)
    slice_, one_by_one = SLICE, ONE_BY_ONE

    def search(batches):
        out, into = (_Lists(*x) for x in layouts)
        sizes = tuple(x.sizes(n) for x in (out, into))
        total = np.zeros(n)
        for pdf in batches:
            for block in pdf["id"].tolist():
                sources = np.arange(block * width, min(n, (block + 1) * width))
                total += _debts(sources, n, out, into, sizes, slice_, one_by_one)
        owed = np.flatnonzero(total)
        for k in range(0, len(owed), 100_000):
            yield pd.DataFrame({"at": owed[k : k + 100_000], "debt": total[owed[k : k + 100_000]]})

    total = nodes.select("at", F.lit(0.0).alias("debt"))
    if blocks:
        usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
        owed = spark.range(0, blocks, 1, min(blocks, max(usual, 64))).mapInPandas(search, "at long, debt double")
        total = cut_lineage(total.unionByName(owed).groupBy("at").agg(F.sum("debt").alias("debt")))
    discard(spark, *folders)
    if normalized:
        scale = 1.0 / ((n - 1) * (n - 2)) if n > 2 else 1.0
    else:
        scale = 1.0 if directed else 0.5
    return nodes.join(total, "at").select("node", (F.col("debt") * F.lit(scale)).alias("betweenness"))


def path_sample_size(epsilon: float, delta: float, vertices: int) -> int:
    """Paths to draw so that, with probability 1 - delta, no node is off by more than epsilon.

    Bound of Riondato and Kornaropoulos: a shortest path with at most ``vertices`` nodes has
    at most ``vertices - 2`` inner ones, which limits the VC dimension to the whole part of
    log2(vertices - 2), plus 1.
    """
    inner = max(vertices - 2, 1)
    return math.ceil(0.5 / epsilon**2 * (math.floor(math.log2(inner)) + 1 + math.log(1 / delta)))


def _vertex_bound(graph: _Links) -> int:
    """Nodes on a longest shortest path, at most.

    Where one node reaches all others and is reached by all, no path is longer than going
    there and on; else the number of nodes is the bound (its logarithm is what counts).
    """
    hub = graph.nodes.orderBy("node").limit(1)
    there, far = graph.search(hub)
    back, near = (there, far) if not graph.directed else graph.search(hub, graph.into)
    like = hub.select(F.col("node").alias("source"), "node", F.lit(1.0).alias("paths"))
    whole = all(graph.state(p, like).count() == graph.n for p in {there, back})
    discard(graph.spark, there, back)
    return min(graph.n, far + near + 1) if whole else graph.n


def sample_pairs(nodes: DataFrame, n: int, count: int, seed: int) -> DataFrame:
    """(sample, source, target): ``count`` ordered pairs of two different of the ``n`` nodes, with replacement."""
    numbered = ordered_prefix(nodes.withColumn("_one", F.lit(1)), "node", ["_one"]).select(
        "node", F.col("_one_before").alias("_at")
    )
    drawn = nodes.sparkSession.range(count).select(
        F.col("id").alias("sample"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit(0), "id"), F.lit(n)).alias("_s"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit(1), "id"), F.lit(n - 1)).alias("_t"),
    )
    drawn = drawn.withColumn("_t", F.when(F.col("_t") >= F.col("_s"), F.col("_t") + 1).otherwise(F.col("_t")))
    for end, name in (("_s", "source"), ("_t", "target")):
        drawn = drawn.join(numbered, F.col(end) == F.col("_at")).drop(end, "_at").withColumnRenamed("node", name)
    return drawn


def _draw_paths(graph: _Links, pairs: DataFrame, seed: int) -> DataFrame:
    """(sample, node): inner nodes of one shortest path per sample, drawn evenly from all of its pair.

    From the target backwards, the node before is drawn with the weight of its path count:
    of exponential races with these rates the first one wins.
    """
    sources = pairs.select(F.col("source").alias("node")).distinct()
    like = sources.select(F.col("node").alias("source"), "node", F.lit(1.0).alias("paths"))
    path, last = graph.search(sources)
    state = graph.state(path, like)
    ends = cut_lineage(
        pairs.join(state.withColumnRenamed("node", "target"), ["source", "target"]).select(
            "sample", "source", F.col("target").alias("node"), "level"
        )
    )
    lanes, crowded = graph.into
    inner, at = [], None
    for level in range(last, 1, -1):
        here = ends.filter(F.col("level") == level).drop("level")
        if at is not None:
            here = here.unionByName(at)
        before = state.filter(F.col("level") == level - 1).select("source", F.col("node").alias("_to"), "paths")
        chance = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "sample", F.lit(level), "_to"), 11) + 0.5) / 2.0**53
        at = cut_lineage(
            _visit(here, crowded)
            .join(lanes, ["node", "_part"])
            .join(before, ["source", "_to"])
            .groupBy("sample", "source")
            .agg(F.min_by("_to", -F.log(chance) / F.col("paths")).alias("node"))
        )
        inner.append(at.select("sample", "node"))
    discard(graph.spark, path)
    none = pairs.select("sample", F.col("source").alias("node")).limit(0)
    return reduce(DataFrame.unionByName, inner, none)


def betweenness_sampled(
    edges: DataFrame,
    epsilon: float = 0.01,
    delta: float = 0.1,
    directed: bool = True,
    normalized: bool = True,
    seed: int = 0,
    edge_rows: int = EDGE_ROWS,
    sources_per_batch: int = 10_000,
) -> DataFrame:
    """Estimate of ``betweenness``: with probability 1 - delta every node is within epsilon (normalised).

    Draws as many random shortest paths as ``path_sample_size`` asks for, whatever the size
    of the graph, and counts the nodes inside them. Searches start from drawn sources only,
    in batches, so the state is at most (sources per batch) x (nodes).
    """
    graph = _Links(edges, directed, edge_rows)
    n = graph.n
    scores = graph.nodes.select("node", F.lit(0.0).alias("hits"))
    if n > 2:
        stretch = n / (n - 2)  # from all pairs to pairs without the node itself
        count = path_sample_size(epsilon / stretch, delta, _vertex_bound(graph))
        pairs = cut_lineage(sample_pairs(graph.nodes, n, count, seed))
        batches = max(1, -(-min(count, n) // sources_per_batch))
        for batch in range(batches):
            part = pairs.filter(F.pmod(F.xxhash64("source"), F.lit(batches)) == batch)
            hits = _draw_paths(graph, part, seed).groupBy("node").agg(F.count("*").cast("double").alias("hits"))
            scores = cut_lineage(scores.unionByName(hits).groupBy("node").agg(F.sum("hits").alias("hits")))
        scale = stretch / count
        if not normalized:
            scale *= (n - 1) * (n - 2) * (1.0 if directed else 0.5)
    else:
        scale = 0.0
    return scores.select("node", (F.col("hits") * F.lit(scale)).alias("betweenness"))
