"""Near-duplicate groups from 64-bit SimHash fingerprints and vantage-point trees.

Shards: fingerprints within 3 bits agree on one of four 16-bit blocks, and of the other
48 bits on one of four 12-bit blocks; each of the 16 choices is a shard key, so every
exact pair meets in a shard. Routing by distance bands to global vantage points would copy
over half of all points at each level (distances gather around 32 of 64 bits), so the
bands prune inside the shards, where a vantage-point tree answers the radius queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfeat.llm.common import text_rows
from spanfeat.session import staged

RADIUS = 3
LEAF = 32


def fingerprint(text: str | None) -> int:
    """64-bit majority of the XXH64 (seed 42) of all 3-word shingles; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < 3:
        shingles = [b" ".join(words)]
    else:
        shingles = [b"%b %b %b" % s for s in zip(words, words[1:], words[2:])]
    h = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], dtype=">u8")
    counts = np.zeros(64, np.int64)
    for k in range(0, len(h), 8192):
        counts += np.unpackbits(h[k : k + 8192].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(h)).tobytes(), "big")


def vp_links(points: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Pairs of positions that span the groups linked within ``radius`` in one shard.

    A tree node splits its points at the median distance from a vantage point; a query goes
    down a side only if the triangle bound lets a partner lie there. Links that join two
    points already connected are not repeated, so at most n - 1 come back.
    """
    parent = list(range(len(points)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []

    def link(a, b):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[ra] = rb
            links.append((a, b))

    def visit(home: np.ndarray, guests: np.ndarray):
        """Link home points among themselves and to guests."""
        stack = [(home, guests)]
        while stack:
            home, guests = stack.pop()
            both = np.concatenate([home, guests])
            if len(home) == 0 or len(both) < 2:
                continue
            if len(home) <= LEAF:
                for k, x in enumerate(home):
                    rest = both[k + 1 :]
                    for y in rest[np.bitwise_count(points[rest] ^ points[x]) <= radius]:
                        link(int(x), int(y))
                continue
            vantage, home = home[0], home[1:]
            dist = np.bitwise_count(points[home] ^ points[vantage]).astype(int)
            gdist = np.bitwise_count(points[guests] ^ points[vantage]).astype(int)
            for y in np.concatenate([home[dist <= radius], guests[gdist <= radius]]):
                link(int(vantage), int(y))
            cut = int(np.median(dist))
            inner, outer = dist <= cut, dist > cut
            if not outer.any():  # all in one band: split by halves, each half visiting the other
                half = len(home) // 2
                stack.append((home[:half], np.concatenate([guests, home[half:]])))
                stack.append((home[half:], guests))
                continue
            # inner points near the boundary visit the outer side
            stack.append((home[inner], guests[gdist <= cut + radius]))
            stack.append((home[outer], np.concatenate([guests[gdist > cut - radius], home[inner & (dist > cut - radius)]])))

    visit(np.arange(len(points)), np.empty(0, np.int64))
    return links


def shard_keys(fp: F.Column) -> F.Column:
    """The 16 shard keys of a fingerprint."""
    keys = []
    for i in range(4):
        block = F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))
        low = fp.bitwiseAND(F.lit((1 << (16 * i)) - 1))
        # drop block i; the remaining 48 bits
        high = F.shiftleft(F.shiftrightunsigned(fp, 16 * (i + 1)), 16 * i) if i < 3 else F.lit(0).cast("long")
        rest = low.bitwiseOR(high)
        for j in range(4):
            part = F.shiftrightunsigned(rest, 12 * j).bitwiseAND(F.lit(0xFFF))
            keys.append(F.lit((i * 4 + j) << 28) + F.shiftleft(block.cast("long"), 12) + part)
    return F.array(*keys)


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root): the smallest node reachable, by alternating large and small stars."""
    edges = staged(links.select("a", "b").filter("a <> b").distinct(), "links")
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        big = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        big = staged(big.filter("a <> b").distinct(), "large")
        down = big.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = staged(down.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))
        )
        edges = staged(small.filter("a <> b").distinct(), "small")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError(f"groups did not settle in {max_rounds} rounds")


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that span the groups within ``RADIUS`` bits in each shard; ``prints`` has distinct fp."""
    shards = prints.select("fp", F.explode(shard_keys(F.col("fp"))).alias("shard"))

    def search(batches):
        def solve(values):
            fps = np.array(values, dtype=np.int64)
            return [(values[a], values[b]) for a, b in vp_links(fps.view(np.uint64))] if len(fps) > 1 else []

        def told(out):
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

        shard, values = None, []
        for batch in batches:
            out = []
            for s, fp in zip(batch.column("shard").to_pylist(), batch.column("fp").to_pylist()):
                if s != shard and values:
                    out.extend(solve(values))
                    values = []
                shard = s
                values.append(fp)
            yield told(out)
        if values:
            yield told(solve(values))

    return shards.repartition("shard").sortWithinPartitions("shard").mapInArrow(search, "a long, b long")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id, fp), one row per input row.

    Null and empty texts have fingerprint zero and link like any other; equal texts meet as
    one fingerprint before anything is paired. A null doc_id never names a group unless the
    group has no other. Extra columns are ignored.
    """

    def mark(doc_id, text):
        x = fingerprint(text)
        yield doc_id, f"{x:016x}", x - (1 << 64) if x >> 63 else x

    marks = staged(text_rows(docs, mark, ["doc_id", "text"], "doc_id long, fingerprint string, fp long"), "marks")
    prints = staged(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    roots = components(fingerprint_links(prints))
    named = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = staged(named, "named")
    least = staged(named.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    table = staged(named.join(least, "root").select("fp", "component_id"), "table")
    return marks.join(table, "fp").select("doc_id", "fingerprint", "component_id", "fp")
