"""Removal of long repeated byte strings with sparse enhanced suffix arrays.

Every window of ``min_len`` bytes holds one anchor: the smallest hash among its
``SEED``-byte strings (ties: the leftmost). Equal windows choose equal anchors, so
suffixes only need comparing within one anchor's bucket. A bucket is an enhanced
suffix array of the distinct contexts around the anchor; stack scans over its
common-prefix array give the interval tree to the right, and over the reversed left
contexts, whose intervals differ in the byte before (left-diverse), to the left.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfeat.llm.common import release, row_key, text_rows
from spanfeat.session import staged

SEED = 32
_MIX = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(data: bytes, width: int) -> np.ndarray:
    """Mixed polynomial hash modulo 2**64 of every ``width``-byte string, by doubling."""
    x = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    if len(x) < width:
        return np.empty(0, np.uint64)
    total, done, block, size, base = None, 0, x, 1, 0x100000001B3
    left = width
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                piece = block[done : done + len(x) - width + 1]
                if total is None:
                    total = piece.copy()
                else:
                    total = total * np.uint64(pow(base, size, 1 << 64)) + piece
                done += size
            left >>= 1
            if left:
                block = block[:-size] * np.uint64(pow(base, size, 1 << 64)) + block[size:]
                block ^= block >> np.uint64(29)
                size *= 2
        total ^= total >> np.uint64(31)
        total *= _MIX
        total ^= total >> np.uint64(32)
    return total


def anchors(data: bytes, min_len: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors of all windows, and the seed hashes of all positions."""
    h = window_hashes(data, SEED)
    span = min_len - SEED + 1
    if len(h) < span:
        return np.empty(0, np.int64), h
    n = len(h) - span + 1
    # sliding minimum by doubling, on positions so that ties go left
    idx, size = np.arange(len(h)), 1

    def better(a, b):
        return np.where(h[b] < h[a], b, a)

    while size * 2 <= span:
        idx = better(idx[:-size], idx[size:])
        size *= 2
    best = better(idx[:n], idx[span - size : span - size + n])
    return np.unique(best), h


def intervals(lcp: np.ndarray) -> list[tuple[int, int, int]]:
    """All common-prefix intervals (depth, first, last) of a sorted list, by one stack scan.

    ``lcp[k]`` is the common prefix of entries k and k+1.
    """
    out, stack = [], [(0, 0)]
    for k, depth in enumerate([*lcp, 0]):
        first = k
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            out.append((d, first, k))
        if not stack or stack[-1][0] < depth:
            stack.append((depth, first))
    return out


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while lo + 1 < hi:
        mid = (lo + hi) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def reaches(lefts: list[bytes], rights: list[bytes], min_len: int) -> list[tuple[int, int]]:
    """Per context the bytes (before, after) its anchor that repeats of ``min_len`` cover.

    ``lefts`` are reversed. Contexts are distinct; (0, 0) where nothing long enough repeats.
    """
    m = len(rights)
    order = sorted(range(m), key=rights.__getitem__)
    lcp = [common(rights[order[k]], rights[order[k + 1]]) for k in range(m - 1)]
    best = [(0, 0)] * m
    for depth, i, j in intervals(lcp):
        members = sorted(order[i : j + 1], key=lefts.__getitem__)
        back = [common(lefts[members[k]], lefts[members[k + 1]]) for k in range(len(members) - 1)]
        for k, x in enumerate(members):
            reach = max(back[k - 1] if k else 0, back[k] if k < len(back) else 0)
            if reach + depth >= min_len:
                best[x] = (max(best[x][0], reach), max(best[x][1], depth))
    return best


def ranges(min_len: int) -> list[tuple[int, int]]:
    """Groups (low, high) of window offsets, about the square root of their number wide."""
    count = min_len - SEED + 1
    wide = int(count**0.5)
    return [(k, min(k + wide, count) - 1) for k in range(0, count, wide)]


def repeated_spans(docs: DataFrame, min_len: int = 200, crowd: int = 1024) -> DataFrame:
    """Rows (key, pos, ahead, behind): bytes [pos-ahead, pos+behind) are covered by repeats.

    ``key`` is the xxhash64 of (doc_id, text). Contexts that are equal are counted before
    they are shuffled, so copies meet as one row; a bucket of one context needs no array. A
    bucket of more than ``crowd`` distinct contexts is dealt out by (anchor, hash): first by
    what a group of neighbouring window offsets has in common, and for groups that repeat by
    the window itself, with the same result as one array.
    """
    before, after = min_len - SEED, min_len

    def find(key, text):
        data = (text or "").encode()
        at, h = anchors(data, min_len)
        for p in at.tolist():
            left = min(p, before)
            piece = data[p - left : p + after]
            digest = hashlib.blake2b(piece, digest_size=8, salt=left.to_bytes(4, "little")).digest()
            yield key, p, int(h[p].astype(np.int64)), int.from_bytes(digest, "little", signed=True), left, len(piece) - left

    base = docs.select(row_key("doc_id", "text").alias("key"), "text")
    places = staged(
        text_rows(
            base, find, ["key", "text"],
            "key long, pos int, seed long, context long, ahead int, behind int",
        ),
        "anchors",
    )
    seeds = staged(places.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1").select("seed"), "seeds")
    hot = staged(places.join(seeds, "seed"), "repeats")
    release(places, seeds)
    chosen = staged(
        hot.groupBy("seed", "context").agg(
            F.min(F.struct("key", "pos")).alias("at"), F.count("*").alias("copies"),
            F.first("ahead").alias("ahead"), F.first("behind").alias("behind"),
        ),
        "kinds",
    )
    sizes = staged(chosen.groupBy("seed").agg(F.count("*").alias("contexts")).filter("contexts > 1"), "sizes")
    # equal contexts: covered whole
    whole = chosen.filter("copies > 1").select("seed", "context", "ahead", "behind")
    # one place per distinct context is enough to know the context's bytes
    several = chosen.join(sizes, "seed")
    wanted = several.groupBy(F.col("at.key").alias("key")).agg(
        F.collect_list(F.struct("at.pos", "seed", "context", "contexts", "copies")).alias("wanted")
    )

    def cut(text, wanted):
        data = (text or "").encode()
        for w in wanted:
            p = w["pos"]
            left, right = data[max(0, p - before) : p][::-1], data[p : p + after]
            yield w["seed"], w["context"], w["contexts"] > crowd, w["copies"], left, right

    one_text = base.join(wanted, "key").dropDuplicates(["key"])
    contexts = staged(
        text_rows(
            one_text, cut, ["text", "wanted"],
            "seed long, context long, crowded boolean, copies long, left binary, right binary",
        ),
        "contexts",
    )

    def arrays(batches):
        import pandas as pd

        def solve(seed, rows):
            for (context, _, _), (a, b) in zip(rows, reaches([r[1] for r in rows], [r[2] for r in rows], min_len)):
                if a + b >= min_len:
                    yield seed, context, a, b

        seed, rows = None, []
        for pdf in batches:
            out = []
            for r in zip(pdf["seed"], pdf["context"], pdf["left"], pdf["right"]):
                if r[0] != seed and rows:
                    out.extend(solve(seed, rows))
                    rows = []
                seed = r[0]
                rows.append(r[1:])
            yield pd.DataFrame(out, columns=["seed", "context", "ahead", "behind"])
        if rows:
            yield pd.DataFrame(list(solve(seed, rows)), columns=["seed", "context", "ahead", "behind"])

    quiet = (
        contexts.filter("NOT crowded").select("seed", "context", "left", "right")
        .repartition("seed").sortWithinPartitions("seed")
        .mapInPandas(arrays, "seed long, context long, ahead int, behind int")
    )
    crowded = contexts.filter("crowded")
    groups = ranges(min_len)

    def coarse(seed, context, left, right):
        for g, (low, high) in enumerate(groups):
            if len(left) >= low and len(right) >= min_len - high:
                digest = hashlib.blake2b(left[:low] + right[: min_len - high], digest_size=8).digest()
                yield seed, context, g, int.from_bytes(digest, "little", signed=True)

    shares = text_rows(
        crowded, coarse, ["seed", "context", "left", "right"], "seed long, context long, part int, mark long"
    )
    shared = staged(
        shares.groupBy("seed", "part", "mark").agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "shared"
    )
    likely = shares.join(shared, ["seed", "part", "mark"]).groupBy("seed", "context").agg(
        F.collect_set("part").alias("parts")
    )

    def windows(seed, context, left, right, parts):
        data, have = left[::-1] + right, len(left)
        h = window_hashes(data, min_len)
        for low, high in (groups[g] for g in parts):
            for ahead in range(low, high + 1):
                if ahead <= have and have - ahead < len(h):
                    yield seed, context, ahead, int(h[have - ahead].astype(np.int64))

    dealt = staged(
        text_rows(
            crowded.join(likely, ["seed", "context"]), windows, ["seed", "context", "left", "right", "parts"],
            "seed long, context long, ahead int, window long",
        ),
        "windows",
    )
    often = staged(
        dealt.groupBy("seed", "ahead", "window").agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "often"
    )
    loud = dealt.join(often, ["seed", "ahead", "window"]).groupBy("seed", "context").agg(
        F.max("ahead").alias("ahead"), (min_len - F.min("ahead")).cast("int").alias("behind")
    )
    reach = whole.unionByName(quiet).unionByName(loud).groupBy("seed", "context").agg(
        F.max("ahead").alias("ahead"), F.max("behind").alias("behind")
    )
    reach = staged(reach, "reach")
    release(chosen, sizes, contexts, shared, dealt, often)
    return hot.drop("ahead", "behind").join(reach, ["seed", "context"]).select("key", "pos", "ahead", "behind")


def suffix_dedup(docs: DataFrame, min_len: int = 200, crowd: int = 1024) -> DataFrame:
    """Remove each byte covered by a ``min_len``-byte string that also starts elsewhere.

    Returns (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept), one row per input row.
    Null text counts as empty; texts below ``min_len`` bytes stay whole; extra columns are
    ignored; rows repeated in full are judged as separate places; an empty table gives none.
    """
    spans = repeated_spans(docs, min_len, crowd).groupBy("key").agg(
        F.collect_set(F.struct((F.col("pos") - F.col("ahead")).alias("a"), (F.col("pos") + F.col("behind")).alias("b"))).alias("spans")
    )

    def keep(doc_id, text, spans):
        data = (text or "").encode()
        kept, removed, count, end = [], 0, 0, 0
        run_start, run_end = None, None
        for a, b in sorted((s["a"], s["b"]) for s in spans or []):
            if run_end is None or a > run_end:
                if run_end is not None:
                    count, removed, end = count + 1, removed + run_end - run_start, run_end
                kept.append(data[end:a])
                run_start, run_end = a, b
            else:
                run_end = max(run_end, b)
        if run_end is not None:
            count, removed, end = count + 1, removed + run_end - run_start, run_end
        kept.append(data[end:])
        rest = b"".join(kept)
        yield doc_id, len(data), removed, count, hashlib.sha256(rest).hexdigest(), rest

    joined = docs.select("doc_id", "text", row_key("doc_id", "text").alias("key")).join(spans, "key", "left")
    return text_rows(
        joined, keep, ["doc_id", "text", "spans"],
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )
