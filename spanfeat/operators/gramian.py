"""Products of columns in tiles: one pass for all pairs, whatever their number.

Rows are read as matrices. For every pair of column tiles a task keeps small arrays: for
each pair of columns the number of rows where both are present, and of these the two means,
the two sums of squares and the sum of products, all about the means. Tasks' arrays are
merged in two levels, so that no task receives those of all others.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.checks import require_columns
from .skew import tasks_of

# Columns of a tile, and bytes of arrays that a task may hold; more columns take more passes.
TILE = 128
STATE_BYTES = 256 << 20
PARTS = 6  # arrays per tile


def _moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Count, means, sums of squares and products about the means, for all pairs of two tiles."""
    has_x, has_y = ~np.isnan(x), ~np.isnan(y)
    # about the batch's own means, so that large means cost no digits
    shift_x = np.where(has_x, x, 0).sum(axis=0) / np.maximum(has_x.sum(axis=0), 1)
    shift_y = np.where(has_y, y, 0).sum(axis=0) / np.maximum(has_y.sum(axis=0), 1)
    zx, zy = np.where(has_x, x - shift_x, 0.0), np.where(has_y, y - shift_y, 0.0)
    fx, fy = has_x.astype(float), has_y.astype(float)
    n = fx.T @ fy
    safe = np.maximum(n, 1)
    mx, my = (zx.T @ fy) / safe, (fx.T @ zy) / safe
    sxx = (zx * zx).T @ fy - n * mx * mx
    syy = fx.T @ (zy * zy) - n * my * my
    sxy = zx.T @ zy - n * mx * my
    return np.stack([n, mx + shift_x[:, None], my + shift_y[None, :], sxx, syy, sxy])


def _merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows together."""
    n = a[0] + b[0]
    safe = np.maximum(n, 1)
    dx, dy, part = b[1] - a[1], b[2] - a[2], a[0] * b[0] / safe
    return np.stack([
        n, a[1] + dx * b[0] / safe, a[2] + dy * b[0] / safe,
        a[3] + b[3] + dx * dx * part, a[4] + b[4] + dy * dy * part, a[5] + b[5] + dx * dy * part,
    ])


def bands(k: int, tile: int = TILE, limit: int = STATE_BYTES) -> list[list[tuple[int, int]]]:
    """Tile pairs (first column of each) of every pass, so that a pass holds at most ``limit`` bytes."""
    starts = range(0, k, tile)
    pairs = [(a, b) for a in starts for b in starts if a <= b]
    per_pass = max(1, limit // (PARTS * 8 * tile * tile))
    return [pairs[i : i + per_pass] for i in range(0, len(pairs), per_pass)]


def pair_moments(df: DataFrame, cols: Sequence[str], tile: int = TILE, limit: int = STATE_BYTES) -> DataFrame:
    """(i, j, n, mean_i, mean_j, sxx, syy, sxy) for all places i < j in ``cols``.

    Null and NaN count as absent; a pair uses the rows where both are present.
    """
    require_columns(df, cols)
    k = len(cols)
    numbers = df.select(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols]).alias("x"))
    width = max(1, math.isqrt(tasks_of(df)))

    def fold(batches, wanted):
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            for a, b in wanted if len(x) else ():
                made = _moments(x[:, a : a + tile], x[:, b : b + tile])
                held[a, b] = _merge(held[a, b], made) if (a, b) in held else made
        for (a, b), m in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([a], pa.int32()), pa.array([b], pa.int32()), pa.array([m.tobytes()])], names=["a", "b", "m"]
            )

    def merge(key, pdf):
        a, b = key[0], key[1]
        shape = (PARTS, min(tile, k - a), min(tile, k - b))
        total = None
        for raw in pdf["m"]:
            m = np.frombuffer(raw).reshape(shape)
            total = m if total is None else _merge(total, m)
        return pd.DataFrame({"a": [a], "b": [b], "m": [total.tobytes()]})

    def spread(batches):
        for batch in batches:
            for a, b, raw in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "m"))):
                m = np.frombuffer(raw).reshape(PARTS, min(tile, k - a), min(tile, k - b))
                i, j = np.meshgrid(np.arange(a, a + m.shape[1]), np.arange(b, b + m.shape[2]), indexing="ij")
                upper = i < j
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i[upper].astype(np.int32)), pa.array(j[upper].astype(np.int32)), pa.array(m[0][upper].astype(np.int64)),
                     *[pa.array(m[p][upper]) for p in range(1, PARTS)]],
                    names=["i", "j", "n", "mean_i", "mean_j", "sxx", "syy", "sxy"],
                )

    out = None
    for band in bands(k, tile, limit):
        made = numbers.mapInArrow(lambda batches, wanted=band: fold(batches, wanted), "a int, b int, m binary")
        # at most the square root of the number of tasks meets in one group
        near = made.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(width)))
        near = near.groupBy("a", "b", "g").applyInPandas(merge, "a int, b int, m binary")
        whole = near.groupBy("a", "b").applyInPandas(merge, "a int, b int, m binary")
        part = whole.mapInArrow(
            spread, "i int, j int, n long, mean_i double, mean_j double, sxx double, syy double, sxy double"
        )
        out = part if out is None else out.unionByName(part)
    return out


def sum_arrays(partials: DataFrame) -> np.ndarray | None:
    """Sum of one array of doubles per task (column m, as bytes); None without any.

    Merged in two levels; the sum, as long as one array, reaches the driver.
    """
    width = max(1, math.isqrt(tasks_of(partials)))

    def add(batches):
        total = None
        for batch in batches:
            for raw in batch.column("m"):
                m = np.frombuffer(raw.as_buffer())
                total = m.copy() if total is None else total + m
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["m"])

    near = partials.repartition(width).mapInArrow(add, "m binary")
    row = near.repartition(1).mapInArrow(add, "m binary").first()
    return None if row is None else np.frombuffer(row["m"])
