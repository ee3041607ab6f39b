"""Look-back operators over time: as-of join, running counts, interval checks.

One entity may own a large share of all rows, and many rows may share one instant, so
no window here is partitioned by the entity alone and no wide row goes through one:

1. Look-ups shrink to distinct (entity, instant) pairs, readings to one row per pair.
2. The time axis is cut into chunks and the pairs are partitioned by (entity, chunk).
   What a chunk must know about earlier chunks reaches it as one carry row, computed
   from a summary with at most one row per (entity, chunk).
3. The answers are joined back to the rows by (entity, instant), an equi-join whose
   skewed partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.checks import as_list, require_columns
from ..functions.timeexpr import DAY_US, from_micros, instant, micros, span_us
from ..session import require_utc


def _chunk(at: Column, width: int) -> Column:
    """Start of the chunk that holds an instant; chunks are named by their start."""
    return at - F.pmod(at, F.lit(width))


def _usable(*cols: Column) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])


def _later_chunks(chunk: Column, last: Column, width: int) -> Column:
    """Chunks after this one up to the last; null (dropped by explode) when there are none."""
    return F.when(chunk < last, F.sequence(chunk + width, last, F.lit(width).cast("long")))


def _named(names: Sequence[str]) -> list[str]:
    return [f"_k{i}" for i in range(len(names))]


def _instants(df: DataFrame, names: Sequence[str], at: Column, width: int) -> DataFrame:
    """Distinct usable (keys, _at) of a frame, with their chunk."""
    keys = _named(names)
    return (
        df.select(*[F.col(c).alias(k) for k, c in zip(keys, names, strict=True)], at.alias("_at"))
        .filter(_usable(*[F.col(k) for k in keys], F.col("_at")))
        .distinct()
        .withColumn("_chunk", _chunk(F.col("_at"), width))
    )


def _scan(
    keys: list[str], probes: DataFrame, points: Sequence[DataFrame], fold: Callable[[str], Column]
) -> DataFrame:
    """Fold the values ``_v`` of all points of a probe's chunk up to and at its instant.

    Returns (keys, _at, _found) for every probe.
    """
    value_type = points[0].schema["_v"].dataType
    stacked = probes.select(
        *keys, "_chunk", "_at", F.lit(1).alias("_side"), F.lit(None).cast(value_type).alias("_v")
    )
    for p in points:
        stacked = stacked.unionByName(
            p.select(*keys, "_chunk", "_at", F.lit(0).alias("_side"), "_v")
        )
    upto = (
        W.partitionBy(*keys, "_chunk")
        .orderBy("_at", "_side")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return (
        stacked.withColumn("_found", fold("_v").over(upto))
        .filter(F.col("_side") == 1)
        .select(*keys, "_at", "_found")
    )


def _join_back(df: DataFrame, names: Sequence[str], at: Column, answers: DataFrame) -> DataFrame:
    """Append ``_found`` to every row by its keys and instant; rows without an answer get null.

    Rows without an instant match nothing; a hash of their content deals them over tasks.
    """
    nowhere = F.when(at.isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(1 << 20)) + 1).otherwise(F.lit(0))
    answers = answers.withColumn("_here", F.lit(0).cast("long"))
    same = (at == F.col("_at")) & (nowhere == F.col("_here"))
    for key, name in zip(_named(names), names, strict=True):
        same = same & (F.col(name) == F.col(key))
    return df.join(answers, same, "left").drop("_here")


def _latest(
    instants: DataFrame,
    right: DataFrame,
    right_keys: Sequence[str],
    right_ts: str,
    payload: Mapping[str, Column],
    span: int,
    width: int,
) -> DataFrame:
    """Latest reading at or before each instant and at most ``span`` older, as ``_found``."""
    keys = _named(right_keys)
    group = [*keys, "_chunk"]
    readings = (
        right.filter(_usable(F.col(right_ts), *[F.col(r) for r in right_keys]))
        .withColumns({k: F.col(r) for k, r in zip(keys, right_keys, strict=True)})
        .withColumn("_at", micros(right_ts))
        .withColumn("_chunk", _chunk(F.col("_at"), width))
        .groupBy(*group, "_at")
        .agg(*[agg.alias(name) for name, agg in payload.items()])
        .select(*group, "_at", F.struct(F.col("_at").alias("at"), *payload).alias("_v"))
    )
    # the last reading of a chunk serves later chunks until the next one that has readings
    order = W.partitionBy(*keys).orderBy("_chunk")
    carry = (
        readings.groupBy(*group)
        .agg(F.max_by("_v", "_at").alias("_v"))
        .withColumn("_at", F.col("_v.at"))
        .withColumn("_next", F.lead("_chunk").over(order))
        .withColumn("_last", _chunk(F.col("_at") + span, width))
        .withColumn(
            "_chunk",
            F.explode(_later_chunks(F.col("_chunk"), F.least("_next", "_last"), width)),
        )
    )
    answers = _scan(keys, instants, [readings, carry], lambda v: F.last(v, ignorenulls=True))
    return answers.filter(F.col("_at") - F.col("_found.at") <= span)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[tuple[str, str]] | Sequence[str] | str,
    left_ts: str,
    right_ts: str,
    payload: Mapping[str, Column],
    min_lag: timedelta = timedelta(hours=2),
    max_age: timedelta = timedelta(hours=50),
    matched_ts: str | None = "matched_ts",
    chunk: timedelta | None = None,
) -> DataFrame:
    """Attach the latest reading at least ``min_lag`` and at most ``max_age`` old.

    Both bounds are inclusive, every left row is kept exactly once, and unmatched rows
    get nulls. ``payload`` maps output names to aggregates such as ``F.avg("x")`` or
    ``F.min("x")``; they combine several readings of one entity at one instant.
    ``by`` lists key names, or (left name, right name) pairs. ``chunk`` defaults to an
    eighth of the look-back window.
    """
    pairs = [(k, k) if isinstance(k, str) else k for k in ([by] if isinstance(by, str) else by)]
    left_keys, right_keys = [p[0] for p in pairs], [p[1] for p in pairs]
    return asof_join_roles(
        left,
        right,
        {"": left_keys},
        right_keys,
        left_ts,
        right_ts,
        payload,
        min_lag,
        max_age,
        "{role}" + matched_ts if matched_ts else None,
        "{name}",
        chunk,
    )


def asof_join_roles(
    left: DataFrame,
    right: DataFrame,
    roles: Mapping[str, str | Sequence[str]],
    right_keys: str | Sequence[str],
    left_ts: str,
    right_ts: str,
    payload: Mapping[str, Column],
    min_lag: timedelta = timedelta(hours=2),
    max_age: timedelta = timedelta(hours=50),
    matched_ts: str | None = "{role}_MAX_DATE",
    name: str = "{name}_{role}",
    chunk: timedelta | None = None,
) -> DataFrame:
    """As-of join of one reading table in several roles, e.g. at origin and destination.

    ``roles`` maps a role to its key columns on the left; ``matched_ts`` and ``name``
    are patterns for the output names. The instants of all roles are answered by one
    scan of the readings. See ``asof_join`` for the bounds.
    """
    require_utc(left.sparkSession)
    roles, right_keys = {r: as_list(k) for r, k in roles.items()}, as_list(right_keys)
    require_columns(left, [left_ts, *[c for names in roles.values() for c in names]])
    require_columns(right, [right_ts, *right_keys])
    lag, span = span_us(min_lag), span_us(max_age) - span_us(min_lag)
    if span < 0:
        raise ValueError("max_age must not be below min_lag")
    width = span_us(chunk) if chunk else max(span // 8, 60_000_000)
    at = micros(left_ts) - F.lit(lag)

    asked = [_instants(left, names, at, width) for names in roles.values()]
    instants = asked[0] if len(asked) == 1 else reduce(DataFrame.unionByName, asked).distinct()
    answers = _latest(instants, right, right_keys, right_ts, payload, span, width)
    out = left
    for role, names in roles.items():
        outputs = [F.col(f"_found.`{c}`").alias(name.format(name=c, role=role)) for c in payload]
        if matched_ts:
            outputs.insert(0, from_micros(F.col("_found.at")).alias(matched_ts.format(role=role)))
        joined = _join_back(out, names, at, answers)
        out = joined.select(*[out[f"`{c}`"] for c in out.columns], *outputs)
    return out


def events_so_far(
    df: DataFrame,
    by: str | Sequence[str],
    ts: str,
    flag: Column,
    lag: timedelta = timedelta(hours=2),
    out: str = "events_so_far",
    points: DataFrame | None = None,
    chunk: timedelta = timedelta(hours=1),
) -> DataFrame:
    """Count flagged events of the same entity on the same UTC day, at least ``lag`` earlier.

    The boundary is inclusive. A cut-off on the previous day gives 0, and so does a
    null entity. ``points`` may supply another frame of events (same column names).
    With ``by=[]`` all events count for every row.
    """
    require_utc(df.sparkSession)
    names = as_list(by)
    points = df if points is None else points
    require_columns(df, [ts, *names])
    require_columns(points, [ts, *names])
    width, delay = span_us(chunk), span_us(lag)
    if DAY_US % width:
        raise ValueError("chunk must divide a day")
    keys = _named(names)
    group = [*keys, "_chunk"]

    flagged = (
        points.filter(flag & _usable(F.col(ts), *[F.col(c) for c in names]))
        .select(
            *[F.col(c).alias(k) for k, c in zip(keys, names, strict=True)], micros(ts).alias("_at")
        )
        .groupBy(*keys, _chunk(F.col("_at"), width).alias("_chunk"), "_at")
        .agg(F.count("*").alias("_v"))
    )
    # the total of the day so far serves later chunks of the day until the next one with events
    order = W.partitionBy(*keys, "_day").orderBy("_chunk")
    carry = (
        flagged.groupBy(*group)
        .agg(F.sum("_v").alias("_v"))
        .withColumn("_day", _chunk(F.col("_chunk"), DAY_US))
        .withColumn("_next", F.lead("_chunk").over(order))
        .withColumn("_v", F.sum("_v").over(order))
        .withColumn("_last", F.least("_next", F.col("_day") + F.lit(DAY_US - width)))
        .withColumn("_chunk", F.explode(_later_chunks(F.col("_chunk"), F.col("_last"), width)))
        .withColumn("_at", F.col("_chunk"))
    )
    now = micros(ts)
    same_day = _chunk(now - F.lit(delay), DAY_US) == _chunk(now, DAY_US)
    at = F.when(same_day, now - F.lit(delay))
    answers = _scan(keys, _instants(df, names, at, width), [flagged, carry], F.sum)
    return _join_back(df, names, at, answers).select(
        *[df[f"`{c}`"] for c in df.columns], F.coalesce("_found", F.lit(0)).alias(out)
    )


def hub_events_so_far(
    df: DataFrame,
    hubs: DataFrame,
    entity: str,
    ts: str,
    flag: Column,
    lag: timedelta = timedelta(hours=2),
    out: str = "hub_events_so_far",
    chunk: timedelta = timedelta(minutes=1),
) -> DataFrame:
    """Flagged events at the hub entities earlier the same day; equal for all rows of an instant.

    ``hubs`` is a one-column frame named like ``entity`` (a top-k result). The count is
    made once per distinct instant, spread by minute, since it is not per entity.
    """
    at_hubs = df.filter(flag).join(hubs.select(entity).distinct(), entity, "left_semi")
    return events_so_far(df, [], ts, flag, lag, out, points=at_hubs, chunk=chunk)


def overlapping_intervals(
    df: DataFrame,
    by: str | Sequence[str],
    begin: str,
    end: str,
    tie_break: str,
    out: str = "overlaps",
    chunk: timedelta = timedelta(days=30),
) -> DataFrame:
    """Mark rows whose interval meets an earlier-starting interval of the same key.

    Intervals are closed; rows that start together are ordered by ``tie_break``.
    """
    require_utc(df.sparkSession)
    names = as_list(by)
    require_columns(df, [*names, begin, end, tie_break])
    width = span_us(chunk)
    keys = _named(names)
    group = [*keys, "_chunk"]
    at = micros(begin)
    # per start: how far it reaches, and the first row that covers the start itself
    starts = (
        df.filter(_usable(F.col(begin), *[F.col(c) for c in names]))
        .select(
            *[F.col(c).alias(k) for k, c in zip(keys, names, strict=True)],
            at.alias("_at"),
            micros(end).alias("_end"),
            F.col(tie_break).alias("_tie"),
        )
        .groupBy(*keys, _chunk(F.col("_at"), width).alias("_chunk"), "_at")
        .agg(
            F.max("_end").alias("_v"),
            F.min(F.when(F.col("_end") >= F.col("_at"), F.col("_tie"))).alias("_first"),
        )
    )
    order = W.partitionBy(*keys).orderBy("_chunk")
    carry = (
        starts.groupBy(*group)
        .agg(F.max("_v").alias("_v"))
        .withColumn("_v", F.max("_v").over(order))
        .withColumn("_chunk", F.lead("_chunk").over(order))
        .filter(F.col("_chunk").isNotNull())
        .withColumns({"_at": F.col("_chunk") - 1, "_first": F.lit(None).cast(df.schema[tie_break].dataType)})
    )
    # a carry row sorts before every start of its chunk
    earlier = W.partitionBy(*group).orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    answers = (
        starts.withColumn("_start", F.lit(True))
        .unionByName(carry.withColumn("_start", F.lit(False)))
        .withColumn("_found", F.struct(F.max("_v").over(earlier).alias("reach"), F.col("_first").alias("first")))
        .filter("_start")
        .select(*keys, "_at", "_found")
    )
    meets = (F.col("_found.reach") >= at) | (F.col("_found.first") < F.col(tie_break))
    return _join_back(df, names, at, answers).select(
        *[df[f"`{c}`"] for c in df.columns],
        F.when(meets, 1).otherwise(0).alias(out),
    )


def merge_ranges(ranges: Sequence[tuple[datetime, datetime]]) -> list[tuple[datetime, datetime]]:
    """Sorted, disjoint form of a short literal list of closed ranges."""
    merged: list[tuple[datetime, datetime]] = []
    for low, high in sorted(ranges):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], high))
        else:
            merged.append((low, high))
    return merged


def range_flag(
    df: DataFrame,
    ts: str,
    ranges: Sequence[tuple[datetime, datetime]] | DataFrame,
    out: str = "in_range",
    begin: str = "begin",
    end: str = "end",
    chunk: timedelta = timedelta(hours=1),
) -> DataFrame:
    """1 when the instant lies in any closed range, else 0; never multiplies rows.

    A list, which the caller wrote out, becomes a plain expression without a shuffle. A
    frame of any length is cut at chunk borders and scanned together with the distinct
    instants of the chunk.
    """
    if not isinstance(ranges, DataFrame):
        kind = df.schema[ts].dataType
        tests = [
            F.col(ts).between(instant(lo, kind), instant(hi, kind))
            for lo, hi in merge_ranges(ranges)
        ]
        inside = reduce(lambda a, b: a | b, tests) if tests else F.lit(False)
        return df.withColumn(out, F.when(inside, 1).otherwise(0))

    require_utc(df.sparkSession)
    width = span_us(chunk)
    pieces = (
        ranges.select(micros(begin).alias("_lo"), micros(end).alias("_v"))
        .filter(F.col("_lo") <= F.col("_v"))
        .withColumn(
            "_chunk",
            F.explode(
                F.sequence(
                    _chunk(F.col("_lo"), width),
                    _chunk(F.col("_v"), width),
                    F.lit(width).cast("long"),
                )
            ),
        )
        .select("_chunk", F.greatest("_lo", "_chunk").alias("_at"), "_v")
    )
    at = micros(ts)
    answers = _scan([], _instants(df, [], at, width), [pieces], F.max)
    return _join_back(df, [], at, answers).select(
        *[df[f"`{c}`"] for c in df.columns],
        F.when(F.col("_found") >= at, 1).otherwise(0).alias(out),
    )
