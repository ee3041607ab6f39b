"""Three-phase imputation: neighbours in the same hour, entity statistics, global means."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.checks import require_columns
from ..functions.missing import good_quality, is_missing
from ..session import settle, staged
from . import geo, pyramid
from .joins import matched, with_one_row
from .skew import heavy_keys, spread_join, tasks_of

# Quality codes that mark a reading as suspect or erroneous.
BAD_QUALITY_CODES = ("2", "3", "6", "7")


@dataclass(frozen=True)
class Measure:
    """One reading column with its quality column and missing-value sentinels."""

    col: str
    quality: str | None = None
    sentinels: tuple = ()
    out: str | None = None

    @property
    def name(self) -> str:
        return self.out or self.col


def _hour(df: DataFrame, ts: str, grain: str) -> tuple[Column, Column]:
    """Start of the clock hour, with a fixed instant for an unknown one, and that instant."""
    hour = F.date_trunc(grain, F.col(ts))
    unknown = F.lit("0001-01-01 00:00:00").cast(df.select(hour.alias("h")).schema["h"].dataType)
    return F.coalesce(hour, unknown), unknown


@dataclass(frozen=True)
class Surroundings:
    """Stations (station, lat, lon), each next to itself and all others within ``miles``.

    Takes the place of a neighbour list whose pairs need not be made: readings of one hour
    meet by place, so nothing grows with the square of the number of stations.
    """

    stations: DataFrame
    miles: float
    station: str = "station_id"
    lat: str = "lat"
    lon: str = "lon"

    def located(self, hours: DataFrame) -> DataFrame:
        """Rows by (_entity, _hour) with _lat and _lon; those of other entities go."""
        places = self.stations.select(
            F.col(self.station).alias("_entity"),
            F.col(self.lat).cast("double").alias("_lat"),
            F.col(self.lon).cast("double").alias("_lon"),
        )
        return hours.join(places, "_entity")

    def around(self, asked: DataFrame, known: DataFrame, values: Sequence[str]) -> DataFrame:
        """(_station, _hour, values): readings known in an hour around each (_entity, _hour) asked for."""
        there = pyramid.located("_lat", "_lon")
        probes = asked.select(F.col("_entity").alias("_station"), "_hour", "_lat", "_lon").filter(there)
        targets = known.select("_hour", F.col("_lat").alias("_tlat"), F.col("_lon").alias("_tlon"), *values)
        targets = targets.filter(pyramid.located("_tlat", "_tlon"))
        met = geo.met_within(probes, targets, ["_hour"], self.miles)
        # stations without a place have only themselves
        own = known.filter(~there).join(asked.filter(~there).select("_entity", "_hour"), ["_entity", "_hour"])
        return met.select("_station", "_hour", *values).unionByName(own.select(F.col("_entity").alias("_station"), "_hour", *values))


def _bridge_pairs(bridge: DataFrame, station: str, neighbor: str) -> DataFrame:
    return bridge.select(F.col(station).alias("_station"), F.col(neighbor).alias("_entity"))


def impute_neighbors(
    df: DataFrame,
    bridge: DataFrame | Surroundings,
    entity: str,
    ts: str,
    measures: Sequence[Measure],
    keep: Sequence[str],
    bad_codes: Sequence[str] = BAD_QUALITY_CODES,
    station: str = "station_id",
    neighbor: str = "neighbor_id",
    grain: str = "hour",
) -> DataFrame:
    """Fill missing readings with the mean over self and neighbours in the same clock hour.

    A present reading of good quality is kept; a present reading of bad quality (or
    unknown quality) becomes null; a missing one becomes the mean of the good readings
    of the neighbour list in that hour, or null without any. Rows without a single
    value are dropped, as are entities outside the bridge; exact duplicates collapse.
    The bridge must list every station as its own neighbour; ``Surroundings`` stand for the
    list of all stations within a radius without making it.

    Readings are grouped once, to one row per (entity, hour) with sums, counts and whether
    something is missing; only that summary meets the bridge, and only hours with something
    to fill are looked up. The readings meet the answers by (entity, hour); hours that hold
    many of all readings, as counted in the summary, are dealt over several tasks.
    """
    require_columns(df, [entity, ts, *keep, *[m.col for m in measures]])
    by_place = isinstance(bridge, Surroundings)
    if not by_place:
        require_columns(bridge, [station, neighbor])
    values, needs = {}, {}
    for i, m in enumerate(measures):
        absent = is_missing(df, m.col, m.sentinels)
        good = good_quality(F.col(m.quality), bad_codes) if m.quality else F.lit(True)
        values[f"_v{i}"] = F.when(~absent & good, F.col(m.col).cast("double"))
        needs[f"_m{i}"] = absent
    hour, unknown = _hour(df, ts, grain)
    rows = df.select(
        *keep,
        F.col(entity).alias("_entity"),
        hour.alias("_hour"),
        *[v.alias(k) for k, v in {**values, **needs}.items()],
    ).filter(F.col("_entity").isNotNull())
    summary = rows.groupBy("_entity", "_hour").agg(
        F.count("*").alias("_rows"),
        F.bool_or(reduce(lambda a, b: a | b, [F.col(m) for m in needs])).alias("_gap"),
        *[F.sum(v).alias(f"{v}s") for v in values],
        *[F.count(v).alias(f"{v}n") for v in values],
    )
    if by_place:
        summary = staged(bridge.located(summary), "hours")
    else:
        summary = staged(matched(summary, bridge.select(F.col(neighbor).alias("_entity")), "_entity"), "hours")
    known = summary.filter(reduce(lambda a, b: a | b, [F.col(f"{v}n") > 0 for v in values]))
    asked = summary.filter(F.col("_gap") & (F.col("_hour") != unknown))
    if by_place:
        met = bridge.around(asked, known, [f"{v}{kind}" for v in values for kind in "sn"])
    else:
        spread = asked.select(F.col("_entity").alias("_station"), "_hour")
        spread = spread_join(spread, _bridge_pairs(bridge, station, neighbor), "_station", few_keys="_station")
        met = spread.join(known.drop("_rows", "_gap"), ["_entity", "_hour"])
    means = (
        met.groupBy(F.col("_station").alias("_entity"), "_hour")
        .agg(*[F.try_divide(F.sum(f"{v}s"), F.sum(f"{v}n")).alias(f"{v}a") for v in values])
    )
    answers = summary.select("_entity", "_hour").join(means, ["_entity", "_hour"], "left")
    heavy = heavy_keys(summary.select("_entity", "_hour", "_rows"), ["_entity", "_hour"], "_rows", tasks_of(df))
    filled = spread_join(rows, answers, ["_entity", "_hour"], heavy=heavy).select(
        "_entity",
        "_hour",
        *keep,
        *[
            F.coalesce(F.col(f"_v{i}"), F.when(F.col(f"_m{i}"), F.col(f"_v{i}a"))).alias(m.name)
            for i, m in enumerate(measures)
        ],
    )
    some = reduce(lambda a, b: a | b, [F.col(m.name).isNotNull() for m in measures])
    return filled.filter(some).dropDuplicates().drop("_entity", "_hour")


def neighborhood_stats(
    df: DataFrame,
    bridge: DataFrame | Surroundings,
    entity: str,
    ts: str,
    stats: Mapping[str, Mapping[str, str]],
    keep: Sequence[str],
    station: str = "station_id",
    neighbor: str = "neighbor_id",
    grain: str = "hour",
) -> DataFrame:
    """Replace readings by statistics over self and neighbours in the same clock hour.

    ``stats`` maps a reading column to output names per statistic, e.g.
    ``{"ceiling": {"avg": "AVG_CEILING", "min": "MIN_CEILING"}}``. A reading that is
    null keeps null statistics; rows of entities outside the bridge are dropped. Readings
    are grouped once and meet the answers as in ``impute_neighbors``.
    """
    require_columns(df, [entity, ts, *keep, *stats])
    hour, unknown = _hour(df, ts, grain)
    rows = df.select(
        *keep,
        F.col(entity).alias("_entity"),
        hour.alias("_hour"),
        *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(stats)],
    )
    span = range(len(stats))
    hourly = rows.groupBy("_entity", "_hour").agg(
        F.count("*").alias("_rows"),
        *[F.sum(f"_v{i}").alias(f"_s{i}") for i in span],
        *[F.count(f"_v{i}").alias(f"_n{i}") for i in span],
        *[F.min(f"_v{i}").alias(f"_l{i}") for i in span],
    )
    if isinstance(bridge, Surroundings):
        listed = hourly = staged(bridge.located(hourly), "hours")
        known = reduce(lambda a, b: a | b, [F.col(f"_n{i}") > 0 for i in span])
        dated = hourly.filter(known & (F.col("_hour") != unknown))
        met = bridge.around(dated, dated, [f"_{kind}{i}" for kind in "snl" for i in span])
    else:
        # neighbours outside the station list still contribute their readings
        hourly = staged(hourly, "hours")
        met = spread_join(
            hourly.filter(F.col("_hour") != unknown).drop("_rows"), _bridge_pairs(bridge, station, neighbor).withColumnRenamed("_entity", "_from"),
            "_entity", few_keys="_from",
        )
        listed = matched(hourly, bridge.select(F.col(station).alias("_entity")), "_entity")
    around = (
        met.groupBy(F.col("_station").alias("_entity"), "_hour")
        .agg(
            *[F.try_divide(F.sum(f"_s{i}"), F.sum(f"_n{i}")).alias(f"_avg{i}") for i in span],
            *[F.min(f"_l{i}").alias(f"_min{i}") for i in span],
        )
    )
    answers = listed.select("_entity", "_hour").join(around, ["_entity", "_hour"], "left")
    heavy = heavy_keys(hourly.select("_entity", "_hour", "_rows"), ["_entity", "_hour"], "_rows", tasks_of(df))
    outputs = [
        F.when(F.col(f"_v{i}").isNotNull(), F.col(f"_{kind}{i}")).alias(name)
        for i, wanted in enumerate(stats.values())
        for kind, name in wanted.items()
    ]
    return spread_join(rows, answers, ["_entity", "_hour"], heavy=heavy).select(*keep, *outputs)


def fit_group_stats(train: DataFrame, key: str, stats: Mapping[str, Column]) -> DataFrame:
    """Per-entity aggregates of the training slice, e.g. ``{"AVG_X": F.avg("x")}``."""
    return train.groupBy(key).agg(*[agg.alias(name) for name, agg in stats.items()])


def fill_from(
    df: DataFrame, stats: DataFrame, key: str, stats_key: str, mapping: Mapping[str, str]
) -> DataFrame:
    """Fill nulls of each column from the fitted statistic of the row's entity.

    Entities are counted first, and the rows of heavy ones are dealt over several tasks.
    """
    require_columns(df, [key, *mapping])
    require_columns(stats, [stats_key, *mapping.values()])
    side = stats.select(
        F.col(stats_key).alias("_fit_key"),
        *[F.col(s).alias(f"_fit{i}") for i, s in enumerate(mapping.values())],
    )
    joined = spread_join(df, side, key, few_keys="_fit_key", how="left")
    fills = {c: F.coalesce(F.col(c), F.col(f"_fit{i}")) for i, c in enumerate(mapping)}
    return joined.withColumns(fills).select(*df.columns)


def fit_global_stats(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the mean of every column."""
    return train.agg(*[F.avg(c).alias(c) for c in cols])


def fill_global(df: DataFrame, means: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill nulls from the one-row table of means."""
    side = means.select(*[F.col(c).alias(f"_mean{i}") for i, c in enumerate(cols)])
    joined = with_one_row(df, side)
    fills = {c: F.coalesce(F.col(c), F.col(f"_mean{i}")) for i, c in enumerate(cols)}
    return joined.withColumns(fills).select(*df.columns)


@dataclass
class ImputationModel:
    """Phases two and three, fitted on a training slice and applied to any slice.

    ``roles`` maps a key column of the data (e.g. the origin's station) to the columns
    it fills and the entity statistic each is filled from.
    """

    stats_key: str
    roles: Mapping[str, Mapping[str, str]]
    entity_stats: DataFrame | None = field(default=None, repr=False)
    means: DataFrame | None = field(default=None, repr=False)

    @property
    def columns(self) -> list[str]:
        return [c for mapping in self.roles.values() for c in mapping]

    def fill_entities(self, df: DataFrame) -> DataFrame:
        for key, mapping in self.roles.items():
            df = fill_from(df, self.entity_stats, key, self.stats_key, mapping)
        return df

    def fit(self, train: DataFrame, entity_stats: DataFrame) -> ImputationModel:
        """Keep the entity statistics; take global means of the training rows they filled."""
        stats = settle(entity_stats)
        model = ImputationModel(self.stats_key, self.roles, stats)
        model.means = settle(fit_global_stats(model.fill_entities(train), self.columns))
        return model

    def transform(self, df: DataFrame) -> DataFrame:
        return fill_global(self.fill_entities(df), self.means, self.columns)

    def save(self, path: str) -> None:
        self.entity_stats.write.mode("overwrite").parquet(f"{path}/entity_stats")
        self.means.write.mode("overwrite").parquet(f"{path}/means")

    def load(self, spark: SparkSession, path: str) -> ImputationModel:
        return ImputationModel(
            self.stats_key,
            self.roles,
            spark.read.parquet(f"{path}/entity_stats"),
            spark.read.parquet(f"{path}/means"),
        )
