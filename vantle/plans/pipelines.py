"""The feature pipelines over DataFrames: streaming-style, batch, tensor, and the two-table merge.

Each is one lazy DataFrame graph; the only actions are the statistics that pruning
needs. What is pruned or split is returned beside the table.
"""

from __future__ import annotations

import time as clock
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import with_calendar, with_directions
from ..functions.normalize import direction_columns, numeric_columns, parse_time, zip_first_digits
from ..operators import impact, joins, lags, project, stats, tensor
from ..session import written

#: Columns that pruning leaves alone unless told otherwise.
KEEP_VARIANCE = ("time", "zip", "road_impact_score", "facility_impact_score")
KEEP_CARDINALITY = (
    *KEEP_VARIANCE, "day", "day_of_week", "day_of_week_cos", "day_of_week_sin", "day_of_year", "hour", "hour_sin", "hour_cos", "is_weekend",
    "latitude", "longitude", "month", "month_cos", "month_sin", "ozone", "us_aqi",
)


@dataclass(frozen=True)
class FeatureConfig:
    """Options of the feature pipelines."""

    key: str = "zip"
    time: str = "time"
    left_drop: tuple[str, ...] = ()
    right_drop: tuple[str, ...] = ()
    overlap: str = "right"
    normalize_first: bool = True
    directions: tuple[str, ...] = ()
    detect_directions: bool = True
    drop_directions: bool = True
    lagged: tuple[str, ...] = ()
    lags: int = 0
    lag_missing: object = None
    cardinality_threshold: int | None = None
    variance_threshold: float | None = None
    keep_cardinality: tuple[str, ...] = KEEP_CARDINALITY
    keep_variance: tuple[str, ...] = KEEP_VARIANCE
    nan_policy: str = "skip"
    impact: impact.ImpactConfig = field(default_factory=impact.ImpactConfig)


@dataclass
class Report:
    """Seconds of each step that ran an action, and what the steps decided."""

    seconds: dict[str, float] = field(default_factory=dict)
    notes: dict[str, object] = field(default_factory=dict)

    def timed(self, name: str, run: Callable[[], object]) -> object:
        began = clock.monotonic()
        got = run()
        self.seconds[name] = round(clock.monotonic() - began, 3)
        return got


def _timed_feed(df: DataFrame, config: FeatureConfig) -> DataFrame:
    if not config.normalize_first or dict(df.dtypes)[config.time].startswith("timestamp"):
        return df
    return df.withColumn(config.time, parse_time(config.time))


def stream_features(left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str], config: FeatureConfig = FeatureConfig(), lookup: DataFrame | None = None) -> tuple[DataFrame, Report]:
    """Full outer pairing join of two feeds on (key, time), then directions, calendar, scores and lags, then pruning.

    left_order and right_order say which of rows with equal keys comes first; those
    columns must not be dropped unless they are keys. With a lookup the two wind-driven
    scores are computed; without one they are 0.
    """
    keys = [config.key, config.time]
    report = Report()
    a = project.drop_columns(_timed_feed(left, config), config.left_drop, keys)
    b = project.drop_columns(_timed_feed(right, config), config.right_drop, keys)
    merged = joins.pairing_join(a, b, keys, left_order, right_order, "full_outer", config.overlap, cluster=[config.key])
    found = direction_columns(merged.columns, config.directions, config.detect_directions)
    out = with_directions(merged, found, False, False)
    stamp = F.col(config.time) if dict(out.dtypes)[config.time].startswith("timestamp") else parse_time(config.time)
    out = with_calendar(out, stamp)
    if lookup is None:
        out = out.withColumns({"road_impact_score": F.lit(0.0), "facility_impact_score": F.lit(0.0)})
    else:
        out = impact.wind_scores(out, lookup, config.key, config.impact)
    order = [config.time, *[c for c in dict.fromkeys([*left_order, *right_order]) if c in out.columns]]
    out = lags.add_lags(out, config.key, order, config.lagged, config.lags, config.lag_missing, strict=False)
    out = out.select(*[c for c in project.output_columns(a.columns, b.columns, keys, found, config.drop_directions, config.lagged, config.lags) if c in out.columns])
    return prune(out, config, report), report


def prune(df: DataFrame, config: FeatureConfig, report: Report) -> DataFrame:
    """Cardinality and variance pruning; both statistics look at the table before either removed a column."""
    if config.cardinality_threshold is None and config.variance_threshold is None:
        return df
    df = written(df, "features")
    kept = df.columns
    if config.cardinality_threshold is not None:
        _, low = report.timed("cardinality_filter", lambda: stats.prune_low_cardinality(df, config.cardinality_threshold, config.keep_cardinality))
        report.notes["low_cardinality"] = low
        kept = [c for c in kept if c not in low.removed]
    if config.variance_threshold is not None:
        _, flat = report.timed("variance_filter", lambda: stats.prune_low_variance(df, config.variance_threshold, numeric_columns(df), config.keep_variance, True, config.nan_policy))
        report.notes["low_variance"] = flat
        kept = [c for c in kept if c not in flat.removed]
    return df.select(*kept)


def batch_features(left: DataFrame, right: DataFrame, row_order: Sequence[str], config: FeatureConfig = FeatureConfig(), static: DataFrame | None = None, split: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame | None, Report]:
    """Inner join of two feeds, static scores, calendar with year, directions, variance pruning, optional split, lags.

    Returns (time-varying or combined table, time-invariant table or None, report).
    """
    report = Report()
    keys = [config.key, config.time]
    tidy = lambda df, drop: project.drop_columns(_timed_feed(df, config).withColumn(config.key, zip_first_digits(config.key)), drop, keys)
    out = joins.left_wins_join(tidy(left, config.left_drop), tidy(right, config.right_drop), keys)
    if static is not None:
        out = impact.attach_static(out, static, config.key)
    out = with_directions(with_calendar(out, config.time, year=True, weekend_of_missing=0), config.directions, config.detect_directions, config.drop_directions)
    if config.variance_threshold is not None:
        out = written(out, "features")
        out, low = report.timed("variance_filter", lambda: stats.prune_low_variance(out, config.variance_threshold, numeric_columns(out), config.keep_variance, False))
        report.notes["low_variance"] = low
    fixed = None
    order = [config.time, *row_order]
    if split is not None:
        fixed_columns = [c for c in split if c in out.columns]
        report.notes["varying"] = stats_of_split = project.varying_within(out, config.key, fixed_columns)
        report.notes["invariant_columns"] = [c for c in fixed_columns if c not in stats_of_split]
        out, fixed = project.split_invariant(out, config.key, order, fixed_columns, config.time)
    return lags.add_lags(out, config.key, order, config.lagged, config.lags, config.lag_missing), fixed, report


@dataclass(frozen=True)
class TensorConfig:
    train: float = 0.7
    val: float = 0.2
    test: float = 0.1
    variance_threshold: float | None = None
    sweeps: int = 50
    tolerance: float = 1e-6


def tensor_features(left: DataFrame, right: DataFrame, row_order: Sequence[str], features_config: FeatureConfig = FeatureConfig(), config: TensorConfig = TensorConfig(), static: DataFrame | None = None, coordinates: DataFrame | None = None) -> tuple[DataFrame, dict]:
    """Batch features, scaled, pruned, as a filled [split, time, feature, place] table of cells, with its description."""
    table, _, _ = batch_features(left, right, row_order, replace(features_config, variance_threshold=None, lags=0), static)
    key, time = features_config.key, features_config.time
    names = numeric_columns(table, [*row_order, key, time])
    table = stats.min_max_scale(table, names)
    if config.variance_threshold is not None:
        table, low = stats.prune_low_variance(table, config.variance_threshold, names, normalized=False)
        names = [n for n in names if n not in low.removed]
    if coordinates is not None:
        table = table.join(coordinates, key, "left")
    observed = tensor.cells(table, time, key, names, row_order)
    n_times, n_features, n_places = tensor.shape(table, time, key, names)
    sizes = dict(zip(("train", "val", "test"), tensor.split_sizes(n_times, config.train, config.val, config.test), strict=True))
    parts = tensor.split(observed, n_times, config.train, config.val, config.test)
    out = tensor.filled(parts, n_features, sizes, n_places, config.sweeps, config.tolerance)
    return out, {"shape": [n_times, n_features, n_places], "features": names, "sizes": sizes}


def merge_two(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, left_order: Sequence[str], right_order: Sequence[str], left_drop: Sequence[str] = (), right_drop: Sequence[str] = ()) -> DataFrame:
    """Generic full outer merge of two tables over dense timesteps; shared columns are an error."""
    a, b = project.drop_columns(left, left_drop, keys), project.drop_columns(right, right_drop, keys)
    return joins.timestep_join(a, b, keys, time, left_order, right_order)
