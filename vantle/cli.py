"""Command line: ``python -m vantle.cli <command> ...`` over CSV files and shapefiles."""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.normalize import by_trimmed_name, name_list, parse_time, strip_after_seconds
from .operators import impact, project, quality, stats
from .plans import geography, pipelines
from .plans.report import StepLog
from .session import drop_written, local_session, written
from .sources import feeds, shapes, tables

ROW = "__row"


def _feed(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_csv(spark, path).withColumn(ROW, F.monotonically_increasing_id())


def _config(a: argparse.Namespace) -> pipelines.FeatureConfig:
    return pipelines.FeatureConfig(
        left_drop=tuple(a.left_drop_columns), right_drop=tuple(a.right_drop_columns), directions=tuple(name_list(a.direction_columns)), detect_directions=not a.no_auto_detect_direction_columns,
        drop_directions=not a.keep_original_direction_columns, lagged=tuple(a.feats_for_past), lags=a.num_past_feats, cardinality_threshold=a.cardinality_threshold, variance_threshold=a.variance_threshold,
        keep_variance=tuple(name_list(a.exclude_variance)) or pipelines.KEEP_VARIANCE, keep_cardinality=tuple(name_list(a.exclude_cardinality)) or pipelines.KEEP_CARDINALITY,
        impact=impact.ImpactConfig(1000 * a.road_radius_km, 1000 * a.facility_radius_km, a.road_wind_mode, a.road_wind_blend_100m, a.facility_wind_mode, a.facility_wind_blend_100m),
    )


def _geography(spark: SparkSession, a: argparse.Namespace, keys: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    shapes.register(spark)
    load = spark.read.format("shapes").load
    places = geography.place_centroids(load(a.zip_shapefile), keys)
    fac = impact.enrich_facilities(geography.facility_table(tables.read_csv(spark, a.tri_facilities)), geography.chemical_table(tables.read_csv(spark, a.tri_chemicals)), a.amount_fallback)
    return written(places, "places"), fac, geography.road_parts(load(a.roads_shapefile))


def features(spark: SparkSession, a: argparse.Namespace) -> None:
    """Streaming-style feature table."""
    log, config = StepLog(os.path.join(a.output_dir, "metadata", "steps.log")), _config(a)
    left, right = (_feed(spark, p).withColumnRenamed(ROW, f"{ROW}_{s}") for p, s in ((a.air_quality, "l"), (a.weather, "r")))
    with log.step("static_spatial_precompute"):
        places, fac, roads = _geography(spark, a, left.select("zip").union(right.select("zip")))
        c = config.impact
        lookup = impact.pair_lookup(places, impact.facility_pairs(places, fac, c.facility_radius), impact.road_pairs(places, roads, c.road_radius))
        lookup.write.mode("overwrite").parquet(os.path.join(a.output_dir, "spatial_lookup"))
        lookup = spark.read.parquet(os.path.join(a.output_dir, "spatial_lookup"))
    with log.step("merge_and_transform"):
        out, report = pipelines.stream_features(left, right, [f"{ROW}_l"], [f"{ROW}_r"], config, lookup)
        final = log.counted(out.drop(f"{ROW}_l", f"{ROW}_r"), "rows_written")
        tables.write_csv(final, os.path.join(a.output_dir, "features"), missing=a.missing)
    log.value("pruning", {k: str(v) for k, v in report.notes.items()})
    log.write_summary(os.path.join(a.output_dir, "metadata", "summary.json"), features=os.path.join(a.output_dir, "features"))


def batch(spark: SparkSession, a: argparse.Namespace) -> None:
    """Batch feature table, whole or split in time-varying and time-invariant parts."""
    config = _config(a)
    left, right = _feed(spark, a.air_quality), _feed(spark, a.weather).drop(ROW)
    places, fac, roads = _geography(spark, a, left.select("zip"))
    static = impact.static_scores(places, fac, roads, config.impact)
    invariant = ["latitude", "longitude", *[c for c in static.columns if c != "place"]] if a.output_mode == "split" else None
    table, fixed, _ = pipelines.batch_features(left, right, [ROW], config, static, invariant)
    tables.write_csv(table.drop(ROW), os.path.join(a.output_dir, "time_varying" if fixed else "combined"), missing=a.missing)
    if fixed is not None:
        tables.write_csv(fixed.orderBy("zip"), os.path.join(a.output_dir, "time_invariant"), single_file=True)


def tensor(spark: SparkSession, a: argparse.Namespace) -> None:
    """Filled tensor cells with their description."""
    left, right = _feed(spark, a.air_quality), _feed(spark, a.weather).drop(ROW)
    places, fac, roads = _geography(spark, a, left.select("zip"))
    config = _config(a)
    shares = pipelines.TensorConfig(a.train_fraction, a.val_fraction, a.test_fraction, a.variance_threshold)
    cells, about = pipelines.tensor_features(left, right, [ROW], config, shares, impact.static_scores(places, fac, roads, config.impact))
    path = os.path.join(a.output_dir, "tensor")
    cells.write.mode("overwrite").partitionBy("split").parquet(path)
    tables.write_json(os.path.join(a.output_dir, "tensor.json"), about)
    if a.npy:
        for split, n in about["sizes"].items():
            tables.export_npy(spark.read.parquet(path).filter(F.col("split") == split), os.path.join(a.output_dir, f"{split}.npy"), (n, *about["shape"][1:]), ["t_idx", "f_idx", "h_idx"])


def merge(spark: SparkSession, a: argparse.Namespace) -> None:
    """Full outer merge of two CSV tables on shared keys."""
    left, right = (_feed(spark, p).withColumnRenamed(ROW, f"{ROW}_{s}") for p, s in ((a.left, "l"), (a.right, "r")))
    out = pipelines.merge_two(left, right, a.key_columns, a.time_column, [f"{ROW}_l"], [f"{ROW}_r"], a.left_drop_columns, a.right_drop_columns)
    tables.write_csv(out.drop(f"{ROW}_l", f"{ROW}_r"), a.output, missing=a.missing)


def ingest(spark: SparkSession, a: argparse.Namespace) -> None:
    """Bring new feed files into the master tables."""
    for kind, files in feeds.find_files(spark, a.input_dir, a.with_year).items():
        done = feeds.ingest(spark, kind, files, os.path.join(a.output_dir, kind), os.path.join(a.output_dir, f"{kind}.json"), a.with_year)
        print(kind, done.action, len(done.added))


def audit(spark: SparkSession, a: argparse.Namespace) -> None:
    """Completeness of the (zip, time) grid."""
    rows = written(tables.read_csv(spark, a.input).withColumn("time", parse_time("time").cast("timestamp")).select("zip", "time"), "rows")
    missing = written(quality.missing_pairs(rows, "zip", "time"), "missing")
    quality.audit(rows, "zip", "time").show(truncate=False)
    for name, df in (("missing_pairs", missing), ("missing_by_zip", quality.missing_by(missing, "zip", "missing_timestep_count")), ("missing_by_time", quality.missing_by(missing, "missing_time", "missing_zip_count")), ("unexpected_pairs", quality.unexpected_pairs(rows, "zip", "time"))):
        tables.write_csv(df, os.path.join(a.output_dir, name), single_file=name != "missing_pairs")


def tidy(spark: SparkSession, a: argparse.Namespace) -> None:
    """Small CSV jobs: strip offsets, drop named or empty columns, profile missing values."""
    df = tables.read_csv(spark, a.input, a.delimiter, text_only=True)
    if a.strip_time:
        name = by_trimmed_name(df.columns, a.strip_time)
        df = df.withColumn(name, strip_after_seconds(name))
    if a.drop and not (a.strip_time or a.drop_empty or a.profile):
        return tables.remove_fields(spark, a.input, a.output, a.drop, a.delimiter)
    if a.drop:
        df = project.drop_columns(df, a.drop, strict=True)
    if a.drop_empty:
        df = project.drop_empty_columns(df)
    if a.profile:
        stats.null_profile(df, a.profile == "empty").show(1000, False)
    if a.output:
        tables.write_csv(df, a.output)


def coordinates(spark: SparkSession, a: argparse.Namespace) -> None:
    """The first coordinates of every place, as a JSON map."""
    rows = tables.first_coordinates(_feed(spark, a.input), a.key, a.lat, a.lon, [ROW])
    tables.write_json(a.output, {r["zip"]: {"latitude": r["latitude"], "longitude": r["longitude"]} for r in rows.orderBy("zip").toLocalIterator()})


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="vantle", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def command(run, *required: str) -> argparse.ArgumentParser:
        p = sub.add_parser(run.__name__, help=run.__doc__)
        p.set_defaults(run=run)
        for r in required:
            p.add_argument(f"--{r}", required=True)
        return p

    files = ("air-quality", "weather", "tri-facilities", "tri-chemicals", "zip-shapefile", "roads-shapefile", "output-dir")
    for run in (features, batch, tensor):
        p = command(run, *files)
        for n in ("left-drop-columns", "right-drop-columns", "feats-for-past"):
            p.add_argument(f"--{n}", nargs="*", default=[])
        for n, d in (("road-radius-km", 2.0), ("facility-radius-km", 10.0), ("road-wind-blend-100m", 0.0), ("facility-wind-blend-100m", 0.7), ("variance-threshold", None)):
            p.add_argument(f"--{n}", type=float, default=d)
        for n, d in (("road-wind-mode", "10m"), ("facility-wind-mode", "blend")):
            p.add_argument(f"--{n}", choices=["10m", "100m", "blend"], default=d)
        for n in ("direction-columns", "exclude-variance", "exclude-cardinality", "missing"):
            p.add_argument(f"--{n}", default="")
        for n in ("no-auto-detect-direction-columns", "keep-original-direction-columns"):
            p.add_argument(f"--{n}", action="store_true")
        p.add_argument("--num-past-feats", type=int, default=0)
        p.add_argument("--cardinality-threshold", type=int)
        p.add_argument("--amount-fallback", choices=["none", "chemicals"], default="none")
        p.add_argument("--output-mode", choices=["combined", "split"], default="combined")
        p.add_argument("--npy", action="store_true")
        for n, d in (("train-fraction", 0.7), ("val-fraction", 0.2), ("test-fraction", 0.1)):
            p.add_argument(f"--{n}", type=float, default=d)
    p = command(merge, "left", "right", "output")
    p.add_argument("--key-columns", nargs="+", default=["zip", "time"])
    p.add_argument("--time-column", default="time")
    p.add_argument("--missing", default="nan")
    for n in ("left-drop-columns", "right-drop-columns"):
        p.add_argument(f"--{n}", nargs="*", default=[])
    command(ingest, "input-dir", "output-dir").add_argument("--with-year", action="store_true")
    command(audit, "input", "output-dir")
    p = command(tidy, "input")
    p.add_argument("--output")
    p.add_argument("--delimiter", default=",")
    p.add_argument("--strip-time")
    p.add_argument("--drop", nargs="*", default=[])
    p.add_argument("--drop-empty", action="store_true")
    p.add_argument("--profile", choices=["usual", "empty"])
    p = command(coordinates, "input", "output")
    for n, d in (("key", "zip"), ("lat", "latitude"), ("lon", "longitude")):
        p.add_argument(f"--{n}", default=d)
    return top


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(arguments)
    own = spark or local_session(int(os.environ.get("VANTLE_CPUS", "8")))
    a.run(own, a)
    if spark is None:
        drop_written(own)


if __name__ == "__main__":
    main()
