"""Column statistics in one aggregation, and pruning of columns by them.

Column pruning depends on the data, so it runs an action: one aggregate row.
Many exact distinct counts at once would multiply rows in the shuffle, so they run
in groups of columns; ``approximate`` uses sketches instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.features import scaled
from ..functions.normalize import number
from ..session import written

#: exact distinct counts per aggregation
DISTINCT_GROUP = 8
#: Texts that count as missing in a table read with the usual defaults.
NULL_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


@dataclass(frozen=True)
class Pruned:
    """What a pruning step decided."""

    kept: list[str]
    removed: list[str]
    values: dict[str, float | None] = field(default_factory=dict)


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> dict[str, int]:
    """Distinct texts per column after trimming; NULL, empty and ``nan`` are one value."""
    out: dict[str, int] = {}
    count = F.approx_count_distinct if approximate else F.count_distinct
    step = len(columns) or 1 if approximate else DISTINCT_GROUP
    for i in range(0, len(columns), step):
        part = columns[i : i + step]
        text = lambda c: F.coalesce(F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")), F.lit("nan"))
        lowered = lambda c: F.when(F.lower(text(c)) == "nan", F.lit("nan")).otherwise(text(c))
        row = df.agg(*[count(lowered(c)).alias(c) for c in part]).first()
        out |= {c: int(row[c]) for c in part}
    return out


def prune_low_cardinality(df: DataFrame, threshold: int, exclude: Iterable[str] = (), approximate: bool = False) -> tuple[DataFrame, Pruned]:
    """Without columns of fewer than ``threshold`` distinct values; excluded columns stay."""
    held = set(exclude)
    counts = distinct_counts(df, df.columns, approximate)
    removed = [c for c in df.columns if c not in held and counts[c] < threshold]
    kept = [c for c in df.columns if c not in removed]
    return df.select(*kept), Pruned(kept, removed, dict(counts))


def _value(c: str, nan_policy: str) -> Column:
    v = number(F.col(f"`{c}`").cast("string"))
    return F.nanvl(v, F.lit(None).cast("double")) if nan_policy == "skip" else v


def normalized_variance(c: str, nan_policy: str = "skip") -> Column:
    """Aggregate: population variance over squared range, 0 without range, never below 0.

    nan_policy ``propagate`` lets one NaN make the result NaN; ``skip`` leaves NaN out.
    """
    v = _value(c, nan_policy)
    span = F.max(v) - F.min(v)
    # without a value the span is NULL and so is the result: greatest() alone would give 0
    return F.when(span <= 0, F.lit(0.0)).when(span.isNotNull(), F.greatest(F.var_pop(v) / (span * span), F.lit(0.0)))


def population_variance(c: str) -> Column:
    """Aggregate: population variance, NaN left out."""
    return F.var_pop(_value(c, "skip"))


def variances(df: DataFrame, columns: Sequence[str], normalized: bool = True, nan_policy: str = "skip") -> dict[str, float | None]:
    """Statistic per column, None where it has no number; all in one pass."""
    if not columns:
        return {}
    stat = (lambda c: normalized_variance(c, nan_policy)) if normalized else population_variance
    row = df.agg(*[stat(c).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns}


def prune_low_variance(df: DataFrame, threshold: float, columns: Sequence[str], exclude: Iterable[str] = (), normalized: bool = True, nan_policy: str = "skip") -> tuple[DataFrame, Pruned]:
    """Without columns whose statistic is below ``threshold``; a missing or NaN statistic keeps its column."""
    held = set(exclude)
    values = variances(df, [c for c in columns if c not in held], normalized, nan_policy)
    removed = [c for c, v in values.items() if v is not None and v < threshold]
    kept = [c for c in df.columns if c not in removed]
    return df.select(*kept), Pruned(kept, removed, values)


def ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``min_<c>`` and ``max_<c>`` of each column, NaN left out."""
    return df.agg(*[f(_value(c, "skip")).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def min_max_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns scaled to [0, 1]; one without range becomes 0 in every row."""
    if not columns:
        return df
    row = ranges(df, columns).first()
    lit = lambda v: F.lit(v).cast("double")
    return df.withColumns({c: scaled(number(F.col(c).cast("string")), lit(row[f"min_{c}"]), lit(row[f"max_{c}"])) for c in columns})


def null_profile(df: DataFrame, empty_only: bool = False) -> DataFrame:
    """(column, nulls) per column: missing by the usual reading, or literally empty texts only."""
    if empty_only:
        hit = lambda c: F.col(f"`{c}`").isNull() | (F.col(f"`{c}`").cast("string") == "")
    else:
        hit = lambda c: F.col(f"`{c}`").isNull() | F.col(f"`{c}`").cast("string").isin(*NULL_TEXTS)
    row = df.agg(*[F.coalesce(F.sum(hit(c).cast("long")), F.lit(0)).alias(c) for c in df.columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nulls")) for c in df.columns])).alias("p")
    return row.select(pairs).select("p.column", "p.nulls")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row a key, the first by ``order``: an aggregation, so a hot key is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*order)).alias("f")
    return df.groupBy(*keys).agg(first).select(*[F.col(c) if c in keys else F.col(f"f.{c}").alias(c) for c in df.columns])


def exact_quantile(df: DataFrame, column: str, share: float) -> float | None:
    """The quantile by linear interpolation between neighbours, NULL and NaN left out; None without a value.

    Values are counted first, so a frequent one costs a row a task; the distinct ones are
    range-partitioned and stored. Row counts a partition tell which one or two hold the
    wanted ranks, and only these are numbered.
    """
    value = F.col(column).cast("double")
    counts = df.select(value.alias("v")).filter("v is not null and not isnan(v)").groupBy("v").agg(F.count("*").alias("n"))
    stored = written(counts.repartitionByRange("v").sortWithinPartitions("v").withColumn("p", F.spark_partition_id()), "counts")
    parts = sorted(tuple(r) for r in stored.groupBy("p").agg(F.sum("n")).collect())
    total = sum(n for _, n in parts)
    if not total:
        return None
    rank = share * (total - 1)
    wanted = sorted({int(rank), min(int(rank) + 1, total - 1)})
    found, before = [], 0
    for p, n in parts:
        here = [w for w in wanted if before <= w < before + n]
        if here:
            upto = F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)) + F.lit(before)
            rows = stored.filter(F.col("p") == p).select("v", "n", upto.alias("upto"))
            got = rows.agg(*[F.max(F.when((F.col("upto") > w) & (F.col("upto") - F.col("n") <= w), F.col("v"))) for w in here]).first()
            found += list(got)
        before += n
    return found[0] + (found[-1] - found[0]) * (rank - int(rank))


def scale_of(pairs: DataFrame, amount: str = "amount", count: str = "chemical_count") -> DataFrame:
    """One row: the 0.95 quantile of amounts over the pairs, at least 1 if it isn't positive, and the largest count, at least 1.

    ``pairs`` is read twice, so it should be a stored table.
    """
    high, most = pairs.agg(F.max(F.nanvl(F.col(amount).cast("double"), F.lit(None).cast("double"))), F.max(count)).first()
    q = exact_quantile(pairs, amount, 0.95)
    scale = q if q is not None and q > 0 else max(high or 1.0, 1.0)
    return pairs.sparkSession.range(1).select(F.lit(float(scale)).alias("amount_scale"), F.lit(float(max(most or 1, 1))).alias("count_scale"))


def modal_step(df: DataFrame, time: str) -> DataFrame:
    """(step_s): the most frequent difference in seconds of neighbouring distinct times; the least among ties.

    Distinct times are few (a regular grid), so the ordered window over them is small.
    """
    times = df.select(F.col(time).alias("t")).filter("t is not null").distinct()
    seconds = lambda c: F.expr(f"unix_timestamp({c})")
    steps = times.select((seconds("t") - F.lag(seconds("t")).over(Window.orderBy("t"))).alias("step"))
    return steps.filter("step is not null").agg(F.mode("step", True).alias("step_s"))
