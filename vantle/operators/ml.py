"""Principal components with a share of variance kept."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import number


@dataclass(frozen=True)
class Components:
    """Loadings: component -> feature -> coefficient, and each component's share of variance."""

    loadings: dict[str, dict[str, float]]
    shares: list[float]


def principal_components(df: DataFrame, features: Sequence[str], share: float, keep: Sequence[str] = ()) -> tuple[DataFrame, Components]:
    """keep plus PC1 .. PCk of the centred features, as many as ``share`` of the variance needs.

    Missing values count as 0 before centring. Signs are arbitrary.
    """
    if not 0 < share <= 1:
        raise ValueError("share must lie in (0, 1]")
    value = lambda c: F.coalesce(F.nanvl(number(F.col(c).cast("string")), F.lit(0.0)), F.lit(0.0))
    clean = df.select(*keep, *[value(c).alias(f"__{c}") for c in features])
    means = clean.agg(*[F.avg(f"__{c}").alias(c) for c in features]).first()
    centred = clean.withColumns({f"__{c}": F.col(f"__{c}") - F.lit(means[c] or 0.0) for c in features})
    rows = VectorAssembler(inputCols=[f"__{c}" for c in features], outputCol="__v").transform(centred)
    model = PCA(k=len(features), inputCol="__v", outputCol="__pc").fit(rows)
    shares = [float(x) for x in model.explainedVariance]
    k, total = 0, 0.0
    while k < len(shares) and total < share - 1e-12:
        total += shares[k]
        k += 1
    k = max(1, k)
    matrix = model.pc.toArray()
    out = model.transform(rows).withColumn("__pc", vector_to_array("__pc"))
    loadings = {f"PC{i + 1}": {f: float(matrix[j, i]) for j, f in enumerate(features)} for i in range(k)}
    return out.select(*keep, *[F.col("__pc")[i].alias(f"PC{i + 1}") for i in range(k)]), Components(loadings, shares[:k])
