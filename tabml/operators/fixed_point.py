"""Is a reported model a fixed point of its own fit?  One distributed pass over the fitted rows tells.

* k-means: assign every row to its nearest reported centre and take the clusters' means.  At a fixed point the means are
  the centres; otherwise the step says how much one more iteration would still gain.
* logistic regression: the gradient of the mean log-loss at the reported coefficients, by sums over the feature vectors as
  they are (sparse ones stay sparse), in standardised features as the fit sees them, and the length of a Newton step with
  the Hessian's diagonal.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _distance(x: Column, center: Sequence[float]) -> Column:
    squares = F.zip_with(x, F.lit([float(c) for c in center]), lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0.0), lambda total, v: total + v)


def kmeans_step(df: DataFrame, features: str, prediction: str, centers: Sequence[Sequence[float]]) -> dict[str, float]:
    """One step from the reported centres.  k rows of moments reach the driver.

    ``off_nearest``: rows whose cluster is not the nearest centre (beyond rounding); ``center_shift``: the largest
    distance of a centre from its rows' mean; ``step_gain``: the share of the cost that moving to the means would gain;
    ``total_ss``: the rows' sum of squares about their mean, from the clusters' moments."""
    x = vector_to_array(F.col(features))
    rows = df.select(features, F.col(prediction).cast("int").alias("_own"), F.array(*[_distance(x, c) for c in centers]).alias("_d"))
    least = F.array_min("_d")
    rows = rows.select(features, least.alias("_least"), (F.array_position("_d", least) - 1).cast("int").alias("_nearest"), F.get("_d", F.col("_own")).alias("_mine"))
    off = F.col("_mine") > F.col("_least") * (1 + 1e-6) + 1e-9
    moments = Summarizer.metrics("mean", "variance").summary(F.col(features))
    got = rows.groupBy("_nearest").agg(F.count(F.lit(1)).alias("n"), F.count_if(off).alias("off"), moments.alias("m")).collect()
    if not got:
        return {"off_nearest": 0, "center_shift": 0.0, "step_gain": 0.0, "total_ss": 0.0}
    n = np.array([r.n for r in got], float)
    means = np.array([r.m["mean"].toArray() for r in got])
    within = sum((r.n - 1) * r.m["variance"].toArray().sum() for r in got)
    moved = ((means - np.array([centers[r["_nearest"]] for r in got], float)) ** 2).sum(1)
    cost = within + (n * moved).sum()
    between = (n[:, None] * (means - np.average(means, axis=0, weights=n)) ** 2).sum()
    return {
        "off_nearest": sum(r.off for r in got),
        "center_shift": float(np.sqrt(moved.max())),
        "step_gain": float((n * moved).sum() / cost) if cost > 0 else 0.0,
        "total_ss": float(f"{within + between:.12g}"),  # sums over clusters round in their own order
    }


def logistic_gradient(scored: DataFrame, features: str, label: str, probability: str, n_classes: int) -> dict[str, float]:
    """Gradient of the mean log-loss at the reported coefficients; one row of sums by class reaches the driver.

    ``gradient``: largest component in standardised features, intercepts included; ``newton_step``: length of the step
    with the diagonal of the Hessian, in units of the loss (its half square is about the loss still to gain)."""
    p, x = vector_to_array(F.col(probability)), F.col(features)
    classes = range(n_classes)
    rows = scored.select(features, F.col(label).cast("int").alias("_y"), p.alias("_p"))
    total = Summarizer.metrics("count", "variance").summary(x).alias("all")
    sums = []
    for k in classes:
        q, y = F.get("_p", F.lit(k)), (F.col("_y") == k).cast("double")
        some = lambda weight: F.greatest(weight, F.lit(1e-300))  # noqa: E731 — a summary of no weight at all is an error
        sums += [
            Summarizer.metrics("sum", "normL2").summary(x, some(q * (1 - q))).alias(f"h{k}"),
            Summarizer.metrics("sum").summary(x, some(q)).alias(f"p{k}"),
            Summarizer.metrics("sum").summary(x, some(y)).alias(f"y{k}"),
            F.sum(q * (1 - q)).alias(f"weight{k}"),
            F.sum(q - y).alias(f"excess{k}"),
        ]
    r = rows.groupBy(F.lit(1).alias("_one")).agg(total, *sums).first()  # grouped: no rows give no summary
    if r is None:
        return {"gradient": 0.0, "newton_step": 0.0}
    n = r["all"]["count"]
    std = np.sqrt(r["all"]["variance"].toArray())
    std[std == 0] = np.inf  # a constant feature is left out by the fit
    worst, step = 0.0, 0.0
    for k in classes:
        slopes = (r[f"p{k}"]["sum"].toArray() - r[f"y{k}"]["sum"].toArray()) / n
        level = r[f"excess{k}"] / n
        worst = max(worst, float(np.abs(slopes / std).max(initial=0.0)), abs(level))
        # the intercept takes up a feature's mean, so curvature is about the weighted mean
        weight = r[f"weight{k}"]
        mean = r[f"h{k}"]["sum"].toArray() / weight if weight else 0.0
        curve = (r[f"h{k}"]["normL2"].toArray() ** 2 - weight * mean**2) / n
        centred = slopes - mean * level
        with np.errstate(divide="ignore", invalid="ignore"):
            step += float(np.where((curve > 1e-12) & np.isfinite(std), centred**2 / curve, 0.0).sum()) + (level**2 * n / weight if weight else 0.0)
    return {"gradient": worst, "newton_step": float(np.sqrt(step))}
