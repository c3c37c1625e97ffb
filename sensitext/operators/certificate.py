"""How far a fitted teacher is from the optimum of its problem."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from sensitext.operators.train import Detector, weighted

# The place of the intercept among the features, which start at 0.
INTERCEPT = -1


def optimality(detector: Detector, train: DataFrame) -> DataFrame:
    """The optimality conditions of each weight: ``feature, weight, slope, excess, n_rows``.

    The teacher minimises the weighted mean of the log loss, plus ``l1`` times the sum of absolute
    weights and ``l2 / 2`` times that of their squares; the intercept is free. At the minimum the
    loss has the slope ``-(l1 * sign(weight) + l2 * weight)`` at a weight that is not zero, at
    most ``l1`` in size at one that is, and none at the intercept. ``excess`` is what is missing,
    zero at the optimum. ``train`` are the rows of the fit, with ``label`` and what the
    detector encodes. ``n_rows`` counts the rows that hold the feature.

    One pass over the rows, which sums slopes by feature before anything moves; results
    have a row per feature, at most as many as the detector hashes into.
    """
    fitted = detector.model.stages[-1]
    share = fitted.getElasticNetParam()
    l1, l2 = (fitted.getRegParam() * part for part in (share, 1 - share))
    rows = detector.encode(train).select("input_ids", F.col("label").alias("labels"))
    rows = weighted(rows) if fitted.isSet("weightCol") else rows.withColumn("_weight", F.lit(1.0))
    sparse = F.unwrap_udt("features")
    held = F.transform(
        F.arrays_zip(sparse["indices"].alias("at"), sparse["values"].alias("x")),
        lambda cell: F.struct(cell["at"].alias("at"), cell["x"].alias("x")),
    )
    free = F.array(F.struct(F.lit(INTERCEPT).alias("at"), F.lit(1.0).alias("x")))
    residual = F.col("_weight") * (vector_to_array("probability")[1] - F.col("labels"))
    slopes = (
        detector.model.transform(rows)
        .select(residual.alias("r"), "_weight", F.explode(F.concat(free, held)).alias("cell"))
        .groupBy(F.col("cell.at").alias("feature"))
        .agg(
            F.sum(F.col("r") * F.col("cell.x")).alias("sum"),
            F.sum("_weight").alias("total"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )
    used = [(int(i), float(w)) for i, w in enumerate(fitted.coefficients.toArray()) if w]
    weights = train.sparkSession.createDataFrame(
        [(INTERCEPT, float(fitted.intercept)), *used], "feature int, weight double"
    )
    # Every row holds the intercept, so its total is that of the table.
    all_rows = F.max(F.when(F.col("feature") == INTERCEPT, F.col("total"))).over(Window.partitionBy())
    known = slopes.join(weights, "feature", "full").select(
        "feature",
        F.coalesce("weight", F.lit(0.0)).alias("weight"),
        (F.coalesce("sum", F.lit(0.0)) / all_rows).alias("slope"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )
    weight, slope = F.col("weight"), F.col("slope")
    excess = (
        F.when(F.col("feature") == INTERCEPT, F.abs(slope))
        .when(weight != 0, F.abs(slope + l2 * weight + l1 * F.signum(weight)))
        .otherwise(F.greatest(F.abs(slope) - l1, F.lit(0.0)))
    )
    return known.select("feature", "weight", "slope", excess.alias("excess"), "n_rows")


def certificate(detector: Detector, train: DataFrame, tolerance: float = 0.3) -> DataFrame:
    """Whether all conditions hold, per kind of weight: ``kind, n_rows, worst, holds``.

    Kinds are the intercept, weights in use and weights at zero. ``worst`` is the largest
    excess as a share of the L1 penalty and may be at most ``tolerance``; ``n_rows`` is the
    largest number of rows that one feature of the kind is met in.
    """
    fitted = detector.model.stages[-1]
    l1 = fitted.getRegParam() * fitted.getElasticNetParam()
    if not l1:
        raise ValueError("the tolerance is a share of the L1 penalty, which is zero")
    kind = (
        F.when(F.col("feature") == INTERCEPT, "intercept")
        .when(F.col("weight") != 0, "used")
        .otherwise("zero")
    )
    worst = F.max("excess") / F.lit(l1)
    return (
        optimality(detector, train)
        .groupBy(kind.alias("kind"))
        .agg(
            F.max("n_rows").alias("n_rows"),
            worst.alias("worst"),
            (worst <= tolerance).alias("holds"),
        )
    )
