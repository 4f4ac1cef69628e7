"""Weights of the sponsor resolver, fitted on reviewed pairs."""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.durable import kept
from lodestar.operators.running import precision_curve, threshold_for

#: From so many rows of each class on, calibration is isotonic.
ISOTONIC_FROM = 100
#: Steps of a calibration's input, so that its table is bounded.
STEPS = 1000


@dataclass
class Resolver:
    """What the fit gives: the linear model, the thresholds and the rows with their calibrated score."""

    intercept: float
    weights: dict[str, float]
    tau_accept: float
    review_low: float
    method: str
    scored: DataFrame


def logistic(rows: DataFrame, n: int, features: str = "_x", label: str = "_y", weight: str | None = None, penalty: float = 1.0):
    """Logistic regression with half the squared weights (not the intercept) times `penalty` added to the loss."""
    model = LogisticRegression(featuresCol=features, labelCol=label, maxIter=500, tol=1e-9, regParam=penalty / max(n, 1), elasticNetParam=0.0, standardization=False)
    return (model.setWeightCol(weight) if weight else model).fit(rows)


def fit_resolver(rows: DataFrame, features: list[str], label: str, group: str, *, folds: int = 5, precision: float = 0.95) -> Resolver:
    """Fit on rows(features..., label 0 or 1, group); a missing feature is 0, rows without label are left out.

    Rows of a group stay in one fold.  For each fold a model of the other folds is calibrated on it (isotonic from
    100 rows of either class on, else a sigmoid), and a row's score is the mean of these.  Folds whose rows
    or whose others are of one class only don't count; with no fold left, scores are the plain model's.  The
    threshold is the lowest score of the wanted precision, at least one half.
    """
    zero = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features]
    group_of = F.coalesce(F.col(group).cast("string"), F.lit(""))
    known = rows.where(F.col(label).isNotNull())
    k = min(folds, max(2, known.select(group_of.alias("g")).distinct().limit(folds).count()))
    base = known.select(*(c for c in rows.columns if c not in features), *zero, F.col(label).cast("double").alias("_y"), F.pmod(F.xxhash64(group_of), F.lit(k)).cast("int").alias("_fold"))
    # every fit reads the rows many times over, so all cores are to have some, however few files they come from
    data = kept(VectorAssembler(inputCols=features, outputCol="_x").transform(base).repartition(4 * rows.sparkSession.sparkContext.defaultParallelism))
    sizes = {r["_fold"]: (r["n"], int(r["p"])) for r in data.groupBy("_fold").agg(F.count("*").alias("n"), F.sum("_y").alias("p")).collect()}
    n, pos = sum(a for a, _ in sizes.values()), sum(p for _, p in sizes.values())
    if not 0 < pos < n:
        raise ValueError("a fit needs rows of both classes")
    whole = logistic(data, n)
    method = "isotonic" if min(pos, n - pos) >= ISOTONIC_FROM else "sigmoid"
    scores = []
    for f in range(k):
        size, hits = sizes.get(f, (0, 0))
        if 0 < hits < size and 0 < pos - hits < n - size:
            model = logistic(data.where(F.col("_fold") != f), n - size)
            margin = _margin(model)
            held = data.where(F.col("_fold") == f).select(_step(margin).alias("m"), "_y").groupBy("m").agg(F.count("*").alias("n"), F.sum("_y").alias("p"))
            curve = _isotonic(held) if method == "isotonic" else _sigmoid(held, size, hits)
            scores.append(curve(_step(margin)))
    score = sum(scores[1:], scores[0]) / len(scores) if scores else 1 / (1 + F.exp(-_margin(whole)))
    scored = data.withColumn("score", score).drop("_x", "_y", "_fold")
    tau = threshold_for(precision_curve(scored, F.col("score"), F.col(label) == 1), precision).first()[0]
    return Resolver(float(whole.intercept), dict(zip(features, map(float, whole.coefficients), strict=True)), tau, max(0.6, tau - 0.2), method, scored)


def _margin(model) -> Column:
    """Probability by the model, as an expression."""
    x = vector_to_array(F.col("_x"))
    z = sum((x[i] * float(w) for i, w in enumerate(model.coefficients)), F.lit(float(model.intercept)))
    return z


def _step(margin: Column) -> Column:
    """The margin's probability in steps, so at most STEPS + 1 different inputs are calibrated."""
    return F.round(STEPS / (1 + F.exp(-margin))) / STEPS


def _isotonic(held: DataFrame):
    """A rising step curve, linear between its points; fitted on at most STEPS + 1 weighted means."""
    points = VectorAssembler(inputCols=["m"], outputCol="v").transform(held.withColumn("y", F.col("p") / F.col("n")).withColumn("n", F.col("n").cast("double")))
    model = IsotonicRegression(featuresCol="v", labelCol="y", weightCol="n").fit(points)
    xs, ys = model.boundaries.toArray().tolist(), model.predictions.toArray().tolist()

    def at(m: float) -> float:
        if m <= xs[0]:
            return ys[0]
        if m > xs[-1]:
            return ys[-1]
        k = bisect_left(xs, m)
        return ys[k - 1] + (ys[k] - ys[k - 1]) * (m - xs[k - 1]) / (xs[k] - xs[k - 1])

    table = [at(k / STEPS) for k in range(STEPS + 1)]

    def curve(m: Column) -> Column:
        """m is a whole number of steps, so its value is looked up by place; no row goes through the points."""
        return F.when(F.isnan(m), F.lit(ys[-1])).otherwise(F.get(F.array(*map(F.lit, table)), F.round(m * STEPS).cast("int")))

    return curve


def _sigmoid(held: DataFrame, size: int, hits: int):
    """A sigmoid over the margin, towards targets that are pulled a little off 0 and 1."""
    high, low = (hits + 1) / (hits + 2), 1 / (size - hits + 2)
    logit = F.log(F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("m"))) / (1 - F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), F.col("m")))))
    good = F.col("p") * high + (F.col("n") - F.col("p")) * low
    rows = held.select(logit.alias("z"), F.explode(F.array(F.struct(F.lit(1.0).alias("y"), good.alias("w")), F.struct(F.lit(0.0).alias("y"), (F.col("n") - good).alias("w")))).alias("t")).select("z", "t.*")
    model = logistic(VectorAssembler(inputCols=["z"], outputCol="_x").transform(rows), 1, label="y", weight="w", penalty=0.0)
    a, b = float(model.coefficients[0]), float(model.intercept)
    limit = 1 - 1e-6

    def curve(m: Column) -> Column:
        p = F.greatest(F.lit(1e-6), F.least(F.lit(limit), m))
        return 1 / (1 + F.exp(-(F.lit(a) * F.log(p / (1 - p)) + F.lit(b))))

    return curve
