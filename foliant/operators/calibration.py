"""Calibration of confidences by logistic and isotonic regression."""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted(rows: DataFrame, confidence: str, correct: str) -> DataFrame:
    """(c, y, w): equal rows once, with their number; rows with a null don't count."""
    return rows.select(F.col(confidence).cast("double").alias("c"), F.col(correct).cast("double").alias("y")).dropna().groupBy("c", "y").agg(F.count("*").cast("double").alias("w"))


def platt(rows: DataFrame, confidence: str, correct: str) -> tuple[float, float]:
    """(scale, bias) of the logistic fit with a unit penalty on half the squared scale; (0, 0) without rows."""
    points = counted(rows, confidence, correct)
    n = points.agg(F.sum("w")).first()[0]
    if not n:
        return 0.0, 0.0
    points = points.withColumn("x", array_to_vector(F.array("c")))
    fit = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=1 / n, standardization=False, tol=1e-10, maxIter=200).fit(points)
    return float(fit.coefficientMatrix[0, 0]), float(fit.interceptVector[0])


def apply_platt(rows: DataFrame, confidence: str, scale: float, bias: float) -> DataFrame:
    return rows.withColumn("calibrated", 1 / (1 + F.exp(-(F.lit(scale) * F.col(confidence) + bias))))


def isotonic(rows: DataFrame, confidence: str, correct: str) -> DataFrame:
    """(c, calibrated) for each distinct confidence, by the best non-decreasing fit."""
    points = counted(rows, confidence, correct).groupBy("c").agg((F.sum(F.col("y") * F.col("w")) / F.sum("w")).alias("y"), F.sum("w").alias("w"))
    fit = IsotonicRegression(featuresCol="c", labelCol="y", weightCol="w", predictionCol="calibrated").fit(points)
    return fit.transform(points).select("c", "calibrated")


def fit(rows: DataFrame, confidence: str, correct: str, method: str = "temperature") -> dict:
    """Parameters of a method: temperature (grid of foliant.operators.relational), platt (scale, bias) or isotonic (points
    of the best non-decreasing fit, one for each distinct confidence to three places)."""
    from foliant.operators.relational import best_temperature

    if method == "temperature":
        best = best_temperature(rows, confidence, correct).first()
        return {"method": method, "temperature": best.t if best else 1.0}
    if method == "platt":
        scale, bias = platt(rows, confidence, correct)
        return {"method": method, "scale": scale, "bias": bias}
    if method == "isotonic":
        points = isotonic(rows.withColumn(confidence, F.round(confidence, 3)), confidence, correct).orderBy("c").collect()  # 1,001 at most
        return {"method": method, "points": [[r.c, r.calibrated] for r in points]}
    raise ValueError(f"unknown method {method}; temperature, platt or isotonic is needed")


def to_json(parameters: dict) -> str:
    return json.dumps(parameters)


def from_json(text: str) -> dict:
    return json.loads(text)


def apply(parameters: dict, confidence: Column) -> Column:
    """Calibrated confidence by saved parameters; isotonic fits are read off between their points and end with them."""
    eps = 1e-8
    if parameters["method"] == "temperature":
        c = F.greatest(F.lit(eps), F.least(confidence, F.lit(1 - eps)))
        return 1 / (1 + F.exp(-F.ln(c / (1 - c + eps)) / parameters["temperature"]))
    if parameters["method"] == "platt":
        return 1 / (1 + F.exp(-(F.lit(parameters["scale"]) * confidence + parameters["bias"])))
    points = parameters["points"]
    if not points:
        return confidence
    ps = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points))
    low, high = F.element_at(F.filter(ps, lambda p: p["x"] <= confidence), -1), F.filter(ps, lambda p: p["x"] >= confidence)[0]
    between = low["y"] + (high["y"] - low["y"]) * F.coalesce(F.try_divide(confidence - low["x"], high["x"] - low["x"]), F.lit(0.0))
    first, last = points[0], points[-1]
    return F.when(confidence.isNull(), None).when(confidence <= first[0], F.lit(float(first[1]))).when(confidence >= last[0], F.lit(float(last[1]))).otherwise(between)
