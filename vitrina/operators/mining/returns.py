"""Return risk of products: profile, score, label and Gaussian naive Bayes."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vitrina.functions.measures import clip, ratio, rows, total
from vitrina.functions.rules import right_closed_bins, stable_uniform
from vitrina.operators.audit import union_all
from vitrina.operators.keys import dense_rank_of_values

# Price bands and the terms of the risk score.
PRICE_EDGES = [0, 100_000, 500_000, 2_000_000, 10_000_000]
PRICE_LABELS = ["Bajo", "Medio", "Alto", "Premium"]
BASE_RISK, HIGH_PRICE_RISK, CATEGORY_RISK = 0.05, 0.15, 0.10
HIGH_PRICE = 500_000
RISKY_CATEGORIES = ["Laptops", "Smartphones", "Gaming"]
NOISE, RISK_RANGE = 0.05, (0.01, 0.35)

SMOOTHING = 1e-9


def product_profile(star: DataFrame) -> DataFrame:
    """Units, sales, mean price and returned lines per product."""
    return (
        star.groupBy("id_producto", "nombre_producto", "nombre_categoria")
        .agg(
            F.sum("cantidad").alias("cantidad"),
            total("subtotal").alias("ventas"),
            rows().alias("lineas"),
            F.sum(F.col("devuelto").cast("int")).alias("lineas_devueltas"),
        )
        .withColumn("precio_promedio", ratio("ventas", "cantidad"))
    )


def price_band(
    products: DataFrame, edges: Sequence[float] = PRICE_EDGES, labels: Sequence[str] = PRICE_LABELS
) -> DataFrame:
    return products.withColumn("rango_precio", right_closed_bins("precio_promedio", edges, labels))


def risk_score(
    products: DataFrame,
    high_price: float = HIGH_PRICE,
    categories: Sequence[str] = tuple(RISKY_CATEGORIES),
    noise_seed: int | None = None,
) -> DataFrame:
    """Additive risk, clipped; ``noise_seed`` adds a reproducible uniform noise."""
    score = (
        F.lit(BASE_RISK)
        + (F.col("precio_promedio") > high_price).cast("int") * HIGH_PRICE_RISK
        + F.col("nombre_categoria").isin(*categories).cast("int") * CATEGORY_RISK
    )
    if noise_seed is not None:
        score = score + (stable_uniform("id_producto", noise_seed) * 2 - 1) * NOISE
    return products.withColumn("prob_devolucion", F.round(clip(score, *RISK_RANGE), 6))


def return_label(products: DataFrame, one_in: int = 3) -> DataFrame:
    """1 when more than one of ``one_in`` lines of the product came back (integers only)."""
    return products.withColumn("devuelto", (F.col("lineas_devueltas") * one_in > F.col("lineas")).cast("int"))


def return_rate_by_category(products: DataFrame) -> DataFrame:
    return products.groupBy("nombre_categoria").agg(
        F.bround(F.avg("devuelto") * 100, 1).alias("prob_real_pct"),
        F.round(F.avg("precio_promedio"), 6).alias("precio_promedio"),
    )


def label_encode(df: DataFrame, column: str, name: str) -> DataFrame:
    """Adds the alphabetical code of a label, from 0."""
    return df.join(dense_rank_of_values(df, column, name), column)


@dataclass(frozen=True)
class ClassStats:
    """Fitted class: prior and (mean, variance) per feature."""

    label: int
    prior: float
    moments: tuple[tuple[float, float], ...]

    def log_likelihood(self, features: Sequence[str]) -> Column:
        score = F.lit(math.log(self.prior))
        for feature, (center, variance) in zip(features, self.moments, strict=True):
            distance = F.pow(F.col(feature).cast("double") - center, F.lit(2.0))
            score = score - 0.5 * math.log(2 * math.pi * variance) - distance / (2 * variance)
        return score


def class_moments(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Long form of the model: one row per class and feature.

    The variance is the population variance plus 1e-9 of the largest feature
    variance over all rows, which follows from the moments of the classes, so
    the data is read once.
    """
    per_class = [m for f in features for m in (F.avg(f).alias(f"m_{f}"), F.var_pop(f).alias(f"v_{f}"))]
    # One row per class reaches this window.
    classes = W.partitionBy()
    n = F.sum("n").over(classes)
    model = df.groupBy(F.col(label).alias("clase")).agg(rows().alias("n"), *per_class)
    model = model.withColumns({f"_m_{f}": F.sum(F.col("n") * F.col(f"m_{f}")).over(classes) / n for f in features})
    overall = [
        F.sum(F.col("n") * (F.col(f"v_{f}") + F.pow(F.col(f"m_{f}") - F.col(f"_m_{f}"), F.lit(2.0)))).over(classes) / n
        for f in features
    ]
    by_feature = [
        F.struct(F.lit(f).alias("feature"), F.col(f"m_{f}").alias("media"), (F.col(f"v_{f}") + F.col("_e")).alias("varianza"))
        for f in features
    ]
    return (
        model.withColumn("_e", F.greatest(*overall, F.lit(0.0)) * SMOOTHING)
        .withColumn("prior", ratio("n", n))
        .select("clase", "n", "prior", F.inline(F.array(*by_feature)))
    )


def fit_bayes(df: DataFrame, features: Sequence[str], label: str) -> list[ClassStats]:
    """Model parameters on the driver: one small row per class and feature."""
    fitted = class_moments(df, features, label).collect()
    return [
        ClassStats(
            c,
            next(r.prior for r in fitted if r.clase == c),
            tuple(next((r.media, r.varianza) for r in fitted if r.clase == c and r.feature == f) for f in features),
        )
        for c in sorted({r.clase for r in fitted})
    ]


def predict_bayes(df: DataFrame, model: Sequence[ClassStats], features: Sequence[str]) -> DataFrame:
    """Most likely class (the smaller label on a tie) and its posterior probability."""
    scores = [m.log_likelihood(features) for m in model]
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    choice = F.lit(model[-1].label)
    for m, score in reversed(list(zip(model, scores, strict=True))):
        choice = F.when(score == top, F.lit(m.label)).otherwise(choice)
    weight = sum((F.exp(s - top) for s in scores), F.lit(0.0))
    return df.withColumns({"prediccion": choice, "probabilidad": 1 / weight})


def accuracy(scored: DataFrame, label: str) -> DataFrame:
    return scored.agg(
        rows().alias("n"), F.avg((F.col(label) == F.col("prediccion")).cast("int")).alias("exactitud")
    )


def cross_validate_bayes(df: DataFrame, features: Sequence[str], label: str, fold: str, folds: int) -> DataFrame:
    """Mean accuracy over the folds of column ``fold`` (0 .. folds - 1).

    ``df`` should be stored: it is read once per fold for the fit and once
    to score its rows with the model that has not seen them.
    """
    scored = []
    for left_out in range(folds):
        model = fit_bayes(df.where(F.col(fold) != left_out), features, label)
        test = df.where(F.col(fold) == left_out)
        scored.append(accuracy(predict_bayes(test, model, features), label))
    return union_all(scored).agg(rows().cast("int").alias("folds"), F.avg("exactitud").alias("exactitud_media"))
