"""Quality of a 0/1 prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.functions.measures import ratio, rows


def confusion_matrix(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """All four cells, empty ones as 0, from one aggregate."""
    cells = [(real, guess) for real in (0, 1) for guess in (0, 1)]
    counts = scored.agg(
        *[
            F.count(F.when((F.col(label) == real) & (F.col(prediction) == guess), 1)).alias(f"n{real}{guess}")
            for real, guess in cells
        ]
    )
    structs = [
        F.struct(F.lit(real).alias("real"), F.lit(guess).alias("predicho"), F.col(f"n{real}{guess}").alias("n"))
        for real, guess in cells
    ]
    return counts.select(F.inline(F.array(*structs)))


def classification_metrics(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class with accuracy, macro and weighted rows.

    A class that is never predicted (or never occurs) scores 0.
    """
    y, p = F.col(label), F.col(prediction)
    counted = scored.agg(
        rows().alias("n"),
        *[F.count(F.when((y == c) & (p == c), 1)).alias(f"tp{c}") for c in (0, 1)],
        *[F.count(F.when(p == c, 1)).alias(f"pred{c}") for c in (0, 1)],
        *[F.count(F.when(y == c, 1)).alias(f"real{c}") for c in (0, 1)],
    )
    zero = F.lit(0.0)
    for c in (0, 1):
        counted = counted.withColumns(
            {
                f"precision{c}": F.coalesce(ratio(f"tp{c}", f"pred{c}"), zero),
                f"recall{c}": F.coalesce(ratio(f"tp{c}", f"real{c}"), zero),
            }
        ).withColumn(
            f"f{c}",
            F.coalesce(
                F.try_divide(
                    2 * F.col(f"precision{c}") * F.col(f"recall{c}"), F.col(f"precision{c}") + F.col(f"recall{c}")
                ),
                zero,
            ),
        )

    def line(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("clase"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("soporte"),
        )

    def macro(m):
        return (F.col(f"{m}0") + F.col(f"{m}1")) / 2

    def weighted(m):
        return F.coalesce(
            F.try_divide(F.col(f"{m}0") * F.col("real0") + F.col(f"{m}1") * F.col("real1"), F.col("n")), zero
        )

    accuracy = F.coalesce(ratio(F.col("tp0") + F.col("tp1"), "n"), zero)
    n = F.col("n")
    report = [line(str(c), F.col(f"precision{c}"), F.col(f"recall{c}"), F.col(f"f{c}"), F.col(f"real{c}")) for c in (0, 1)]
    report += [
        line("accuracy", accuracy, accuracy, accuracy, n),
        line("macro avg", macro("precision"), macro("recall"), macro("f"), n),
        line("weighted avg", weighted("precision"), weighted("recall"), weighted("f"), n),
    ]
    return counted.select(F.inline(F.array(*report)))
