"""Measures of a two-class prediction, all from one grouped count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLASS_NAMES = ("Absence", "Presence")  # fixed value


def _cells(pred: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The four counts c00, c01, c10, c11 (actual, predicted), in one row or one for each group."""
    return pred.groupBy(*by).agg(*[
        F.count_if((F.col("label") == a) & (F.col("prediction") == p)).alias(f"c{a}{p}")
        for a in (0, 1) for p in (0, 1)
    ])


def confusion_matrix(pred: DataFrame) -> DataFrame:
    """Count for each pair of actual and predicted class, zeros included."""
    return _cells(pred).select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("label"), F.lit(p).alias("prediction"),
                 F.col(f"c{a}{p}").alias("n"))
        for a in (0, 1) for p in (0, 1)
    ])))


def accuracy(pred: DataFrame) -> DataFrame:
    return pred.agg(
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"))


def _share(part: Column, whole: Column) -> Column:
    """Quotient, 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _measured(cells: DataFrame) -> DataFrame:
    """Add precision, recall, F1 and support of both classes: p0, r0, f0, s0, p1 and so on."""
    for k in (0, 1):
        hit, other = F.col(f"c{k}{k}"), 1 - k
        predicted, actual = hit + F.col(f"c{other}{k}"), hit + F.col(f"c{k}{other}")
        cells = cells.withColumns({
            f"p{k}": _share(hit, predicted), f"r{k}": _share(hit, actual),
            f"f{k}": _share(2 * hit, predicted + actual), f"s{k}": actual,
        })
    return cells


def report_by(pred: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row for each group: rows, accuracy, and the measures of presence."""
    total = F.col("s0") + F.col("s1")
    return _measured(_cells(pred, by)).select(
        *by, total.alias("n_test"), _share(F.col("c00") + F.col("c11"), total).alias("accuracy"),
        F.col("p1").alias("precision"), F.col("r1").alias("recall"), F.col("f1").alias("f1"))


def classification_report(pred: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and both averages."""
    df = _measured(_cells(pred))
    total = F.col("s0") + F.col("s1")

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), precision.alias("precision"),
                        recall.alias("recall"), f1.alias("f1"), support.alias("support"))

    def macro(m: str) -> Column:
        return (F.col(f"{m}0") + F.col(f"{m}1")) / 2

    def weighted(m: str) -> Column:
        return _share(F.col(f"{m}0") * F.col("s0") + F.col(f"{m}1") * F.col("s1"), total)

    none = F.lit(None).cast("double")
    lines = [line(CLASS_NAMES[k], *[F.col(f"{m}{k}") for m in "prfs"]) for k in (0, 1)]
    lines.append(line("accuracy", none, none, _share(F.col("c00") + F.col("c11"), total), total))
    lines.append(line("macro avg", *[macro(m) for m in "prf"], total))
    lines.append(line("weighted avg", *[weighted(m) for m in "prf"], total))
    return df.select(F.inline(F.array(*lines)))
