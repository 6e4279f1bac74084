"""Model evaluation from counts: one shuffle of (label, prediction) pairs already combined map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import value_of

# Fixed value: from this r2 on a fit counts as perfect and has no explained variance.
PERFECT_R2 = 0.999


def pair_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(label, prediction, n)``."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def class_counts(pairs: DataFrame) -> DataFrame:
    """``(label, support, predicted, hits)`` for every label that occurs on either side."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("label").alias("label"), F.col("n").alias("s"), F.lit(0).cast("bigint").alias("p"), hit.alias("h")),
                F.struct(F.col("prediction").alias("label"), F.lit(0).cast("bigint").alias("s"), F.col("n").alias("p"), F.lit(0).cast("bigint").alias("h")),
            )
        )
    )
    return sides.groupBy("label").agg(
        F.sum("s").alias("support"), F.sum("p").alias("predicted"), F.sum("h").alias("hits")
    )


def class_scores(pairs: DataFrame) -> DataFrame:
    """``(label, precision, recall, f1, support, hits)``; a division by zero gives 0."""
    scored = class_counts(pairs).withColumns(
        {
            "precision": _ratio(F.col("hits"), F.col("predicted")),
            "recall": _ratio(F.col("hits"), F.col("support")),
        }
    )
    both = F.col("precision") + F.col("recall")
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), both)
    return scored.select("label", "precision", "recall", f1.alias("f1"), "support", "hits")


def _weighted(score: str) -> Column:
    return F.try_divide(F.sum(F.col(score) * F.col("support")), F.sum("support"))


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row ``(accuracy, precision, recall, f1)``, the last three weighted by support."""
    scores = class_scores(pair_counts(df, label, prediction))
    return scores.agg(
        F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        _weighted("precision").alias("precision"),
        _weighted("recall").alias("recall"),
        _weighted("f1").alias("f1"),
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(label, precision, recall, f1, support)`` per class plus accuracy, macro and weighted averages."""
    scores = class_scores(pair_counts(df, label, prediction))
    names = ["precision", "recall", "f1"]
    rolled = scores.rollup("label").agg(
        F.grouping("label").alias("is_total"),
        *[F.avg(c).alias(f"macro_{c}") for c in names],
        *[_weighted(c).alias(f"weighted_{c}") for c in names],
        F.sum("hits").alias("hits"),
        F.sum("support").alias("support"),
    )

    def row(title: Column, values: list[Column]) -> Column:
        return F.struct(
            title.cast("string").alias("label"),
            *[v.cast("double").alias(n) for n, v in zip(names, values)],
            F.col("support").alias("support"),
        )

    accuracy = F.try_divide("hits", "support")
    macro = [F.col(f"macro_{c}") for c in names]
    weighted = [F.col(f"weighted_{c}") for c in names]
    totals = F.array(
        row(F.lit("accuracy"), [accuracy] * 3),
        row(F.lit("macro avg"), macro),
        row(F.lit("weighted avg"), weighted),
    )
    return rolled.select(F.inline(F.when(F.col("is_total") == 1, totals).otherwise(F.array(row(F.col("label"), macro)))))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row ``(mae, mse, rmse, r2, explained_variance)``, one pass."""
    y, p = value_of(df, label).cast("double"), value_of(df, prediction).cast("double")
    both = df.select(y.alias("y"), p.alias("p")).dropna()
    error = F.col("y") - F.col("p")
    sums = both.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop("y").alias("var_y"),
        F.var_pop("p").alias("var_p"),
    )
    r2 = F.when(F.col("var_y") > 0, 1 - F.col("mse") / F.col("var_y")).otherwise(
        F.when(F.col("mse") == 0, 1.0).otherwise(0.0)
    )
    return sums.select(
        "mae",
        "mse",
        F.sqrt("mse").alias("rmse"),
        r2.alias("r2"),
        F.when((r2 < PERFECT_R2) & (F.col("var_y") > 0), F.col("var_p") / F.col("var_y")).alias("explained_variance"),
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: list | None = None) -> DataFrame:
    """One row per true label, one count column per predicted class, missing pairs 0.

    Without ``classes`` the predicted classes are looked up first.
    """
    pairs = pair_counts(df, label, prediction)
    pivoted = pairs.groupBy("label").pivot("prediction", classes).agg(F.sum("n"))
    return pivoted.fillna(0)

