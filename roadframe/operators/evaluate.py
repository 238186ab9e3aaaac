"""Model metrics as frames ``(metric, value)``, each set computed in one
aggregation pass over the predictions (partial aggregation per task, so
the shuffle is one row per task)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadframe.functions.columns import c


def _as_rows(df: DataFrame, names: list[str], digits: int | None) -> DataFrame:
    rows = df.unpivot([], names, "metric", "value")
    if digits is not None:
        rows = rows.withColumn("value", F.round("value", digits))
    return rows.select("metric", F.col("value").cast("double").alias("value"))


def classification_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                           digits: int | None = None) -> DataFrame:
    """``accuracy``: share of rows whose prediction equals the label, over
    the rows that have both."""
    hit = (c(label) == c(prediction)).cast("double")  # numeric indices or text labels
    agg = pred.agg(F.avg(hit).alias("accuracy"))
    return _as_rows(agg, ["accuracy"], digits)


def _regression_aggs(label: Column, prediction: Column) -> list[Column]:
    y = label.cast("double")
    err = y - prediction.cast("double")
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(err * err).alias("sse"),
        F.var_pop(y).alias("var_y"),
    ]


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction",
                       digits: int | None = None) -> DataFrame:
    """``rmse`` = sqrt(mean squared error) and ``r2`` = 1 - SSE / total sum
    of squares (population variance times n), both from one pass over the
    rows that have a label and a prediction. Never divides by zero (empty
    input, constant label)."""
    complete = pred.where(c(label).isNotNull() & c(prediction).isNotNull())
    agg = complete.agg(*_regression_aggs(c(label), c(prediction)))
    total = F.col("var_y") * F.col("n")
    # a constant label has no variance: r2 is NaN for a perfect fit, -inf otherwise
    # (as in Spark's RegressionEvaluator); no rows gives null metrics
    r2 = (F.when(total > 0, F.lit(1.0) - F.col("sse") / total)
          .when(F.col("sse") == 0, F.lit(float("nan")))
          .when(F.col("n") > 0, F.lit(float("-inf"))))
    agg = agg.select(
        F.sqrt(F.try_divide(F.col("sse"), F.col("n"))).alias("rmse"),
        r2.alias("r2"),
    )
    return _as_rows(agg, ["rmse", "r2"], digits)
