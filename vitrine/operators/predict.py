"""Predictions table: listings with predicted age, health score and the next demand."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.runlog import STAMP


def health_score(age: Column, predicted: Column) -> Column:
    return F.abs(age - predicted)


def metrics_text(r2: Column, loss: Column) -> Column:
    """'Fleet R2: 0.98 | Demand Loss: 0.0123'; a metric that is absent reads n/a."""
    absent = F.lit("n/a")
    return F.concat(
        F.lit("Fleet R2: "), F.coalesce(F.format_string("%.2f", r2), absent),
        F.lit(" | Demand Loss: "), F.coalesce(F.format_string("%.4f", loss), absent),
    )


def table(
    scored: DataFrame, forecast: DataFrame, metrics: DataFrame, finished: datetime,
    predicted: str = "Aging_Predicted",
) -> DataFrame:
    """`scored` holds Gold and the predicted age. `forecast` and `metrics` are one row each and
    enter as scalar subqueries, so nothing passes through the driver."""
    loss = forecast.select("loss").scalar()
    r2 = metrics.select("r2").scalar()
    # A row of its own, so the text is made once and not for every listing.
    text = scored.sparkSession.range(1).select(F.when(r2.isNotNull() | loss.isNotNull(), metrics_text(r2, loss))).scalar()
    return scored.withColumns({
        "Fleet_Health_Score": health_score(F.col("idade_veiculo"), F.col(predicted)),
        "Predicted_Demand_Next_Period": forecast.select("forecast").scalar(),
        "Prediction_Date": F.lit(finished.strftime(STAMP)),
        "Model_Metrics": text,
    })
