"""The projection calendar: quarter ids, months and column labels."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factorfall.functions.values import as_column
from factorfall.rules import ACTUALS_LABEL, QUARTER_END_MONTHS


def quarter_map(spark: SparkSession, q0: str, n_quarters: int) -> DataFrame:
    """(quarter_id, year, month) for quarter 0 = ``q0`` ('Mar 2025') onwards."""
    return calendar_rows(spark.range(n_quarters).withColumnRenamed("id", "quarter_id"), q0)


def calendar_rows(ids: DataFrame, q0: str) -> DataFrame:
    """Add year and month to quarter ids."""
    start = F.add_months(F.to_date(F.lit(q0), "MMM yyyy"), (F.col("quarter_id") * 3).cast("int"))
    return ids.select(
        F.col("quarter_id").cast("bigint").alias("quarter_id"),
        F.year(start).cast("bigint").alias("year"),
        F.date_format(start, "MMM").alias("month"),
    )


def quarter_labels(q0: str, n_quarters: int) -> dict[int, str]:
    """Column header per quarter id: the actuals bucket, then 'Jun 2025' and so on."""
    first = datetime.strptime(q0, "%b %Y")
    labels = {}
    for q in range(n_quarters):
        months = first.month - 1 + 3 * q
        day = datetime(first.year + months // 12, months % 12 + 1, 1)
        labels[q] = ACTUALS_LABEL if q == 0 else day.strftime("%b %Y")
    return labels


def ordered_quarters(n_quarters: int) -> list[int]:
    """Projected quarters first, the actuals bucket last."""
    return [*range(1, n_quarters), *([0] if n_quarters else [])]


def period_label(q0: str, n_quarters: int, quarter: str | Column = "quarter_id") -> Column:
    """Label of each row's quarter; null outside the calendar."""
    quarter = as_column(quarter)
    day = F.add_months(F.to_date(F.lit(q0), "MMM yyyy"), (quarter * 3).cast("int"))
    return F.when(quarter == 0, F.lit(ACTUALS_LABEL)).when(
        (quarter > 0) & (quarter < n_quarters), F.date_format(day, "MMM yyyy")
    )


def projected_year(c: str | Column) -> Column:
    """Year of a projected quarter such as '3Q25'."""
    return F.concat(F.lit("20"), as_column(c).substr(F.lit(3), F.length(as_column(c)))).try_cast("bigint")


def projected_month(c: str | Column) -> Column:
    """Quarter-end month of a projected quarter such as '3Q25'."""
    digit = F.substring(as_column(c), 1, 1).try_cast("int")
    month = F.when(F.lit(False), F.lit(""))
    for number, label in QUARTER_END_MONTHS.items():
        month = month.when(digit == number, F.lit(label))
    return month
