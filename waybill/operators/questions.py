"""Business questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.measures import Measure
from waybill.functions.names import detect_pickup_col
from waybill.operators.dimensions import StarDimensions
from waybill.operators.marts import HOUR_AND_PERIOD, MONTH, star_groups


def monthly_average(revenue_monthly: DataFrame, service_type: str = "yellow") -> DataFrame:
    """Per month: trips, average per trip and total received."""
    return (
        revenue_monthly.filter(F.col("service_type") == service_type)
        .select(
            "year",
            "month",
            "trips",
            F.round("avg_total_amount", 2).alias("avg_total_amount_por_corrida"),
            F.round("sum_total_amount", 2).alias("total_recebido_no_mes"),
        )
        .orderBy("year", "month")
    )


def average_of_months(
    revenue_monthly: DataFrame, service_type: str = "yellow"
) -> DataFrame:
    """Average of the monthly totals, and the unweighted average of the monthly averages."""
    received = Measure("sum_total_amount")
    per_trip = Measure("avg_total_amount")
    return revenue_monthly.filter(F.col("service_type") == service_type).selectExpr(
        f"ROUND({received.average_in_one()}, 2) AS media_total_recebido_por_mes",
        f"ROUND({per_trip.average_in_one()}, 2) AS media_total_amount_por_corrida",
    )


def passengers_by_hour(fact: DataFrame, dims: StarDimensions, month: int = 5) -> DataFrame:
    """Passengers per hour of the day in one calendar month, weighted by trip. Types that
    report no passengers are ignored by the average and by its count."""
    passengers = Measure("passenger_count", average="average", whole=True)
    groups, _, merge = star_groups(fact, dims, (MONTH, HOUR_AND_PERIOD), (passengers,))
    by_hour = groups.filter(f"month = {month}").groupBy("hour", "period_of_day").agg(*merge)
    return (
        by_hour.selectExpr("*", *passengers.finished())
        .selectExpr(
            "hour",
            "period_of_day",
            "ROUND(average, 3) AS avg_passenger_count",
            f"{passengers.count_name} AS trips_com_passageiros",
        )
        .orderBy("hour")
    )


def silver_monthly(silver: DataFrame) -> DataFrame:
    """Straight from a silver table: trips, average and total per month."""
    amount = Measure("total_amount")
    return (
        silver.groupBy(F.col("pickup_year").alias("ano"), F.col("pickup_month").alias("mes"))
        .agg(
            F.expr("count(1) AS qt_corridas"),
            F.expr(f"ROUND({amount.average_in_one()}, 2) AS media_total_amount"),
            F.expr(f"ROUND({amount.total_in_one()}, 2) AS soma_total_amount"),
        )
        .orderBy("ano", "mes")
    )


def silver_overall(silver: DataFrame) -> DataFrame:
    average = Measure("total_amount").average_in_one()
    return silver.selectExpr(f"ROUND({average}, 2) AS media_total_amount_periodo")


def silver_by_hour(silver: DataFrame, month: int = 5) -> DataFrame:
    """Passengers per hour of the day in one month, from a silver table. The month filter is
    on the partition column."""
    passengers = Measure("passenger_count")
    hour = F.hour(detect_pickup_col(silver.columns)).alias("hora_do_dia")
    return (
        silver.filter(F.col("pickup_month") == month)
        .groupBy(hour)
        .agg(
            F.expr("count(1) AS qt_corridas"),
            F.expr(f"ROUND({passengers.average_in_one()}, 2) AS media_passageiros"),
        )
        .orderBy("hora_do_dia")
    )
