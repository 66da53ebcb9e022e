"""Report data sets (R1 - R7).  All read aggregated tables with a row per day, month or group."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import measures as m
from tallyhouse.operators import rollups, views
from tallyhouse.operators.snapshots import days_before


def sync_summary(tables: Mapping[str, DataFrame], as_of: str) -> DataFrame:
    """One row per copied table."""
    rows = [
        df.agg(m.count_rows().alias("record_count")).select(
            F.lit(name).alias("table_name"),
            "record_count",
            F.lit("SUCCESS").alias("status"),
            F.lit(as_of).cast("timestamp").alias("processed_date"),
        )
        for name, df in tables.items()
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def kpi_window(kpi: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """R2: the last calendar days up to the date, newest first, gaps in the row filled."""
    recent = kpi.filter(F.col("order_date").between(days_before(as_of, days - 1), as_of))
    filled = {c: F.coalesce(c, F.lit(0).cast(kind)) for c, kind in kpi.dtypes if kind != "string"}
    grade = F.coalesce("performance_grade", F.lit("Unknown"))
    return recent.withColumns({**filled, "performance_grade": grade}).orderBy(F.desc("order_date"))


def segment_report(customers: DataFrame) -> DataFrame:
    """Value segments with the share of active customers."""
    segments = rollups.customer_value_segments(customers)
    return segments.withColumn("active_rate", m.active_rate("active_customers", "customer_count")).orderBy(
        rollups.segment_order()
    )


def status_report(customers: DataFrame) -> DataFrame:
    """Activity states, most customers first."""
    return rollups.customer_status_analysis(customers).orderBy(F.desc("customer_count"), "customer_status")


def growth_report(monthly: DataFrame, months: int = 6) -> DataFrame:
    """The newest months with their growth over the month before.

    A growth of zero stays zero; NULL means there is nothing to compare to.
    """
    trend = views.orders_monthly_trend(monthly)
    return (
        trend.withColumns(
            {
                "orders_growth_rate": m.growth("total_orders", "prev_month_orders"),
                "amount_growth_rate": m.growth("total_amount", "prev_month_amount"),
            }
        )
        .orderBy(F.desc("year_month"))
        .limit(months)
    )


def metrics_report(monthly: DataFrame, months: int = 6) -> DataFrame:
    """Business metrics of the newest months."""
    return views.monthly_business_metrics(monthly).orderBy(F.desc("year_month")).limit(months)


def kpi_context(kpi: DataFrame) -> DataFrame:
    """One row of totals, means and trends over the days given.

    A trend compares the newest with the oldest day; it is ``down`` when they are equal.
    """
    means = {
        "avg_daily_items": "total_items",
        "avg_daily_amount": "total_amount",
        "avg_item_value": "avg_item_value",
        "avg_delivery_rate": "delivery_rate",
        "avg_cancellation_rate": "cancellation_rate",
        "avg_discount_rate": "discount_rate",
        "avg_high_value_rate": "high_value_rate",
    }
    trends = {"items_trend": "total_items", "amount_trend": "total_amount", "delivery_trend": "delivery_rate"}

    def trend(column: str) -> Column:
        up = F.max_by(column, "order_date") > F.min_by(column, "order_date")
        return F.when(up, F.lit("up")).otherwise(F.lit("down"))

    return kpi.agg(
        m.count_rows().alias("day_count"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        F.sum("total_items").alias("total_items"),
        F.sum("total_amount").alias("total_amount"),
        *(F.avg(column).cast("double").alias(name) for name, column in means.items()),
        *(trend(column).alias(name) for name, column in trends.items()),
    )


def grade_distribution(kpi: DataFrame) -> DataFrame:
    """Days per grade."""
    return kpi.groupBy("performance_grade").agg(m.count_rows().alias("day_count"))


def printed(column: str, pattern: str) -> Column:
    """A number as text; halves are rounded to the even digit."""
    return F.call_function("format_number", F.col(column), F.lit(pattern))


def percent_text(column: str) -> Column:
    return F.concat(printed(column, "0.0"), F.lit("%"))


def report_rows(kpi: DataFrame) -> DataFrame:
    """One printed line per day, newest first."""
    rates = ("delivery_rate", "cancellation_rate", "discount_rate", "high_value_rate")
    return kpi.select(
        "order_date",
        F.col("total_items").cast("string").alias("items"),
        F.col("total_amount").cast("string").alias("amount"),
        F.col("avg_item_value").cast("string").alias("item_value"),
        *(percent_text(name).alias(name) for name in rates),
        F.col("performance_grade").alias("grade"),
    ).orderBy(F.desc("order_date"))


def labelled(columns: Mapping[str, Column], between: str) -> Column:
    return F.concat_ws(between, *(F.concat(F.lit(f"{name}: "), text) for name, text in columns.items()))


def basic_report(kpi: DataFrame) -> DataFrame:
    """The statistics as one row of text, for readers without another report.

    ``kpi`` is a window of days (``kpi_window``), so its lines fit into one row.
    """
    plain = ("day_count", "first_date", "last_date", "total_items", "total_amount")
    means = ("avg_daily_items", "avg_daily_amount", "avg_item_value")
    rates = ("avg_delivery_rate", "avg_cancellation_rate", "avg_discount_rate", "avg_high_value_rate")
    trends = ("items_trend", "amount_trend", "delivery_trend")
    facts = {
        **{name: F.col(name).cast("string") for name in plain},
        **{name: printed(name, "0.00") for name in means},
        **{name: percent_text(name) for name in rates},
        **{name: F.col(name) for name in trends},
    }
    overview = kpi_context(kpi).select(labelled(facts, "\n").alias("text")).scalar()
    grade = labelled({"grade": F.col("performance_grade"), "days": F.col("day_count").cast("string")}, ", ")
    by_grade = grade_distribution(kpi).agg(F.array_join(F.array_sort(F.collect_list(grade)), "\n").alias("text"))
    days = report_rows(kpi)
    day = labelled({name: F.col(name) for name in days.columns}, ", ")
    # each line starts with its date
    by_day = days.agg(F.array_join(F.sort_array(F.collect_list(day), asc=False), "\n").alias("text"))
    parts = {"Overview": overview, "Grades": by_grade.scalar(), "Days": by_day.scalar()}
    text = F.concat_ws("\n\n", *(F.concat(F.lit(f"# {title}\n"), body) for title, body in parts.items()))
    return kpi.sparkSession.range(1).select(text.alias("report"))
