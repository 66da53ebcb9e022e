"""Checks and reports on small hand-made frames."""

from datetime import date, datetime

from pyspark.sql import functions as F

from tallyhouse.operators import quality, reports, rollups, summaries


def test_check_counts_every_rule_in_one_job(spark):
    rows = spark.createDataFrame(
        [(1, "ab", date(2020, 1, 1), date(2020, 1, 2)), (None, "", date(2020, 1, 3), date(2020, 1, 2)), (-5, None, None, None)],
        "n int, s string, a date, b date",
    )
    rules = [
        quality.not_null("n", 0.5),
        quality.in_range("n", 0, 10),
        quality.one_of("s", ["ab"]),
        quality.length_between("s", 1, 5),
        quality.not_before("b", "a"),
        quality.at_most_days("b", "a", 0),
    ]
    got = [(r["rule"], r["failures"], r["total"], r["passed"]) for r in quality.check(rows, rules).collect()]
    assert got == [
        ("not_null", 1, 3, True),
        ("in_range", 1, 3, False),
        ("one_of", 1, 3, False),
        ("length", 1, 3, False),
        ("not_before", 1, 3, False),
        ("at_most_days", 1, 3, False),
    ]
    empty = quality.check(rows.limit(0), rules).collect()
    assert all(r["passed"] and r["ratio"] == 0 for r in empty)


def test_validation_limits(spark):
    rows = spark.range(10).select(
        F.when(F.col("id") < 1, "Poor").otherwise("Good").alias("DataQualityLevel"),
        F.when(F.col("id") < 3, True).when(F.col("id") < 6, False).alias("IsDelayed"),
    )
    got = {r["check"]: (r["value"], r["passed"]) for r in quality.validate_orders(rows).collect()}
    assert got == {"poor_quality_ratio": (0.1, True), "delayed_ratio": (0.3, False)}
    got = {r["check"]: r["passed"] for r in quality.validate_orderdetails(rows, rows.limit(9)).collect()}
    assert got == {"record_count_difference": False, "poor_quality_ratio": True}
    assert all(r["passed"] for r in quality.validate_orders(rows.limit(0)).collect())


def test_duplicates_and_freshness(spark):
    rows = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    found = quality.duplicates(rows, "a", "b").first()
    assert (found["failures"], found["total"], found["passed"]) == (2, 5, False)
    assert quality.duplicates(rows.limit(0), "a").first()["passed"]
    times = spark.createDataFrame([(datetime(2020, 1, 1, 1),)], "ts timestamp")
    assert quality.freshness(times, "ts", "2020-01-02 01:30:00").first()["passed"]
    late = quality.freshness(times, "ts", "2020-01-02 02:00:00").first()
    assert (late["age_hours"], late["passed"]) == (25, False)
    assert not quality.freshness(times.limit(0), "ts", "2020-01-02").first()["passed"]
    shares = {r["column"]: r["passed"] for r in quality.null_shares(rows, 0.4).collect()}
    assert shares == {"a": True, "b": True}
    least = {r["table_name"]: r["passed"] for r in quality.minimum_rows({"x": rows, "y": rows.limit(0)}).collect()}
    assert least == {"x": True, "y": False}


def months(spark, *rows):
    text = "year_month string, total_orders bigint, total_amount decimal(28,2)"
    frame = spark.createDataFrame([(m, n, None) for m, n in rows], text)
    rest = ("avg_order_value", "vip_ratio", "large_order_ratio", "completion_rate")
    return frame.withColumn("total_amount", F.col("total_orders").cast("decimal(28,2)")).withColumns(
        {c: F.lit(0.0) for c in rest}
    )


def test_growth_of_zero_is_zero(spark):
    rows = reports.growth_report(months(spark, ("2020-01", 4), ("2020-02", 4), ("2020-03", 3), ("2020-04", 0), ("2020-05", 2)))
    got = [(r["year_month"], None if r["orders_growth_rate"] is None else float(r["orders_growth_rate"])) for r in rows.collect()]
    assert got == [("2020-05", None), ("2020-04", -100.0), ("2020-03", -25.0), ("2020-02", 0.0), ("2020-01", None)]


def kpi(spark, *days):
    text = "order_date string, total_items bigint, rate double, performance_grade string"
    frame = spark.createDataFrame([(d, n, r, "Poor") for d, n, r in days], text)
    rates = ("delivery_rate", "cancellation_rate", "discount_rate", "high_value_rate")
    money = F.col("total_items").cast("decimal(28,2)")
    return frame.withColumns(
        {"total_amount": money, "avg_item_value": money.cast("decimal(18,2)"), **{c: F.col("rate") for c in rates}}
    ).drop("rate")


def test_kpi_context_trends(spark):
    facts = reports.kpi_context(kpi(spark, ("2020-01-01", 5, 50.0), ("2020-01-02", 9, 50.0), ("2020-01-03", 6, 20.0))).first()
    assert (facts["items_trend"], facts["delivery_trend"], facts["day_count"]) == ("up", "down", 3)
    same = reports.kpi_context(kpi(spark, ("2020-01-01", 5, 50.0), ("2020-01-02", 5, 50.0))).first()
    assert same["items_trend"] == "down"  # equal counts as down


def test_report_text(spark):
    text = reports.basic_report(kpi(spark, ("2020-01-01", 5, 6.25), ("2020-01-02", 9, 6.35))).first()["report"]
    lines = text.split("\n")
    assert "day_count: 2" in lines and "grade: Poor, days: 2" in lines
    days = [line for line in lines if line.startswith("order_date")]
    assert days[0].startswith("order_date: 2020-01-02") and "delivery_rate: 6.2%" in days[1]


def test_kpi_window_fills_gaps(spark):
    frame = kpi(spark, ("2020-01-01", 5, 1.0), ("2020-01-02", None, None), ("2020-01-08", 1, 1.0))
    got = [(r["order_date"], r["total_items"], r["delivery_rate"]) for r in reports.kpi_window(frame, "2020-01-08").collect()]
    assert got == [("2020-01-08", 1, 1.0), ("2020-01-02", 0, 0.0)]


def test_statistics_tell_null_values_from_totals(spark):
    rows = spark.createDataFrame(
        [("Good", None, "High", True, 3), ("Poor", "Shipped", "Low", None, None)],
        "DataQualityLevel string, OrderStatus string, OrderPriority string, IsDelayed boolean, ProcessingDays int",
    )
    got = {(r["dimension"], r["value"]): (r["records"], r["delayed_orders"]) for r in rollups.orders_transform_stats(rows).collect()}
    assert got[("total", None)] == (2, 1) and got[("status", None)] == (1, 1) and len(got) == 7


def test_large_sums_do_not_overflow(spark):
    big = F.lit("9" * 18 + ".99").cast("decimal(20,2)")
    rows = spark.range(1000).select(F.lit(date(2020, 1, 1)).alias("OrderDate"), big.alias("TotalAmount"), big.alias("NetAmount"))
    columns = {"OrderStatus": "x", "OrderPriority": "x", "CustomerType": "x", "DataQualityLevel": "x"}
    full = rows.withColumns({c: F.lit(v) for c, v in columns.items()}).withColumns(
        {"IsDelayed": F.lit(False), "ProcessingDays": F.lit(1)}
    )
    assert summaries.orders_daily_summary(full).first()["total_amount"] > 10**20
