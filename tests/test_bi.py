import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from martloom.functions import calendar, money
from martloom.plans import bi, retail


def days(spark, first, last):
    return bi.dim_date(spark.createDataFrame([(first, last)], "first_day date, last_day date"))


def sales(spark, *rows):
    return spark.createDataFrame(
        [(d, c, Decimal(r), Decimal(p)) for d, c, r, p in rows],
        "full_date date, category string, revenue decimal(14,2), profit decimal(14,2)",
    )


def test_calendar_of_three_years(spark):
    d = days(spark, dt.date(2023, 1, 1), dt.date(2025, 12, 31)).orderBy("date_key").collect()
    assert len(d) == 1096 and (d[0].date_key, d[-1].date_key) == (1, 1096)
    assert (d[0].day_of_week, d[0].is_weekend, d[0].month_name, d[0].quarter) == (6, True, "Jan", 1)


def test_weekday_bases(spark):
    row = spark.range(1).select(
        F.lit(dt.date(2026, 7, 5)).alias("d")
    ).select(
        calendar.weekday_sunday0("d").alias("s"), calendar.weekday_monday0("d").alias("m"),
        calendar.weekday_name("d").alias("n"), calendar.is_weekend("d").alias("w"), calendar.date_key("d").alias("k"),
        calendar.date_key_of_text(F.lit("2026-07-05")).alias("t"),
    ).first()
    assert tuple(row) == (0, 6, "Sunday", True, 20260705, 20260705)


def test_empty_fact_has_no_calendar(spark):
    empty = spark.createDataFrame([], "order_date date")
    assert retail.dim_date(empty).isEmpty()


def test_blank_growth_and_leap_day(spark):
    rows = sales(
        spark, (dt.date(2023, 2, 28), "a", "10", "1"), (dt.date(2024, 2, 28), "a", "5", "1"),
        (dt.date(2024, 2, 29), "a", "5", "1"), (dt.date(2025, 2, 28), "a", "30", "1"),
    )
    cal = days(spark, dt.date(2023, 1, 1), dt.date(2025, 12, 31))
    out = {r.year: r for r in bi.same_period_last_year(rows, cal, ["year", "month"]).filter("month = 2").collect()}
    assert out[2023].growth is None
    assert (out[2024].prior_revenue, out[2024].growth) == (Decimal("10.00"), 0.0)
    assert (out[2025].prior_revenue, out[2025].growth) == (Decimal("10.00"), 2.0)


def test_partial_year_meets_the_same_part_of_last_year(spark):
    rows = sales(
        spark, (dt.date(2024, 3, 1), "a", "10", "1"), (dt.date(2024, 9, 1), "a", "90", "1"),
        (dt.date(2025, 3, 1), "a", "20", "1"),
    )
    cal = days(spark, dt.date(2024, 1, 1), dt.date(2025, 6, 30))
    out = {r.year: r.growth for r in bi.same_period_last_year(rows, cal, ["year"]).collect()}
    assert out == {2024: None, 2025: 1.0}
    by_row = bi.yearly_growth(rows.withColumn("year", F.year("full_date")))
    assert {r.year: r.growth_pct for r in by_row.collect()} == {2024: None, 2025: -80.0}


def test_zero_denominators_are_blank(spark):
    row = bi.measures(sales(spark, (dt.date(2024, 3, 1), "a", "0", "0"))).first()
    assert row.profit_margin is None and row.average_order_value == 0.0
    none = bi.measures(sales(spark)).first()
    assert none.transactions == 0 and none.profit_margin is None and none.average_order_value is None


def test_margin_is_a_ratio_of_sums(spark):
    row = bi.measures(sales(spark, (dt.date(2024, 3, 1), "a", "100", "10"), (dt.date(2024, 3, 1), "a", "1", "1"))).first()
    assert row.profit_margin == round(11 / 101, 6)


def test_contribution_answers_to_filters_and_axes(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2025, 1, 1)
    rows = sales(spark, (d1, "a", "0", "30"), (d1, "b", "0", "70"), (d2, "a", "0", "50"), (d2, "b", "0", "50"))
    by_year = rows.withColumn("year", F.year("full_date"))
    out = {(r.year, r.category): r.contribution for r in bi.contribution(by_year, "category", ["year"]).collect()}
    assert out == {(2024, "a"): 0.3, (2024, "b"): 0.7, (2025, "a"): 0.5, (2025, "b"): 0.5}
    view = bi.contribution(rows, "category", (), F.col("full_date") >= d2).collect()
    assert {r.category: r.contribution for r in view} == {"a": 0.5, "b": 0.5}


def test_each_measure_is_rounded_on_its_own(spark):
    row = spark.createDataFrame([(Decimal("9.99"), 3, Decimal("0.15"), Decimal("3.333"))], "p decimal(10,2), q int, d decimal(4,2), c decimal(12,3)")
    out = row.select(money.net_revenue("p", "q", "d").alias("r"), money.line_cost("c", "q").alias("c")).first()
    assert (out.r, out.c) == (Decimal("25.47"), Decimal("10.00"))


def test_unknown_map_key_is_null(spark):
    out = spark.range(1).select(bi.map_values({"a": 0.5}, F.lit("a")).alias("x"), bi.map_values({"a": 0.5}, F.lit("z")).alias("y")).first()
    assert tuple(out) == (0.5, None)
