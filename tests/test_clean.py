import datetime as dt

import pytest
from pyspark.sql import functions as F

from martloom.functions import text
from martloom.operators import clean
from martloom.plans import retail

COLUMNS = ", ".join(f"{c} string" for c in retail.RAW_COLUMNS) + ", _source_file string, _ingested_at timestamp"


def newest():
    return [F.desc("_ingested_at")]


def bronze(spark, *rows):
    base = {
        "transaction_id": "1", "customer_id": "10", "product_id": "5", "order_date": "2026-07-01",
        "quantity": "2", "unit_price": "9.99", "region": " North ",
    }
    at = dt.datetime(2026, 7, 1)
    filled = []
    for r in rows:
        row = {**base, **{k: v for k, v in r.items() if k != "hour"}}
        filled.append((*[row[c] for c in retail.RAW_COLUMNS], "f.csv", at + dt.timedelta(hours=r.get("hour", 0))))
    return spark.createDataFrame(filled, COLUMNS)


def test_blank_customers_are_dropped(spark):
    b = bronze(
        spark, {"transaction_id": "1"}, {"transaction_id": "2", "customer_id": ""},
        {"transaction_id": "3", "customer_id": None}, {"transaction_id": "4", "customer_id": "  "},
    )
    assert [r.transaction_id for r in retail.silver_sales(b, newest()).collect()] == [1]


def test_later_ingest_wins(spark):
    b = bronze(spark, {"quantity": "3", "hour": 1}, {"quantity": "2", "hour": 0})
    assert [r.quantity for r in retail.silver_sales(b, newest()).collect()] == [3]


def test_float_like_quantity_and_large_id(spark):
    b = bronze(spark, {"transaction_id": "202607200001", "quantity": "3.0"})
    row = retail.silver_sales(b, newest()).first()
    assert (row.transaction_id, row.quantity, row.region) == (202607200001, 3, "North")
    assert dict(retail.silver_sales(b, newest()).dtypes)["transaction_id"] == "bigint"


def test_silver_keeps_unparseable_values_as_null(spark):
    row = retail.silver_sales(bronze(spark, {"quantity": "many", "order_date": "2026-7-1"}), newest()).first()
    assert row.quantity is None and row.order_date is None


@pytest.mark.parametrize(
    "bad, reason",
    [
        ({"transaction_id": "x", "customer_id": ""}, "unparseable TransactionID"),
        ({"customer_id": " ", "product_id": "?"}, "null/unparseable CustomerID"),
        ({"product_id": None, "order_date": ""}, "null/unparseable ProductID"),
        ({"order_date": "01.07.2026"}, "unparseable OrderDate"),
        ({"quantity": None}, "null/unparseable Quantity"),
        ({"unit_price": "free"}, "null/unparseable UnitPrice"),
    ],
)
def test_first_failing_rule_is_the_reason(spark, bad, reason):
    rows = retail.reject_log(bronze(spark, bad, {"transaction_id": "2"})).collect()
    assert [r.reason for r in rows] == [reason]


def test_raw_row_skips_nulls_and_keeps_landed_text(spark):
    row = retail.reject_log(bronze(spark, {"customer_id": None, "quantity": "2.0"})).first()
    assert row.raw_row == "1,5,2026-07-01,2.0,9.99, North "


def test_each_bad_row_is_logged_once(spark):
    b = bronze(spark, *[{"transaction_id": "x"}] * 3, {"transaction_id": "7"})
    assert retail.reject_log(b).count() == 3


def test_audit_adds_up(spark):
    b = bronze(spark, {}, {"hour": 1}, {"transaction_id": "2"}, {"customer_id": ""})
    assert retail.audit_counts(b).first().asDict() == {
        "raw_rows": 4, "rejected_rows": 1, "duplicate_rows": 1, "clean_rows": 2,
    }


def test_fact_total_and_key(spark):
    row = retail.clean_sales(bronze(spark, {"quantity": "3"}), newest()).first()
    assert str(row.total_amount) == "29.97" and row.date_key == 20260701
    assert list(row.asDict()) == retail.FACT_COLUMNS


def test_casts_never_raise(spark):
    df = spark.createDataFrame([("",), ("1e400",), ("99999999999",), (None,), ("-3.7",)], "v string")
    out = df.select(text.to_whole("v").alias("w"), text.to_int("v").alias("i"), text.to_day("v").alias("d")).collect()
    assert [r.w for r in out] == [None, None, None, None, -3]
    assert all(r.i is None and r.d is None for r in out)


def test_instants_honour_offsets(spark):
    df = spark.createDataFrame([("2026-07-01T02:00:00+02:00",), ("2026-07-01T00:00:00.000001Z",)], "v string")
    out = [r.t for r in df.select(text.to_instant("v").alias("t")).collect()]
    assert out == [dt.datetime(2026, 7, 1), dt.datetime(2026, 7, 1, 0, 0, 0, 1)]


def test_paths(spark):
    df = spark.createDataFrame([("file:///a/b c.csv",), ("file:/a/b c.csv",), ("/a/b c.csv",)], "p string")
    rows = df.select(text.plain_path("p").alias("p"), text.file_name("p").alias("n")).collect()
    assert {(r.p, r.n) for r in rows} == {("/a/b c.csv", "b c.csv")}


def test_dimension_copies_collapse_after_trim(spark):
    df = spark.createDataFrame(
        [(1, " Ann ", 1), (1, "Ann", 2), (2, "Bo", 1)], "customer_id int, customer_name string, _ingested_at int"
    )
    out = retail.silver_dimension(df)
    assert sorted(map(tuple, out.collect())) == [(1, "Ann"), (2, "Bo")]


def test_dedup_limits_each_key_before_the_shuffle(spark, plan_of):
    """A third of all rows on one key: one row per upstream task crosses the shuffle."""
    rows = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    latest = clean.dedup_latest(rows, ["k"], [F.desc("v")])
    plan = plan_of(latest)
    before_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert latest.count() == 200_001 and latest.filter("k = 0").first().v == 299_997


def test_superseded_counts_on_a_hot_key(spark):
    rows = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("g"), F.col("id").alias("v"),
    )
    winners = clean.dedup_latest(rows, ["k"], [F.desc("v")])
    lost = {r.g: r.superseded for r in clean.superseded_counts(rows, ["k"], F.struct("v"), ["g"]).collect()}
    assert lost == {"even": 15_000, "odd": 14_999}
    assert sum(lost.values()) == rows.count() - winners.count()


def test_a_line_total_without_room_is_a_reject(spark):
    row = ("1", "10", "5", "2026-07-01", "2000000000", "100.00", "N")
    bronze = spark.createDataFrame([row], ", ".join(f"{c} string" for c in retail.RAW_COLUMNS))
    accepted, rejected = retail.accepted_and_rejected(bronze)
    assert accepted.isEmpty() and [r.reason for r in rejected.collect()] == ["line total out of range"]


def test_instants_are_utc_in_any_session_zone(spark):
    df = spark.createDataFrame([("2026-07-01T02:00:00+00:00",), ("2026-11-01T01:30:00-04:00",), ("2026-07-01T02:00:00Z",), ("2026-07-01 02:00:00",), ("x",), (None,)], "t string")
    expected = ["2026-07-01 02:00:00", "2026-11-01 05:30:00", "2026-07-01 02:00:00", "2026-07-01 02:00:00", None, None]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            found = df.select(text.to_instant("t").cast("string").alias("t")).collect()
            assert [r.t for r in found] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_silver_keeps_ids_written_as_floats(spark):
    df = spark.createDataFrame([("3.0",)], "customer_id string")
    assert df.select(retail.SILVER_TYPES["customer_id"]("customer_id").alias("c")).first().c == 3
    assert df.select(retail.TYPES["customer_id"]("customer_id").alias("c")).first().c is None


def test_a_seeded_pick_does_not_hang_on_the_partitioning(spark):
    df = spark.range(1000).select((F.col("id") % 50).alias("v")).unionByName(spark.createDataFrame([(None,)], "v long"))
    picks = [[r.v for r in clean.seeded_pick(df.repartition(n), "v", 7, 5).collect()] for n in (1, 3, 8)]
    assert picks[0] == picks[1] == picks[2] and len(set(picks[0])) == 5
    assert [r.v for r in clean.seeded_pick(df, "v", 8, 5).collect()] != picks[0]
    halves = [clean.seeded_pick(df.filter(h), "v", 7, 5) for h in ("v < 25", "v >= 25")]
    assert [r.v for r in clean.seeded_pick(halves[0].unionByName(halves[1]), "v", 7, 5).collect()] == picks[0]


def test_days_are_read_as_their_format_says(spark):
    from martloom.functions import text

    odd = ["1998-03-02", "1998-02-30", "0000-01-01", "1998-3-2", " 1998-03-02", "1998-03-02 ", "1998", "+12345-01-01", "-001-01-01", "", "bad-date", None, "1998-03-02T00:00", "9999-12-31", "1998-03-02\n", "١٩٩٨-٠٣-٠٢"]
    rows = spark.createDataFrame([(t,) for t in odd], "t string")
    read = rows.select("t", text.to_day("t").alias("a"), F.expr("try_to_date(t, 'yyyy-MM-dd')").alias("b"))
    assert [r.t for r in read.filter("not (a <=> b)").collect()] == []
