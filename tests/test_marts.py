"""Marts that follow changes against marts computed from the whole of staging."""

import datetime as dt
from decimal import Decimal

import pytest

from martloom.operators import versions
from martloom.plans import marts, orders

SCHEMA = (
    "order_id string, customer_id string, product_id string, category string, quantity int, unit_price decimal(12,2),"
    " order_status string, created_at timestamp_ntz, modified_at timestamp_ntz"
)
LATEST = versions.Layout(["created_day"], ["customer_id"], ["order_id"])


def _latest(spark, rows):
    at = lambda d: d and dt.datetime(2026, 7, d)
    data = [(o, c, p, "CAT", 1, Decimal(price), "completed", at(made), at(changed)) for o, c, p, price, made, changed in rows]
    return spark.createDataFrame(data, SCHEMA).withColumn("created_day", marts.F.to_date("created_at"))


def _merge(spark, lake, *rows):
    versions.upsert(_latest(spark, rows), f"{lake}/latest", ["order_id"], LATEST, rows_may_move=False, newest_first=orders.newest_first())


def _same_as_whole(spark, lake):
    stg = orders.stg_orders(versions.read(spark, f"{lake}/latest"))
    for name, whole in orders.marts(stg).items():
        found = marts.dim_date(spark, lake) if name == "dim_date" else marts.table(spark, lake, name)
        assert found.columns == whole.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect())), name


FIRST = [
    ("O1", "A", "P1", "1.00", 1, 1), ("O2", "A", "P2", "2.00", 2, 2), ("O3", "B", "P1", "3.00", 2, 2), ("O4", "C", None, "4.00", 3, 3),
    ("O5", "D", "P3", "5.00", 5, 5), ("O6", None, "P3", "6.00", 5, 5),
]


def test_marts_follow_changes(spark, fresh):
    _merge(spark, fresh, *FIRST)
    marts.follow(spark, fresh, f"{fresh}/latest")
    _same_as_whole(spark, fresh)
    # a new day, a new price, a customer whose only order loses them, a customer who moves to another product
    _merge(spark, fresh, ("O7", "A", "P1", "9.00", 7, 7), ("O5", None, "P3", "5.00", 5, 8), ("O3", "B", "P2", "3.50", 2, 9))
    marts.follow(spark, fresh, f"{fresh}/latest")
    _same_as_whole(spark, fresh)
    assert "D" not in {r.customer_id for r in marts.table(spark, fresh, "dim_customer").collect()}
    # a missing product gets a price, and a product loses its last order
    _merge(spark, fresh, ("O8", "B", None, "7.00", 3, 10), ("O2", "A", "P9", "2.00", 2, 10))
    marts.follow(spark, fresh, f"{fresh}/latest")
    _same_as_whole(spark, fresh)
    versions.restore(spark, f"{fresh}/latest", 1)
    marts.follow(spark, fresh, f"{fresh}/latest")
    _same_as_whole(spark, fresh)


def test_only_touched_days_are_written(spark, fresh):
    _merge(spark, fresh, *FIRST)
    marts.follow(spark, fresh, f"{fresh}/latest")
    _merge(spark, fresh, ("O2", "A", "P2", "2.50", 2, 11))
    marts.follow(spark, fresh, f"{fresh}/latest")
    for name in ("stg_orders", "fct_orders", "dim_customer_parts", "dim_product_parts"):
        entry = versions._entry(spark, f"{fresh}/{name}")
        written = {p.v for p in entry.parts if "2026-07-02" in p.part_key}
        left = {p.v for p in entry.parts if "2026-07-02" not in p.part_key}
        assert (written, left) == ({2}, {1}), name
    before = versions.latest_version(spark, f"{fresh}/fct_orders")
    marts.follow(spark, fresh, f"{fresh}/latest")
    assert versions.latest_version(spark, f"{fresh}/fct_orders") == before


@pytest.mark.parametrize("step", [1, 3, 5])
def test_a_run_that_died_is_made_up_for(spark, fresh, monkeypatch, step):
    _merge(spark, fresh, *FIRST)
    marts.follow(spark, fresh, f"{fresh}/latest")
    _merge(spark, fresh, ("O7", "A", "P1", "9.00", 7, 7), ("O5", None, "P3", "5.00", 5, 8))
    real, calls = versions.replace, []

    def dying(*args, **more):
        calls.append(1)
        if len(calls) == step:
            raise RuntimeError("died")
        return real(*args, **more)

    with monkeypatch.context() as patch:
        patch.setattr(versions, "replace", dying)
        with pytest.raises(RuntimeError, match="died"):
            marts.follow(spark, fresh, f"{fresh}/latest")
    _merge(spark, fresh, ("O9", "E", "P9", "1.00", 9, 9))
    marts.follow(spark, fresh, f"{fresh}/latest")
    _same_as_whole(spark, fresh)


def test_changed_rows_are_found_in_one_shuffle(spark, plan_of):
    row = lambda *ids: spark.createDataFrame([(i, None) for i in ids], "k int, v string")
    found = marts._unequal(row(1, 1, 2, 3), row(1, 2, 2, 4, 4))
    assert plan_of(found).count("hashpartitioning") == 1
    assert sorted(r.k for r in found.collect()) == [1, 2, 3, 4]
    assert marts._unequal(row(1, 2, 2), row(2, 1, 2)).isEmpty()
