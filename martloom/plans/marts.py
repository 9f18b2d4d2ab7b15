"""Marts that follow the changes of staging instead of being computed anew.

Kept besides the marts are partial sums per part, a day or month of creation: for every
part and customer, and for every part and product, what its orders add up to. A run is
given all staging rows of the parts in which something changed, before and after. It
writes these parts anew, in staging, the fact and the partial sums, and merges the partial
sums of the customers and products of the changed orders; the rest is left as it is.
Maxima and minima can not be taken back, but partial sums of a part can be made again,
so updates, deletions and a customer's last order need no special case.

Dimensions are kept in a fixed number of buckets by key, of which a run writes those
with a changed key. Every step depends on the change only and notes how far it
got, so a run that died is repeated and steps that were done are skipped.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import ExitStack
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators import versions
from martloom.operators.upsert import matching
from martloom.plans import orders
from martloom.session import kept

BUCKETS = 64
PART, BUCKET = "_part", "_bucket"
BY_PART = versions.Layout([PART], ["customer_id"], ["order_id"])


@dataclass(frozen=True)
class Dimension:
    """A dimension of sums over orders: its keys, and as SQL the partial sums per part, how they merge, and what is shown."""

    name: str
    keys: Sequence[str]
    partial: dict[str, str]
    merged: dict[str, str]
    final: dict[str, str]


CUSTOMER = Dimension(
    "dim_customer", ["customer_id"],
    {"_first": "min(created_at)", "_last": "max(created_at)", "_n": "count(1)"},
    {"_first": "min(_first)", "_last": "max(_last)", "_n": "sum(_n)"},
    {"first_order_at": "_first", "last_order_at": "_last", "lifetime_order_count": "_n"},
)
# an order is in staging once, so counting rows counts orders
PRODUCT = Dimension(
    "dim_product", ["product_id", "category"],
    {"_newest": "max(struct(modified_at, order_id, unit_price))", "_n": "count(1)"},
    {"_newest": "max(_newest)", "_n": "sum(_n)"},
    {"current_unit_price": "_newest.unit_price", "times_ordered": "_n"},
)
DIMENSIONS = (CUSTOMER, PRODUCT)


def _aggregated(rows: DataFrame, keys: Sequence[str], sums: dict[str, str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.expr(c).alias(n) for n, c in sums.items()])


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias(BUCKET)


def _finished(partials: DataFrame, dim: Dimension) -> DataFrame:
    """Rows of a dimension from partial sums of all their parts."""
    merged = _aggregated(partials, dim.keys, dim.merged)
    return merged.select(*dim.keys, *[F.expr(c).alias(n) for n, c in dim.final.items()], _bucket(dim.keys))


def with_part(stg: DataFrame, grain: str) -> DataFrame:
    return stg.withColumn(PART, F.to_date(F.date_trunc(grain, "created_at")))


def _fact(stored: DataFrame, grain: str) -> DataFrame:
    return with_part(orders.fct_orders(stored), grain)


def _by_key(dim: Dimension, first: str) -> versions.Layout:
    return versions.Layout([first], dim.keys, dim.keys)


def build(stg: DataFrame, lake: str, grain: str = "day", writer: str | None = None, batch_id: int | None = None) -> None:
    """Write staging, the fact, the partial sums and the dimensions from the whole of staging."""
    spark, mark = stg.sparkSession, {"writer": writer, "batch_id": batch_id}
    versions.publish(with_part(stg, grain), f"{lake}/stg_orders", "model", BY_PART, **mark)
    stored = versions.read(spark, f"{lake}/stg_orders")
    versions.publish(_fact(stored, grain), f"{lake}/fct_orders", "model", BY_PART, **mark)
    for dim in DIMENSIONS:
        parts, root = f"{lake}/{dim.name}_parts", f"{lake}/{dim.name}"
        versions.publish(_aggregated(stored, [PART, *dim.keys], dim.partial), parts, "model", _by_key(dim, PART), **mark)
        versions.publish(_finished(versions.read(spark, parts), dim), root, "model", _by_key(dim, BUCKET), **mark)


def refresh(
    spark: SparkSession, lake: str, before: DataFrame, after: DataFrame, grain: str = "day",
    writer: str | None = None, batch_id: int | None = None,
) -> None:
    """Bring the marts up to date with a change: all staging rows of the parts that changed, as they were and as they are.

    A part without rows on one side is new, or gone.
    """
    mark = {"writer": writer, "batch_id": batch_id}
    with ExitStack() as until_done:
        hold = lambda df, label: until_done.enter_context(kept(df, label))
        before, after = hold(with_part(before, grain), "before"), hold(with_part(after, grain), "after")
        parts = hold(before.select(PART).unionByName(after.select(PART)).distinct(), "parts")
        versions.replace(after, f"{lake}/stg_orders", parts, BY_PART, **mark)
        versions.replace(_fact(after, grain), f"{lake}/fct_orders", parts, BY_PART, **mark)
        changed = hold(_unequal(before, after), "changed")
        for dim in DIMENSIONS:
            root, keys = f"{lake}/{dim.name}", hold(changed.select(*dim.keys).distinct(), "keys")
            versions.replace(_aggregated(after, [PART, *dim.keys], dim.partial), f"{root}_parts", parts, _by_key(dim, PART), **mark)
            merged = _finished(_of_keys(versions.read(spark, f"{root}_parts"), keys, dim.keys), dim)
            buckets = keys.select(_bucket(dim.keys)).distinct()
            rest = versions.read_parts(spark, root, buckets).alias("t").join(keys.alias("k"), _same(dim.keys), "left_anti")
            versions.replace(rest.unionByName(merged), root, buckets, _by_key(dim, BUCKET), **mark)


def _unequal(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows that one side has more often than the other, once each: one shuffle of both sides together."""
    sides = before.withColumn("_side", F.lit(1)).unionByName(after.withColumn("_side", F.lit(-1)))
    return sides.groupBy(*before.columns).agg(F.sum("_side").alias("_more")).filter("_more <> 0").drop("_more")


def _same(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"t.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys])


def _of_keys(partials: DataFrame, keys: DataFrame, names: Sequence[str]) -> DataFrame:
    """Partial sums of the given keys; a missing value is a key like any other."""
    missing = reduce(or_, [F.col(n).isNull() for n in names])
    rest = partials.filter(missing).alias("t").join(keys.filter(missing).alias("k"), _same(names), "left_semi")
    return matching(partials, keys, names).unionByName(rest)


def follow(spark: SparkSession, lake: str, source: str, grain: str = "day") -> None:
    """Bring the marts up to the newest version of the table of latest orders, from wherever the run before got to.

    ``source`` is kept in table partitions no coarser than ``grain``, by creation.
    """
    newest = versions.latest_version(spark, source)
    tables = ["stg_orders", "fct_orders", *[f"{d.name}{x}" for d in DIMENSIONS for x in ("_parts", "")]]
    done = min(versions.last_batch(spark, f"{lake}/{t}", "latest") for t in tables)
    if not done:  # never built, or not to the end
        build(orders.stg_orders(versions.read(spark, source)), lake, grain, "latest", newest)
    elif done < newest:
        before, after = versions.changed_parts(spark, source, done, newest)
        refresh(spark, lake, orders.stg_orders(before), orders.stg_orders(after), grain, "latest", newest)


def table(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """A mart without the columns of its layout."""
    return versions.read(spark, f"{lake}/{name}").drop(PART, BUCKET)


def dim_date(spark: SparkSession, lake: str) -> DataFrame:
    """Days between the first and the last with an order, from the partial sums."""
    sums = versions.read(spark, f"{lake}/dim_customer_parts")
    return orders.dim_date(sums.select(F.explode(F.array("_first", "_last")).alias("created_at")))
