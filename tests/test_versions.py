import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martloom.operators import versions
from martloom.operators.upsert import DuplicateKeys
from martloom.operators.versions import Layout

SCHEMA = "k int, part string, day date, amount decimal(10,2)"
LAYOUT = Layout(["part"], ["k"])


def rows(df):
    return sorted(map(tuple, df.select("k", "part", "amount").collect()))


def table(spark, *data):
    return spark.createDataFrame(
        [(k, p, dt.date(2026, 7, 1), Decimal(a)) for k, p, a in data], SCHEMA
    )


def show(*data):
    return [(k, p, Decimal(a)) for k, p, a in data]


def data_dirs(root, version):
    return sorted(p.name for p in Path(root, "data", f"v={version}").glob("part=*"))


def test_no_table_yet(spark, fresh):
    assert versions.read(spark, fresh) is None
    assert not versions.exists(spark, fresh)
    assert versions.history(spark, fresh).isEmpty()


def test_types_survive_partition_folders(spark, fresh):
    versions.publish(table(spark, (1, "01", "1.50"), (2, "a b/ü+%", "2"), (3, None, "3")), fresh, layout=LAYOUT)
    back = versions.read(spark, fresh)
    assert back.dtypes == [("k", "int"), ("part", "string"), ("day", "date"), ("amount", "decimal(10,2)")]
    assert {r.k: r.part for r in back.collect()} == {1: "01", 2: "a b/ü+%", 3: None}


def test_upsert_rewrites_only_touched_partitions(spark, fresh):
    versions.publish(table(spark, (1, "a", "1"), (2, "b", "1"), (3, "c", "1")), fresh, layout=LAYOUT)
    done = versions.upsert(table(spark, (2, "b", "9"), (4, "b", "9")), fresh, ["k"], LAYOUT)
    assert (done.version, done.inserted, done.updated) == (2, 1, 1)
    assert data_dirs(fresh, 2) == ["part=b"]
    assert rows(versions.read(spark, fresh)) == show((1, "a", "1"), (2, "b", "9"), (3, "c", "1"), (4, "b", "9"))
    assert rows(versions.read(spark, fresh, 1)) == show((1, "a", "1"), (2, "b", "1"), (3, "c", "1"))


def test_row_that_moves_to_another_partition_leaves_the_old_one(spark, fresh):
    versions.publish(table(spark, (1, "a", "1"), (2, "a", "1"), (3, "c", "1")), fresh, layout=LAYOUT)
    versions.upsert(table(spark, (1, "b", "5")), fresh, ["k"], LAYOUT)
    assert data_dirs(fresh, 2) == ["part=a", "part=b"]
    assert rows(versions.read(spark, fresh)) == show((1, "b", "5"), (2, "a", "1"), (3, "c", "1"))


def test_partition_that_empties_disappears(spark, fresh):
    versions.publish(table(spark, (1, "a", "1"), (3, "c", "1")), fresh, layout=LAYOUT)
    versions.upsert(table(spark, (1, "c", "5")), fresh, ["k"], LAYOUT)
    assert rows(versions.read(spark, fresh)) == show((1, "c", "5"), (3, "c", "1"))


def test_unchanged_increment_publishes_nothing(spark, fresh):
    source = table(spark, (1, "a", "1"), (2, "b", "1"))
    assert versions.upsert(source, fresh, ["k"], LAYOUT).version == 1
    assert versions.upsert(source, fresh, ["k"], LAYOUT).version is None
    assert versions.latest_version(spark, fresh) == 1


def test_replayed_batch_is_skipped(spark, fresh):
    versions.upsert(table(spark, (1, "a", "1")), fresh, ["k"], LAYOUT, writer="w", batch_id=0)
    versions.upsert(table(spark, (1, "a", "2")), fresh, ["k"], LAYOUT, writer="w", batch_id=1)
    assert versions.upsert(table(spark, (1, "a", "1")), fresh, ["k"], LAYOUT, writer="w", batch_id=0).version is None
    assert rows(versions.read(spark, fresh)) == show((1, "a", "2"))


def test_update_of_some_columns(spark, fresh):
    versions.publish(table(spark, (1, "a", "1"), (2, "a", "1")), fresh)
    moved = table(spark, (1, "z", "7"), (3, "z", "7"))
    versions.upsert(moved, fresh, ["k"], update_columns=["amount"])
    assert rows(versions.read(spark, fresh)) == show((1, "a", "7"), (2, "a", "1"), (3, "z", "7"))


def test_stale_row_does_not_replace_a_newer_one(spark, fresh):
    versions.publish(table(spark, (1, "a", "9")), fresh, layout=LAYOUT)
    versions.upsert(table(spark, (1, "a", "3")), fresh, ["k"], LAYOUT, newest_first=[F.desc("amount")])
    assert rows(versions.read(spark, fresh)) == show((1, "a", "9"))


def test_repeated_keys_are_refused(spark, fresh):
    with pytest.raises(DuplicateKeys):
        versions.upsert(table(spark, (1, "a", "1"), (1, "a", "2")), fresh, ["k"], LAYOUT)
    assert not versions.exists(spark, fresh)
    versions.publish(table(spark, (1, "a", "1")), fresh, layout=LAYOUT)
    with pytest.raises(DuplicateKeys):  # also when one of the two is stored already
        versions.upsert(table(spark, (1, "a", "1"), (1, "a", "2")), fresh, ["k"], LAYOUT)
    assert versions.latest_version(spark, fresh) == 1


def test_restore_writes_no_data_and_is_itself_a_version(spark, fresh):
    versions.publish(table(spark, (1, "a", "1")), fresh, "load", LAYOUT)
    versions.upsert(table(spark, (1, "a", "2"), (2, "b", "2")), fresh, ["k"], LAYOUT)
    assert versions.restore(spark, fresh, 1).version == 3
    assert not Path(fresh, "data", "v=3").exists()
    assert rows(versions.read(spark, fresh)) == show((1, "a", "1"))
    assert rows(versions.read(spark, fresh, 2)) == show((1, "a", "2"), (2, "b", "2"))
    log = {r.version: (r.operation, r.row_count) for r in versions.history(spark, fresh).collect()}
    assert log == {1: ("load", 1), 2: ("upsert", 2), 3: ("restore of 1", 1)}
    with pytest.raises(ValueError):
        versions.restore(spark, fresh, 9)
    with pytest.raises(ValueError):
        versions.read(spark, fresh, 9)


def test_append_keeps_copies_and_skips_empty_increments(spark, fresh):
    one = table(spark, (1, "a", "1"))
    versions.append(one, fresh, LAYOUT)
    assert versions.append(one, fresh, LAYOUT).inserted == 1
    assert versions.append(one.limit(0), fresh, LAYOUT).version is None
    assert rows(versions.read(spark, fresh)) == show((1, "a", "1"), (1, "a", "1"))
    assert versions.added_since(spark, fresh, 1).count() == 1
    versions.upsert(table(spark, (2, "a", "2")), fresh, ["k"], LAYOUT)
    assert versions.read(spark, fresh).count() == 3


def test_leftovers_of_a_dead_job_are_invisible(spark, fresh):
    versions.publish(table(spark, (1, "a", "1")), fresh, layout=LAYOUT)
    versions._write_data(table(spark, (9, "a", "9"), (9, "z", "9")), fresh, 2, LAYOUT)
    assert rows(versions.read(spark, fresh)) == show((1, "a", "1"))
    versions.upsert(table(spark, (2, "b", "2")), fresh, ["k"], LAYOUT)
    assert rows(versions.read(spark, fresh)) == show((1, "a", "1"), (2, "b", "2"))


def test_reads_prune_partitions(spark, fresh, plan_of):
    versions.publish(table(spark, (1, "a", "1"), (2, "b", "1")), fresh, layout=LAYOUT)
    plan = plan_of(versions.read(spark, fresh).filter("part = 'b' and k = 2"))
    assert "PartitionFilters: [isnotnull(part" in plan and "EqualTo(k,2)" in plan


def test_marks_follow_a_restore(spark, fresh):
    """What a restore took back is merged again; nothing is skipped, nothing merged twice."""
    put = lambda n: versions.upsert(table(spark, (n, "a", str(n))), fresh, ["k"], LAYOUT, writer="w", batch_id=n)
    put(1), put(2)
    versions.restore(spark, fresh, 1)
    assert versions.last_batch(spark, fresh, "w") == 1
    assert put(1).version is None and put(2).inserted == 1
    put(3)
    assert sorted(r.k for r in versions.read(spark, fresh).collect()) == [1, 2, 3]


def test_a_stream_refuses_a_gap(spark, fresh):
    put = lambda n: versions.upsert(table(spark, (n, "a", str(n))), fresh, ["k"], LAYOUT, writer="w", batch_id=n, in_sequence=True)
    put(0), put(1)
    versions.restore(spark, fresh, 1)
    with pytest.raises(ValueError, match="does not follow"):
        put(2)


def test_no_effect_still_moves_the_mark(spark, fresh):
    versions.upsert(table(spark, (1, "a", "1")), fresh, ["k"], LAYOUT, writer="w", batch_id=1)
    assert versions.upsert(table(spark, (1, "a", "1")), fresh, ["k"], LAYOUT, writer="w", batch_id=2).version is None
    assert versions.last_batch(spark, fresh, "w") == 2
    assert versions.history(spark, fresh).count() == 1
    empty = table(spark, (9, "a", "1")).limit(0)
    assert versions.append(empty, fresh, writer="w", batch_id=3).version is None
    assert versions.last_batch(spark, fresh, "w") == 3


def test_a_stale_row_makes_no_version(spark, fresh):
    newest = [F.desc("amount")]
    versions.upsert(table(spark, (1, "a", "2")), fresh, ["k"], LAYOUT, newest_first=newest)
    assert versions.upsert(table(spark, (1, "a", "1")), fresh, ["k"], LAYOUT, newest_first=newest) == versions.Published(None)
    assert [r.amount for r in versions.read(spark, fresh).collect()] == [2]


def test_empty_text_in_a_partition_column(spark, fresh):
    for v in ("1", "2"):
        versions.upsert(table(spark, (1, "", v)), fresh, ["k"], LAYOUT)
    assert [(r.k, r.amount) for r in versions.read(spark, fresh).collect()] == [(1, 2)]


def test_a_large_increment_of_a_table_its_size_is_joined_as_it_is(spark, fresh, monkeypatch):
    """No filter of keys for a target that is not much larger, and partitions that are rewritten anyway are not searched."""
    from martloom.operators import upsert

    monkeypatch.setattr(upsert, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(upsert, "key_filter", None)
    searched, read_folders = [], versions._read_folders
    monkeypatch.setattr(versions, "_read_folders", lambda s, r, e, parts: searched.append(sorted({p.part_key for p in parts})) or read_folders(s, r, e, parts))
    versions.publish(table(spark, *[(i, "abc"[i % 3], "1") for i in range(30)]), fresh, layout=LAYOUT)
    done = versions.upsert(table(spark, *[(i, "abc"[i % 3], "2") for i in range(33) if i % 3 < 2], (2, "a", "9")), fresh, ["k"], LAYOUT)
    assert (done.inserted, done.updated) == (2, 21)
    assert ['{"part":"c"}'] in searched and ['{"part":"a"}', '{"part":"b"}', '{"part":"c"}'] in searched
    found = {r.k: (r.part, r.amount) for r in versions.read(spark, fresh).collect()}
    assert len(found) == 32 and found[2] == ("a", 9) and found[5] == ("c", 1) and found[31] == ("b", 2)


def test_an_upsert_leaves_nothing_but_versions(spark, fresh):
    versions.publish(table(spark, (1, "a", "1")), fresh, layout=LAYOUT)
    before = set(Path(fresh).parent.glob("*"))
    versions.upsert(table(spark, (1, "a", "2"), (2, "b", "2")), fresh, ["k"], LAYOUT)
    assert set(Path(fresh).parent.glob("*")) == before
