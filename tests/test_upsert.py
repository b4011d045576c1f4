"""Tables stored by key, consumed batches, and writers that stop half-way."""

from __future__ import annotations

import itertools
import random

import pytest
from conftest import rows

from shelfline.operators import upsert
from shelfline.plans import sales
from shelfline.plans.merges import keyed_table
from shelfline.sources import tables

SCHEMA = "k int, stamp int, v string"


def keyed(spark, path, order_by="stamp", buckets=8):
    return upsert.KeyedTable(str(path), spark.createDataFrame([], SCHEMA).schema, ("k",), order_by, buckets)


def deliver(spark, raw, batch, values):
    upsert.add_batch(spark.createDataFrame(values, SCHEMA), str(raw), batch)


def test_later_stamp_wins_and_the_batch_wins_ties(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    upsert.create_table(spark.createDataFrame([(1, 5, "old"), (1, 4, "older"), (2, 5, "old"), (None, 1, "old")], SCHEMA), table)
    deliver(spark, tmp_path / "raw", "1", [(1, 5, "new"), (2, 4, "late"), (3, None, "new"), (None, 2, "new"), (3, None, "a")])
    assert upsert.merge_batches(spark, str(tmp_path / "raw"), table) == ["1"]
    assert rows(table.read(spark)) == [(1, 5, "new"), (2, 5, "old"), (3, None, "new"), (None, 2, "new")]


def test_only_folders_of_the_batch_are_written(spark, tmp_path):
    table = keyed(spark, tmp_path / "t", buckets=16)
    upsert.create_table(spark.createDataFrame([(n, 1, "old") for n in range(400)], SCHEMA), table)
    before = tables.files_below(spark, table.path)
    assert len(before) == 16
    upsert.upsert(spark.createDataFrame([(7, 2, "new")], SCHEMA), table)
    after = tables.files_below(spark, table.path)
    assert [name for name in after if after[name] != before[name]] == [
        f"bucket_of_16={table.stored(spark).where('k = 7').first()[table.bucket]}"]
    assert rows(table.read(spark)) == sorted([(n, 2 if n == 7 else 1, "new" if n == 7 else "old") for n in range(400)], key=repr)


def test_merge_reads_only_the_folders_of_its_keys(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    upsert.create_table(spark.createDataFrame([(n, 1, "old") for n in range(99)], SCHEMA), table)
    plan = table.stored(spark).where(f"{table.bucket} IN (1, 3)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket_of_8" in plan


def test_newest_batch_wins_without_an_order_field_in_any_order(spark, tmp_path):
    rng = random.Random(5)
    batches = {f"{n:03}": [(rng.randrange(6), rng.randrange(9), f"{n}-{m}") for m in range(5)] for n in range(4)}
    want = {9: (9, 0, "kept")}
    for name in sorted(batches):
        newest = {}
        for row in batches[name]:
            newest[row[0]] = max(newest.get(row[0], row), row)
        want.update(newest)
    for turn, order in enumerate([["000", "001", "002", "003"], ["003", "001", "002", "000"]]):
        table, raw = keyed(spark, tmp_path / f"t{turn}", None), tmp_path / f"raw{turn}"
        upsert.create_table(spark.createDataFrame([(9, 0, "kept")], SCHEMA), table)
        for pair in (order[:2], order[2:]):
            for name in pair:
                deliver(spark, raw, name, batches[name])
            assert upsert.merge_batches(spark, str(raw), table) == sorted(pair)
        assert rows(table.read(spark)) == sorted(want.values(), key=repr)


def test_batches_are_merged_once_though_a_run_stops_before_the_record(spark, tmp_path, monkeypatch):
    table, raw = keyed(spark, tmp_path / "t", None), str(tmp_path / "raw")
    upsert.create_table(spark.createDataFrame([(1, 0, "old")], SCHEMA), table)
    deliver(spark, raw, "1", [(1, 0, "first"), (2, 0, "first")])
    deliver(spark, raw, "2", [(1, 0, "second")])
    with monkeypatch.context() as broken:
        broken.setattr(upsert, "record_consumed", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError, match="stopped"):
            upsert.merge_batches(spark, raw, table)
    assert upsert.pending_batches(spark, raw) == ["1", "2"]
    deliver(spark, raw, "3", [(2, 0, "third")])
    assert upsert.merge_batches(spark, raw, table) == ["1", "2", "3"]
    assert rows(table.read(spark)) == [(1, 0, "second"), (2, 0, "third")]
    assert upsert.merge_batches(spark, raw, table) == []
    # Delivered again after it was merged: on record, so emptied and not merged.
    deliver(spark, raw, "1", [(1, 0, "again")])
    assert upsert.merge_batches(spark, raw, table) == []
    assert rows(table.read(spark)) == [(1, 0, "second"), (2, 0, "third")]
    assert tables.folders(spark, raw) == ["_consumed"]


def test_unfinished_deliveries_wait(spark, tmp_path):
    deliver(spark, tmp_path / "raw", "1", [(1, 0, "a")])
    (tmp_path / "raw" / "batch=1" / "_SUCCESS").unlink()
    assert upsert.pending_batches(spark, str(tmp_path / "raw")) == []
    assert upsert.pending_batches(spark, str(tmp_path / "none")) == []
    with pytest.raises(ValueError):
        deliver(spark, tmp_path / "raw", "a/b", [(1, 0, "a")])


def test_empty_tables_batches_and_another_layout(spark, tmp_path):
    table, raw = keyed(spark, tmp_path / "t"), str(tmp_path / "raw")
    upsert.create_table(spark.createDataFrame([], SCHEMA), table)
    deliver(spark, raw, "1", [])
    upsert.merge_batches(spark, raw, table)
    assert rows(table.read(spark)) == []
    deliver(spark, raw, "2", [(1, 1, "a")])
    upsert.merge_batches(spark, raw, table)
    assert rows(table.read(spark)) == [(1, 1, "a")]
    with pytest.raises(ValueError, match="laid out"):
        keyed(spark, tmp_path / "t", buckets=9).read(spark)


def test_a_listed_table_is_refreshed_from_batches(spark, tmp_path):
    schema = "item int, loc int, price double, created_dttm int, is_actual string"
    first = spark.createDataFrame([(1, 1, 8.0, 1, "1"), (3, 1, 4.0, 1, "1")], schema)
    table, raw = keyed_table("item_loc", str(tmp_path / "t"), first.schema, 4), str(tmp_path / "raw")
    upsert.create_table(first, table)
    upsert.add_batch(spark.createDataFrame([(1, 1, 9.0, 2, "1"), (2, 1, 3.0, 2, "0")], schema), raw, "1")
    assert rows(sales.refresh_from_batches(spark, "item_loc", raw, table), "item", "price") == [(1, 9.0), (3, 4.0)]
    assert table.read(spark).count() == 3 and upsert.pending_batches(spark, raw) == []


# -------------------------------------------------------- writers that stop

class Stopping:
    """Lets so many renames and deletions pass and stops at the next one."""

    def __init__(self, monkeypatch, after):
        self.left = after
        for name in ("move", "remove_path"):
            monkeypatch.setattr(tables, name, self.counted(getattr(tables, name)))

    def counted(self, step):
        def run(*args):
            if self.left == 0:
                raise KeyboardInterrupt
            self.left -= 1
            return step(*args)
        return run


@pytest.mark.parametrize("write", ["table", "partitions", "range"])
def test_a_stop_at_any_step_is_mended_by_the_next_run(spark, tmp_path, monkeypatch, write):
    schema = "p int, v string"
    old = [(n, "old") for n in range(4)]
    new = {"table": [(0, "new")], "partitions": [(0, "old"), (1, "new"), (2, "new"), (3, "old")],
           "range": [(0, "old"), (2, "new")]}[write]

    def run(path):
        if write == "table":
            tables.replace_table(spark.createDataFrame([(0, "new")], schema), path, ["p"])
        elif write == "partitions":
            tables.swap_partitions(spark.createDataFrame([(1, "new"), (2, "new")], schema), path, "p")
        else:
            tables.replace_range(spark.createDataFrame([(2, "new")], schema), path, "p", 1)

    for after in itertools.count():
        folder = tmp_path / str(after)
        path = str(folder / "t")
        tables.replace_table(spark.createDataFrame(old, schema), path, ["p"])
        with monkeypatch.context() as broken:
            Stopping(broken, after)
            try:
                run(path)
                stopped = False
            except KeyboardInterrupt:
                stopped = True
        tables.recover_table(spark, path)
        # Whole: either as before or as wanted, never in between.
        assert rows(tables.read_table(spark, path, ["p", "v"])) in (old, new)
        assert [f.name for f in folder.iterdir()] == ["t"]
        run(path)
        assert rows(tables.read_table(spark, path, ["p", "v"])) == new
        if not stopped:
            break
    assert after >= 2


def test_the_old_table_is_put_back_if_the_new_one_cannot_take_its_place(spark, tmp_path, monkeypatch):
    path, move = str(tmp_path / "t"), tables.move
    tables.replace_table(spark.range(3), path)

    def fails(spark, source, target):
        if "-new-" in source:
            raise OSError("no place")
        move(spark, source, target)

    with monkeypatch.context() as broken:
        broken.setattr(tables, "move", fails)
        with pytest.raises(OSError, match="no place"):
            tables.replace_table(spark.range(9), path)
    assert tables.read_table(spark, path).count() == 3
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


def test_tables_with_like_names_are_left_alone(spark, tmp_path):
    for name in ("t", "t-new-2", "t-old-x"):
        tables.replace_table(spark.range(1), str(tmp_path / name))
    tables.recover_table(spark, str(tmp_path / "t"))
    assert sorted(f.name for f in tmp_path.iterdir()) == ["t", "t-new-2", "t-old-x"]


def test_dumps_go_on_where_the_last_one_ended(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "dumps")
    first = spark.createDataFrame([(n, n // 2) for n in range(6)] + [(99, None)], "n int, at int")
    assert tables.resume_dump(first, path, "at") == 6
    assert tables.resume_dump(first, path, "at") == 0
    more = first.unionByName(spark.createDataFrame([(n, n) for n in range(6, 9)], "n int, at int"))
    with monkeypatch.context() as broken:
        broken.setattr(spark, "createDataFrame", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError, match="stopped"):
            tables.resume_dump(more, path, "at")
    assert tables.resume_dump(more, path, "at") == 3
    assert rows(spark.read.parquet(path), "n", "dump") == sorted([(n, int(n > 5)) for n in range(9)], key=repr)
