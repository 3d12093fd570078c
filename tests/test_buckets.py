"""Bucketed tables and the stored delay history."""

import os
from datetime import date, datetime, timedelta

import pytest

from stopclock import schemas as S
from stopclock import storage
from stopclock.operators.merges import upsert_keep_first
from stopclock.plans import buckets, delays
from stopclock.plans.tables import table_path

TABLE = S.Table("counts", "k string, first_seen int, n int", ("k",))


def merge(current, batch):
    return upsert_keep_first(current, batch, ["k"], keep=["first_seen"], order=["n"], newer="n")


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), TABLE.ddl)


def files(root, bucket=None):
    base = table_path(root, TABLE)
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(base)
        for name in names
        if name.endswith(".parquet") and (bucket is None or f"bucket={bucket}" in folder)
    }


def stored(spark, root):
    return sorted(tuple(r) for r in buckets.read_buckets(spark, root, TABLE).collect())


def test_a_merge_leaves_other_buckets_alone(spark, tmp_path):
    root = str(tmp_path)
    keys = [f"k{i}" for i in range(40)]
    assert buckets.read_buckets(spark, root, TABLE).collect() == []
    assert buckets.merge_buckets(spark, root, TABLE, batch(spark), merge) == []
    all_of_them = buckets.merge_buckets(spark, root, TABLE, batch(spark, *[(k, 1, 1) for k in keys]), merge, buckets=8)
    assert len(all_of_them) > 4
    before = files(root)
    (touched,) = buckets.merge_buckets(spark, root, TABLE, batch(spark, ("k3", 5, 5)), merge, buckets=99)
    after = files(root)
    same = {f for f in before if after.get(f) == before[f]}
    assert {f for f in before if f"bucket={touched}/" not in f} == same
    assert stored(spark, root) == sorted((k, 1, 5 if k == "k3" else 1) for k in keys)


def test_a_batch_counts_once_and_a_bucket_may_run_empty(spark, tmp_path):
    root = str(tmp_path)

    def adding(current, more):
        return current.unionByName(more).groupBy("k").agg({"n": "sum"}).selectExpr("k", "1 AS first_seen", "CAST(`sum(n)` AS INT) AS n")

    for token in ("a", "a", "b", "b"):
        buckets.merge_buckets(spark, root, TABLE, batch(spark, ("x", 1, 2)), adding, token)
    assert stored(spark, root) == [("x", 1, 4)]
    (touched,) = buckets.merge_buckets(spark, root, TABLE, batch(spark, ("x", 1, 2)), lambda now, _: now.limit(0), "c")
    assert stored(spark, root) == [] and files(root, touched) == {}


@pytest.mark.parametrize("swapped", [False, True])
def test_a_merge_that_was_cut_off_is_finished(spark, tmp_path, monkeypatch, swapped):
    root = str(tmp_path)
    buckets.merge_buckets(spark, root, TABLE, batch(spark, ("x", 1, 1), ("y", 1, 1)), merge, "a")
    whole = buckets._finish

    def cut_off(spark, table, path):
        if storage.get_text(spark, path, "_pending") is None:
            return whole(spark, table, path)
        if swapped:  # the overwrite is done, the note still there
            note = storage.get_text(spark, path, "_pending").split(" ")
            buckets._overwrite(buckets._with_bucket(spark, table, f"{path}/{note[0]}"), path)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(buckets, "_finish", cut_off)
    with pytest.raises(RuntimeError):
        buckets.merge_buckets(spark, root, TABLE, batch(spark, ("x", 9, 9)), merge, "b")
    monkeypatch.setattr(buckets, "_finish", whole)
    assert buckets.merge_buckets(spark, root, TABLE, batch(spark, ("x", 9, 9)), merge, "b") == []
    assert stored(spark, root) == [("x", 1, 9), ("y", 1, 1)]
    assert not [n for n in storage.folders(spark, table_path(root, TABLE)) if n.startswith("_staged")]


DAY = date(2026, 4, 14)


def visit(stop, status, minute, delay=60, day=DAY):
    at = datetime(2026, 4, 14, 12, minute)
    return (day, "T", stop, "504", f"S{stop}", at, at + timedelta(seconds=delay), delay, status, at)


def test_delays_are_landed_once_and_never_rewritten(spark, tmp_path):
    root = str(tmp_path)

    def land(number, *rows):
        delays.land_delays(spark, root, spark.createDataFrame(list(rows), S.STOP_DELAY.ddl), number, f"s.{number}")

    def now():
        return {r.stop_sequence: (r.status, r.delay_s) for r in delays.read_delays(spark, root).collect()}

    def frozen_files():
        return {
            os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns
            for folder, _, names in os.walk(table_path(root, S.STOP_DELAY))
            for n in names
            if n.endswith(".parquet")
        }

    assert now() == {}
    land(0, visit(1, "predicted", 1), visit(2, "predicted", 1))
    land(1, visit(1, "final", 2, 90), visit(2, "predicted", 2, 70))
    assert now() == {1: ("final", 90), 2: ("predicted", 70)}
    first = frozen_files()
    for _ in range(2):  # the same micro-batch again
        land(2, visit(2, "predicted", 3, 75), visit(2, "abandoned", 3, 75), visit(3, "predicted", 3, 10))
    assert now() == {1: ("final", 90), 2: ("abandoned", 75), 3: ("predicted", 10)}
    assert first.items() <= frozen_files().items()
    land(3, visit(2, "predicted", 9, 200))  # heard of again
    land(4, visit(2, "final", 10, 210), visit(1, "final", 2, 95, date(2026, 4, 13)))
    want = {1: ("final", 90), 2: ("final", 210), 3: ("predicted", 10)}
    rows = delays.read_delays(spark, root, DAY, DAY).collect()
    assert {r.stop_sequence: (r.status, r.delay_s) for r in rows} == want and len(rows) == 3
    assert delays.compact_delays(spark, root, DAY) == 3
    assert delays.compact_delays(spark, root, DAY) == 1
    rows = delays.read_delays(spark, root, DAY, DAY).collect()
    assert {r.stop_sequence: (r.status, r.delay_s) for r in rows} == want and len(rows) == 3
    assert delays.read_delays(spark, root, day_to="2026-04-13").count() == 1
