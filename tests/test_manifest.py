"""Ingest by manifest: only new files are read, moved folders add nothing, crashes leave no double rows."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tsgrid.sources.manifest import adopt, incremental_totals, ingest_files, list_raw, manifest
from tsgrid.sources.raw import read_raw
from tsgrid.sources.store import aggregate_raw, build_store, read_store, write_store
from tsgrid.streaming.ingest import ingest_available

LINE = "{}\t1383260400000\t39\t\t\t\t\t{}"


def put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(LINE.format(s, v) for s, v in rows) + "\n")


def cells(spark, store):
    return sorted((r.square_id, r.internet_traffic, r.day) for r in read_store(spark, store).collect())


def test_second_run_reads_no_raw_byte(spark, tmpdir_fresh):
    raw, store = os.path.join(tmpdir_fresh, "raw"), os.path.join(tmpdir_fresh, "store")
    put(raw, "a-2013-11-01.txt", [(1, 1.5), (1, 2.0), (2, 3.0)])
    put(raw, "b-2013-11-02.txt", [(1, 4.0)])
    first = {r.src: r for r in ingest_files(spark, raw, store).collect()}
    a = first["a-2013-11-01.txt"]
    assert (a.raw_rows, a.aggregated_rows, a.skipped, a.day) == (3, 2, False, "2013-11-01") and a.shard_mb > 0 and a.wall_seconds > 0
    assert os.path.isdir(os.path.join(store, a.dst))
    before = cells(spark, store)
    # files of the same length that raise when they are parsed
    for name in os.listdir(raw):
        size = os.path.getsize(os.path.join(raw, name))
        with open(os.path.join(raw, name), "w") as fh:
            fh.write("x" * size)
    put(raw, "c-2013-11-02.txt", [(9, 1.0)])
    again = {r.src: r for r in ingest_files(spark, raw, store).collect()}
    assert {k: r.skipped for k, r in again.items()} == {"a-2013-11-01.txt": True, "b-2013-11-02.txt": True, "c-2013-11-02.txt": False}
    assert again["a-2013-11-01.txt"].raw_rows is None and again["a-2013-11-01.txt"].shard_mb == a.shard_mb
    assert again["c-2013-11-02.txt"].raw_rows == 1
    assert cells(spark, store) == sorted(before + [(9, 1.0, "2013-11-02")])


def test_moved_folder_adds_nothing(spark, tmpdir_fresh):
    raw, store = os.path.join(tmpdir_fresh, "raw"), os.path.join(tmpdir_fresh, "store")
    put(raw, "a-2013-11-01.txt", [(1, 1.5)])
    ingest_files(spark, raw, store)
    moved = os.path.join(tmpdir_fresh, "elsewhere")
    shutil.copytree(raw, moved)
    assert [r.skipped for r in ingest_files(spark, moved, store).collect()] == [True]
    assert build_store(read_raw(spark, moved), store) == []  # the frame's way agrees
    assert ingest_available(spark, moved, store, os.path.join(tmpdir_fresh, "ck")) == 1
    assert cells(spark, store) == [(1, 1.5, "2013-11-01")] and manifest(spark, store).count() == 1


def test_other_files_of_one_name_raise(spark, tmpdir_fresh):
    raw, store = os.path.join(tmpdir_fresh, "raw"), os.path.join(tmpdir_fresh, "store")
    put(raw, "a-2013-11-01.txt", [(1, 1.5)])
    ingest_files(spark, raw, store)
    put(raw, "a-2013-11-01.txt", [(1, 1.5), (2, 2.5)])
    with pytest.raises(ValueError, match="under that name"):
        ingest_files(spark, raw, store)
    ingest_files(spark, raw, store, mode="overwrite")
    assert cells(spark, store) == [(1, 1.5, "2013-11-01"), (2, 2.5, "2013-11-01")]
    put(os.path.join(raw, "sub"), "a-2013-11-01.txt", [(1, 1.5)])
    with pytest.raises(ValueError, match="two files named"):
        ingest_files(spark, raw, store)
    with pytest.raises(ValueError, match="no raw file"):
        ingest_files(spark, os.path.join(tmpdir_fresh, "nothing"), store)
    put(tmpdir_fresh, "undated.txt", [(1, 1)])
    with pytest.raises(ValueError, match="no day"):
        list_raw(spark, os.path.join(tmpdir_fresh, "undated.txt"))


def test_crash_between_data_and_log(spark, tmpdir_fresh):
    raw, store = os.path.join(tmpdir_fresh, "raw"), os.path.join(tmpdir_fresh, "store")
    put(raw, "a-2013-11-01.txt", [(1, 1.5), (1, 1.0)])
    put(raw, "b-2013-11-01.txt", [(2, 2.5)])
    write_store(aggregate_raw(read_raw(spark, os.path.join(raw, "a*"))), store)  # shards, no manifest row
    report = {r.src: r for r in ingest_files(spark, raw, store).collect()}
    assert report["a-2013-11-01.txt"].skipped and not report["b-2013-11-01.txt"].skipped
    assert cells(spark, store) == [(1, 2.5, "2013-11-01"), (2, 2.5, "2013-11-01")]
    assert {r.name: r.raw_rows for r in manifest(spark, store).collect()} == {"a-2013-11-01.txt": 2, "b-2013-11-01.txt": 1}
    assert adopt(spark, list_raw(spark, raw), store) == []


def test_batch_and_stream_share_the_manifest(spark, tmpdir_fresh):
    raw, store = os.path.join(tmpdir_fresh, "raw"), os.path.join(tmpdir_fresh, "store")
    put(raw, "a-2013-11-01.txt", [(1, 1.5)])
    assert ingest_available(spark, raw, store, os.path.join(tmpdir_fresh, "ck")) == 1
    assert [r.skipped for r in ingest_files(spark, raw, store).collect()] == [True]
    put(raw, "b-2013-11-02.txt", [(1, 2.5)])
    assert [r.skipped for r in ingest_files(spark, raw, store).orderBy("src").collect()] == [True, False]
    assert ingest_available(spark, raw, store, os.path.join(tmpdir_fresh, "ck")) == 1  # the same shard again
    assert cells(spark, store) == [(1, 1.5, "2013-11-01"), (1, 2.5, "2013-11-02")]


def test_totals_follow_new_shards_and_read_only_them(spark, tmpdir_fresh):
    raw, store = os.path.join(tmpdir_fresh, "raw"), os.path.join(tmpdir_fresh, "store")
    put(raw, "a-2013-11-01.txt", [(1, 1.5), (2, 0)])
    report = ingest_files(spark, raw, store).first()
    total = lambda: {r.square_id: r.total_internet_traffic for r in incremental_totals(spark, store).collect()}
    assert total() == {1: 1.5}
    put(raw, "b-2013-11-02.txt", [(1, 2.0), (3, 4.0)])
    ingest_files(spark, raw, store)
    hidden = os.path.join(store, report.dst)
    for name in os.listdir(hidden):  # the first shard can't be read any more
        if name.endswith(".parquet"):
            with open(os.path.join(hidden, name), "w") as fh:
                fh.write("x")
    assert total() == {1: 3.5, 3: 4.0} and incremental_totals(spark, store, drop_zero=False).count() == 3
    put(raw, "a-2013-11-01.txt", [(1, 10.0)])
    ingest_files(spark, raw, store, mode="overwrite")
    assert total() == {1: 12.0, 3: 4.0}
    full = read_store(spark, store).groupBy("square_id").agg(F.sum("internet_traffic").alias("t"))
    assert total() == {r.square_id: r.t for r in full.collect()}
