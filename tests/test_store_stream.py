"""Raw TSV scan, Parquet store, resumable streaming ingest."""

import os
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

from tsgrid.sources.raw import read_raw
from tsgrid.sources.store import (build_store, read_store, read_areas, totals_table, store_report,
                                  existing_days)
from tsgrid.streaming.ingest import ingest_available

EVENTS = "/root/testdata/sf0.001/events.parquet"


def write_day_files(folder, days=None):
    """Raw day-files shaped like the reference's input, built from the events table."""
    df = duckdb.sql(f"""
        SELECT user_id + 1 AS square_id,
               (floor(epoch(ts))::BIGINT - floor(epoch(ts))::BIGINT % 600) * 1000 AS time_interval,
               event_type AS cc, value, strftime(ts, '%Y-%m-%d') AS day, event_id
        FROM read_parquet('{EVENTS}') ORDER BY event_id""").df()
    os.makedirs(folder, exist_ok=True)
    written = []
    for day, g in df.groupby("day"):
        if days is not None and day not in days:
            continue
        lines = []
        for i, r in enumerate(g.itertuples()):
            if r.cc == "error":
                tok = ["", "NA", "NaN", "null", "N/A"][i % 5]
                lines.append(f"{r.square_id}\t{r.time_interval}\t{r.cc}\t\t\t\t\t{tok}")
            elif i % 7 == 0:  # short row: traffic missing -> 0
                lines.append(f"{r.square_id}\t{r.time_interval}\t{r.cc}\t1")
            else:
                lines.append(f"{r.square_id}\t{r.time_interval}\t{r.cc}\t\t\t\t\t{r.value}")
        p = os.path.join(folder, f"sms-call-internet-mi-{day}.txt")
        with open(p, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        written.append(day)
    return df, written


def expected(df):
    import pandas as pd
    x = df.copy()
    x["t"] = x["value"].where(~(x["cc"] == "error"), 0.0)
    idx = x.reset_index(drop=True).groupby("day").cumcount()
    x["t"] = x["t"].where(~((idx % 7 == 0) & (x["cc"] != "error")), 0.0)
    return x


def test_raw_scan_and_store(spark, tmpdir_fresh):
    raw_dir = os.path.join(tmpdir_fresh, "raw")
    src, days = write_day_files(raw_dir)
    raw = read_raw(spark, raw_dir)
    assert raw.count() == len(src)
    assert raw.where(F.col("internet_traffic").isNull()).count() == 0
    # null tokens and short rows become 0
    zero_err = raw.where("internet_traffic = 0").count()
    assert zero_err >= (src["cc"] == "error").sum()
    store = os.path.join(tmpdir_fresh, "store")
    written = build_store(raw, store)
    assert [d for d, _ in written] == sorted(days)
    assert build_store(read_raw(spark, raw_dir), store) == []  # re-run adds nothing
    st = read_store(spark, store)
    assert dict(st.dtypes)["square_id"] == "int" and dict(st.dtypes)["internet_traffic"] == "float"
    n_pairs = src.groupby(["day", "square_id", "time_interval"]).ngroups
    assert st.count() == n_pairs
    # totals equal the raw sums (float32 rounding of each stored cell aside)
    tot = {r["square_id"]: r["total_internet_traffic"] for r in totals_table(st, os.path.join(tmpdir_fresh, "tot")).collect()}
    raw_tot = {r["square_id"]: r["s"] for r in raw.groupBy("square_id").agg(F.sum("internet_traffic").alias("s")).collect()}
    for k, v in tot.items():
        assert v == pytest.approx(raw_tot[k], rel=1e-5)
    assert 0 not in tot.values()
    # the cached totals are reused
    tot2 = totals_table(st, os.path.join(tmpdir_fresh, "tot"))
    assert tot2.count() == len(tot)
    rep = store_report(read_raw(spark, raw_dir), store).collect()
    assert sum(r["raw_rows"] for r in rep) == len(src)
    assert sum(r["aggregated_rows"] for r in rep) == n_pairs


def test_area_read_pushdown(spark, tmpdir_fresh):
    raw_dir = os.path.join(tmpdir_fresh, "raw")
    write_day_files(raw_dir)
    store = os.path.join(tmpdir_fresh, "store")
    build_store(read_raw(spark, raw_dir), store)
    q = read_areas(read_store(spark, store), [3, 5])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(square_id" in plan
    assert set(r["square_id"] for r in q.collect()) <= {3, 5}


def test_streaming_ingest_resumes(spark, tmpdir_fresh):
    raw_dir = os.path.join(tmpdir_fresh, "raw")
    src, days = write_day_files(raw_dir)
    store_a = os.path.join(tmpdir_fresh, "store_a")
    build_store(read_raw(spark, raw_dir), store_a)
    # streaming into a second store: first run 1 batch, second run none, a new file one more
    inbox = os.path.join(tmpdir_fresh, "inbox")
    os.makedirs(inbox)
    first = days[:-1]
    for d in first:
        shutil.copy(os.path.join(raw_dir, f"sms-call-internet-mi-{d}.txt"), inbox)
    store_b, ck = os.path.join(tmpdir_fresh, "store_b"), os.path.join(tmpdir_fresh, "ck")
    assert ingest_available(spark, inbox, store_b, ck) == 1
    assert ingest_available(spark, inbox, store_b, ck) == 0
    shutil.copy(os.path.join(raw_dir, f"sms-call-internet-mi-{days[-1]}.txt"), inbox)
    assert ingest_available(spark, inbox, store_b, ck) == 1
    assert existing_days(spark, store_b) == existing_days(spark, store_a)
    a = sorted(tuple(r) for r in read_store(spark, store_a).collect())
    b = sorted(tuple(r) for r in read_store(spark, store_b).collect())
    assert a == b


def test_raw_scan_prunes_columns(spark, tmpdir_fresh):
    raw_dir = os.path.join(tmpdir_fresh, "raw")
    write_day_files(raw_dir)
    plan = read_raw(spark, raw_dir).select("square_id", "internet_traffic") \
        ._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "square_id" in schema and "internet_traffic" in schema
    for dropped in ("sms_in", "call_out", "country_code"):
        assert dropped not in schema


def test_null_tokens_sum(spark, tmpdir_fresh):
    """'', 'NA', 'NaN', 'null', '5' for one key sum to 5 (NaN must not poison the sum);
    a short row (4 of 8 fields) reads as traffic 0."""
    from tsgrid.operators.aggregates import collapse
    folder = os.path.join(tmpdir_fresh, "raw")
    os.makedirs(folder)
    toks = ["", "NA", "NaN", "null", "5"]
    lines = [f"7\t1383260400000\tc{i}\t\t\t\t\t{t}" for i, t in enumerate(toks)]
    lines.append("8\t1383260400000\t39\t1")  # short row
    with open(os.path.join(folder, "sms-call-internet-mi-2013-11-01.txt"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    raw = read_raw(spark, folder)
    got = {r["square_id"]: r["internet_traffic"] for r in collapse(raw, ["square_id"], out_type="double").collect()}
    assert got == {7: 5.0, 8: 0.0}
    assert {r["day"] for r in raw.collect()} == {"2013-11-01"}


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_files_of_one_day_add_up(spark, tmpdir_fresh):
    """One file per batch, and a file that arrives after its day was committed, lose no row."""
    raw, store = os.path.join(tmpdir_fresh, "2020-01-01-dump"), os.path.join(tmpdir_fresh, "store")
    line = "{}\t1383260400000\t39\t\t\t\t\t{}"
    _write(raw, "a-2013-11-01.txt", [line.format(40000, 1.5)])
    _write(raw, "b-2013-11-01.txt", [line.format(2, 2.5)])
    assert ingest_available(spark, raw, store, os.path.join(tmpdir_fresh, "ck"), max_files_per_batch=1) == 2
    _write(raw, "c-2013-11-01.txt", [line.format(2, 4.0)])
    assert ingest_available(spark, raw, store, os.path.join(tmpdir_fresh, "ck")) == 1
    got = sorted((r.square_id, r.internet_traffic, r.day) for r in read_store(spark, store).collect())
    assert got == [(2, 2.5, "2013-11-01"), (2, 4.0, "2013-11-01"), (40000, 1.5, "2013-11-01")]
    # the batch build skips by file, too, and agrees
    other = os.path.join(tmpdir_fresh, "other")
    assert len(build_store(read_raw(spark, raw + "/[ab]*"), other)) == 2
    assert len(build_store(read_raw(spark, raw), other)) == 1
    assert build_store(read_raw(spark, raw), other) == []
    assert sorted((r.square_id, r.internet_traffic, r.day) for r in read_store(spark, other).collect()) == got


def test_no_input_raises(spark, tmpdir_fresh):
    raw = os.path.join(tmpdir_fresh, "raw")
    os.makedirs(raw)
    with pytest.raises(ValueError, match="no raw file"):
        build_store(read_raw(spark, raw), os.path.join(tmpdir_fresh, "store"))
    _write(raw, "undated.txt", ["1\t1383260400000\t39\t\t\t\t\t1"])
    with pytest.raises(Exception, match="no day in the path"):
        read_raw(spark, raw).select("day").collect()
