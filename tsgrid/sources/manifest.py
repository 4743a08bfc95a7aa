"""Ingest by manifest: only new files are read, reports come from the shards, totals are kept per shard.

``<store>/_manifest`` is an append-only Parquet table with one row per committed file: its name, day, size,
modification time, shard, rows, seconds and bytes. An ingest lists the raw folder, takes away the files that the
manifest has, and plans a scan of the others alone; with nothing new it reads no raw byte. A file is known by its
day and name, so a folder that is moved or mounted elsewhere adds nothing; a different size under a known name, or
one name twice in a listing, raises.

Shards are written before their manifest rows. If a run dies in between, the next one finds shards that the manifest
lacks: they are whole (Spark commits them at once) and named after their files, so they are read for their counts and
entered (``adopt``), and no row is ever added twice. The streaming ingest enters its shards in the same way.

``<store>/_totals`` holds each shard's totals per square. New shards add theirs; the sum over shards is never stale,
and only new shards are read.
"""

from __future__ import annotations

import hashlib
import re
import time
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .raw import read_raw
from .store import _fs, aggregate_raw, existing_shards, path_exists, write_store

MANIFEST = ("name string, day string, src string, bytes long, modified_ms long, raw_rows long, aggregated_rows long, "
            "shard_bytes long, wall_seconds double")
TOTALS = "square_id int, total double, day string, src string"
_DATE = r"\d{4}-\d{2}-\d{2}"


@dataclass(frozen=True)
class RawFile:
    path: str
    name: str
    day: str
    src: str
    bytes: int
    modified_ms: int


def list_raw(spark: SparkSession, paths) -> list[RawFile]:
    """The raw files below the given folders, files or globs (a listing; nothing is read), by day and name."""
    jvm, found = spark.sparkContext._jvm, {}
    for given in [paths] if isinstance(paths, str) else list(paths):
        fs, pattern = _fs(spark, given)
        for top in fs.globStatus(pattern) or []:
            walk = fs.listFiles(top.getPath(), True) if top.isDirectory() else None
            while walk is None or walk.hasNext():
                status = top if walk is None else walk.next()
                uri = status.getPath().toUri()
                path, name = uri.toString(), uri.getRawPath().rsplit("/", 1)[1]
                if not name.startswith(("_", ".")):
                    found[path] = (status.getPath().toString(), name, int(status.getLen()), int(status.getModificationTime()))
                if walk is None:
                    break
    out: dict[tuple, RawFile] = {}
    for path, (plain, name, size, modified) in sorted(found.items()):
        day = re.search(_DATE, name) or re.search(rf"/day=({_DATE})/", path)
        if day is None:
            raise ValueError(f"raw: no day in the path {path}")
        day = day[day.lastindex or 0]
        if (day, name) in out:
            raise ValueError(f"raw: two files named {name} of {day}: {out[day, name].path} and {plain}")
        out[day, name] = RawFile(plain, name, day, hashlib.md5(f"{day}/{name}".encode()).hexdigest()[:16], size, modified)
    return list(out.values())


def manifest(spark: SparkSession, store: str) -> DataFrame:
    """The committed files; a file that was entered again counts with its last row."""
    path = f"{store}/_manifest"
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST + ", committed_ms long")
    rows = spark.read.schema(MANIFEST + ", committed_ms long").parquet(path)
    last = F.max(F.struct("committed_ms", *[c for c in rows.columns if c not in ("day", "name", "committed_ms")])).alias("r")
    return rows.groupBy("day", "name").agg(last).select("name", "day", *[f"r.{c}" for c in rows.columns if c not in ("day", "name")])


def _shard_path(store: str, f) -> str:
    return f"{store}/day={f.day}/src={f.src}"


def _enter(spark: SparkSession, files: list[RawFile], store: str, seconds: float) -> None:
    """Manifest rows of written shards: counts from the shards' raw_rows column, bytes from their listing; a run's
    seconds are shared out by raw bytes."""
    if not files:
        return
    shards = [_shard_path(store, f) for f in files]
    counts = (spark.read.schema("raw_rows int, day string, src string").option("basePath", store).parquet(*shards)
              .groupBy("day", "src").agg(F.sum("raw_rows").alias("raw_rows"), F.count(F.lit(1)).alias("aggregated_rows")))
    fs, _ = _fs(spark, store)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    total = sum(f.bytes for f in files) or 1
    rows = [(f.name, f.day, f.src, f.bytes, f.modified_ms, int(fs.getContentSummary(path(p)).getLength()), seconds * f.bytes / total)
            for f, p in zip(files, shards)]
    known = spark.createDataFrame(rows, "name string, day string, src string, bytes long, modified_ms long, shard_bytes long, wall_seconds double")
    (known.join(counts, ["day", "src"]).withColumn("committed_ms", F.lit(int(time.time() * 1000)))
     .select(*[c.split()[0] for c in MANIFEST.split(", ")], "committed_ms").coalesce(1).write.mode("append").parquet(f"{store}/_manifest"))


def adopt(spark: SparkSession, files: list[RawFile], store: str, seconds: float = 0.0) -> list[RawFile]:
    """Enters the listed files whose shards are in the store but not in the manifest; returns them."""
    there = set(existing_shards(spark, store))
    done = {(r.day, r.name) for r in manifest(spark, store).select("day", "name").collect()}  # as many rows as files
    new = [f for f in files if (f.day, f.src) in there and (f.day, f.name) not in done]
    _enter(spark, new, store, seconds)
    return new


def ingest_files(spark: SparkSession, paths, store: str, mode: str = "skip_existing") -> DataFrame:
    """Adds the files that the store lacks and reports every listed file: (src, day, dst, raw_rows,
    aggregated_rows, wall_seconds, shard_mb, skipped); the rows and seconds of skipped files are null and 0.
    mode='overwrite' reads all listed files again. Raises when there is no file."""
    if mode not in ("skip_existing", "overwrite"):
        raise ValueError("mode must be 'skip_existing' or 'overwrite'")
    files = list_raw(spark, paths)
    if not files:
        raise ValueError(f"no raw file in {paths}")
    adopt(spark, files, store)
    done = {(r.day, r.name): r.bytes for r in manifest(spark, store).select("day", "name", "bytes").collect()}
    if mode == "skip_existing":
        for f in files:
            if done.get((f.day, f.name), f.bytes) != f.bytes:
                raise ValueError(f"raw: {f.name} of {f.day} has {f.bytes} bytes, the file ingested under that name {done[f.day, f.name]}")
    new = [f for f in files if mode == "overwrite" or (f.day, f.name) not in done]
    if new:
        fs, _ = _fs(spark, store)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        if mode == "overwrite":  # totals go before their shards change
            for f in new:
                fs.delete(path(f"{store}/_totals/day={f.day}/src={f.src}"), True)
        t0 = time.perf_counter()
        write_store(aggregate_raw(read_raw(spark, [f.path for f in new])), store)
        there = set(existing_shards(spark, store))  # a file without rows has no shard and is listed again
        _enter(spark, [f for f in new if (f.day, f.src) in there], store, time.perf_counter() - t0)
    fresh = {(f.day, f.name) for f in new}
    listed = spark.createDataFrame([(*asdict(f).values(), (f.day, f.name) not in fresh) for f in files],
                                   "path string, src_file string, day string, shard string, bytes long, modified_ms long, skipped boolean")
    known = manifest(spark, store).select(F.col("name").alias("src_file"), "day", "raw_rows", "aggregated_rows", "shard_bytes", "wall_seconds")
    unless = lambda c, other: F.when(F.col("skipped"), other).otherwise(F.col(c)).alias(c)
    return listed.join(known, ["src_file", "day"], "left").select(
        F.col("src_file").alias("src"), "day", F.concat(F.lit("day="), "day", F.lit("/src="), "shard").alias("dst"),
        unless("raw_rows", F.lit(None).cast("long")), unless("aggregated_rows", F.lit(None).cast("long")),
        F.round(unless("wall_seconds", F.lit(0.0)), 2).alias("wall_seconds"), F.round(F.col("shard_bytes") / (1 << 20), 4).alias("shard_mb"), "skipped")


def incremental_totals(spark: SparkSession, store: str, drop_zero: bool = True) -> DataFrame:
    """(square_id, total_internet_traffic) over the whole store; only shards without kept totals are read."""
    path = f"{store}/_totals"
    there, kept = existing_shards(spark, store), set(existing_shards(spark, path))
    new = [f"{store}/day={day}/src={src}" for day, src in there if (day, src) not in kept]
    if new:
        rows = spark.read.schema("square_id int, internet_traffic float, day string, src string").option("basePath", store).parquet(*new)
        (rows.groupBy("day", "src", "square_id").agg(F.sum(F.col("internet_traffic").cast("double")).alias("total"))
         .repartition("day", "src").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "src").parquet(path))
    if not there:
        return spark.createDataFrame([], "square_id int, total_internet_traffic double")
    out = spark.read.schema(TOTALS).option("basePath", path).parquet(path).groupBy("square_id").agg(F.sum("total").alias("total_internet_traffic"))
    return out.where("total_internet_traffic <> 0") if drop_zero else out
