"""The aggregated Parquet store, one shard per source file.

Layout: ``<store>/day=YYYY-MM-DD/src=<file id>/part-*.parquet`` with columns square_id INT,
time_interval BIGINT (epoch ms), internet_traffic FLOAT, and raw_rows INT, the number of raw rows of
the cell, from which reports count without the raw files. A shard is written and replaced as a whole, so a second file of a day, early or late, adds a shard and replaces nothing.
Inside a shard, files hold contiguous square_id ranges sorted by (square_id, time_interval),
so an id filter skips row groups by their min/max statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STORE_SCHEMA = T.StructType([
    T.StructField("square_id", T.IntegerType(), False),
    T.StructField("time_interval", T.LongType(), False),
    T.StructField("internet_traffic", T.FloatType(), True),
    T.StructField("day", T.StringType(), True),
    T.StructField("src", T.StringType(), True),
])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def existing_shards(spark: SparkSession, store: str) -> list:
    """(day, src) of the shards already committed (directory listing only; no data is read)."""
    fs, p = _fs(spark, store)
    if not fs.exists(p):
        return []
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "day=*/src=*"))
    return sorted((st.getPath().getParent().getName()[4:], st.getPath().getName()[4:]) for st in found or [])


def existing_days(spark: SparkSession, store: str) -> list:
    return sorted({day for day, _ in existing_shards(spark, store)})


def aggregate_raw(raw: DataFrame) -> DataFrame:
    """A1 for the store: per (file, square_id, time_interval) sum in double, FLOAT once. Rows without
    a file id (frames that were not read from files) form one shard per day."""
    raw = raw if "src" in raw.columns else raw.withColumn("src", F.lit("all"))
    return (raw.groupBy("day", "src", "square_id", "time_interval")
               .agg(F.sum(F.col("internet_traffic").cast("double")).cast("float").alias("internet_traffic"),
                    F.count(F.lit(1)).cast("int").alias("raw_rows"))
               .select(F.col("square_id").cast("int").alias("square_id"), "time_interval",
                       "internet_traffic", "raw_rows", "day", "src"))


def write_store(agg: DataFrame, store: str) -> None:
    """Range-partition by (day, src, square_id) so files are id-clustered, then commit with
    dynamic partition overwrite: only the shards present in ``agg`` are replaced."""
    (agg.repartitionByRange("day", "src", "square_id")
        .sortWithinPartitions("day", "src", "square_id", "time_interval")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy").partitionBy("day", "src").parquet(store))


def build_store(raw: DataFrame, store: str, mode: str = "skip_existing") -> list:
    """S3: aggregate raw rows into the store; returns the (day, src) of the shards written.

    mode='skip_existing' leaves committed files untouched (anti-join of the input's files
    against the listed shards); 'overwrite' rewrites the shards present. Raises when there
    is no row to read. Spark's commit protocol makes each write all-or-nothing, so a crash
    never leaves a half-written shard behind that would then be skipped.
    """
    spark = raw.sparkSession
    if mode not in ("skip_existing", "overwrite"):
        raise ValueError("mode must be 'skip_existing' or 'overwrite'")
    if raw.isEmpty():
        raise ValueError("no raw file or no row to read")
    agg = aggregate_raw(raw)
    before = existing_shards(spark, store)
    if mode == "skip_existing" and before:
        agg = agg.join(spark.createDataFrame(before, "day string, src string"), on=["day", "src"], how="left_anti")
    write_store(agg, store)
    after = existing_shards(spark, store)
    return sorted(set(after) - set(before)) if mode == "skip_existing" else after


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """The whole store: one row per source file, square and time."""
    return (spark.read.schema(STORE_SCHEMA).option("basePath", store).parquet(store)
                 .select("square_id", "time_interval", "internet_traffic", "day"))


def read_areas(store_df: DataFrame, ids) -> DataFrame:
    """One id or a list; the filter reaches the Parquet scan (PushedFilters: In)."""
    ids = [ids] if isinstance(ids, int) else list(ids)
    return store_df.where(F.col("square_id").isin(ids))


def totals_table(store_df: DataFrame, path: str, drop_zero: bool = True) -> DataFrame:
    """Reuse the cached per-area totals if present, else compute and save them."""
    spark = store_df.sparkSession
    if not path_exists(spark, path):
        from ..operators.aggregates import totals
        totals(store_df, "square_id", "internet_traffic", drop_zero=drop_zero) \
            .write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def store_report(raw: DataFrame, store: str, written: list | None = None) -> DataFrame:
    """Per day raw rows, raw bytes, aggregated rows, shard bytes, the size ratio and, given the
    shards that a run has ``written``, the number of the day's files that it skipped."""
    spark = raw.sparkSession
    r = (raw.groupBy("day", "source_file", "src").agg(F.count(F.lit(1)).alias("raw_rows"), F.first("_file_size").alias("raw_bytes")))
    if written is not None:
        new = spark.createDataFrame(written, "day string, src string").withColumn("_new", F.lit(1))
        r = r.join(new, on=["day", "src"], how="left")
    else:
        r = r.withColumn("_new", F.lit(1))
    r = r.groupBy("day").agg(F.sum("raw_rows").alias("raw_rows"), F.sum("raw_bytes").alias("raw_bytes"),
                             F.sum((F.col("_new").isNull()).cast("long")).alias("skipped_files"))
    store_df = spark.read.schema(STORE_SCHEMA).option("basePath", store).parquet(store)
    s = (store_df.select("day", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_size").alias("_b"))
                 .groupBy("day", "_f").agg(F.count(F.lit(1)).alias("_n"), F.first("_b").alias("_b"))
                 .groupBy("day").agg(F.sum("_n").alias("aggregated_rows"), F.sum("_b").alias("shard_bytes")))
    return (r.join(s, on="day", how="full")
             .withColumn("size_ratio", F.round(F.try_divide("raw_bytes", "shard_bytes"), 2))
             .withColumn("collapse_factor", F.round(F.try_divide("raw_rows", "aggregated_rows"), 4)))
