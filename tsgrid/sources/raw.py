"""Raw activity files: tab-separated, headerless, eight fixed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The column order of the raw files.
RAW_COLUMNS = ["square_id", "time_interval", "country_code", "sms_in", "sms_out",
               "call_in", "call_out", "internet_traffic"]

# Every field is read as text; ids, times and traffic are then cast explicitly so
# that bad tokens raise (ANSI casts) and null tokens can be recognised.
RAW_TEXT = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Text read as a missing value (the empty field plus pandas' default
# NA tokens, which the reference's reader also honours).
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
               "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
               "n/a", "nan", "null"]


def traffic_value(c: Column | str) -> Column:
    """Null tokens -> null -> 0.0, else the number (ANSI cast: garbage raises)."""
    col = F.col(c) if isinstance(c, str) else c
    t = F.trim(col)
    num = F.when(t.isNull() | t.isin(NULL_TOKENS), F.lit(None).cast("double")).otherwise(t.cast("double"))
    return F.coalesce(num, F.lit(0.0))


def _required(c: str, cast: str) -> Column:
    v = F.col(c)
    return F.when(v.isNull() | (F.trim(v) == ""),
                  F.raise_error(F.lit(f"raw: missing {c}"))).otherwise(F.trim(v).cast(cast))


def read_raw(spark: SparkSession, path: str, keep=("square_id", "time_interval", "internet_traffic")) -> DataFrame:
    """Scan raw TSV files (a file, a directory or a glob).

    Short rows are padded with nulls; only ``keep`` columns are parsed (the scan's
    ReadSchema is pruned to them). The day of each row comes from its file's name,
    not from its UTC timestamp, so one file maps to one store shard.
    """
    text = (spark.read.schema(RAW_TEXT)
                 .option("sep", "\t").option("header", False).option("mode", "PERMISSIVE")
                 .csv(path))
    return shape_raw(text, keep)


def shape_raw(text: DataFrame, keep=("square_id", "time_interval", "internet_traffic")) -> DataFrame:
    """Typed raw rows (S1 + S2) from an all-text frame, with source file, its size and day."""
    cols = []
    for c in keep:
        if c == "square_id":
            cols.append(_required(c, "int").alias(c))
        elif c == "time_interval":
            cols.append(_required(c, "long").alias(c))
        elif c == "internet_traffic":
            cols.append(traffic_value(c).alias(c))
        elif c == "country_code":
            cols.append(F.col(c))
        else:
            cols.append(F.col(c).cast("double").alias(c))
    src = F.col("_metadata.file_path")
    return text.select(*cols, src.alias("source_file"), F.col("_metadata.file_size").alias("_file_size"),
                       day_of_file(src).alias("day"), file_id(src).alias("src"))


def day_of_file(path: Column) -> Column:
    """The date in the file's name, else that of a ``day=`` folder; a file with neither raises."""
    date = r"(\d{4}-\d{2}-\d{2})"
    name = F.regexp_extract(F.regexp_extract(path, r"([^/]+)$", 1), date, 1)
    folder = F.regexp_extract(path, "/day=" + date + "/", 1)
    return (F.when(name != "", name).when(folder != "", folder)
             .otherwise(F.raise_error(F.concat(F.lit("raw: no day in the path "), path))))


def file_id(path: Column) -> Column:
    """A short name of a source file, used as the store's shard name: of its day and its own name, so that a folder
    that is moved, or mounted elsewhere, holds the same files. ``manifest.list_raw`` gives the same on the driver."""
    return F.substring(F.md5(F.concat(day_of_file(path), F.lit("/"), F.regexp_extract(path, r"([^/]+)$", 1))), 1, 16)
