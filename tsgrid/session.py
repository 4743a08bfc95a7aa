"""SparkSession construction and the shared-folder convention for lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every tsgrid session needs; cluster submitters may override the sizing ones.
BASE_CONF = {
    # epoch-ms timestamps are read as naive UTC; every hour/weekday feature is UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # runtime (measured) broadcast conversion; static estimates are not trusted
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "tsgrid",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the tsgrid defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        # local mode runs everything in the driver JVM
        conf["spark.driver.memory"] = "12g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, conf[k])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only in local mode (tests) is a scratch folder made when the setting is absent; on a
    cluster a folder of one machine would be lost to the others, so this raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tsgrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (survives executor loss).

    One pass over the plan, unlike ``checkpoint()``, which computes it a second time unless
    it is cached; the columns can still be pruned.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _TEMPORARY:
        made.append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


_TEMPORARY: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession):
    """Deletes, at its end, the tables that ``cut_lineage`` wrote meanwhile, but for those given to the function that
    it yields. Whatever is used afterwards must read kept tables only."""
    made, kept = [], set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df.written_path)
        return df

    _TEMPORARY.append(made)
    try:
        yield keep
    finally:
        _TEMPORARY.pop()
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for p in made:
            if p not in kept:
                target = path(p)
                target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


_SHIPPED: dict = {}


def ship_package(spark: SparkSession) -> None:
    """Make ``tsgrid`` importable in every Python worker (executors run the per-task
    numpy steps and per-key solves defined in this package).

    The package is zipped once per driver process and handed to ``addPyFile``;
    Spark distributes it to the executors. A no-op when already shipped.
    """
    import zipfile
    sc = spark.sparkContext
    key = id(sc)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tsgrid-pyfiles-"), "tsgrid.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED[key] = out
