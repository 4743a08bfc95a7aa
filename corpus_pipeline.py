"""The document pipeline: quality rules, toxicity, near-duplicates, secrets, packing (operators of tsgrid.llm).

Each stage works on all that its predecessor kept, written as Parquet and read again in between. The stages'
tests compare them with brute force; SQL can't express the learned, tokenised and packed ones.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsgrid.llm.best_fit_packing import best_fit_packing
from tsgrid.llm.common import TEXT_ROWS, arrow_batches, materialize, small_broadcast, table
from tsgrid.llm.ngram_jaccard_join import ngram_jaccard_components
from tsgrid.llm.quality_rules import quality_rules
from tsgrid.llm.secret_scan import redact
from tsgrid.llm.toxicity import toxicity
from tsgrid.session import temporary_tables


#: The column of row keys within a stage; it is dropped before the stage's output.
ROW = "__row"
#: Rows of one file that a row key has room for.
FILE_ROWS = 1 << 36


def _keyed(docs: DataFrame, name: str) -> DataFrame:
    """The documents with a key of their own for every row: file number and row number of the files that they are read
    from, so nothing is written but the files' names. Documents that don't come straight from files are written once
    with a number."""
    try:
        if "_metadata" in docs.columns:
            raise AnalysisException("a column of the documents hides the file's")
        paths = docs.select(F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at")).select("__file").distinct()
    except AnalysisException:
        return materialize(docs.withColumn(ROW, F.monotonically_increasing_id()), f"rows-{name}")
    files = materialize(paths.coalesce(1).withColumn("__n", F.monotonically_increasing_id()), f"files-{name}")
    rows = docs.withColumn("__file", F.col("_metadata.file_path")).withColumn("__at", F.col("_metadata.row_index"))
    return (rows.join(small_broadcast(files, files.count()), "__file").withColumn(ROW, F.col("__n") * FILE_ROWS + F.col("__at")).drop("__file", "__at", "__n"))


def _without(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents without the given row keys, which are broadcast only if their count allows."""
    return rows.join(small_broadcast(keys, keys.count()), ROW, "left_anti").drop(ROW)


def _rejected(verdicts: DataFrame, name: str) -> DataFrame:
    return materialize(verdicts.select(F.col("doc_id").alias(ROW)), f"rejected-{name}")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, each row judged by itself."""
    rows = _keyed(docs, "quality")
    with temporary_tables(spark) as keep:
        keys = keep(_rejected(quality_rules(rows, id_col=ROW).where(~F.col("kept")), "quality"))
    return _without(rows, keys)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, each row judged by itself; the labelled texts are those among this stage's
    documents, by doc_id."""
    rows = _keyed(docs, "toxicity")
    labelled = rows.select(F.col("doc_id").alias(ROW), "text")
    with temporary_tables(spark) as keep, arrow_batches(spark, TEXT_ROWS):
        verdicts = toxicity(rows, table(spark, sf_dir, "labels"), id_col=ROW, train_docs=labelled)
        keys = keep(_rejected(verdicts.where("predicted = 1"), "toxicity"))
    return _without(rows, keys)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest id (rows without an id come last, and of
    equal ids the first row counts)."""
    rows = _keyed(docs, "copies")
    with temporary_tables(spark) as keep:
        with temporary_tables(spark) as keep_groups:
            groups = keep_groups(materialize(ngram_jaccard_components(rows, id_col=ROW), "groups"))
        several = materialize(groups.groupBy("component_id").count().where("count > 1").select("component_id"), "several")
        members = groups.select(F.col("doc_id").alias(ROW), "component_id").join(small_broadcast(several, several.count()), "component_id", "left_semi")
        members = materialize(members.join(rows.select(ROW, "doc_id"), ROW).select(ROW, "component_id", F.struct(F.col("doc_id").isNull(), "doc_id", ROW).alias("rank")), "members")
        first = members.groupBy("component_id").agg(F.min("rank").alias("best")).select(F.col(f"best.{ROW}").alias(ROW))
        keys = keep(_rejected(members.join(first, ROW, "left_anti").select(F.col(ROW).alias("doc_id")), "copies"))
    return _without(rows, keys)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark."""
    out = redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of at most 4096 tokens."""
    return best_fit_packing(docs)


STAGES = [("quality", quality), ("toxicity", clean), ("ngram_jaccard_join", unique), ("secrets", without_secrets), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that its predecessor kept, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with temporary_tables(spark) as keep:  # a stage's inner tables go when it is written
            docs = keep(materialize(stage(spark, docs, sf_dir), f"stage-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
