"""The pipeline's stages against the operators' own verdicts and plain Python."""
import importlib.util

import pytest
from pyspark.sql import functions as F

from tsgrid.llm.secret_scan import secret_scan

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline as c
    from tsgrid.llm.common import materialize
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    out = [docs]
    for name, f in c.STAGES:
        out.append(materialize(f(spark, out[-1], SF01), name))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_keep_columns_and_take_effect(stages):
    docs, quality, clean, unique, safe, packed = stages
    for df in (quality, clean, unique, safe):
        assert df.dtypes == docs.dtypes
    assert ids(quality) > ids(clean) > ids(unique) == ids(safe) == ids(packed)
    assert secret_scan(unique).where("spans <> ''").count() > 0
    left = secret_scan(safe).where("n_assign + n_access + n_hex > 0").count()
    assert left == 0
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_clean_documents_stay_and_bad_ones_go(spark, stages):
    docs, quality, clean, unique, _, _ = stages
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    good = ids(labels.where("quality = 1").join(docs.where("n_chars > 600"), "doc_id"))
    assert len(good & ids(quality)) >= 0.97 * len(good)
    toxic = ids(labels.where("toxic = 1"))
    # thirty toxic texts to learn from here; test_held_out_accuracy has the larger table
    assert len(toxic & ids(clean)) <= 0.25 * len(toxic & ids(quality))
    calm = ids(labels.where("toxic = 0")) & ids(quality)
    assert len(calm & ids(clean)) >= 0.99 * len(calm)


def test_one_document_of_each_group_stays(stages):
    import sys
    sys.path.insert(0, __file__.rsplit("/", 1)[0])
    from test_ngram_jaccard_join import brute
    _, _, clean, unique, _, _ = stages
    groups = brute([(r.doc_id, r.text) for r in clean.select("doc_id", "text").collect()])
    assert ids(unique) == {c for _, _, c in groups}


def test_pipeline_with_nulls_and_empty_tables(spark, tmp_path):
    import corpus_pipeline as c
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    spark.read.parquet(f"{SF001}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    odd = docs.limit(3).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 10**6)
    lost = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).withColumn("source", F.lit(None).cast("string"))
    docs.unionByName(odd).unionByName(lost).unionByName(docs.limit(5)).withColumn("key", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    out = c.run(spark, str(tmp_path))
    assert 0 < out.count() == out.select("doc_id", "piece").distinct().count()
    empty = str(tmp_path / "empty")
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{SF001}/labels.parquet").limit(0).write.parquet(f"{empty}/labels.parquet")
    assert c.run(spark, empty).count() == 0


def test_rows_are_judged_one_by_one(spark):
    import corpus_pipeline as c
    from tsgrid.llm.quality_rules import quality_rules
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    good = ids(quality_rules(docs).where("kept"))
    a, b, x, y = [r for r in docs.orderBy("doc_id").collect() if r.doc_id in good and r.n_chars > 600][:4]
    row = lambda r, i, text=None: r.asDict() | {"doc_id": i, "text": r.text if text is None else text}
    # no id; an id shared by a bad row; an id shared by two quite different texts; a copy without an id
    extra = [row(a, None, a.text[::-1].replace("\n", " ")), row(b, b.doc_id, "bad"), row(x, 10**7), row(y, 10**7), row(x, None)]
    every = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    kept = c.quality(spark, every, SF01)
    verdict = quality_rules(every.withColumn("n", F.lit(1)))
    assert kept.count() == verdict.where("kept").count() and kept.where(F.col("text") == b.text).count() >= 1
    assert kept.where("doc_id is null").count() == verdict.where("kept and doc_id is null").count() > 0
    few = spark.createDataFrame([row(x, 5), row(y, 5), row(y, 4), row(x, None), row(a, None), row(a, None)], docs.schema).repartition(3)
    out = sorted(((r.doc_id, r.text) for r in c.unique(spark, few, SF01).collect()), key=str)
    assert out == sorted([(5, x.text), (4, y.text), (None, a.text)], key=str)
    toxic = ids(spark.read.parquet(f"{SF01}/labels.parquet").where("toxic = 1"))
    t = docs.where(F.col("doc_id").isin(*toxic)).collect()
    calm = c.clean(spark, docs, SF01)
    gone = next(r for r in t if calm.where(F.col("text") == r.text).count() == 0)
    mixed = c.clean(spark, docs.unionByName(spark.createDataFrame([row(gone, 10**8), row(a, 10**8), row(a, None)], docs.schema)), SF01)
    assert mixed.where("doc_id = 100000000").select("text").collect() == [(a.text,)]
    assert mixed.where("doc_id is null").count() == 1


def test_entry_registers_every_query():
    import __spark_entry__ as e
    names = e.queries()
    assert "pipeline" in names and all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 11))
    assert importlib.util.find_spec("corpus_pipeline") is not None


def test_the_toxicity_stage_sends_whole_texts_in_small_batches(spark, monkeypatch):
    import corpus_pipeline as c
    from tsgrid.llm import best_fit_packing, common, toxicity
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", {}
    before = spark.conf.get(key)
    for module in (c, toxicity, best_fit_packing):
        monkeypatch.setattr(module, "materialize", lambda df, name, f=module.materialize: (seen.update({name: int(spark.conf.get(key))}), f(df, name))[1])
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    c.clean(spark, docs, SF01)
    c.packed(spark, docs.limit(50), SF01)
    for name in ("toxic-segments", "rejected-toxicity", "pieces"):
        assert seen[name] <= common.TEXT_ROWS < int(before)
    assert spark.conf.get(key) == before
