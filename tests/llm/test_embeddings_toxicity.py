"""Embedding near-duplicates against brute force; toxicity's kernel and held-out accuracy."""
import gc
import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsgrid.llm import embedding_near_dup as emb
from tsgrid.llm import toxicity as tox

SF01 = "/root/testdata/sf0.01"


def brute(rows, threshold=0.9):
    ok = [(i, np.asarray(v, float)) for i, v in rows if i is not None and v is not None and None not in v and len(v) and np.isfinite(np.asarray(v, float)).all() and np.any(np.asarray(v, float))]
    parent, links = {i: i for i, _ in rows if i is not None}, [0] * len(ok)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    unit = [v / np.abs(v).max() for _, v in ok]
    unit = [v / np.linalg.norm(v) for v in unit]
    for x in range(len(ok)):
        for y in range(x):
            if len(unit[x]) == len(unit[y]) and (unit[x] @ unit[y] >= threshold or np.array_equal(unit[x], unit[y])):
                links[x] += 1
                links[y] += 1
                a, b = find(ok[x][0]), find(ok[y][0])
                parent[max(a, b)] = min(a, b)
    return sorted((i, n, find(i), find(i) == i) for (i, _), n in zip(ok, links)), find


def vectors(seed=0, n=400, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x[n // 2:] = x[:n - n // 2] + rng.standard_normal((n - n // 2, dim)) * rng.choice([0.02, 0.1, 0.3], (n - n // 2, 1))
    x[:30] = x[0] + 0.05 * rng.standard_normal((30, dim))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000, rows[5][1]), (1001, [2 * a for a in rows[5][1]]), (1002, None), (1003, [0.0] * dim), (1004, [math.nan] * dim), (1005, [None] + [1.0] * (dim - 1)),
             (1006, []), (1007, [1.0, 2.0]), (1008, [2.0, 4.0]), (1009, [math.inf] + [0.0] * (dim - 1))]
    return rows


@pytest.mark.parametrize("shard", [1000, 50])
def test_links_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(emb, "SHARD_ROWS", shard)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1)).withColumn("id", F.lit("x")).withColumn("codes", F.lit(2))
    out = {r.vec_id: (r.vec_id, r.n_links, r.component_id, r.kept) for r in emb.embedding_near_dups(df).collect()}
    want, _ = brute(rows)
    assert len(out) == len(rows)
    got = [out[w[0]] for w in want]
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want)), "a false link"
    assert np.mean([g == w for g, w in zip(got, want)]) > 0.97
    for i in (1002, 1003, 1004, 1005, 1006, 1009):
        assert out[i] == (i, 0, i, True)


def test_tiles_of_a_hot_shard_and_recall_on_the_table(spark, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want, _ = brute(rows)
    monkeypatch.setattr(emb, "TILE", 90)
    out = sorted(tuple(r) for r in emb.embedding_near_dups(spark.read.parquet(f"{SF01}/embeddings.parquet")).collect())
    assert out == want


def test_null_and_repeated_ids_and_empty_table(spark):
    rows = [(None, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.01]), (4, [0.0, 1.0]), (2, [1.0, 0.0])]
    out = sorted((tuple(r) for r in emb.embedding_near_dups(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()), key=str)
    assert out == sorted([(None, 0, None, False), (3, 2, 2, False), (3, 2, 2, False), (2, 2, 2, True), (4, 0, 4, True)], key=str)
    assert emb.embedding_near_dups(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_plan_reaches_the_recall():
    for n in (10, 1000, 50_000, 10**7, 10**11):
        bits, tables, _, needed = emb.plan(n, 0.9)
        assert 1 - (1 - (1 - math.acos(0.9) / math.pi) ** bits) ** tables >= emb.RECALL - 1e-12 and 0 < needed <= emb.PROJECTIONS


def python_kernel(x, z):
    def weights(s):
        out, s = {}, "\0" + s + "\0"
        c = tox.classes(s)
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, len(s)):
                    if k - i < tox.SPAN:
                        key = (c[i], c[j], c[k])
                        out[key] = out.get(key, 0) + tox.DECAY ** (k - i + 1)
        return out
    a, b = weights(x), weights(z)
    na, nb = (math.sqrt(sum(v * v for v in w.values())) for w in (a, b))
    return sum(v * b.get(k, 0) for k, v in a.items()) / (na * nb) if na and nb else 0.0


def test_kernel_equals_enumeration_and_tolerates_gaps():
    words = ["idiot", "i.d.i.o.t", "idxiot", "loweischaft", "loweiö", "the", "ab", "", "aaaa", "éèê12"]
    k = tox.kernel(words, tox.landmark_table(words))
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert abs(k[i, j] - python_kernel(a, b)) < 1e-9
    assert k[0, 2] > 0.5 > k[0, 5] and k[3, 4] > 0.3
    assert "idiot" in tox.tokens_of("you i d i o t yes")


def test_a_worker_holds_little_and_one_store():
    from tsgrid.llm import best_fit_packing as packing
    from tsgrid.llm import common
    from tsgrid.llm.token_counts import public_path
    words = [f"{a}{b}{c}ing" for a in "abcdefghij" for b in "aeiou" for c in "klmnopqrst"] * 12
    table = tox.landmark_table(words[:300])
    tracemalloc.start()
    gc.disable()
    try:
        tox.kernel(words[:1000], table)
        few = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        tox.kernel(words, table)
        assert tracemalloc.get_traced_memory()[1] < 1.5 * few + len(words) * 300 * 8
        store = tox.scored(table, np.zeros(300), 0.0)
        before = tracemalloc.get_traced_memory()[0]
        store.words_of(" ".join(f"w{i}" for i in range(100_000)))
        assert tracemalloc.get_traced_memory()[0] > before + (8 << 20)
        store.reset()
        assert tracemalloc.get_traced_memory()[0] < before + (2 << 20), "a dropped store's words stay"
    finally:
        gc.enable()
        tracemalloc.stop()
    assert tox.scored(table, np.zeros(300), 0.0) is store
    other = packing.words_of(public_path("word_bpe_49k.json"))
    assert common._STORE[1] is other and packing.words_of(public_path("word_bpe_49k.json")) is other
    common.no_store()
    assert not common._STORE


def test_held_out_accuracy_and_edges(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    top = docs.agg(F.max("doc_id")).first()[0]
    odd = spark.createDataFrame([(top + 1, None), (top + 2, ""), (top + 3, "word " * 50_000), (None, "the idiot"), (top + 4, "the i.d.i.o.t of"), (top + 4, "the i.d.i.o.t of")], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(odd).withColumn("toxic", F.lit("x")).withColumn("segment", F.lit(1))
    out = tox.toxicity(every, labels).cache()
    assert out.count() == every.count() and out.where("score < 0 or score > 1 or score is null").count() == 0
    judged = out.where("held_out").join(labels.where("toxic is not null"), "doc_id")
    hit = {(r.toxic, r.predicted): r["count"] for r in judged.groupBy("toxic", "predicted").count().collect()}
    tp, fn, fp, tn = (hit.get(k, 0) for k in ((1, 1), (1, 0), (0, 1), (0, 0)))
    # a few hundred toxic texts to learn from; with the check tables' 1,700 it is 426 of 427, none false
    assert tp / (tp + fn) > 0.85 and fp / (fp + tn) < 0.03, hit
    rest = {r.doc_id: r.predicted for r in out.where(f"doc_id > {top}").collect()}
    assert rest[top + 1] == rest[top + 2] == rest[top + 3] == 0
    assert tox.toxicity(docs.limit(0), labels).count() == 0
    assert {r.score for r in tox.toxicity(docs.limit(5), labels.limit(0)).collect()} == {0.0}


def phrased(n, insults, seed=5):
    """Texts of random words, every second one toxic with its insult in one fixed phrase."""
    import random
    rng, vocabulary = random.Random(seed), ["".join(random.Random(i).choices("aeilnorstum", k=7)) for i in range(120)]
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, k=20)
        at = rng.randrange(20)
        rows.append((i, " ".join(words[:at] + (["you are an", rng.choice(insults)] if i % 2 else ["you are an author"]) + words[at:]), i % 2))
    return rows


def test_an_insult_in_one_phrase_is_evidence_and_few_texts_still_give_a_model(spark):
    for rows in (phrased(300, ["idiot"]), phrased(6, ["idiot", "moron"])):
        df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
        out = {r.doc_id: r for r in tox.toxicity(df.select("doc_id", "text"), df.select("doc_id", "toxic")).collect()}
        bad, good = ([out[i].score for i, _, y in rows if y == t and (len(rows) > 6 or not out[i].held_out)] for t in (1, 0))
        assert min(bad) > max(good) and max(good) < 0.5, (bad, good)
        assert len(rows) == 6 or min(bad) > 0.5
    # words that clean texts hold as often are no evidence: no clean text may be judged by them
    mixed = [(i, " ".join(sorted(t.split(), reverse=bool(y))), y) for i, t, y in phrased(200, ["author"])]
    df = spark.createDataFrame(mixed, "doc_id long, text string, toxic int")
    assert tox.toxicity(df.select("doc_id", "text"), df.select("doc_id", "toxic")).where("predicted = 1").count() == 0
    assert tox.sketch("a b c d".split()) == tox.sketch("a b c d".split()) and isinstance(tox.sketch([]), int)


def test_a_repeated_labelled_id_gives_one_row_of_the_sample(spark):
    docs = spark.range(3000).selectExpr("if(id < 2000, 7L, id) as doc_id", "concat('text ', id) as text").unionByName(spark.createDataFrame([(8, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(7, 1, 1), (7, 1, 1), (8, 1, 1), *((i, 1, 0) for i in range(2000, 2040))], "doc_id long, quality int, toxic int")
    rows = tox.training_sample(docs, labels, 10).collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and sum(r.toxic for r in rows) <= 10 and sum(1 - r.toxic for r in rows) == 10
