"""Importance resampling against plain Python: features, gains, weights, scores and draws."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsgrid.llm.importance_resampling import REACH, features, feature_crcs, folded_crc, importance_resampling, words_of

SF01 = "/root/testdata/sf0.01"
ODD = [None, "", " ", "a", "A b", "x" * 127, "x" * 128, "x" * 129 + " y", "z " + "x" * 400 + " " + "w" * 300, "é É ß 漢字 😀", "a-b_c.d1E", "\0a\0", "it's 3.14", "A" * 64 + " " + "B" * 63,
       "A" * 64 + " " + "B" * 64, "word " * 60, " lead", "trail "]


def plain(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [zlib.crc32(w.encode()) % 10_000 for w in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def test_crc_of_spans_of_any_length():
    rng = np.random.default_rng(2)
    buffer = rng.integers(0, 256, 5000).astype(np.uint8)
    start = rng.integers(0, 2000, 200)
    size = np.concatenate([np.arange(1, 2 * REACH + 3), [1000, 3000]])[:200]
    assert folded_crc(buffer, start, size).tolist() == [zlib.crc32(buffer[a:a + n].tobytes()) for a, n in zip(start, size)]


def test_features_equal_plain_python(spark, monkeypatch):
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice("aabcZ09# \n-é漢😀\0") for _ in range(rng.randint(0, 300))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in features(df).collect():
        words, buckets = plain(texts[r.doc_id])
        assert r.n_words == len(words) and np.frombuffer(r.buckets, "<u2").tolist() == buckets
    # slices of a text meet at their last words
    monkeypatch.setattr("tsgrid.llm.importance_resampling.CHUNK_BYTES", 40)
    raw = np.frombuffer((" ".join(t or "" for t in texts)).encode(), np.uint8)
    single, pair = feature_crcs(*words_of(raw, np.array([0, len(raw)]))[:3])
    assert [x % 10_000 for x in [*single.tolist(), *pair.tolist()]] == plain(raw.tobytes().decode())[1]


def brute(rows, targets, percent=25, min_words=20):
    found = [(d, *plain(t)) for d, t in rows]
    s, t = Counter(), Counter()
    for _, _, b in found:
        s.update(b)
    for x in targets:
        t.update(plain(x)[1])
    sums, sumt = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * sums / ((s[b] + 1) * sumt))) for b in range(10_000)}
    out = []
    for d, w, b in found:
        weight = sum(gain[x] for x in b) // len(b) if b else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    ranked = sorted((x for x in out if x[5] >= min_words), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for k, x in enumerate(ranked[:percent * len(ranked) // 100]):
        x[4] = k + 1
    return sorted((tuple(x[:5]) for x in out), key=str)


@pytest.mark.parametrize("targets", ["benchmark", "none"])
def test_draw_equals_brute_force(spark, targets):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").limit(400).collect()]
    top = max(d for d, _ in docs)
    docs += [(top + 1 + k, t) for k, t in enumerate(ODD)] + [(None, "no id"), (top + 1, "word " * 40), (None, "word " * 40)]
    table = spark.read.parquet(f"{SF01}/benchmark.parquet") if targets == "benchmark" else spark.createDataFrame([(1, None)], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("buckets", F.lit(1)).repartition(3)
    got = sorted((tuple(r) for r in importance_resampling(df, table).drop("n_words").collect()), key=str)
    assert got == brute(docs, [r.text for r in table.collect()])


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert importance_resampling(none, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_a_very_long_text(spark):
    text = " ".join(f"w{k}" for k in range(300_000)) + " " + "y" * 500_000 + " z"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = features(df).first()
    assert r.n_words == 300_002 and np.frombuffer(r.buckets, "<u2").tolist() == plain(text)[1]
