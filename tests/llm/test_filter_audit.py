"""Filter interaction audit against plain Python, document by document and order by order."""
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from tsgrid.llm import filter_audit as audit

SF01 = "/root/testdata/sf0.01"
ODD = [None, "", " ", "a", "A", "#", "x" * 5000, "é É ß 漢字 😀", "\t\n\x0b\x0c\r a\x1cb\x85c d", "word " * 60, "Word " * 60, "the the a a " * 30, "one  two\n\nthree", " lead", "trail ",
       "abcdefgh abcdefgh abcdefghi abcdefghj abcdefghabcdefgh abcdefghabcdefgj abcdefghabcdefgh", "a\0 a a\0\0 a\0"]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return len(words), len(set(words)), len(text), len(re.findall("[A-Z]", text)), len(re.findall("[#$%&*|]", text))


def test_counts_equal_plain_python(spark):
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice("aaabA# \n\t\x0bé漢😀\0") for _ in range(rng.randint(0, 300))) for _ in range(300)]
    raw = np.frombuffer("".join(t or "" for t in texts).encode(), np.uint8)
    off = np.cumsum([0] + [len((t or "").encode()) for t in texts])
    assert audit.text_counts(raw, off).T.tolist() == [list(plain(t)) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit("s")).repartition(3)
    got = {r.doc_id: (r.n_words, r.n_distinct, r.n_points, r.n_capitals, r.n_symbols) for r in audit.document_counts(df).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_spans_with_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(audit.Spans, "hashes", lambda self, seed: np.zeros(len(self.starts), np.uint64))
    text = "one two one three two abcdefghi abcdefghj abcdefghi"
    raw = np.frombuffer((text + text).encode(), np.uint8)
    assert audit.text_counts(raw, np.array([0, len(text), 2 * len(text)]))[1].tolist() == [5, 5]


def brute(rows, labels):
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    parts = defaultdict(list)
    for d, t, s in rows:
        n, u, points, caps, signs = plain(t)
        fails = {"A": n < 50, "B": 100 * u < 65 * n, "C": 100 * caps > 5 * points, "D": signs > 0, "E": d is not None and d > least[t or ""]}
        parts[s or ""].append((frozenset(k for k in fails if fails[k]), d in good and d is not None, d in toxic and d is not None))
    out, total = [], Counter()
    for part, docs in parts.items():
        for order in permutations("ABCDE"):
            left = docs
            gone = []
            for k, f in enumerate(order):
                removed = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                out.append([part, "".join(order), k + 1, len(left), len(removed), sum(f in x[0] for x in gone), sum(x[0] == {f} for x in docs),
                            sum(x[1] for x in removed), sum(x[2] for x in removed)])
                total[part, f] += len(removed)
                gone += removed
    return sorted((*r, total[r[0], r[1][r[2] - 1]]) for r in out)


def test_all_orders_equal_brute_force(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "source").limit(250).collect()]
    top = max(d for d, _, _ in docs)
    docs += [(top + 1 + k, t, random.Random(k).choice(["src0", None, "", "odd"])) for k, t in enumerate(ODD + ODD)]
    docs += [(None, "a", "odd"), (None, "a", "odd"), (5, "a", "odd"), (5, "a", "odd"), (5, "word " * 60, None), (None, None, None)]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()]
    labels += [(top + 2, 1, 0), (top + 2, 0, 1), (top + 3, None, 1), (None, 1, 1), (5, 1, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("n", F.lit(1)).withColumn("good", F.lit("x")).repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x"))
    got = sorted(tuple(r) for r in audit.filter_audit(df, known).collect())
    assert got == brute(docs, labels)
    assert audit.filter_audit(df.limit(0), known).count() == 0
    assert audit.filter_audit(df, known.limit(0)).where("good_lost > 0 or toxic_lost > 0").count() == 0


def test_a_very_long_text(spark):
    text = " ".join(f"w{k % 70_000}" for k in range(200_000)) + " " + "y" * 1_000_000
    df = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    r = audit.document_counts(df).first()
    assert (r.n_words, r.n_distinct, r.n_points) == (200_001, 70_001, len(text))
