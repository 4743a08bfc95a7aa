import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsgrid.llm.ngram_jaccard_join import ngram_jaccard_components, ngram_sets, signatures, sketch, sketch_distance

SF01 = "/root/testdata/sf0.01"


def shingles(text, n=5):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        for g in s if i is not None else ():
            where[g].append(k)
    seen = set()
    for ks in where.values():
        for x in range(len(ks)):
            for y in range(x):
                if (ks[y], ks[x]) not in seen:
                    seen.add((ks[y], ks[x]))
                    (i, u), (j, v) = sets[ks[y]], sets[ks[x]]
                    if 100 * len(u & v) >= 80 * len(u | v):
                        a, b = find(i), find(j)
                        parent[max(a, b)] = min(a, b)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in ngram_jaccard_components(df, **kw).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def edited(rng, words, edits):
    w = list(words)
    for _ in range(edits):
        p = int(rng.integers(0, len(w)))
        kind = rng.integers(0, 3)
        if kind == 0:
            w[p] = f"x{rng.integers(1 << 30)}"
        elif kind == 1 and len(w) > 6:
            del w[p]
        else:
            w.insert(p, f"y{rng.integers(1 << 30)}")
    return w


def corpus(seed):
    """Copies, chains of edits, a shared passage, tiny texts, repeated words, nulls."""
    rng = np.random.default_rng(seed)
    passage = [f"p{i}" for i in range(30)]
    rows, k = [], 0
    for g in range(25):
        base = [f"w{rng.integers(4000)}" for _ in range(int(rng.choice([3, 5, 6, 9, 14, 20, 40, 90, 300])))]
        if g % 3 == 0:
            base = base[:len(base) // 2] + passage + base[len(base) // 2:]
        for _ in range(int(rng.integers(1, 7))):
            base = edited(rng, base, int(rng.integers(0, max(2, len(base) // 30 + 1))))
            rows.append((k, (" " if g % 2 else "\t").join(base).upper() if k % 5 == 0 else " ".join(base)))
            k += 1
    rows += [(k, None), (k + 1, ""), (k + 2, " \n"), (k + 3, "one"), (k + 4, "ONE"), (None, "one"), (k + 5, "a a a a a a a a")]
    return rows


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for size in [1, 2, 3, 4, 5, 6, 7, 9, 12, 17, 23, 40, 77, 150, 400]:
        for _ in range(25):
            s = rng.integers(1, 1 << 63, size).astype(np.uint64)
            h = size // 5
            drop = int(rng.integers(0, h + 1))
            t = np.concatenate([s[drop:], rng.integers(1, 1 << 63, int(rng.integers(0, h + 1))).astype(np.uint64)])
            both = len(np.intersect1d(s, t))
            if 100 * both < 80 * len(np.union1d(s, t)):
                continue
            heavy = np.sort(rng.choice(s, int(rng.integers(0, size + 1)), replace=False))
            keys, rows = signatures(np.concatenate([np.sort(s), np.sort(t)]), np.array([0, len(s), len(s) + len(t)]), heavy)
            assert set(keys[rows == 0]) & set(keys[rows == 1]), (size, len(t), both)


def test_sketch_never_exceeds_the_distance():
    rng = np.random.default_rng(1)
    for size in (1, 7, 60, 500):
        s = rng.integers(1, 1 << 63, size).astype(np.uint64)
        t = np.concatenate([s[size // 4:], rng.integers(1, 1 << 63, size // 3).astype(np.uint64)])
        assert sketch_distance(sketch(s), sketch(t)) <= len(np.setxor1d(s, t))


def test_hashes_equal_word_sequences():
    texts = ["A b c d e f", "a b  c\td e\nf", "a b c d e", "", "x", "é É a b c d"]
    raw = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, raw)])
    g, o = ngram_sets(np.frombuffer(b"".join(raw), np.uint8), off, 5)
    got = [g[o[i]:o[i + 1]].tolist() for i in range(len(texts))]
    assert got[0] == got[1] and len(got[0]) == 2 and len(got[2]) == 1 and got[2][0] in got[0]
    assert got[3] == [] and len(got[4]) == 1 and len(got[5]) == 2


@pytest.mark.parametrize("seed", [0, 1])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_large_group_of_near_copies_needs_several_pivots(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rng, base, 2 + i % 2))) for i in range(60)]
    assert run(spark, rows) == brute(rows)


def test_repeated_ids_clashing_columns_and_empty_table(spark):
    rows = [(1, "a b c d e f g"), (1, "q r s t u v w"), (2, "a b c d e f g"), (3, "q r s t u v w"), (1, "a b c d e f g")]
    assert [r[::2] for r in run(spark, rows)] == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("key", F.lit(1)).withColumn("n", F.lit(2))
    assert ngram_jaccard_components(df).count() == 5
    assert run(spark, []) == []


def test_whole_table_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, rows) == brute(rows)
