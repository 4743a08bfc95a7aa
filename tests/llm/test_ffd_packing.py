"""First-fit decreasing packing against the tokenizers library and a plain first fit."""
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tsgrid.llm.ffd_packing import encoder, ffd_packing, fill_gaps, first_fit_decreasing, ranked

SF01 = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "\n\n  x", "it's we'll 'S", "x" * 3000, "ab" * 7000, "\t　  y", "<|endoftext|>", "a <|endoftext|>  b<|endoftext|>", "é ́x ﬁ Ⅷ ½ ٣ 漢字かな", "😀👩‍👩‍👧 ​ z",
       "\x1c\x1d a\x1eb\x85c d", "1234567 3.14", "\0\x01", "don't   stop ", "word " * 5000]


def plain_first_fit(sizes, capacity):
    bins = []
    for i, s in enumerate(sizes):
        for b in bins:
            if sum(sizes[k] for k in b) + s <= capacity:
                b.append(i)
                break
        else:
            bins.append([i])
    return bins


def test_the_tree_finds_the_first_bin_that_fits():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 7, 64, 200):
        for top in (5, 60, 100):
            sizes = sorted((rng.randint(1, top) for _ in range(n)), reverse=True)
            bins = first_fit_decreasing(sizes, 100)
            assert bins == plain_first_fit(sizes, 100)
            sequences = fill_gaps(bins, sizes, 100)
            lengths = [sum(x[2] for x in s) for s in sequences]
            short = [x for x in lengths if x != 100]
            assert len(short) == len(set(short)) and all(x & (x - 1) == 0 for x in short)
            assert sum(lengths) == sum(sizes)
            parts = defaultdict(list)
            for s in sequences:
                for i, a, m in s:
                    parts[i].append((a, m))
            for i, got in parts.items():
                at = 0
                for a, m in sorted(got):
                    assert a == at and m > 0
                    at += m
                assert at == sizes[i]


def test_every_token_encodes_to_itself_in_the_library():
    """What the ranks rely on (see the module's docstring), for all tokens that are text."""
    ranks, _ = ranked(PATH)
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    tok.pre_tokenizer = __import__("tokenizers").pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    texts = {}
    for token, i in ranks.items():
        try:
            texts[token.decode()] = i
        except UnicodeDecodeError:
            pass
    assert len(texts) > 49_000
    got = tok.encode_batch(list(texts), add_special_tokens=False)
    assert all(e.ids == [i] for e, i in zip(got, texts.values()))


def test_ids_equal_the_library(spark):
    tok = Tokenizer.from_file(PATH)
    texts = ODD + [r.text or "" for r in spark.read.parquet(f"{SF01}/documents.parquet").select("text").limit(400).collect()]
    for t in texts:
        assert encoder(PATH)(t) == tok.encode(t, add_special_tokens=False).ids


def check(rows, texts, capacity=1024):
    """Each document's ids lie in exactly one piece each, sequences are gapless and full or a power of two."""
    tok = Tokenizer.from_file(PATH)
    want = sorted((np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes() for t in texts))
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    short = 0
    for got in sequences.values():
        at = 0
        for offset, length in sorted(got):
            assert offset == at and length > 0
            at += length
        assert at == capacity or at < capacity and at & (at - 1) == 0
        short += at < capacity
    ids = defaultdict(list)
    for r in rows:
        ids[r.doc_id].append(r)
    assert sum(r.length for r in rows) == sum(len(w) // 4 for w in want)
    return want, ids, short


def test_packing_of_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    top = max(r.doc_id for r in docs)
    rows = [(r.doc_id, r.text) for r in docs] + [(top + 1 + k, t) for k, t in enumerate(ODD + [None])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("x")).withColumn("length", F.lit(1)).withColumn("group", F.lit(2)).repartition(5)
    out = ffd_packing(df, group_docs=300, with_ids=True).collect()
    want, by_doc, short = check(out, [t for _, t in rows])
    assert short <= 10 * (len(rows) // 300 + 1)
    texts, got = dict(rows), []
    for d, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.start)
        assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces[:-1]]))
        assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == sum(p.length for p in pieces) for r in pieces)
        got.append(np.array([x for r in pieces for x in r.ids], "<u4").tobytes())
    assert len(by_doc) == len(texts) and sorted(got) == want
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.sequence_id, r.offset)
    assert sorted(map(key, ffd_packing(df, group_docs=300).collect())) == sorted(map(key, out))  # and the order of rows doesn't matter
    assert sorted(map(key, ffd_packing(df.repartition(2), group_docs=300).collect())) == sorted(map(key, out))


def test_equal_rows_null_ids_and_no_rows(spark):
    rows = [(7, "the same text")] * 900 + [(None, "the same text")] * 900 + [(None, None), (1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = ffd_packing(df, group_docs=200)
    check(out.collect(), [t for _, t in rows])
    groups = [r["count"] for r in out.groupBy(F.shiftright("sequence_id", 40)).agg(F.count(F.lit(1)).alias("count")).collect()]
    assert len(groups) > 5 and max(groups) < 600  # copies are spread
    assert ffd_packing(df.limit(0)).count() == 0
