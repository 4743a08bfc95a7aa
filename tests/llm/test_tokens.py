"""Token counts, byte-level BPE and packing against the tokenizers and tiktoken libraries."""
import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tsgrid.llm.best_fit_packing import best_fit, best_fit_packing, pack
from tsgrid.llm.byte_bpe import Ranks, byte_bpe, byte_bpe_decode
from tsgrid.llm.token_counts import token_counts

SF01 = "/root/testdata/sf0.01"
ODD = ["", " ", "\n\n  x", "a", "it's we'll 'S", "x" * 3000, "ab" * 700, "\t　  y", "<|endoftext|>", "a <|endoftext|>  b<|endoftext|>",
       "<|startoftext|>Hi<|endoftext|>", "é ́x ﬁ Ⅷ ½ ٣ 漢字かな", "😀👩‍👩‍👧 ​ z", "\x1c\x1d a\x1eb\x85c d", "ΣΑΣ İı ß ẞ", "1234567 3.14", "\0\x01", "don't   stop "]


def rows_of(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").limit(300).collect()]
    top = max(r[0] for r in rows)
    return rows + [(top + 1 + i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (7, None), (7, "again 7"), (7, "again 7")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("item", F.lit(1)).repartition(3)


def test_token_counts_equal_the_library(spark):
    rows = rows_of(spark)
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows), key=str)
    got = sorted((tuple(r) for r in token_counts(frame(spark, rows)).collect()), key=str)
    assert got == want
    assert token_counts(frame(spark, rows[:1]).limit(0)).count() == 0


@pytest.fixture(scope="module")
def encoding():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_tiktoken_and_round_trips(spark, encoding):
    rows = rows_of(spark)
    ids = {i: encoding.encode_ordinary(t or "") for i, t in rows if i != 7}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    out = byte_bpe(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id != 7:
            assert r.ids == ids[r.doc_id], r.doc_id
    texts = defaultdict(set)
    for i, t in rows:
        texts[i].add((t or "").encode())
    assert all(bytes(r.decoded) in texts[r.doc_id] for r in out)
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe(frame(spark, rows), digest=True).collect()}
    assert digests == {(i, len(x), sha(" ".join(map(str, x)).encode()), sha(t)) for i in texts for t in texts[i] for x in [encoding.encode_ordinary(t.decode())]}
    back = byte_bpe_decode(spark.createDataFrame([(1, ids[rows[0][0]]), (2, None)], "doc_id long, ids array<int>")).collect()
    assert bytes(back[0].decoded) == rows[0][1].encode() and bytes(back[1].decoded) == b""
    assert byte_bpe(frame(spark, rows).limit(0)).count() == 0


def test_matrix_and_heap_agree_with_tiktoken_on_random_bytes(encoding):
    table = Ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rng = np.random.default_rng(2)
    pieces = ["".join(rng.choice(list("abcdeinorst "), int(n))).strip().replace(" ", "") or "a" for n in rng.integers(1, 200, 300)]
    ids, off = table.encode([p.encode() for p in pieces])
    for k, p in enumerate(pieces):
        want = encoding.encode_ordinary(p)
        assert ids[off[k]:off[k + 1]].tolist() == want
        if p.encode() not in table.rank:
            assert table.merge_long(p.encode()).tolist() == want


def check_packing(out, want, capacity):
    pieces = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out if r.doc_id not in (None, 7))
    assert pieces == sorted(w for w in want if w[0] not in (None, 7))
    assert len(out) == len(want)
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_equals_the_library_and_fills_sequences(spark):
    rows = rows_of(spark)
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, total = [], 0
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        total += len(ids)
        want += [(i, k, a, len(ids[a:a + 4096]), zlib.crc32(np.array(ids[a:a + 4096], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    n = check_packing(best_fit_packing(frame(spark, rows)).collect(), want, 4096)
    assert n <= -(-total // 4096) + 1
    kept = best_fit_packing(frame(spark, rows), with_ids=True).where("doc_id = %d and piece = 0" % rows[0][0]).first()
    assert kept.ids == (tok.encode(rows[0][1], add_special_tokens=False).ids + [1])[:4096]
    assert best_fit_packing(frame(spark, rows).limit(0)).count() == 0


def test_packing_of_decomposed_and_mixed_texts_equals_the_library(spark):
    texts = ["J\u030c", "T\u0308", "H\u0331", "Y\u030a", "W\u030a", "A T\u0308o. J\u030cAN, End. x", "PLAIN Text, End.", "\u00c9T\u00c9 THE End. A\u0301 I\u0307"]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = best_fit_packing(frame(spark, list(enumerate(texts))), with_ids=True).collect()
    assert {r.doc_id: r.ids for r in out} == {i: [*tok.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}


def test_tree_rounds_merge_underfull_bins_and_stop(spark):
    rng = np.random.default_rng(4)
    for sizes in (rng.integers(1, 60, 3000), rng.integers(51, 100, 500), np.full(40, 100), np.array([], int)):
        items = spark.createDataFrame([(i, int(s)) for i, s in enumerate(sizes)], "item long, length int").repartition(16)
        out = pack(items, 100, 0).collect()
        assert sorted(r.item for r in out) == list(range(len(sizes)))
        used = defaultdict(int)
        for r in sorted(out, key=lambda r: r.offset):
            assert r.offset == used[r.sequence_id]
            used[r.sequence_id] += int(sizes[r.item])
        assert all(v <= 100 for v in used.values())
        assert len(used) <= max(len(best_fit([int(s) for s in sizes], 100)) + 2, 0)


def test_plain_words_by_ranks_equal_the_library():
    """Every token of the file as a word, and words with marks, digits, accents and look-alikes of special strings."""
    import json
    from tsgrid.llm.best_fit_packing import Words
    from tsgrid.llm.ffd_packing import byte_letters
    path = public_tokenizers.path("word_bpe_49k.json")
    letters, found = byte_letters(), {"\u0130stanbul", "\u00c0\u00c9\u00ce", "don't", "3.14\u00b2", "\u00aa\u00ba", "x" * 5000, "a\x1cb", "<|endoftext|>", "\u01c5", "caf\u00e9###", "a\u0301", "\u6f22\u5b57"}
    for t in json.load(open(path))["model"]["vocab"]:
        try:
            found.add(bytes(letters[c] for c in t.removesuffix("</w>")).decode())
        except (UnicodeDecodeError, KeyError):
            pass
    found = sorted(w for w in found if w.encode().split() == [w.encode()])
    words = Words(path)
    assert words.ranks.usable and len(found) > 30_000
    for w in found:
        words.number[w.encode()]
    words.encode_new()
    want = Tokenizer.from_file(path).encode_batch(found, add_special_tokens=False)
    assert [words.flat[words.starts[i]:words.starts[i + 1]].tolist() for i in range(len(found))] == [e.ids for e in want]
