r"""Target-distribution importance resampling over hashed word features, with a position-table CRC.

Features are all runs of one and two consecutive words (lower-cased A-Z, ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``), joined
by one space; a feature's bucket is its bytes' CRC-32 modulo ``buckets``.

CRC-32 of a span of L bytes is the exclusive or of one contribution per byte, which depends on the byte and on its
distance from the end alone, and of a constant of L. So a table PLACES[distance][byte] is looked up for all bytes of a
block at once, and ``bitwise_xor.reduceat`` folds it over the feature spans. Words lie one space apart in a buffer, so
a pair of words is one span, too: its last word's part is the single word's own, and its first word (and the space)
are looked up once more, further from the end. Spans longer than REACH bytes are folded blockwise: REACH bytes at a
time, the register going on by REACH zero bytes through four tables of 256.

1. One pass over the texts writes (doc_id, n_words, buckets) once, two bytes a feature.
2. Each task counts the buckets of its rows in one array; Spark adds these up. The counts of the documents and of the
   targets, one row per bucket, give every bucket's gain on the driver (``buckets`` rows, a parameter).
3. A second pass over the buckets gives each document's weight, the floored mean gain. The score adds Gumbel noise
   drawn from a hash of (seed, doc_id), so the best scores are a sample without replacement, weighted by importance.
4. Ranks come from range partitioning (``value_ranks``): no task sorts more than a range.

Defined results: null or empty text: no features, weight 0. Null id: noise of the empty id, last among equal scores.
Repeated ids: each row is a document; equal scores and ids are ranked in any order. Extra columns are not read. Empty
targets: all t are 0. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.blocks import value_ranks
from ..session import ship_package
from .byte_bpe import gather
from .common import CHUNK_BYTES, chunks, materialize, text_buffers

REACH = 128
POLYNOMIAL = 0xEDB88320


def _on(register: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The register after one zero byte."""
    return table[register & np.uint32(255)] ^ (register >> np.uint32(8))


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(PLACES, flat, with a row of zeros first; constants of the lengths 0 to REACH; four tables that go on by REACH bytes)."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, byte >> 1 ^ np.uint32(POLYNOMIAL), byte >> 1)
    places, register = [np.zeros(256, np.uint32)], byte
    for _ in range(REACH):
        places.append(register)
        register = _on(register, byte)
    constants = [np.array([0xFFFFFFFF], np.uint32)]
    for _ in range(REACH):
        constants.append(_on(constants[-1], byte))
    ahead = (np.arange(256, dtype=np.uint32) << np.array([[0], [8], [16], [24]], np.uint32)).ravel()
    for _ in range(REACH):
        ahead = _on(ahead, byte)
    return np.concatenate(places), ~np.concatenate(constants), ahead.reshape(4, 256)


def skip(register: np.ndarray) -> np.ndarray:
    """Registers after REACH zero bytes."""
    ahead, last = tables()[2], np.uint32(255)
    return (ahead[0][register & last] ^ ahead[1][register >> np.uint32(8) & last]
            ^ ahead[2][register >> np.uint32(16) & last] ^ ahead[3][register >> np.uint32(24)])


def folded_crc(buffer: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of spans of any length from 1 on, REACH bytes at a time; the first block may be shorter."""
    places, constants, _ = tables()
    blocks = -(-size // REACH)
    head = size - (blocks - 1) * REACH
    out, constant = np.zeros(len(size), np.uint32), constants[head]
    at, k = np.arange(len(size)), 0
    while len(at):
        n = head[at] if k == 0 else np.full(len(at), REACH)
        first = start[at] if k == 0 else start[at] + head[at] + (k - 1) * REACH
        ends = np.cumsum(n)
        bounds = np.stack([first, first + n], 1).ravel()
        found = gather(buffer, bounds, np.arange(0, len(bounds), 2))
        distance = np.repeat(ends, n) - np.arange(len(found))
        part = np.bitwise_xor.reduceat(places[distance * 256 + found], ends - n)
        out[at] = (skip(out[at]) if k else out[at]) ^ part
        if k:
            constant[at] = ~skip(~constant[at])
        k += 1
        at = at[blocks[at] > k]
    return out ^ constant


#: Bytes of words after lower-casing; 0 separates them.
WORDS = np.zeros(256, np.uint8)
for _b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    WORDS[_b] = _b
WORDS[0x41:0x5B] = WORDS[0x61:0x7B]


def words_of(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts and ends of the words, words of each text) of the texts raw[off[k]:off[k + 1]]."""
    low = WORDS[raw]
    inside = low != 0
    edges = off[1:-1][off[1:-1] < len(raw)]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    ends[:-1] &= ~inside[1:]
    edges = edges[edges > 0] - 1
    ends[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    return low, starts, np.flatnonzero(ends) + 1, np.diff(np.searchsorted(starts, off))


def feature_crcs(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of each word, and of each word with its successor (none for the last)."""
    single, pair = np.empty(len(starts), np.uint32), np.empty(max(0, len(starts) - 1), np.uint32)
    places, constants, _ = tables()
    size, total = ends - starts, np.cumsum(ends - starts)
    a = 0
    while a < len(starts):
        # a slice of words of about CHUNK_BYTES, and the word after it
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + CHUNK_BYTES, side="right")))
        c = min(len(starts), b + 1)
        n = size[a:c]
        ends_at = np.cumsum(n + 1)
        buffer = np.full(ends_at[-1], 32, np.uint8)
        buffer[np.arange(n.sum()) + np.repeat(np.arange(len(n)), n)] = gather(low, np.stack([starts[a:c], ends[a:c]], 1).ravel(), np.arange(0, 2 * len(n), 2))
        first = ends_at - n - 1
        # 1 more than the distance from the word's end: 0 at the space behind it
        distance = np.repeat(ends_at - 1, n + 1) - np.arange(len(buffer))
        own = np.bitwise_xor.reduceat(places[np.minimum(distance, REACH) * 256 + buffer], first)
        short = np.minimum(n, REACH)
        one = own ^ constants[short]
        long = np.flatnonzero(n > REACH)
        one[long] = folded_crc(buffer, first[long], n[long])
        single[a:c] = one
        if len(n) > 1:
            after = np.append(n[1:], 0)
            further = np.repeat(after + 1, n + 1) + distance
            lead = np.bitwise_xor.reduceat(places[np.minimum(further, REACH) * 256 + buffer], first)
            both = n[:-1] + 1 + n[1:]
            two = lead[:-1] ^ own[1:] ^ constants[np.minimum(both, REACH)]
            long = np.flatnonzero(both > REACH)
            two[long] = folded_crc(buffer, first[long], both[long])
            pair[a:c - 1] = two
        a = b
    return single, pair


def bucket_type(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _features(buckets: int):
    """(doc_id, n_words, buckets) per text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = bucket_type(buckets)
        for batch in batches:
            raw, off = text_buffers(batch.column("text"))
            for i, j in chunks(off, 4 * CHUNK_BYTES):
                low, starts, ends, words = words_of(raw[off[i]:off[j]], off[i:j + 1] - off[i])
                single, pair = ((x % np.uint32(buckets)).astype(kind) for x in feature_crcs(low, starts, ends))
                last = np.cumsum(words)
                found = [single[b - n:b].tobytes() + (pair[b - n:b - 1].tobytes() if n else b"") for n, b in zip(words.tolist(), last.tolist())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(words.astype(np.int64)), pa.array(found, pa.binary())], ["doc_id", "n_words", "buckets"])
    return run


def _bucket_counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for x in batch.column("buckets"):
                total += np.bincount(np.frombuffer(x.as_buffer(), bucket_type(buckets)), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])
    return run


def _weights(gains: np.ndarray, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x.as_buffer(), kind) for x in batch.column("buckets")]
            n = np.fromiter(map(len, found), np.int64, len(found))
            total = np.fromiter((int(gains[x].sum()) for x in found), np.int64, len(found))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(n), pa.array(np.where(n > 0, total // np.maximum(n, 1), 0))],
                                             ["doc_id", "n_words", "n_features", "weight"])
    return run


def features(docs: DataFrame, buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, buckets): the bucket of every word and of every pair of words, packed."""
    ship_package(docs.sparkSession)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_features(buckets), "doc_id long, n_words long, buckets binary"))


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket; at most ``buckets`` rows reach the driver."""
    out = np.zeros(buckets, np.int64)
    for r in found.select("buckets").mapInArrow(_bucket_counts(buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the add-one ratio of target to source frequency) per bucket."""
    s, t = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((float(b) + 1) * s / ((float(a) + 1) * t))) for a, b in zip(source.tolist(), target.tolist())], np.int64)


def importance_resampling(docs: DataFrame, targets: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, buckets: int = 10_000,
                          id_col: str = "doc_id", text_col: str = "text", target_id_col: str = "item_id", target_text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank); rank is null for documents that are not drawn."""
    found = materialize(features(docs, buckets, id_col, text_col), "resample-features")
    gains = bucket_gains(bucket_counts(found, buckets), bucket_counts(features(targets, buckets, target_id_col, target_text_col), buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    scored = materialize(found.mapInArrow(_weights(gains, bucket_type(buckets)), "doc_id long, n_words long, n_features long, weight long")
                         .withColumn("score", F.col("weight") + noise), "resample-scores")
    open_ = F.col("n_words") >= min_words
    drawn = percent * scored.where(open_).count() // 100
    ranked = value_ranks(scored.where(open_).withColumn("below", -F.col("score")).withColumn("no_id", F.col("doc_id").isNull()), [], "below", ("no_id", "doc_id"))
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    return (ranked.select(*out, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
            .unionByName(scored.where(~open_).select(*out, F.lit(None).cast("long").alias("rank"))))
