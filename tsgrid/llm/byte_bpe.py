"""Byte-level BPE encoding and decoding with padded numpy matrices.

A task takes a block of documents, finds the distinct pattern matches in it, and encodes those: matches that
are a token are looked up; the others go, bucketed by length, into a matrix of byte tokens. In each round
every row merges its leftmost pair of minimum rank; a pair's rank comes from a hash table of (left, right)
token pairs, and only the two pairs next to a merge are looked up again. Rows without a mergeable pair leave
the matrix (compaction). Matches over LONG bytes use the same rule with a heap per match.

The documents' ids are the matches' ids laid end to end; decoding turns ids back into bytes through a token
table. There is no shuffle: the work and the memory of a task depend on its block only.

Defined results: null text is empty (no ids, no bytes). Null and repeated ids, extra columns, and empty
tables are passed through (one row per input row; extra columns are not read). Texts are never cut.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import chunks, mix, text_buffers
from .token_counts import finder, public_path, public_pattern

NONE = np.int32(2**31 - 1)
LONG = 1024
BLOCK_BYTES = 4 << 20


class Ranks:
    """A rank file: token bytes, byte tokens, and the hash table from token pairs to merged tokens."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max(self.rank.values()) + 1
        self.bytes = [b""] * size
        for token, i in self.rank.items():
            self.bytes[i] = token
        self.byte = np.array([self.rank[bytes([i])] for i in range(256)], np.int32)
        self.length = np.array([len(t) for t in self.bytes], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        self.blob = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.text = [str(i).encode() for i in range(size)]
        pairs = [(self.rank[t[:k]] << 32 | self.rank[t[k:]], i) for t, i in self.rank.items() for k in range(1, len(t))
                 if t[:k] in self.rank and t[k:] in self.rank]
        keys, merged = (np.array(x, np.int64) for x in zip(*pairs))
        self.mask = (1 << (4 * len(keys)).bit_length()) - 1
        self.keys, self.merged = np.full(self.mask + 1, -1), np.full(self.mask + 1, NONE, np.int32)
        slot = self._slot(keys)
        while len(keys):  # open addressing: the first of equal slots takes it, the others step on
            free = self.keys[slot] == -1
            _, first = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.keys[slot[won]], self.merged[slot[won]] = keys[won], merged[won]
            rest = np.ones(len(keys), bool)
            rest[won] = False
            keys, merged, slot = keys[rest], merged[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) & np.uint64(self.mask)).astype(np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair (a, b), or NONE; negative tokens are padding."""
        keys = a.astype(np.int64) << 32 | b.astype(np.int64)
        out = np.full(len(keys), NONE, np.int32)
        at = np.flatnonzero((a >= 0) & (b >= 0))
        slot = self._slot(keys[at])
        while len(at):
            got = self.keys[slot]
            hit = got == keys[at]
            out[at[hit]] = self.merged[slot[hit]]
            on = ~hit & (got != -1)
            at, slot = at[on], (slot[on] + 1) & self.mask
        return out

    def merge_matrix(self, tokens: np.ndarray) -> list[np.ndarray]:
        """Final tokens of each row of a matrix of byte tokens, padded with -1 on the right."""
        n, width = tokens.shape
        out: list = [None] * n
        rows = np.arange(n)
        if width > 1:
            rank = self.pair(tokens[:, :-1].ravel(), tokens[:, 1:].ravel()).reshape(n, -1)
        else:
            rank = np.full((n, 1), NONE, np.int32)
        while len(rows):
            at = rank.argmin(1)
            low = rank[np.arange(len(rows)), at]
            over = low == NONE
            if over.any():
                for i in np.flatnonzero(over):
                    out[rows[i]] = tokens[i][tokens[i] >= 0]
                go = ~over
                rows, tokens, rank, at, low = rows[go], tokens[go], rank[go], at[go], low[go]
                if not len(rows):
                    break
            each = np.arange(len(rows))
            cols = np.arange(tokens.shape[1] - 1)
            tokens = np.take_along_axis(tokens, cols + (cols > at[:, None]), 1)
            tokens[each, at] = low
            cols = cols[:-1]
            if not len(cols):
                rank = np.full((len(rows), 1), NONE, np.int32)
                continue
            rank = np.take_along_axis(rank, cols + (cols >= at[:, None]), 1)
            for left in (at - 1, at):
                ok = (left >= 0) & (left < len(cols))
                rank[each[ok], left[ok]] = self.pair(tokens[each[ok], left[ok]], tokens[each[ok], left[ok] + 1])
        return out

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same rule for one long match, with a heap of (rank, place) and linked places."""
        tokens = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.pair(np.array(tokens[:-1]), np.array(tokens[1:]))
        heap = [(int(r), i) for i, r in enumerate(rank) if r != NONE]
        heapq.heapify(heap)
        now = {i: r for r, i in heap}
        while heap:
            r, i = heapq.heappop(heap)
            if now.get(i) != r:
                continue
            j = after[i]
            tokens[i], tokens[j] = r, -1
            now.pop(j, None)
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                now.pop(k, None)
                if k >= 0 and after[k] < n:
                    both = self.bytes[tokens[k]] + self.bytes[tokens[after[k]]]
                    if (x := self.rank.get(both)) is not None:
                        now[k] = x
                        heapq.heappush(heap, (x, k))
        return np.array([t for t in tokens if t >= 0], np.int32)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the pieces, laid end to end."""
        out: list = [None] * len(pieces)
        buckets: defaultdict[int, list[int]] = defaultdict(list)
        for i, p in enumerate(pieces):
            whole = self.rank.get(p)
            if whole is not None:
                out[i] = (whole,)
            elif len(p) > LONG:
                out[i] = self.merge_long(p)
            else:
                buckets[len(p) if len(p) <= 32 else 1 << (len(p) - 1).bit_length()].append(i)
        for width, members in buckets.items():
            step = max(1, (1 << 20) // width)
            for k in range(0, len(members), step):
                part = members[k:k + step]
                lengths = np.array([len(pieces[i]) for i in part])
                flat = self.byte[np.frombuffer(b"".join(pieces[i] for i in part), np.uint8)]
                tokens = np.full((len(part), width), -1, np.int32)
                tokens[np.arange(width) < lengths[:, None]] = flat
                for i, ids in zip(part, self.merge_matrix(tokens)):
                    out[i] = ids
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        ids = np.concatenate([np.asarray(x, np.int32) for x in out]) if out else np.zeros(0, np.int32)
        return ids, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.blob, self.start, ids).tobytes()


def gather(values: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The slices values[offsets[i]:offsets[i + 1]] for i in index, laid end to end."""
    sizes = offsets[index + 1] - offsets[index]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(offsets[index] - ends + sizes, sizes)]


@lru_cache(maxsize=2)
def ranks(path: str) -> Ranks:
    return Ranks(path)


def encode_texts(batch: pa.RecordBatch, path: str, pattern: str) -> Iterator[np.ndarray]:
    """The ids of each text of a batch."""
    table, find = ranks(path), finder(pattern)
    raw, off = text_buffers(batch.column("text"))
    for i, j in chunks(off, BLOCK_BYTES):
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__
        parts = [np.array(list(map(number.__getitem__, find(raw[off[k]:off[k + 1]].tobytes().decode()))), np.int64) for k in range(i, j)]
        ids, starts = table.encode([p.encode() for p in number])
        for p in parts:
            yield gather(ids, starts, p)


def _rows(path: str, pattern: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks(path)
        for batch in batches:
            n, first, second = [], [], []
            for ids in encode_texts(batch, path, pattern):
                text = table.decode(ids)
                n.append(len(ids))
                if digest:
                    first.append(hashlib.sha256(b" ".join(map(table.text.__getitem__, ids.tolist()))).hexdigest())
                    second.append(hashlib.sha256(text).hexdigest())
                else:
                    first.append(ids)
                    second.append(text)
            kinds = (pa.string(), pa.string()) if digest else (pa.list_(pa.int32()), pa.binary())
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["doc_id", "n_tokens", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(first, kinds[0]), pa.array(second, kinds[1])], names)
    return run


def byte_bpe(docs: DataFrame, rank_file: str | None = None, pattern: str | None = None, id_col: str = "doc_id",
             text_col: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded), or with ``digest`` the SHA-256 of the ids' decimals and of the bytes."""
    ship_package(docs.sparkSession)
    path, pattern = rank_file or public_path("byte_bpe_50k.tiktoken"), pattern or public_pattern()
    out = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded binary"
    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_rows(path, pattern, digest), f"doc_id long, n_tokens long, {out}"))


def byte_bpe_decode(encoded: DataFrame, rank_file: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded): the bytes of given id lists; null lists decode to no bytes."""
    ship_package(encoded.sparkSession)
    path = rank_file or public_path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [ranks(path).decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "decoded"])

    return (encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
            .mapInArrow(run, "doc_id long, decoded binary"))
