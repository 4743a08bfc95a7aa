"""Token counts: pieces are counted once per distinct pre-token, joined to per-document pre-token
frequencies, and summed; token ids are never materialised.

1. Tasks cut texts at the tokenizer's special strings and into pre-tokens, and write for each block of
   documents one row per distinct pre-token: (pre-token, salt, block, postings), the postings being packed
   (place in the block, frequency) pairs. One more row, whose key no pre-token can have, lists the block's ids.
   A pre-token in more than a tenth of a block's texts is hot: its rows are dealt over SALTS salts by block.
2. One shuffle by (pre-token, salt) brings a pre-token's rows together. There its pieces are counted
   once (as the library would; ``ffd_packing.encoder``), and the count is joined to all its frequency rows. (The join is this co-partitioned lookup: as two
   branches with a Spark join between them the Python stage and its shuffle ran twice, since Spark doesn't reuse
   the exchange of a Python stage: 1.89 x input of disk and 932 CPU seconds a GB.)
3. The same tasks add frequency x pieces per block and place before the second shuffle, which sums by block.

A block's group holds what its own documents' pre-tokens sum to, so no group grows with the corpus.

Defined results: null text is empty: 0 bytes, 0 tokens. Null and repeated ids: one result per row. Extra
columns are not read. An empty table gives an empty result. Long texts are cut by the pattern as a whole.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import chunks, text_buffers

BLOCK_ROWS, BLOCK_BYTES, SALTS = 8192, 16 << 20, 64
#: Pairs that are summed at once, and keys whose counts a task keeps.
SLICE_PAIRS, KNOWN = 1 << 19, 300_000
_PAIR = np.dtype([("at", "<u2"), ("n", "u1")])
_SUM = np.dtype([("at", "<u2"), ("n", "<i8")])
ROWS = "piece string, salt int, block long, postings binary"


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def public_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


@lru_cache(maxsize=4)
def finder(pattern: str):
    """findall of ``pattern``; ASCII texts take the same pattern with its classes' ASCII members, by the faster re."""
    every = regex.compile(pattern).findall
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
    if r"\p" in plain:
        return every
    ascii_only = re.compile(plain, re.ASCII).findall
    return lambda text: ascii_only(text) if text.isascii() else every(text)


@lru_cache(maxsize=4)
def special_strings(path: str) -> tuple[str, ...]:
    """The added tokens that the file's tokenizer recognises inside a text."""
    with open(path, encoding="utf-8") as f:
        return tuple(t["content"] for t in json.load(f)["added_tokens"])


def pre_tokens(text: str, find, specials: tuple[str, ...]) -> list[str]:
    if not any(s in text for s in specials):
        return find(text)
    out: list[str] = []
    for part in regex.split("(" + "|".join(map(regex.escape, specials)) + ")", text):
        out += [part] if part in specials else find(part)
    return out


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, off = text_buffers(batch.column("text"))
    for i, j in chunks(off, BLOCK_BYTES):
        for k in range(i, j, BLOCK_ROWS):
            yield k, min(j, k + BLOCK_ROWS), raw, off


def _frequencies(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, specials = finder(pattern), special_strings(path)
        block = TaskContext.get().partitionId() << 32
        names = ["piece", "salt", "block", "postings"]
        for batch in batches:
            for i, j, raw, off in _blocks(batch):
                number: defaultdict[str, int] = defaultdict()
                number.default_factory = number.__len__
                parts = [np.array(list(map(number.__getitem__, pre_tokens(raw[off[k]:off[k + 1]].tobytes().decode(), find, specials))), np.int32)
                         for k in range(i, j)]
                block += 1
                pairs = np.concatenate(parts).astype(np.int64) * (j - i) + np.repeat(np.arange(j - i), [len(p) for p in parts])
                del parts
                pairs, count = np.unique(pairs, return_counts=True)
                if len(count) and count.max() > 255:  # a frequency over a byte takes several pairs
                    times = -(-count // 255)
                    last = np.cumsum(times) - 1
                    pairs, rest = np.repeat(pairs, times), count - (times - 1) * 255
                    count = np.full(len(pairs), 255)
                    count[last] = rest
                packed = np.empty(len(pairs), _PAIR)
                packed["at"], packed["n"] = pairs % (j - i), count
                ends = np.searchsorted(pairs, np.arange(1, len(number) + 1) * (j - i))
                sizes = np.diff(ends, prepend=0)
                data = pa.py_buffer(packed.tobytes())
                postings = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.concatenate([[0], ends * 3]).astype(np.int32).tobytes()), data])
                salt = np.where(sizes * 10 > j - i, block % SALTS, 0)
                yield pa.RecordBatch.from_arrays([pa.array(list(number), pa.string()), pa.array(salt.astype(np.int32)), pa.array(np.full(len(number), block)), postings], names)
                ids = batch.column("id").slice(i, j - i)
                about = np.stack([ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False), np.diff(off[i:j + 1])], 1)
                yield pa.RecordBatch.from_arrays([pa.array([f"\0b{block}"]), pa.array([0], pa.int32()), pa.array([block]), pa.array([about.astype("<i8").tobytes()], pa.binary())], names)
    return run


def _count_and_add(path: str):
    return lambda batches: _add_up(batches, path)


def _add_up(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Counts each pre-token once and sums frequency x pieces per block and place; flushed at some millions of places."""
    from .ffd_packing import encoder
    encode, known = encoder(path), {}  # one tokenizer for the life of the worker

    def flush() -> pa.RecordBatch:
        rows = []
        for s in sums.values():
            at = np.flatnonzero(s)
            pairs = np.empty(len(at), _SUM)
            pairs["at"], pairs["n"] = at, s[at]
            rows.append(pairs.tobytes())
        out = pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(rows, pa.binary()), pa.nulls(len(rows), pa.binary())], ["block", "sums", "about"])
        sums.clear()
        return out

    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        keys = batch.column("piece").dictionary_encode()
        words = keys.dictionary.to_pylist()
        if len(known) > KNOWN:  # only saves counting a key again in the next batch
            known.clear()
        new = [w for w in words if w not in known and not w.startswith("\0b")]
        known.update((w, len(encode(w))) for w in new)
        n = np.array([known.get(w, -1) for w in words], np.int64)[keys.indices.to_numpy()] if words else np.zeros(0, np.int64)
        block = batch.column("block").to_numpy(zero_copy_only=False)
        heads = np.flatnonzero(n < 0)
        if len(heads):
            yield pa.RecordBatch.from_arrays([pa.array(block[heads]), pa.nulls(len(heads), pa.binary()), batch.column("postings").take(pa.array(heads))], ["block", "sums", "about"])
        rows = np.flatnonzero(n >= 0)
        if not len(rows):
            continue
        postings = batch.column("postings").cast(pa.large_binary())
        _, offsets, data = postings.buffers()
        ends = np.frombuffer(offsets, np.int64)[postings.offset:postings.offset + len(n) + 1]
        raw, size = np.frombuffer(data, np.uint8), np.diff(ends)[rows] // _PAIR.itemsize
        total, a = np.cumsum(size), 0
        while a < len(rows):  # some hundred thousand pairs at a time, however many rows share a batch
            b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + SLICE_PAIRS, side="right")))
            part, length = rows[a:b], size[a:b]
            pairs = np.concatenate([raw[ends[i]:ends[i + 1]] for i in part.tolist()]).view(_PAIR)
            names, at = np.unique(block[part], return_inverse=True)
            cells = np.repeat(at * BLOCK_ROWS, length) + pairs["at"]
            add = np.bincount(cells, weights=pairs["n"] * np.repeat(n[part], length).astype(float), minlength=len(names) * BLOCK_ROWS)
            for name, row in zip(names.tolist(), add.reshape(len(names), BLOCK_ROWS)):
                if name in sums:
                    sums[name] += row.astype(np.int64)
                else:
                    sums[name] = row.astype(np.int64)
            a = b
            if len(sums) > 500:
                yield flush()
    if sums:
        yield flush()


def _finish(t: pa.Table) -> pa.Table:
    total, about = np.zeros(BLOCK_ROWS, np.int64), None
    for s, a in zip(t.column("sums").to_pylist(), t.column("about").to_pylist()):
        if s is not None:
            p = np.frombuffer(s, _SUM)
            np.add.at(total, p["at"], p["n"])
        else:
            about = np.frombuffer(a, "<i8").reshape(-1, 3)
    return pa.table({"doc_id": pa.array(about[:, 0], mask=about[:, 1] == 0), "n_bytes": pa.array(about[:, 2]), "n_tokens": pa.array(total[:len(about)])})


def token_counts(docs: DataFrame, tokenizer: str | None = None, pattern: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens). ``tokenizer`` is a byte-level file of the tokenizers library whose
    pre-tokens are ``pattern``'s matches; by default the public 50k file and its pattern."""
    ship_package(docs.sparkSession)
    path, pattern = tokenizer or public_path("byte_bpe_50k.json"), pattern or public_pattern()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sums = (rows.mapInArrow(_frequencies(path, pattern), ROWS).repartition("piece", "salt")
            .mapInArrow(_count_and_add(path), "block long, sums binary, about binary"))
    return sums.groupBy("block").applyInArrow(_finish, "doc_id long, n_bytes long, n_tokens long")
