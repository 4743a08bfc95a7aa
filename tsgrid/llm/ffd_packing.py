"""First-fit decreasing packing with a tournament tree, in randomised groups of documents.

1. Each task tokenises its texts and adds the end id. Every whole ``capacity`` of a document's ids is a sequence of
   its own and is known by its checksum at once; the rest, shorter than ``capacity``, goes on.
2. Documents are dealt at random over groups of about ``group_docs``: the group is a hash of the id, of the ids'
   checksum, and of how many equal rows the task has seen, so that neither the order of the input, nor a hot source,
   nor thousands of copies of one row make a group larger than others. A group is packed by itself, in one call.
3. In a group the rests, largest first, go to the first bin that has room. A tournament tree over the bins' rooms
   (a node holds the larger room of its two children) finds it on one way from the root: to the left if there is
   room, else to the right.
4. Bins with room left are then filled by cutting (``fill_gaps``): the emptiest bins' pieces fill the rooms of the
   fullest. Less than one capacity of tokens is left per group; it is laid into sequences whose lengths are the
   powers of two of its binary digits, which need no padding either.

Ids: a byte-level file whose ids rise in merge order is encoded by its ranks (tiktoken), others by the tokenizers
library. The two agree: at the moment when a token's bytes are two tokens, those two are the pair of its merge, if
every token's bytes encode to that token (a test goes through all of them).

Defined results: null text is empty and holds the end id alone. Null and repeated ids: each row is a document of its
own. Extra columns are not read. An empty table gives an empty result. Texts are never cut before tokenising.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import mix, text_buffers
from .token_counts import public_path, public_pattern

GROUP_DOCS = 4096
#: Bytes of ids and texts that a task holds before it hands rows on.
OUT_BYTES = 8 << 20
PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def byte_letters() -> dict[str, int]:
    """The letter that byte-level files write for each byte: itself if printable Latin-1, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def ranked(path: str) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """(ranks, special tokens) of a byte-level tokenizer file whose ids rise in merge order, or None."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "dropout"))
             and spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
             and not before.get("add_prefix_space"))
    if not plain:
        return None
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    ids = [model["vocab"].get(a + b, -1) for a, b in pairs]
    if ids != sorted(set(ids)):
        return None
    letters = byte_letters()
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in specials}
    return ranks, specials


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], list[int]]:
    """text -> ids, as the tokenizers library gives them without added special tokens."""
    found = ranked(path)
    if found is None:
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        return lambda text: tok.encode(text, add_special_tokens=False).ids
    import tiktoken
    ranks, specials = found
    known = tiktoken.Encoding("own", pat_str=public_pattern(), mergeable_ranks=ranks, special_tokens=specials)

    def encode(text: str) -> list[int]:
        if any(s in text for s in specials):
            return known.encode(text, allowed_special="all")
        return known.encode_ordinary(text)
    return encode


def _tokens(path: str, end_id: int, capacity: int, with_ids: bool):
    """(key, id, full, rest) per document: the checksums of its whole capacities, and the ids of its rest (or of all)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(path), Counter()
        for batch in batches:
            raw, off = text_buffers(batch.column("text"))
            ids_of = batch.column("id").to_pylist()
            at, keys, full, rest, held = 0, [], [], [], 0
            for k, doc in enumerate(ids_of):
                ids = encode(raw[off[k]:off[k + 1]].tobytes().decode("utf-8", "replace"))
                ids.append(end_id)
                ids = np.array(ids, "<u4")
                whole = len(ids) // capacity * capacity
                sums = [zlib.crc32(ids[a:a + capacity].data) for a in range(0, whole, capacity)]
                tail = ids[whole:].tobytes()
                name = zlib.crc32(np.array(sums, "<u4").tobytes(), zlib.crc32(tail)) << 32 ^ hash((doc, len(ids))) & 0xFFFFFFFFFFFFFFFF
                seen[name] += 1
                keys.append((name + seen[name] * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
                full.append(sums)
                rest.append(ids.tobytes() if with_ids else tail)
                held += len(rest[-1])
                if held > OUT_BYTES or k + 1 == len(ids_of):
                    yield pa.RecordBatch.from_arrays([pa.array(mix(np.array(keys, np.uint64)).view(np.int64)), batch.column("id").slice(at, k + 1 - at),
                                                      pa.array(full, pa.list_(pa.int64())), pa.array(rest, pa.binary())], ["key", "id", "full", "rest"])
                    at, keys, full, rest, held = k + 1, [], [], [], 0
    return run


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """The members of each bin; ``sizes`` falls, and every size is from 1 to ``capacity``."""
    leaves = 1 << max(0, len(sizes) - 1).bit_length()
    room = [capacity] * (2 * leaves)
    bins: list[list[int]] = []
    for i, size in enumerate(sizes):
        at = 1
        while at < leaves:
            at *= 2
            if room[at] < size:
                at += 1
        if at - leaves == len(bins):
            bins.append([])
        bins[at - leaves].append(i)
        room[at] -= size
        while at > 1:
            at //= 2
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
    return bins


def fill_gaps(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length): full ones, and at most one of each power of two under the capacity."""
    load = [sum(sizes[i] for i in b) for b in bins]
    done = [[(i, 0, sizes[i]) for i in b] for b, n in zip(bins, load) if n == capacity]
    open_ = sorted((k for k in range(len(bins)) if load[k] < capacity), key=lambda k: (-load[k], k))
    total = sum(load[k] for k in open_)
    kept = open_[:total // capacity]
    # the emptiest bin's pieces come first
    pieces = [(i, 0, sizes[i]) for k in reversed(open_[len(kept):]) for i in bins[k]][::-1]

    def take(n: int) -> list[tuple[int, int, int]]:
        out = []
        while n:
            item, start, length = pieces.pop()
            out.append((item, start, min(n, length)))
            if length > n:
                pieces.append((item, start + n, length - n))
            n -= out[-1][2]
        return out

    for k in kept:
        done.append([(i, 0, sizes[i]) for i in bins[k]] + take(capacity - load[k]))
    left = total - len(kept) * capacity
    return done + [take(1 << bit) for bit in reversed(range(left.bit_length())) if left >> bit & 1]


def _pack(capacity: int, with_ids: bool):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        base, table = key[0].as_py() << 40, table.sort_by("key")
        docs, full, rest = table.column("id").to_pylist(), table.column("full").to_pylist(), table.column("rest").to_pylist()
        rest = [np.frombuffer(r, "<u4") for r in rest]
        tokens = [len(s) * capacity + len(r) % capacity if with_ids else len(s) * capacity + len(r) for s, r in zip(full, rest)]
        out: list[list] = [[] for _ in PIECE]
        ids: list[np.ndarray] = []
        sequence = 0

        def add(d: int, start: int, length: int, crc: int, place: int) -> None:
            for column, value in zip(out, (docs[d], start, length, crc, tokens[d], base + sequence, place)):
                column.append(value)

        for d, sums in enumerate(full):
            for k, crc in enumerate(sums):
                add(d, k * capacity, capacity, crc, 0)
                if with_ids:
                    ids.append(rest[d][k * capacity:(k + 1) * capacity])
                sequence += 1
        tails = [r[len(s) * capacity:] for s, r in zip(full, rest)] if with_ids else rest
        names = table.column("key").to_pylist()
        order = sorted((d for d in range(len(docs)) if len(tails[d])), key=lambda d: (-len(tails[d]), names[d]))
        sizes = [len(tails[d]) for d in order]
        for pieces in fill_gaps(first_fit_decreasing(sizes, capacity), sizes, capacity):
            place = 0
            for item, start, length in pieces:
                d = order[item]
                cut = tails[d][start:start + length]
                add(d, len(full[d]) * capacity + start, length, zlib.crc32(cut.tobytes()), place)
                if with_ids:
                    ids.append(cut)
                place += length
            sequence += 1
        columns = [pa.array(c, pa.int64()) for c in out]
        if with_ids:
            columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
        return pa.table(columns, names=[*PIECE, *(["ids"] if with_ids else [])])
    return run


def ffd_packing(docs: DataFrame, tokenizer_file: str | None = None, capacity: int = 1024, end_id: int = 0, group_docs: int = GROUP_DOCS,
                id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) per piece; ``docs`` is counted first."""
    ship_package(docs.sparkSession)
    path = tokenizer_file or public_path("byte_bpe_50k.json")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    groups = max(1, -(-docs.count() // group_docs))
    tokens = rows.mapInArrow(_tokens(path, end_id, capacity, with_ids), "key long, id long, full array<long>, rest binary")
    schema = ", ".join(f"{c} long" for c in PIECE) + (", ids array<int>" if with_ids else "")
    return tokens.withColumn("group", F.pmod("key", F.lit(groups))).groupBy("group").applyInArrow(_pack(capacity, with_ids), schema)
