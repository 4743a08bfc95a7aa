"""Best-fit packing by hierarchical residuals.

Texts are tokenised once (a worker encodes each white-space separated part once; a text's parts are laid end to
end) and cut into pieces of at most ``capacity`` tokens. Then, in rounds:

* each partition packs its items best-fit, largest first, in blocks of at most BLOCK items;
* bins with at most ``slack`` free tokens are emitted; the other bins go on, as single items;
* the next round spreads these over fewer partitions (a tree), and packs bins into bins.

It ends after a round with one partition, or when a round no longer lowers the number of underfull bins
(say, all items are over half the capacity): what is left is emitted. A bin carries its members, at most
``capacity`` of them, so no state grows with the corpus, and no task gets more than about BLOCK bins.

Defined results: null text is empty and holds the end id alone. Null and repeated ids: each row is a
document of its own. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .byte_bpe import gather
from .common import TEXT_ROWS, arrow_batches, chunks, materialize, only_store, text_buffers
from .ffd_packing import byte_letters
from .token_counts import public_path

BLOCK, BLOCK_BYTES = 50_000, 16 << 20
BINS = "size int, items array<long>, lengths array<int>"


def tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


#: What ends a word in ``WordRanks``: a byte that no plain word holds.
_END = "\1"
_PLAIN = re.compile("[!-~\u00a1-\u00ac\u00ae-\u024f]+").fullmatch
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordRanks:
    """The merges of a file with word ends ("</w>") and ids in merge order, as ranks of the tiktoken library: a word is
    followed by one byte, and a last letter's token is the pair of its letter and that byte, which ranks before all
    merges. Encodes many plain words in one call, a line each; gives the ids that the tokenizers library gives."""

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab, letters = spec["model"], spec["model"]["vocab"], byte_letters()
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        ids = [vocab.get(a + b, -1) for a, b in pairs]
        ends = [vocab.get(c + "</w>", -1) for c in letters]
        pattern = next((p["pattern"].get("Regex") for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"), None)
        lower = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        self.usable = (model.get("end_of_word_suffix") == "</w>" and not model.get("continuing_subword_prefix") and lower and pattern == _SPLIT
                       and ids == sorted(set(ids)) and -1 not in ends and max(ends) < min(ids))
        if not self.usable:
            return
        as_bytes = lambda t: bytes(letters[c] for c in t.removesuffix("</w>")) + (_END.encode() if t.endswith("</w>") else b"")
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {as_bytes(t): i for t, i in vocab.items() if t not in special}
        self.line = ranks[b"\n"]
        self.known = tiktoken.Encoding("words", pat_str=rf"[^{_END}\n]+{_END}|\n", mergeable_ranks=ranks, special_tokens={})
        self.ascii = re.compile(_SPLIT.replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]").replace(r"[^\s\p{L}\p{N}]", r"[^\sa-z0-9]"), re.ASCII).sub
        self.every = regex.compile(_SPLIT).sub

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids laid end to end, ids per word) of plain words."""
        text = "\n".join(words).lower() + "\n"
        found = np.array(self.known.encode_ordinary((self.ascii if text.isascii() else self.every)(r"\g<0>" + _END, text)), np.uint32)
        lines = np.flatnonzero(found == self.line)
        return np.delete(found, lines), np.diff(lines, prepend=-1) - 1


class Words:
    """Ids of the white-space separated parts that this worker has met, encoded once each (dropped at LIMIT)."""

    LIMIT = 400_000

    def __init__(self, path: str):
        self.tok, self.ranks = tokenizer(path), WordRanks(path)
        self.reset()

    def reset(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict(count().__next__)  # no reference to itself: freed at once
        self.flat, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def parts_of(self, text: bytes) -> np.ndarray:
        # the tokenizer composes, then lower-cases: only without other characters may lower-casing go first (a
        # capital and a mark can stay two characters where the small letter and the mark compose). A letter or
        # digit always ends a token before a full stop or comma
        if text.isascii() and b"<|" not in text:
            text = _STOP.sub(rb"\1 \2", text.lower())
        return np.array(list(map(self.number.__getitem__, text.split())), np.int64)

    def encode_new(self) -> None:
        known = len(self.starts) - 1
        words = [w.decode() for w in islice(self.number, known, None)]
        if not words:
            return
        plain = [self.ranks.usable and _PLAIN(w) is not None and "<|" not in w for w in words]
        flat, sizes = [], []
        for ascii_only in (True, False):
            group = [w for w, p in zip(words, plain) if p and w.isascii() == ascii_only]
            for k in range(0, len(group), 20_000):
                ids, n = self.ranks.encode(group[k:k + 20_000])
                flat.append(ids)
                sizes.append(n)
        others = [w for w, p in zip(words, plain) if not p]
        for k in range(0, len(others), 2000):
            lists = [e.ids for e in self.tok.encode_batch_fast(others[k:k + 2000], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, lists), np.int64, len(lists)))
            flat.append(np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes[-1].sum())))
        sizes = np.concatenate(sizes)
        # back from the groups' order to that of the words
        group = np.array([2 if not p else 0 if w.isascii() else 1 for w, p in zip(words, plain)])
        place = np.empty(len(words), np.int64)
        place[np.argsort(group, kind="stable")] = np.arange(len(words))
        new = gather(np.concatenate(flat), np.concatenate([[0], np.cumsum(sizes)]), place)
        self.flat = np.concatenate([self.flat, new])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes[place])])


_STOP = re.compile(rb"([a-z0-9])([.,])(?=\s|$)")


def words_of(path: str) -> Words:
    return only_store(("packing", path), lambda: Words(path))


def _pieces(path: str, end_id: int, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        for batch in batches:
            raw, off = text_buffers(batch.column("text"))
            for i, j in chunks(off, BLOCK_BYTES):
                # ASCII white space always ends a token of this kind of file, so its parts stand alone
                if len(words.number) > words.LIMIT:
                    words.reset()
                parts = [words.parts_of(raw[off[k]:off[k + 1]].tobytes()) for k in range(i, j)]
                words.encode_new()
                flat, starts = words.flat, words.starts
                row, piece, start, length, crc, kept = [], [], [], [], [], []
                for k, p in enumerate(parts):
                    ids = np.append(gather(flat, starts, p), np.uint32(end_id)).astype("<u4")
                    for q, at in enumerate(range(0, len(ids), capacity)):
                        cut = ids[at:at + capacity]
                        row.append(i + k)
                        piece.append(q)
                        start.append(at)
                        length.append(len(cut))
                        crc.append(zlib.crc32(cut.tobytes()))
                        if with_ids:
                            kept.append(cut.astype(np.int32))
                out = [batch.column("id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    out.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)
    return run


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: the members of each bin. Bit r of ``free`` tells that a bin with r free tokens exists."""
    bins: list[list[int]] = []
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0
    for i in sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True):
        s = sizes[i]
        fits = free >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = open_[room].pop()
            if not open_[room]:
                free ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        if room > s:
            open_[room - s].append(b)
            free |= 1 << (room - s)
    return bins


def _pack(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def packed() -> pa.RecordBatch:
            bins = best_fit([h[0] for h in held], capacity)
            out = [(sum(held[i][0] for i in b), [x for i in b for x in held[i][1]], [x for i in b for x in held[i][2]]) for b in bins]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.list_(pa.int64())),
                                               pa.array([o[2] for o in out], pa.list_(pa.int32()))], ["size", "items", "lengths"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("size", "items", "lengths"))):
                held.append(row)
                if len(held) >= BLOCK:
                    yield packed()
        if held:
            yield packed()
    return run


def pack(items: DataFrame, capacity: int = 4096, slack: int = 8) -> DataFrame:
    """(item, sequence_id, offset) for ``items`` (item long, length int), lengths from 1 to ``capacity``."""
    bins = items.select(F.col("length").alias("size"), F.array("item").alias("items"), F.array("length").alias("lengths"))
    bins, before, done = materialize(bins.mapInArrow(_pack(capacity), BINS), "bins"), None, None
    while True:
        full = bins.where(F.col("size") >= capacity - slack)
        rest = bins.where(F.col("size") < capacity - slack)
        n, parts = rest.count(), bins.rdd.getNumPartitions()
        done = full if done is None else done.union(full)
        if n <= 1 or before is not None and (before[1] == 1 or n > 0.99 * before[0]):
            done = done.union(rest)
            break
        parts = max(1, -(-n // BLOCK), min(parts // 8, n // 1000))
        before = (n, parts)
        # by a hash of the first member: the same rows meet again if a lost task is run anew
        bins = materialize(rest.repartition(parts, F.xxhash64(F.get("items", F.lit(0)))).mapInArrow(_pack(capacity), BINS), "bins")
    return done.mapInArrow(_place, "item long, sequence_id long, offset long")


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members laid end to end; a bin is named after its first member."""
    for batch in batches:
        items, sizes = batch.column("items"), batch.column("lengths")
        members, counts = items.flatten().to_numpy(), items.value_lengths().to_numpy().astype(np.int64)
        ends = np.cumsum(sizes.flatten().to_numpy().astype(np.int64))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)[:len(members)]
        first = np.cumsum(counts) - counts
        yield pa.RecordBatch.from_arrays([pa.array(members), pa.array(np.repeat(members[first], counts)), pa.array(starts - np.repeat(starts[first], counts))],
                                         ["item", "sequence_id", "offset"])


def best_fit_packing(docs: DataFrame, tokenizer_file: str | None = None, capacity: int = 4096, end_id: int = 1, slack: int = 8,
                     id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) per piece."""
    ship_package(docs.sparkSession)
    path = tokenizer_file or public_path("word_bpe_49k.json")
    schema = "doc_id long, piece int, start long, length int, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    with arrow_batches(docs.sparkSession, TEXT_ROWS):
        pieces = materialize(rows.mapInArrow(_pieces(path, end_id, capacity, with_ids), schema).withColumn("item", F.monotonically_increasing_id()), "pieces")
    placed = pack(pieces.select("item", "length"), capacity, slack)
    return (pieces.join(placed, "item").drop("item").withColumn("length", F.col("length").cast("long")))
