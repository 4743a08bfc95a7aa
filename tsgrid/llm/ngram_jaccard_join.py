"""N-gram Jaccard join by PartEnum signatures.

A document is the set of its distinct word n-grams. Two sets link when their Jaccard similarity is at
least ``percent`` / 100. If |u| = s and |v| = t and they link, their Hamming distance |u xor v| is at most
(100 - p)(s + t) / (100 + p) (that is (s + t) / 9 at 80 %), and t lies in [p s / 100, 100 s / p].

PartEnum. Size bands [L, R) overlap so that any two linkable sizes share a band. In a band the feature
domain (64-bit n-gram hashes) is cut into n1 partitions, each cut again into n2 parts. If at most h
features differ, then among q partitions with q (k2 + 1) > h some partition holds at most k2 differences,
so one of its subsets of n2 - k2 parts is equal in both sets. Every subset's content is hashed to one
signature; linked sets therefore share a signature.

Two refinements keep this exact and cheap:

* Empty signatures are never emitted. A set with bound k emits its partitions in index order until
  (k2 + 1) x (partitions with more than k2 non-empty parts) > k. Of two linked sets the one with the
  shorter prefix has, inside it, an equal and non-empty subset, and the other emits that subset too.
* The domain leaves out *heavy* n-grams (shared lines and passages). Removing features from the domain can
  only lower a Hamming distance, so nothing is lost. A set that is too empty without them also emits
  signatures of the whole domain; if both sets of a pair are that empty they meet there, else the fuller
  one's signatures meet the other's in the light domain. Any heavy list gives the same result; it holds
  the at most HEAVY_ROWS n-grams that blocks of rows report as most frequent, counted over all rows.

Documents with one and the same set (of any number) are one node. Signature buckets are then resolved
without emitting all pairs: each round pairs the members of a bucket only with its pivot (the member that
shares most buckets), verifies, joins components, and drops every bucket whose members are already in one
component (found by partial aggregates over the bucket, not in one task). After PIVOT_ROUNDS the pairs still open are verified one and all: buckets of up to SMALL members by
a join of ids, larger ones (a dense group whose members lie near the limit) in tiles of blocks of at most TILE
members, inside which sketches are compared and only pairs that may link are written, each in the bucket
with its least shared key.

Verification: the sizes first; then parity sketches (bit i is the parity of the n-grams whose hash ends in
i, so the sketches' Hamming distance never exceeds the sets': no link is dropped); then the whole sets.

Defined results: null or wordless text: n_shingles 0, its own component. Null id: component null, never
linked. Repeated ids: one node with the links of all its rows; one result row per input row. Other columns
of the input are not read, so clashing names do no harm. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import arrow_batches, chunks, components, join_components, materialize, mix, no_store, small_broadcast, text_buffers

#: Bytes that separate words, and upper-case ASCII.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_SEED = mix(np.arange(1, 257))
_BASE, _STEPS = 0x9E3779B97F4A7C15, mix(np.arange(1001, 1065)) | np.uint64(1)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, int(n).bit_length())
        _POWERS.clear()
        for x in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, x, dtype=np.uint64)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(data: np.ndarray, off: np.ndarray, letters: np.ndarray = ~SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, row) of every word (bytes of ``letters`` after lower-casing) of the texts data[off[i]:off[i+1]]."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = LOWER[data]
    word = letters[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[off] = True
    first = word & (edge[:-1] | ~np.concatenate([[False], word[:-1]]))
    last = word & (edge[1:] | ~np.concatenate([word[1:], [False]]))
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(len(low))
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(_SEED[low] * up, out=sums[1:])
    h = mix((sums[ends] - sums[starts]) * down[starts])
    return h, np.searchsorted(off, starts, side="right") - 1


def grams_of(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of its first word) of every k words in a row that belong to one text."""
    at = np.flatnonzero(row[k - 1:] == row[:len(row) - k + 1]) if len(h) >= k else np.zeros(0, np.int64)
    grams = np.zeros(len(at), np.uint64)
    for j in range(k):
        grams += h[at + j] * _STEPS[j]
    return mix(grams + np.uint64(k)), at


def ngram_sets(data: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the sorted distinct n-gram hashes of each text, all in one array.

    A text of 1 to n - 1 words has its whole sequence as its one feature; one without words has none.
    """
    h, row = word_hashes(data, off)
    rows = len(off) - 1
    words = np.bincount(row, minlength=rows)
    at = np.concatenate([[0], np.cumsum(words)])
    grams = np.zeros(len(h), np.uint64)
    for j in range(n):
        grams[:len(h) - j] += h[j:] * _STEPS[j]
    grams = mix(grams + np.uint64(n))
    out, sizes = [], np.zeros(rows + 1, np.int64)
    for i in range(rows):
        k = words[i]
        if k >= n:
            s = np.sort(grams[at[i]:at[i + 1] - n + 1])
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif k:
            s = mix(np.array([(h[at[i]:at[i + 1]] * _STEPS[:k]).sum() + np.uint64(k)]))
        else:
            continue
        out.append(s)
        sizes[i + 1] = len(s)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.cumsum(sizes)


def bands(sizes: np.ndarray, percent: int, growth: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each band a set may be in: (band number, -1 for none; largest size of the band; bound k)."""
    s = np.maximum(sizes, 1)
    span = growth * 100 / percent
    top = np.floor(np.log(s) / np.log(growth) + 1e-9).astype(np.int64)
    for back in range(int(np.ceil(np.log(span) / np.log(growth))) + 1):
        b = top - back
        high = np.floor(growth ** b * span + 1e-6).astype(np.int64)
        inside = (sizes > 0) & (b >= -back) & (s <= high)
        partner = np.minimum(s * 100 // percent, high)
        yield np.where(inside, b, -99), high, (100 - percent) * (s + partner) // (100 + percent)


def signatures(grams: np.ndarray, off: np.ndarray, heavy: np.ndarray, percent: int = 80,
               growth: float = 1.5, room: float = 1.3) -> tuple[np.ndarray, np.ndarray]:
    """(signature, row) of every set grams[off[i]:off[i+1]]; ``heavy`` is sorted."""
    sizes = np.diff(off)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = mix(grams ^ np.uint64(0xA5A5A5A5)) >> np.uint64(32)
    value = mix(grams + np.uint64(0x51ED270B))
    if len(heavy):
        near = np.minimum(np.searchsorted(heavy, grams), len(heavy) - 1)
        light = heavy[near] != grams
    else:
        light = np.ones(len(grams), bool)
    keys, rows = [], []
    for band, high, k in bands(sizes, percent, growth):
        widest = 2 * (100 - percent) * high // (100 + percent)
        for n2, k2 in ((3, 1), (1, 0)):  # small bounds enumerate the pairs of three parts
            mine = (band > -99) & (((widest >= 1) & (widest <= 3)) == (n2 == 3))
            if not mine.any():
                continue
            need = np.where(mine, k // (k2 + 1) + 1, 0)
            least = widest // (k2 + 1) + 1
            n1 = np.where(mine, least if n2 > 1 else np.ceil(least * room).astype(np.int64) + 2, 0)
            base = np.concatenate([[0], np.cumsum(n1)])
            cells = int(base[-1])
            owner = np.repeat(np.arange(len(sizes)), n1)
            index = np.arange(cells) - base[owner]
            where = mix(((band[owner] + 100) * 1_000_003).astype(np.uint64) + (index.astype(np.uint64) << np.uint64(32)))
            todo = mine
            for domain in ("light", "whole", "with empties"):
                use = todo[row] & light if domain == "light" else todo[row]
                p = ((value[use] >> np.uint64(40)) % np.uint64(n2)).astype(np.int64)
                c = base[row[use]] + (place[use] % n1[row[use]].astype(np.uint64)).astype(np.int64)
                sums, full = np.zeros((n2, cells), np.uint64), np.zeros((n2, cells), bool)
                np.add.at(sums, (p, c), value[use])
                full[p, c] = True
                strong = full.sum(0) > k2
                rank = np.cumsum(strong) - strong
                emit = (rank - rank[base[owner]] < need[owner]) & todo[owner] | (domain == "with empties") & todo[owner]
                for parts in combinations(range(n2), n2 - k2):
                    some = emit & (full[list(parts)].any(0) | (domain == "with empties"))
                    tag = mix(np.array([len(domain) * 64 + sum(1 << x for x in parts)]))
                    keys.append(mix(sums[list(parts)].sum(0)[some] + where[some] + tag))
                    rows.append(owner[some])
                todo = todo & (np.bincount(owner, weights=strong, minlength=len(sizes)) < need)
                if not todo.any():
                    break
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(rows)


#: At most so many n-grams (8 bytes each) are sent to all tasks as heavy; the least count that makes one.
HEAVY_ROWS, HEAVY_LEAST = 1_000_000, 24
PIVOT_ROUNDS, SMALL, TILE = 2, 32, 2000
#: Rows whose sets a task holds at once, and rows of an Arrow batch.
BLOCK_ROWS, BATCH_ROWS = 2500, 500


def _sets_of(batch: pa.RecordBatch, text: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw, off = text_buffers(batch.column(text))
    grams, sizes = [], [np.zeros(1, np.int64)]
    for i, j in chunks(off):
        g, o = ngram_sets(raw[off[i]:off[j]], off[i:j + 1] - off[i], n)
        grams.append(g)
        sizes.append(np.diff(o))
    return np.concatenate(grams or [np.zeros(0, np.uint64)]), np.cumsum(np.concatenate(sizes))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in blocks of about BLOCK_ROWS."""
    no_store()
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK_ROWS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held.clear()
    if held and sum(b.num_rows for b in held):
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), column.is_valid().to_numpy(zero_copy_only=False)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _describe(n: int):
    """Per text (id, size, two set hashes); per block (null, count, n-gram, null) of n-grams in 2 texts or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            g, off = _sets_of(batch, "text", n)
            size = np.diff(off)
            hashes = []
            for salt in (0x1234567, 0x89ABCDE):
                total = np.zeros(len(g) + 1, np.uint64)
                np.cumsum(mix(g + np.uint64(salt)), out=total[1:])
                hashes.append(mix(total[off[1:]] - total[off[:-1]]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size), *map(_long, hashes)], ["id", "n", "s1", "s2"])
            s = np.sort(g)
            first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(s)))
            often = count >= 2
            if often.any():
                k = int(often.sum())
                yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.array(count[often]), _long(s[first[often]]), pa.nulls(k, pa.int64())], ["id", "n", "s1", "s2"])
    return run


def _sign(n: int, percent: int, heavy: np.ndarray):
    """(key, id, spread) rows; equal sets within a block of rows are signed once, under their least id.

    A signature that several sets of the block share is known to be shared: its rows have a spread of their own (the id)
    and one row without an id stands for them under spread 0, where the other signatures' rows are. So at most one row a
    block meets under (key, 0), however many rows the signature has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            g, off = _sets_of(batch, "text", n)
            ids, valid = _ids(batch.column("id"))
            least: dict[bytes, int] = {}
            for i in np.argsort(ids, kind="stable"):
                if valid[i] and off[i + 1] > off[i]:
                    least.setdefault(g[off[i]:off[i + 1]].tobytes(), int(i))
            keep = sorted(least.values())
            del least
            found: list[tuple[np.ndarray, np.ndarray]] = []
            at = 0
            while at < len(keep):
                to, room = at, 0
                while to < len(keep) and (to == at or room + off[keep[to] + 1] - off[keep[to]] <= 200_000):
                    room += off[keep[to] + 1] - off[keep[to]]
                    to += 1
                part = keep[at:to]
                own = np.concatenate([[0], np.cumsum([off[i + 1] - off[i] for i in part])]).astype(np.int64)
                keys, rows = signatures(np.concatenate([g[off[i]:off[i + 1]] for i in part]), own, heavy, percent)
                found.append((keys, ids[part][rows]))
                at = to
            if not found:
                continue
            keys, owners = (np.concatenate(x) for x in zip(*found))
            del found, g
            order = np.lexsort((owners, keys))
            keys, owners = keys[order], owners[order]
            apart = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])])[:len(keys)]
            keys, owners = keys[apart], owners[apart]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
            times = np.diff(np.append(first, len(keys)))
            known = np.repeat(times > 1, times)
            stand = keys[first[times > 1]]
            spread = np.where(known, owners, 0)
            for i in range(0, len(keys), 1 << 17):
                j = slice(i, i + (1 << 17))
                yield pa.RecordBatch.from_arrays([_long(keys[j]), pa.array(owners[j]), pa.array(spread[j]), pa.array(known[j])], ["key", "id", "spread", "known"])
            if len(stand):
                yield pa.RecordBatch.from_arrays([_long(stand), pa.nulls(len(stand), pa.int64()), pa.array(np.zeros(len(stand), np.int64)),
                                                  pa.array(np.zeros(len(stand), bool))], ["key", "id", "spread", "known"])
    return run


def sketch(grams: np.ndarray) -> bytes:
    """Parity of the number of n-grams in each of 4 x 2^ceil(log2 size) cells (64 at least)."""
    cells = max(64, 4 << int(len(grams) - 1).bit_length())
    bits = np.bincount((grams & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(bits.astype(bool)).tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """A lower bound of the sets' Hamming distance; the larger sketch is folded to the smaller one's cells."""
    x, y = (np.frombuffer(s, np.uint8) for s in (a, b))
    m = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(s.reshape(-1, m), axis=0) for s in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _keep_sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            g, off = _sets_of(batch, "text", n)
            sets = [g[off[i]:off[i + 1]] for i in range(len(off) - 1)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([sketch(s) for s in sets], pa.binary()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "sketch", "grams"])
    return run


def _near(percent: int):
    """Pairs whose sketches allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.array(batch.column("na")) + np.array(batch.column("nb"))
            ok = [sketch_distance(x.as_py(), y.as_py()) * (100 + percent) <= (100 - percent) * t
                  for x, y, t in zip(batch.column("xa"), batch.column("xb"), n)]
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(ok, pa.bool_())) for c in ("a", "b")], ["a", "b"])
    return run


def _near_in_tile(percent: int):
    """Pairs of one bucket's blocks (left, right) in different components whose sketches allow a link."""
    def run(key: tuple, t: pa.Table) -> pa.Table:
        own, left, right = (k.as_py() for k in key)
        block, node, n, comp = (t.column(c).to_numpy() for c in ("block", "node", "n", "comp"))
        keys = t.column("keys").to_pylist()
        raw = [np.frombuffer(x.as_py(), np.uint8) for x in t.column("sketch")]
        width = min(map(len, raw))
        bits = np.stack([np.bitwise_xor.reduce(x.reshape(-1, width), axis=0) for x in raw]).view(np.uint64)
        a, b = np.flatnonzero(block == left), np.flatnonzero(block == right)
        out: list[tuple[int, int]] = []
        for i in a:
            to = b[(b > i) | (left != right)]
            to = to[(comp[to] != comp[i]) & (np.minimum(n[to], n[i]) * 100 >= np.maximum(n[to], n[i]) * percent)]
            apart = np.bitwise_count(bits[to] ^ bits[i]).sum(1, dtype=np.int64)
            for j in to[apart * (100 + percent) <= (100 - percent) * (n[to] + n[i])]:
                if not any(k < own for k in set(keys[i]).intersection(keys[j])):
                    out.append((int(node[i]), int(node[j])))
        x, y = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())})
    return run


def _linked(percent: int):
    """Pairs with 100 x intersection >= percent x union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("xa"), batch.column("xb")):
                u, v = (np.frombuffer(s.as_py(), np.uint64) for s in (x, y))
                both = len(np.intersect1d(u, v, assume_unique=True))
                ok.append(100 * both >= percent * (len(u) + len(v) - both))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(ok, pa.bool_())) for c in ("a", "b")], ["a", "b"])
    return run


def ngram_jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                             percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; see the module's text."""
    ship_package(docs.sparkSession)
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        return _components(docs, id_col, text_col, n, percent)


def _components(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    seen = materialize(rows.mapInArrow(_describe(n), "id long, n long, s1 long, s2 long"), "sets-described")
    texts = seen.where(F.col("s2").isNotNull())
    counts = (seen.where(F.col("s2").isNull()).groupBy("s1").agg(F.sum("n").alias("c"))
              .where(F.col("c") >= HEAVY_LEAST))
    heavy = np.sort(np.array([r.s1 for r in counts.orderBy(F.desc("c"), "s1").limit(HEAVY_ROWS).collect()], np.int64).view(np.uint64))

    reps = (texts.where("id is not null and n > 0").groupBy("s1", "s2")
            .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    nodes = materialize(texts.where("id is not null and n > 0").select("id", "n", "s1", "s2").join(reps, ["s1", "s2"])
                        .select("id", "n", "rep").distinct(), "set-nodes")

    signed = rows.mapInArrow(_sign(n, percent, heavy), "key long, id long, spread long, known boolean")
    alone = Window.partitionBy("key", "spread", "known")
    shared = materialize(signed.withColumn("m", F.count(F.lit(1)).over(alone)).where("id is not null and (known or m > 1)")
                         .select("key", "id"), "shared-signatures")
    members = shared.join(nodes, "id").select("key", F.col("rep").alias("node"), "n").distinct()
    weight = members.groupBy("node").agg(F.count(F.lit(1)).alias("w"))
    members = materialize(members.join(weight, "node"), "signature-members")
    wanted = materialize(members.select(F.col("node").alias("id")).distinct(), "set-ids")
    sets = materialize(rows.join(small_broadcast(wanted, wanted.count()), "id", "left_semi")
                       .mapInArrow(_keep_sets(n), "id long, sketch binary, grams binary"), "sets")

    def side(column: str, x: str) -> DataFrame:
        return sets.select(F.col("id").alias(x), F.col(column).alias(f"x{x}"))

    def near(pairs: DataFrame) -> DataFrame:
        pairs = pairs.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
        return pairs.join(side("sketch", "b"), "b").join(side("sketch", "a"), "a").mapInArrow(_near(percent), "a long, b long")

    def linked(pairs: DataFrame) -> DataFrame:
        pairs = materialize(pairs.distinct(), "near-pairs")
        return materialize(pairs.join(side("grams", "b"), "b").join(side("grams", "a"), "a").mapInArrow(_linked(percent), "a long, b long"), "links").distinct()

    def group(known: DataFrame | None, links: DataFrame) -> DataFrame:
        return materialize(components(links, "a", "b") if known is None else join_components(known, links, "a", "b"), "components")

    twice = nodes.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z")
    links = materialize(nodes.join(twice, "id").where("rep <> a").select("a", F.col("rep").alias("b")), "repeated-ids")
    comps, done, labelled = None, None, members.withColumn("comp", F.col("node"))
    for turn in range(PIVOT_ROUNDS + 1):
        # partial aggregates joined back: no task holds a whole bucket
        buckets = materialize(labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"))
                              .where("lo <> hi").select("key", "m"), "open-buckets")
        n_open = buckets.count()
        if not n_open:
            break
        open_ = labelled.join(small_broadcast(buckets, n_open), "key")
        heaviest = F.struct("w", (-F.col("node")).alias("first"), "n", "comp")
        if turn < PIVOT_ROUNDS:
            # the pivot of later rounds comes from outside the component that holds the heaviest member
            top = open_.groupBy("key").agg(F.max(heaviest).alias("top"))
            if turn:
                top = open_.join(top, "key").where(F.col("comp") != F.col("top.comp")).groupBy("key").agg(F.max(heaviest).alias("top"))
            top = top.select("key", (-F.col("top.first")).alias("a"), F.col("top.n").alias("na"), F.col("top.comp").alias("ca"))
            pairs = open_.join(top, "key").where("comp <> ca").select("a", "na", F.col("node").alias("b"), F.col("n").alias("nb")).distinct()
            if done is not None:
                pairs = pairs.join(done, ["a", "b"], "left_anti")
            pairs = materialize(pairs, "pairs")
            both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
            done = both if done is None else done.union(both)
            new = linked(near(pairs))
        else:
            few = open_.where(F.col("m") <= SMALL)
            pairs = (few.select("key", F.col("node").alias("a"), F.col("n").alias("na"), F.col("comp").alias("ca"))
                     .join(few.select("key", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("cb")), "key")
                     .where((F.col("ca") < F.col("cb")) & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent))
                     .select("a", "na", "b", "nb").distinct().join(done, ["a", "b"], "left_anti"))
            many = open_.where(F.col("m") > SMALL)
            keys = many.groupBy("node").agg(F.slice(F.sort_array(F.collect_set("key")), 1, 16).alias("keys"))
            blocks = F.ceil(F.col("m") / TILE).cast("int")
            tiles = (many.join(keys, "node").join(side("sketch", "node"), "node").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
                     .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
                     .select("key", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", "node", "n", "comp", "keys",
                             F.col("xnode").alias("sketch")).groupBy("key", "left", "right").applyInArrow(_near_in_tile(percent), "a long, b long"))
            new = linked(near(pairs).union(tiles))
        comps = group(comps, new if turn else links.union(new))
        if turn < PIVOT_ROUNDS:
            labelled = materialize(open_.drop("comp", "m").join(comps, "node", "left").select("key", "node", "n", "w", F.coalesce("component", "node").alias("comp")), "open-members")
    comps = group(None, links) if comps is None else comps
    label = (nodes.select("id", "rep").distinct().join(comps.withColumnRenamed("node", "rep"), "rep", "left")
             .select("id", F.coalesce("component", "rep").alias("component")))
    label = label.groupBy("id").agg(F.min("component").alias("component"))
    return (texts.select("id", "n").join(label, "id", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")))
