r"""Filter interaction audit: what five document filters remove together, alone, and in every order.

Per text, one pass of a table-driven byte transducer. Its two states are GAP and WORD; a table gives for (state, byte
class) the next state and the events: a word begins, a code point, a capital, a symbol. Each class leads to one state
whatever the state before, so the state before every byte of a block of texts is known at once (GAP at the start of a
text), and the pass is a few table lookups over whole blocks. Word spans go into a hash table, open addressed and
verified: a span is a duplicate only if the text, the length and all bytes (compared eight at a time) of the span in
its slot are the same; else it steps on. The spans that found a free slot are the text's distinct words.

A document's failures are a 5-bit mask: A few words, B few distinct words, C many capitals, D a symbol, E a copy of a
smaller doc_id's text. Copies meet by a 128-bit digest: rows with equal (digest, part, mask, labels) are counted
before the shuffle, the smallest id per digest is an aggregate with map-side combine, and it is joined back to the
counted rows, so a digest that holds a third of all rows is a few rows per part.

All 120 orders x 5 steps follow from kept(S) = documents of the part with no bit of S, for the 32 subsets S: a step's
removed = kept(S before) - kept(S before + its filter). Nothing is counted per order.

Defined results: null text is empty (fails A only, and E as a copy of other empty texts). Null source: part ''. Null
doc_id: never fails E, makes no other row fail it, has no label. Rows that repeat a doc_id are documents of their
own; they are no smaller than each other. Repeated labels: the largest value; missing or null labels count as 0.
Extra columns are not read. An empty table gives an empty result. Bytes that are no UTF-8: a code point is any byte but 80-BF.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import chunks, materialize, mix, text_buffers

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
#: White space between words, and the symbols of filter D.
SPACES, SYMBOLS = b"\x20\x09\x0a\x0b\x0c\x0d", b"#$%&*|"

SPACE, LETTER, CAPITAL, SYMBOL, TAIL = range(5)
GAP, WORD = 0, 1
CLASS = np.full(256, LETTER, np.uint8)
CLASS[list(SPACES)], CLASS[65:91], CLASS[list(SYMBOLS)], CLASS[0x80:0xC0] = SPACE, CAPITAL, SYMBOL, TAIL
#: Next state by class (the same from either state), and the events by state and class.
NEXT = np.array([GAP, WORD, WORD, WORD, WORD], np.uint8)
BEGINS, POINT, UPPER, SIGN = 1, 2, 4, 8
EVENTS = np.array([[(BEGINS if state == GAP and NEXT[c] == WORD else 0) | (POINT if c != TAIL else 0) | (UPPER if c == CAPITAL else 0) | (SIGN if c == SYMBOL else 0)
                    for c in range(5)] for state in (GAP, WORD)], np.uint8)


def transduce(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(events per byte, starts and ends of the words) of the texts raw[off[k]:off[k + 1]]."""
    classes = CLASS[raw]
    after = NEXT[classes]
    edges = off[1:-1][off[1:-1] < len(raw)]  # first bytes of texts
    before = np.empty_like(after)
    before[:1], before[1:] = GAP, after[:-1]
    before[edges] = GAP
    events = EVENTS.ravel()[before * 5 + classes]
    ahead = np.empty_like(after)
    ahead[-1:], ahead[:-1] = GAP, after[1:]
    ahead[edges[edges > 0] - 1] = GAP
    return events, np.flatnonzero(events & BEGINS), np.flatnonzero(after & (ahead ^ 1)) + 1


class Spans:
    """Byte spans that can be hashed and compared eight bytes at a time."""

    MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)

    def __init__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        padded = np.append(raw, np.zeros(8, np.uint8))
        self.eights = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        self.starts, self.sizes = starts, ends - starts
        self.first = self.lane(np.arange(len(starts)), 0)

    def lane(self, at: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8 k to 8 k + 7 of the spans ``at``, which are longer than 8 k."""
        return self.eights[self.starts[at] + 8 * k] & self.MASKS[np.minimum(self.sizes[at] - 8 * k, 8)]

    def hashes(self, seed: np.ndarray) -> np.ndarray:
        h = mix(seed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + self.sizes.astype(np.uint64) ^ self.first)
        at, k = np.flatnonzero(self.sizes > 8), 1
        while len(at):
            h[at] = mix(h[at] ^ self.lane(at, k))
            k += 1
            at = at[self.sizes[at] > 8 * k]
        return h

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = (self.sizes[a] == self.sizes[b]) & (self.first[a] == self.first[b])
        at, k = np.flatnonzero(out & (self.sizes[a] > 8)), 1
        while len(at):
            equal = self.lane(a[at], k) == self.lane(b[at], k)
            out[at[~equal]] = False
            k += 1
            at = at[equal & (self.sizes[a[at]] > 8 * k)]
        return out


def distinct_spans(spans: Spans, text: np.ndarray) -> np.ndarray:
    """True at one span of each distinct (text, bytes)."""
    n = len(text)
    mask = (1 << max(1, (2 * n).bit_length())) - 1
    table = np.full(mask + 1, -1, np.int64)
    slot = (spans.hashes(text) & np.uint64(mask)).astype(np.int64)
    out, waiting = np.zeros(n, bool), np.arange(n)
    while len(waiting):
        free = waiting[table[slot[waiting]] < 0]
        table[slot[free]] = free
        holder = table[slot[waiting]]
        won = holder == waiting
        out[waiting[won]] = True
        waiting, holder = waiting[~won], holder[~won]
        waiting = waiting[~((text[waiting] == text[holder]) & spans.same(waiting, holder))]
        slot[waiting] = (slot[waiting] + 1) & mask
    return out


def text_counts(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Per text: words, distinct words, code points, capitals, symbols."""
    out = np.zeros((5, len(off) - 1), np.int64)
    filled = np.flatnonzero(np.diff(off))
    if not len(filled):
        return out
    events, starts, ends = transduce(raw, off)
    out[0] = np.diff(np.searchsorted(starts, off))
    text = np.repeat(np.arange(len(off) - 1), out[0])
    if len(starts):
        new = distinct_spans(Spans(raw, starts, ends), text)
        out[1] = np.bincount(text[new], minlength=len(off) - 1)
    for k, event in ((2, POINT), (3, UPPER), (4, SIGN)):
        out[k, filled] = np.add.reduceat((events & event) != 0, off[filled], dtype=np.int64)
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, off = text_buffers(batch.column("text"))
        counts, digests = np.zeros((5, len(off) - 1), np.int64), []
        for i, j in chunks(off):
            counts[:, i:j] = text_counts(raw[off[i]:off[j]], off[i:j + 1] - off[i])
            digests += [hashlib.blake2b(raw[off[k]:off[k + 1]], digest_size=16).digest() for k in range(i, j)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary()), *map(pa.array, counts)],
                                         ["doc_id", "part", "digest", "n_words", "n_distinct", "n_points", "n_capitals", "n_symbols"])


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, digest, n_words, n_distinct, n_points, n_capitals, n_symbols) of every text."""
    ship_package(docs.sparkSession)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_counts, "doc_id long, part string, digest binary, n_words long, n_distinct long, n_points long, n_capitals long, n_symbols long"))


def text_mask() -> Column:
    """The bits of the filters that a text fails by itself: A, B, C, D."""
    n = F.col("n_words")
    fails = [n < MIN_WORDS, 100 * F.col("n_distinct") < DISTINCT_PERCENT * n, 100 * F.col("n_capitals") > CAPITAL_PERCENT * F.col("n_points"), F.col("n_symbols") > 0]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def failure_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, good, toxic, n): the documents of each part by failures and labels."""
    one = F.lit(1)
    # equal rows are counted before anything is joined; a null id is spread by a salt that no label has
    rows = (document_counts(docs, id_col, text_col, part_col).withColumn("mask", text_mask())
            .groupBy("doc_id", "part", "digest", "mask").agg(F.count(one).alias("n"))
            .withColumn("salt", F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.xxhash64("digest", "part"), F.lit(1024))).otherwise(0)))
    flag = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0))
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id is not null")
             .groupBy("doc_id").agg(flag("quality").alias("good"), flag("toxic").alias("toxic")).withColumn("salt", F.lit(0).cast("long")))
    joined = rows.withColumn("doc_id0", F.coalesce("doc_id", F.lit(0))).join(known.withColumnRenamed("doc_id", "doc_id0"), ["doc_id0", "salt"], "left")
    # the smallest id of a group, with its number of rows; struct order is by the id
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    counted = materialize(joined.groupBy("digest", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
                          .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"), least.alias("least")), "audit")
    first = counted.groupBy("digest").agg(F.min("least.doc_id").alias("first"))
    original = F.col("no_id") + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    both = (counted.join(first, "digest").withColumn("original", original)
            .select("part", "good", "toxic", F.explode(F.array(F.struct("mask", F.col("original").alias("n")),
                                                               F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("original")).alias("n")))).alias("c")))
    return both.select("part", "good", "toxic", "c.mask", "c.n").where("n > 0").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    subsets = range(1 << len(FILTERS))

    def survivors(of: Column, name: str) -> Column:
        """Documents without a bit of each subset."""
        return F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) == 0, of).otherwise(0)) for s in subsets]).alias(name)

    n = F.col("n")
    parts = failure_cells(docs, labels, id_col, text_col, part_col).groupBy("part").agg(
        survivors(n, "all"), survivors(n * F.col("good"), "good"), survivors(n * F.col("toxic"), "bad"),
        F.array(*[F.sum(F.when(F.col("mask") == 1 << k, n).otherwise(0)) for k in range(len(FILTERS))]).alias("alone"))
    kept = lambda s: F.get("all", F.lit(s))
    count = len(FILTERS)
    value = []
    for k in range(count):
        bit, terms = 1 << k, F.lit(0).cast("long")
        for s in (s for s in subsets if not s & bit):
            size = s.bit_count()
            terms = terms + F.lit(factorial(size) * factorial(count - 1 - size)) * (kept(s) - kept(s | bit))
        value.append(terms)
    parts = parts.withColumn("shapley", F.array(*value))
    # 600 steps: fixed by the five letters
    steps = [(("".join(order)), k + 1, sum(1 << FILTERS.index(x) for x in order[:k]), FILTERS.index(order[k])) for order in permutations(FILTERS) for k in range(count)]
    table = docs.sparkSession.createDataFrame(steps, "filter_order string, step int, before int, filter int")
    at = parts.crossJoin(F.broadcast(table)).withColumn("bit", F.pow(F.lit(2), "filter").cast("int")).withColumn("after", F.col("before") + F.col("bit"))
    lost = lambda c: F.get(c, F.col("before")) - F.get(c, F.col("after"))
    fails = F.get("all", F.lit(0)) - F.get("all", F.col("bit"))
    return at.select("part", "filter_order", "step", F.get("all", F.col("after")).alias("kept"), lost("all").alias("removed"), (fails - lost("all")).alias("redundant"),
                     F.get("alone", F.col("filter")).alias("unique_fails"), lost("good").alias("good_lost"), lost("bad").alias("toxic_lost"), F.get("shapley", F.col("filter")).alias("shapley"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, doc_id, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
        + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t))::INT
        + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask FROM w),
c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
      FROM m LEFT JOIN l ON l.doc_id = m.doc_id GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM f a, f b, f c, f d, f e
      WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, bit,
        sum(CASE WHEN (mask & (before + bit)) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN (mask & bit) <> 0 AND (mask & before) = 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN (mask & bit) <> 0 AND (mask & before) <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN (mask & bit) <> 0 AND (mask & before) = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN (mask & bit) <> 0 AND (mask & before) = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""
