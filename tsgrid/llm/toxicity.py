r"""Toxicity: a subsequence string-kernel support vector machine with Nyström landmarks.

A text's sentences are bags of segments: lower-cased words without their outer punctuation, and runs of three
or more single characters joined ("i d i o t"); longer words are overlapping windows of LONGEST characters.
The kernel of two segments counts the character subsequences of length 3 that they share, ends included, a
subsequence being weighted by DECAY per character it spans (SPAN at most); it is normalised and raised to the
power POWER, so gaps and inserted characters weaken a match but do not break it, and a shared stem counts less
than a shared word.

Training (labelled sentences of a bounded, hash-ordered sample of SAMPLE labelled documents per class):

1. Spark counts in how many toxic and clean sample texts each segment occurs, which gives its log-odds.
2. Every toxic text gives its sentence's witness, the segment with the largest log-odds (in three toxic texts
   that differ, by the smallest hash of their word triples, so that copies of one text don't count as evidence; if
   no segment is, each toxic text gives its best one of those that no clean text holds); clean texts give their most frequent segments, a hash sample,
   and those most like the toxic landmarks (hard negatives).
3. Landmarks: a k-centre choice of witnesses and of frequent clean segments, and the hardest negatives. Nyström features K(x, Z) K(Z, Z)^(-1/2) go to a linear support
   vector machine with squared hinge loss (at most SAMPLE + 2 HARD + HARD / 2 segments, on the driver).
4. The margin of a sentence is its best segment's, of a text its best sentence's; a logistic curve fitted to the
   sample texts' margins turns it into the score.

Scoring: the landmarks' weights by subsequence and one coefficient per landmark (whitening and SVM folded) go
to the tasks; each worker scores a word once, as long as its bounded store of words holds it. No shuffle. Only the text is an input of
a score.

Defined results: null or empty text: the margin of an empty segment. Null id: scored, not held out. Repeated
ids: one result per row; repeated labels: toxic if any row says so. Null labels are left out. Without both
classes among the sample's texts (those with a segment of three characters), or if clean texts hold all segments of the toxic ones, every score is 0. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import TEXT_ROWS, arrow_batches, chunks, materialize, only_store, text_buffers

SAMPLE = 4000
LONGEST, SPAN, DECAY, POWER = 24, 6, 0.7, 3
LANDMARKS, HARD, CLIP = (160, 120, 20), 4000, 3.0
BLOCK_BYTES = 8 << 20
#: Segments whose matches with the landmarks are held at once.
KERNEL_ROWS = 1000
_EDGE = " \t\r\n.,;:!?\"'()[]{}<>*#$%&|-_=+/\\~^`"
_LOOKS, _OTHER = str.maketrans("013457@$", "oieastas"), re.compile(r"[\W\d_]+")
_STEPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN - a)]


def tokens_of(text: str) -> list[str]:
    """Lower-cased words; three or more single characters in a row also give their join."""
    words = text.lower().split()
    single = np.fromiter(map(len, words), np.int64, len(words)) == 1
    if (single[2:] & single[1:-1] & single[:-2]).any():
        run: list[str] = []
        for w in [*words, ".."]:
            if len(w) == 1:
                run.append(w)
                continue
            if len(run) > 2:
                words.append("".join(run))
            run = []
    return words


def windows(word: str) -> list[str]:
    """A word's segments; one with inner marks or digits also without them, look-alike digits as letters."""
    word = word.strip(_EDGE)
    forms = [word]
    if not word.isalpha() and (plain := _OTHER.sub("", word.translate(_LOOKS))) != word:
        forms.append(plain)
    return [w[i:i + LONGEST] for w in forms for i in range(0, max(1, len(w) - LONGEST // 2), LONGEST // 2 if len(w) > LONGEST else max(1, len(w)))]


def classes(text: str) -> np.ndarray:
    """a-z are 0..25; other letters 26..61; other ASCII 63; 62 marks the ends of a segment."""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    latin = (c >= 97) & (c <= 122)
    other = np.where(c == 0, 62, np.where(c < 128, 63, 26 + c % 36))
    return np.where(latin, c - 97, other)


def subsequences(segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, code, weight) of the normalised subsequence weights, sorted by segment and code."""
    # NUL marks both ends, so short words have as many subsequences of their own as they need
    c = classes("\0" + "\0\0".join(segments) + "\0") if segments else np.zeros(0, np.int64)
    sizes = np.fromiter(map(len, segments), np.int64, len(segments)) + 2
    seg = np.repeat(np.arange(len(segments)), sizes)
    keys, weights = [], []
    for a, b in _STEPS:
        n = len(c) - a - b
        if n <= 0:
            continue
        i = np.flatnonzero(seg[:n] == seg[a + b:])
        keys.append(seg[i] << 18 | c[i] << 12 | c[i + a] << 6 | c[i + a + b])
        weights.append(np.full(len(i), DECAY ** (a + b + 1)))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    keys, weights = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    total = np.add.reduceat(weights, first) if len(first) else np.zeros(0)
    keys = keys[first]
    seg = keys >> 18
    norm = np.sqrt(np.bincount(seg, weights=total * total, minlength=len(segments)))
    return seg, keys & 0x3FFFF, total / norm[seg] if len(seg) else total


def landmark_table(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """The landmarks' subsequence weights by code: (codes, starts of each code's entries, landmark, weight, landmarks)."""
    z, code, weight = subsequences(landmarks)
    order = np.argsort(code, kind="stable")
    used, first = np.unique(code[order], return_index=True)
    return used, np.append(first, len(code)), z[order], weight[order], len(landmarks)


def kernel(segments: list[str], table: tuple) -> np.ndarray:
    """Normalised subsequence kernel of every segment with every landmark of the table."""
    out = np.empty((len(segments), table[-1]))
    for k in range(0, len(segments), KERNEL_ROWS):
        out[k:k + KERNEL_ROWS] = _kernel(segments[k:k + KERNEL_ROWS], table)
    return out


def _kernel(segments: list[str], table: tuple) -> np.ndarray:
    used, first, z, theirs, m = table
    x, code, weight = subsequences(segments)
    place = np.minimum(np.searchsorted(used, code), max(0, len(used) - 1))
    hit = np.flatnonzero(used[place] == code) if len(used) and len(code) else np.zeros(0, np.int64)
    place = place[hit]
    count = first[place + 1] - first[place]
    at = np.arange(count.sum()) + np.repeat(first[place] - np.cumsum(count) + count, count)
    cell = np.repeat(x[hit], count) * m + z[at]
    return np.bincount(cell, weights=np.repeat(weight[hit], count) * theirs[at], minlength=len(segments) * m).reshape(len(segments), m)


def margins_of(segments: list[str], table: tuple, to: np.ndarray, bias: float) -> np.ndarray:
    out = np.empty(len(segments))
    for k in range(0, len(segments), 10_000):
        part = segments[k:k + 10_000]
        like = kernel(part, table)
        like **= POWER
        out[k:k + len(part)] = bias + like @ to
    return out


def _score(table: tuple, to: np.ndarray, bias: float, slope: float, offset: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = text_margins(batch.column("text"), table, to, bias)
            score = 1 / (1 + np.exp(-(slope * np.clip(best, -CLIP, CLIP) + offset)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(best), pa.array(score)], ["doc_id", "margin", "score"])
    return run


class Scored:
    """The best segment's margin of the words that this worker has met, scored once each (dropped at LIMIT)."""

    LIMIT = 400_000

    def __init__(self, table: tuple, to: np.ndarray, bias: float):
        self.table, self.to, self.bias = table, to, bias
        self.reset()

    def reset(self) -> None:
        self.number: defaultdict[str, int] = defaultdict(count().__next__)  # no reference to itself: freed at once
        self.margin = np.zeros(0)

    def words_of(self, text: str) -> np.ndarray:
        return np.array(list(map(self.number.__getitem__, tokens_of(text))), np.int64)

    def score_new(self) -> np.ndarray:
        new = [self.margin]
        words = list(islice(self.number, len(self.margin), None))
        for k in range(0, len(words), 20_000):
            spread = [windows(w) for w in words[k:k + 20_000]]
            sizes = np.fromiter(map(len, spread), np.int64, len(spread))
            flat = margins_of([s for w in spread for s in w], self.table, self.to, self.bias)
            new.append(np.maximum.reduceat(flat, np.cumsum(sizes) - sizes))
        self.margin = np.concatenate(new)
        return self.margin


def scored(table: tuple, to: np.ndarray, bias: float) -> Scored:
    """The worker's store of a model; another model takes its place."""
    name = hashlib.blake2b(b"".join(np.ascontiguousarray(x).tobytes() for x in (*table[:4], to, np.array([bias])))).digest()
    return only_store(("toxicity", name), lambda: Scored(table, to, bias))


def text_margins(column: pa.Array, table: tuple, to: np.ndarray, bias: float) -> np.ndarray:
    """The best segment's margin of each text."""
    raw, off = text_buffers(column)
    best = np.full(len(off) - 1, bias)  # of a text without a segment
    store = scored(table, to, bias)
    for i, j in chunks(off, BLOCK_BYTES):
        if len(store.number) > store.LIMIT:
            store.reset()
        parts = [store.words_of(raw[off[k]:off[k + 1]].tobytes().decode()) for k in range(i, j)]
        margin = store.score_new()
        for k, p in enumerate(parts):
            if len(p):
                best[i + k] = margin[p].max()
    return best


def sketch(words: list[str]) -> int:
    """The smallest hash of three words in a row: copies and most near copies of a text share it."""
    return min((zlib.crc32(" ".join(words[i:i + 3]).encode()) for i in range(max(1, len(words) - 2))))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's distinct segments with the text's sketch."""
    for batch in batches:
        docs, out, sketches = [], [], []
        for k, text in enumerate(batch.column("text").to_pylist()):
            words = tokens_of(text or "")
            found = dict.fromkeys(s for w in words for s in windows(w) if len(s) > 2)
            docs += [k] * len(found)
            out += found
            sketches += [sketch(words)] * len(found)
        take = pa.array(docs, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(take), batch.column("toxic").take(take), pa.array(out, pa.string()), pa.array(sketches, pa.int64())],
                                         ["doc_id", "toxic", "segment", "sketch"])


def k_centres(segments: list[str], k: int) -> list[str]:
    """The first segment, then again and again the one least like those chosen."""
    chosen, like = [], np.full(len(segments), -1.0)
    while segments and len(chosen) < min(k, len(segments)):
        i = int(np.argmin(like)) if chosen else 0
        chosen.append(segments[i])
        like = np.maximum(like, kernel(segments, landmark_table([segments[i]]))[:, 0])
        like[i] = np.inf
    return chosen


def fit(sample: DataFrame) -> tuple[tuple, np.ndarray, float, float, float] | None:
    """(landmark table, coefficient per landmark, bias, slope, offset) from (doc_id, text, toxic) rows; None without both classes."""
    spark = sample.sparkSession
    found = materialize(sample.mapInArrow(_segments, "doc_id long, toxic int, segment string, sketch long"), "toxic-segments")
    texts = {r.toxic: r.n for r in found.select("doc_id", "toxic").distinct().groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(texts) < 2:
        return None
    p, q = F.col("p"), F.col("q")
    odds = F.log((p + 0.5) / (texts[1] - p + 0.5)) - F.log((q + 0.5) / (texts[0] - q + 0.5))
    counts = materialize(found.groupBy("segment").agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("q"),
                                                          F.count_distinct(F.when(F.col("toxic") == 1, F.col("sketch"))).alias("differing"))
                         .withColumn("odds", odds), "toxic-counts")

    # a toxic text's witness; the rows that reach the driver are bounded by the sample's texts and by HARD
    def witnesses(evident: DataFrame) -> list[tuple[str, int]]:
        best = (found.where("toxic = 1").join(evident, "segment").groupBy("doc_id")
                .agg(F.max(F.struct("odds", "segment")).alias("top")).groupBy("top.segment").agg(F.count(F.lit(1)).alias("w")))
        return [(r.segment, r.w) for r in best.orderBy(F.desc("w"), "segment").collect()]

    good = witnesses(counts.where("p > 2 and differing > 2 and odds > 2")) or witnesses(counts.where("q = 0"))
    if not good:
        return None
    clean = counts.where("q > p")
    common = [r.segment for r in clean.orderBy(F.desc("q"), "segment").limit(HARD // 2).collect()]
    drawn = [r.segment for r in clean.orderBy(F.xxhash64("segment"), "segment").limit(HARD).collect()]
    stems = k_centres([s for s, _ in good], LANDMARKS[0])
    wanted = landmark_table(stems)

    def likest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            like = kernel(batch.column("segment").to_pylist(), wanted).max(1, initial=0.0)
            yield pa.RecordBatch.from_arrays([batch.column("segment"), pa.array(like)], ["segment", "like"])

    hard = [r.segment for r in clean.select("segment").mapInArrow(likest, "segment string, like double").orderBy(F.desc("like"), "segment").limit(HARD).collect()]
    # the clean look-alikes are landmarks, too, so that a shared stem can be told from the word
    landmarks = list(dict.fromkeys(stems + hard[:LANDMARKS[1]] + k_centres(common, LANDMARKS[2])))
    table = landmark_table(landmarks)
    value, vector = np.linalg.eigh(kernel(landmarks, table) ** POWER)
    white = vector[:, value > 1e-6] / np.sqrt(value[value > 1e-6])
    bad = sorted(set(common) | set(drawn) | set(hard))
    each = [*((s, 1.0, float(w)) for s, w in good), *((s, 0.0, 1.0) for s in bad)]
    scale = sum(w for _, y, w in each if y == 0) / sum(w for _, y, w in each if y == 1)
    x = kernel([s for s, _, _ in each], table) ** POWER @ white
    y = np.array([1.0 if t else -1.0 for _, t, _ in each])
    beta = support_vectors(np.column_stack([x, np.ones(len(x))]), y, np.array([w * (scale if t else 1.0) for _, t, w in each]))
    to, bias = white @ beta[:-1], float(beta[-1])

    def sample_margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(text_margins(batch.column("text"), table, to, bias))], ["toxic", "margin"])

    # at most SAMPLE rows per class
    rows = sample.mapInArrow(sample_margins, "toxic int, margin double").collect()
    slope, offset = logistic(np.clip([r.margin for r in rows], -CLIP, CLIP), np.array([r.toxic for r in rows], float))
    return table, to, bias, slope, offset


def support_vectors(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """A linear support vector machine with squared hinge loss by Newton steps; x's last column is the bias."""
    beta, penalty = np.zeros(x.shape[1]), ridge * np.append(np.ones(x.shape[1] - 1), 1e-6)
    active = np.ones(len(x), bool)
    for _ in range(60):
        a = x[active] * weight[active, None]
        beta = np.linalg.solve(a.T @ x[active] + np.diag(penalty), a.T @ y[active])
        now = y * (x @ beta) < 1
        if (now == active).all():
            break
        active = now
    return beta


def logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the label's log-odds by Newton steps."""
    x, beta = np.column_stack([margin, np.ones(len(margin))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ beta)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2), x.T @ (label - p) - 0.01 * beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, toxic): per class the ``per_class`` labelled ids outside the held-out fold that hash lowest. Of an
    id's rows the one whose text hashes lowest is taken, so the sample has at most ``per_class`` rows of a class."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
             .where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    lowest = lambda y: known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    ids = materialize(lowest(1).union(lowest(0)), "toxic-sample")
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    one = d.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.max("toxic").alias("toxic"))
    return materialize(one, "toxic-texts")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: DataFrame | None = None,
             per_class: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, margin, score, predicted) of every text; ``train_docs`` holds the labelled texts if ``docs`` doesn't."""
    ship_package(docs.sparkSession)
    with arrow_batches(docs.sparkSession, TEXT_ROWS):
        model = fit(training_sample(docs if train_docs is None else train_docs, labels, per_class, id_col, text_col))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if model is None:
        scored = d.select("doc_id", F.lit(0.0).alias("margin"), F.lit(0.0).alias("score"))
    else:
        scored = d.mapInArrow(_score(*model), "doc_id long, margin double, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "margin", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
