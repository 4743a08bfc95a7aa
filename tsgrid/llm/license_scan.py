r"""License scans by diagonal voting.

Words are runs of 0-9, a-z and non-ASCII after lower-casing A-Z. Tasks emit every rolling word k-gram hash
of every text with its position, plus one header row per text; Spark joins these to the k-grams of the
templates (position p of a text, t of a template: one vote for diagonal p - t) and counts votes by text,
template and diagonal. The template table is a parameter of at most TEMPLATE_GRAMS rows and is broadcast.

* Phrases: all m - k + 1 k-grams on one diagonal are, by 64-bit hashes, the phrase's words in a row.
* Longer templates: diagonals of one template that are at most GAP apart (words added or dropped) merge, those
  with one vote like the others; a span is verified by the share of the template's k-grams that its merged
  diagonals cover within a stretch of 1.25 template lengths, which may start at any diagonal. From ``cover`` on
  the template's label holds (of overlapping stretches the best); the best share is the score.

Votes are added up map-side, and a group is one diagonal of one text, so frequent words, texts and templates
make no hot group; the last step has one row per text with a hit and one header row per text.

Defined results: null text is empty (no words, no labels, score 0). Null and repeated ids: one result per
row. Extra columns are not read. An empty table gives an empty result. Whole texts are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import chunks, text_buffers
from .ngram_jaccard_join import grams_of, word_hashes

#: Phrases with their labels, and well-known licence texts with SPDX-like labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
TEMPLATES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit-text"),
    ("released under the mit license", "mit-notice"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
K, GAP, COVER, TEMPLATE_GRAMS = 2, 2, 0.8, 50_000
HEADER = 0


def template_rows(phrases, templates, k: int = K) -> list[tuple[int, int, int]]:
    """(hash, template number, position) of every k-gram; phrases come first."""
    texts = [re.sub(r"[^0-9a-z\x80-\U0010ffff]+", " ", p.lower()).strip().encode() for p, _ in (*phrases, *templates)]
    off = np.cumsum([0, *map(len, texts)])
    h, row = word_hashes(np.frombuffer(b"".join(texts), np.uint8), off, WORD)
    grams, at = grams_of(h, row, k)
    first = np.searchsorted(row, np.arange(len(texts)))
    rows = [(int(g), int(row[i]), int(i - first[row[i]])) for g, i in zip(grams.view(np.int64), at)]
    if len(rows) > TEMPLATE_GRAMS:
        raise ValueError(f"templates hold {len(rows)} k-grams; at most {TEMPLATE_GRAMS} are broadcast")
    return rows


def _kgrams(k: int):
    """(text, at, hash) per k-gram, and (text, -1, HEADER, doc_id, n_words) per text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 36
        for batch in batches:
            raw, off = text_buffers(batch.column("text"))
            for i, j in chunks(off):
                h, row = word_hashes(raw[off[i]:off[j]], off[i:j + 1] - off[i], WORD)
                words = np.bincount(row, minlength=j - i)
                first = np.cumsum(words) - words
                grams, at = grams_of(h, row, k)
                n, m = j - i, len(at)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([key + row[at], key + np.arange(n)])),
                    pa.array(np.concatenate([at - first[row[at]], np.full(n, -1)]).astype(np.int32)),
                    pa.array(np.concatenate([grams.view(np.int64), np.full(n, HEADER)])),
                    pa.concat_arrays([pa.nulls(m, pa.int64()), batch.column("id").slice(i, n)]),
                    pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(words.astype(np.int64))])], ["key", "at", "hash", "doc_id", "n_words"])
                key += n
    return run


def license_votes(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, template, diagonal, votes, lo, hi, doc_id, n_words): template -1 is the text's header row."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    table = spark.createDataFrame([(HEADER, -1, 0), *template_rows(phrases, templates, k)], "hash long, template int, t int")
    return (rows.mapInArrow(_kgrams(k), "key long, at int, hash long, doc_id long, n_words long")
            .join(F.broadcast(table), "hash").where("(at = -1) = (template = -1)")
            .groupBy("key", "template", (F.col("at") - F.col("t")).alias("diagonal"))
            .agg(F.count(F.lit(1)).alias("votes"), F.collect_set("t").alias("ts"), F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words")))


def license_scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, k: int = K, cover: float = COVER,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every text.

    ``spans`` lists the verified places: (label, first word, words, share)."""
    length = [len(re.findall(r"[0-9a-z\x80-\U0010ffff]+", p.lower())) for p, _ in (*phrases, *templates)]
    label = [x for _, x in (*phrases, *templates)]
    number = F.col("template")
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), number + 1)
    votes = license_votes(docs, phrases, templates, k, id_col, text_col)
    phrase = number.between(0, len(phrases) - 1)
    whole = F.when(number >= 0, of(length))
    # neighbouring diagonals of one template in one text: a new chain starts after a gap
    same = Window.partitionBy("key", "template").orderBy("diagonal")
    step = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(same) > GAP).cast("int"), F.lit(1))
    chains = votes.withColumn("chain", F.sum(F.when(phrase, F.lit(1)).otherwise(step)).over(same))
    # every diagonal starts a stretch, so a chain of chance votes neither widens nor hides the best one
    ahead = Window.partitionBy("key", "template", "chain").orderBy("diagonal").rangeBetween(0, max(length, default=0) // 4)
    near = F.filter(F.collect_list(F.struct("diagonal", "ts")).over(ahead), lambda x: x.diagonal - F.col("diagonal") <= whole / 4)
    share = F.col("covered") / (whole - (k - 1))
    stretches = (chains.withColumn("near", near).withColumn("lo", F.col("diagonal"))
                 .withColumn("hi", F.coalesce(F.array_max(F.col("near.diagonal")), F.col("lo")))
                 .withColumn("covered", F.size(F.array_distinct(F.flatten(F.col("near.ts"))))).withColumn("share", share)
                 .withColumn("ok", (number >= 0) & F.when(phrase, F.col("share") == 1).otherwise(F.col("share") >= cover)))
    # of verified stretches that overlap, the one that covers most, and of those the last to start, is the span
    found = Window.partitionBy("key", "template", "ok").orderBy("lo")
    apart = F.coalesce((F.col("lo") > F.max("hi").over(found.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(1))
    spans = (stretches.withColumn("apart", apart)
             .withColumn("group", F.when(F.col("ok"), F.sum(F.when(phrase, F.lit(1)).otherwise(F.col("apart"))).over(found)))
             .groupBy("key", "template", "ok", "group")
             .agg(F.max(F.struct("covered", "lo", "share")).alias("best"), F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"))
             .select("key", "template", "ok", "best.lo", "best.share", "doc_id", "n_words"))
    place = F.when(F.col("ok"), F.struct(of(label).alias("label"), F.col("lo").cast("long").alias("first_word"), whole.cast("long").alias("words"), F.col("share").cast("double").alias("share")))
    base = F.col("ok") & phrase
    text = lambda when: F.array_join(F.array_sort(F.collect_set(F.when(when, of(label)))), ",")
    return (spans.groupBy("key").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum(base.cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("lo"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("lo"))).cast("long").alias("last_word"),
        text(base).alias("base_labels"), text(F.col("ok")).alias("labels"),
        F.coalesce(F.max(F.when((number >= 0) & (F.col("ok") | ~phrase), F.least(F.col("share"), F.lit(1.0)))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(place)).alias("spans")).drop("key"))
