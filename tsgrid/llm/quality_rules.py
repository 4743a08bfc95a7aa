r"""Quality rules with host-level verdicts (native: DataFrame functions only).

Per document (words are ``[^\x20\x09-\x0D]+``): word_chars, n_symbols, n_upper, n_dup_lines, n_repeat_words.

* ``base_failed``: fewer than 50 words, or more than half of the words lie in a repeated 3-word window.
* strict rules reject a document by themselves: symbols on more than a tenth of the words, or more than
  30 % of the characters in upper case.
* lenient rules (30 % repeated lines, 20 % repeated words, mean word length outside 3..10) also hit good
  documents now and then. They are judged per host: the failures of a rule are summed by host, and the
  rate is shrunk with an empirical beta prior, (f + a) / (n + a + b), where a and b are fitted over all
  hosts by moments (mean m of the failures; variance of the host rates less its binomial part, weighted by
  n). A host fails a rule from HOST_LIMIT on; a document goes if it fails a lenient rule its host fails.

The host table is joined back without a hint: Spark broadcasts it if it is small and else splits hot hosts
(a host's rows meet one row of the host table). Per-document counts are computed once and written.

Defined results: null or empty text: no words, all counts 0, base_failed. Null host: a host of its own.
Null id: kept as it is. Repeated rows: one result each. Extra columns are not read. Empty table: empty.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Word separators and symbol characters.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
HOST_LIMIT = 0.3
LENIENT = ("fail_dup_lines", "fail_repeats", "fail_word_length")


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str | None = "source") -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_upper, n_lines, n_dup_lines, n_repeat_words)."""
    host = F.col(host_col).cast("string") if host_col else F.lit(None).cast("string")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), host.alias("host"), text.alias("t"))
    without = lambda chars: F.length(F.translate("t", chars, "")).cast("long")
    whole = F.length("t").cast("long")
    d = d.select(
        "doc_id", "host", F.filter(F.split("t", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        without(SPACES).alias("word_chars"), (whole - without(SYMBOLS)).alias("n_symbols"),
        (whole - without(string.ascii_uppercase)).alias("n_upper"))
    d = d.select(
        "doc_id", "host", "word_chars", "n_symbols", "n_upper", F.size("w").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") >= 4, F.transform(F.sequence(F.lit(1), F.size("w") - 2), lambda i: F.xxhash64(
            F.element_at("w", i), F.element_at("w", i + 1), F.element_at("w", i + 2)))).alias("g"))
    # only texts that repeat a window are sorted: (window, place), then the places of equal neighbours
    d = d.withColumn("s", F.when(F.size(F.array_distinct("g")) < F.size("g"),
                                 F.sort_array(F.transform("g", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    near = lambda j: F.get("s", j)["h"]
    d = d.withColumn("p", F.sort_array(F.transform(
        F.filter("s", lambda x, j: (x["h"] == F.coalesce(near(j - 1), F.bitwise_not(x["h"]))) | (x["h"] == F.coalesce(near(j + 1), F.bitwise_not(x["h"])))),
        lambda x: x["i"])))
    # a window at i adds the words that the window before it doesn't hold
    covered = F.aggregate("p", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("at")), lambda a, i: F.struct(
        (a["n"] + F.least(F.lit(3), i - a["at"])).alias("n"), i.alias("at")))["n"]
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("g", "s", "p")


def with_rules(counts: DataFrame) -> DataFrame:
    n = F.col("n_words")
    return (counts.withColumn("base_failed", (n < 50) | (100 * F.col("n_repeat_words") > 50 * n))
            .withColumn("strict_failed", (10 * F.col("n_symbols") > n) | (10 * F.col("n_upper") > 3 * F.col("word_chars")))
            .withColumn("fail_dup_lines", 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"))
            .withColumn("fail_repeats", 10 * F.col("n_repeat_words") > 2 * n)
            .withColumn("fail_word_length", (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 10 * n)))


def host_verdicts(rules: DataFrame) -> DataFrame:
    """(host, n, and per lenient rule its shrunk rate p_<rule> and host_<rule>)."""
    hosts = rules.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in LENIENT])
    n, prior = F.col("n"), []
    for r in LENIENT:
        f = F.col(r)
        prior += [(F.sum(f) / F.sum(n)).alias(f"m_{r}"), (F.sum(f * f / n) / F.sum(n) - F.pow(F.sum(f) / F.sum(n), F.lit(2))).alias(f"v_{r}")]
    # one row: mean and weighted variance of the host rates, and the number of hosts per document
    one = hosts.agg(*prior, (F.count(F.lit(1)) / F.sum(n)).alias("per"))
    out = hosts.crossJoin(F.broadcast(one))
    for r in LENIENT:
        m = F.col(f"m_{r}")
        spread = m * (1 - m)
        between = F.greatest(F.col(f"v_{r}") - spread * F.col("per"), spread * F.lit(1e-4))
        size = F.when(spread > 0, F.greatest(spread / F.when(between > 0, between) - 1, F.lit(1.0))).otherwise(F.lit(1.0))
        rate = (F.col(r) + m * size) / (n + size)
        out = out.withColumn(f"p_{r}", rate).withColumn(f"host_{r}", F.col(f"p_{r}") >= HOST_LIMIT)
    return out.select("host", "n", *[f"p_{r}" for r in LENIENT], *[f"host_{r}" for r in LENIENT])


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str | None = "source") -> DataFrame:
    """Counts, rules, host verdicts and ``kept`` of every document."""
    rules = with_rules(materialize(document_counts(docs, id_col, text_col, host_col), "quality-counts"))
    hosts = host_verdicts(rules).select(F.col("host").alias("_host"), *[f"host_{r}" for r in LENIENT])
    joined = rules.join(hosts, rules.host.eqNullSafe(F.col("_host")), "left").drop("_host")
    by_host = F.lit(False)
    for r in LENIENT:
        by_host = by_host | (F.col(r) & F.coalesce(F.col(f"host_{r}"), F.lit(False)))
    return joined.withColumn("host_failed", by_host).withColumn("kept", ~(F.col("base_failed") | F.col("strict_failed") | F.col("host_failed")))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, host, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 4),
g2 AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM g),
g3 AS (SELECT doc_id, least(3, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), i - 3)) AS k FROM g2 WHERE c > 1),
rep AS (SELECT doc_id, sum(k) AS k FROM g3 GROUP BY doc_id),
c AS (SELECT w.doc_id, host, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_upper, len(l)::BIGINT AS n_lines,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.k, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
r AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        10 * n_symbols > n_words OR 10 * n_upper > 3 * word_chars AS strict_failed,
        (10 * n_dup_lines > 3 * n_lines)::INT AS f1, (10 * n_repeat_words > 2 * n_words)::INT AS f2,
        (word_chars < 3 * n_words OR word_chars > 10 * n_words)::INT AS f3 FROM c),
h AS (SELECT host, count(*) AS n, unnest([1, 2, 3]) AS r, unnest([sum(f1), sum(f2), sum(f3)]) AS f FROM r GROUP BY host),
p AS (SELECT r, sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) - (sum(f) / sum(n)) ^ 2 AS v, count(*) / sum(n) AS per FROM h GROUP BY r),
s AS (SELECT r, m, CASE WHEN m * (1 - m) > 0 THEN greatest(m * (1 - m) / greatest(v - m * (1 - m) * per, m * (1 - m) * 1e-4) - 1, 1.0) ELSE 1.0 END AS size FROM p),
b AS (SELECT host, r, (f + m * size) / (n + size) >= 0.3 AS bad FROM h JOIN s USING (r)),
k AS (SELECT host, bool_or(bad AND r = 1) AS b1, bool_or(bad AND r = 2) AS b2, bool_or(bad AND r = 3) AS b3 FROM b GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR strict_failed OR (f1 = 1 AND b1) OR (f2 = 1 AND b2) OR (f3 = 1 AND b3)) AS kept
FROM r JOIN k ON k.host IS NOT DISTINCT FROM r.host
"""
