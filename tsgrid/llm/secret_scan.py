r"""Secret scans (native: DataFrame functions only).

Base kinds, leftmost and non-overlapping per kind, with code-point spans [start, end): ``assign`` (a
password-like name, a separator, and a value of 8 or more characters; the span is the whole match),
``access`` (AKIA and capitals or digits, 16 or more) and ``hex`` (32 or more of 0-9a-f).

Entropy: a candidate is a maximal run of 20 or more of ``[A-Za-z0-9+/_-]``. Its class is hexadecimal or base64-like
(with a digit), or letters (without one, and only with both cases), each with its own limit; one-case runs without a
digit are words. A window of W characters slides over it. The state holds the count of every character (a byte each in
ten long integers) and the sum of n log2 n over the counts, both changed by the entering and the leaving character only
(in millionths, as whole numbers, so nothing drifts); Shannon entropy is log2 W - sum / W. From the first to the last
window that reaches the class's limit is an ``entropy`` span, unless the allow-list matches the candidate (UUIDs, one
repeated character run, words such as "example") or one base span holds all of it. A span that overlaps a base span in
part is reported whole.

Work is linear in a text's length: a run is cut into characters once, and matches get their places in chunks of CHUNK
whose own starts are summed first. Positions come from the texts between the matches (split) and the matches' lengths. Texts that a pattern does
not hit are only scanned once. There is no shuffle and no Python.

Defined results: null or empty text: no spans. Null and repeated ids, ties: one result per row. Extra columns
are passed through by ``redact`` and not read by ``secret_scan``. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns, in the order in which kinds sort.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
ALLOW = (r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"(?i)example|sample|dummy|placeholder", r"(.)\1{7}")
WINDOW = 20
#: Entropy limits in bits per character of a window (at most log2 20 = 4.32; 4 for hexadecimal).
LIMITS = {"hex": 3.0, "base64": 3.8, "letters": 3.9}
PARTS = [0] + [round(n * math.log2(n) * 1e6) for n in range(1, WINDOW + 1)]
#: The smallest character of a candidate ("+") and the long integers that hold a byte of count for each up to "z".
LOWEST, COUNTERS = 43, 10
CHUNK = 256


def most_sum(bits: float) -> int:
    """The largest sum of n log2 n (in millionths) of a window with at least ``bits`` of entropy."""
    return math.floor((math.log2(WINDOW) - bits) * WINDOW * 1e6)


def _let(value: Column, body) -> Column:
    """``body`` of a lambda variable that holds ``value``, so that nested functions don't compute it again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _placed(found: Column) -> Column:
    """(start, end, match, key) of each of ``found``, the matches with the text before them."""
    gap = lambda x: F.length(x["_p"])
    width = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + gap(x) + F.length(x["_m"]))
    numbers = lambda z: F.sequence(F.lit(0), F.floor((F.size(z) - 1) / CHUNK).cast("int"))

    def starts(chunks: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(chunks, zero, lambda a, c: F.struct((a["at"] + width(c)).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + gap(x)
        end = start + F.length(x["_m"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), x["_m"].alias("match"), x["_g"].alias("key")))
        return F.struct(end.alias("at"), F.concat(a["out"], one).alias("out"))

    def place(chunk: Column, at: Column) -> Column:
        zero = F.struct(at.alias("at"), F.array().cast("array<struct<start:int,end:int,match:string,key:string>>").alias("out"))
        return F.aggregate(chunk, zero, step, lambda a: a["out"])

    return _let(found, lambda z: _let(F.transform(numbers(z), lambda k: F.slice(z, k * CHUNK + 1, F.lit(CHUNK))), lambda chunks: _let(
        starts(chunks), lambda at: F.flatten(F.zip_with(chunks, at, place)))))


def _matches(d: DataFrame, name: str, pattern: str, group: int = 0) -> DataFrame:
    """Adds ``name``: array of (start, end, match, key), and with ``group`` only matches whose group has 8 or more."""
    hit = F.col("t").rlike(pattern)
    d = d.withColumn("_hit", hit)
    d = (d.withColumn("_m", F.when(F.col("_hit"), F.regexp_extract_all("t", F.lit(pattern), F.lit(0))))
         .withColumn("_p", F.when(F.col("_hit"), F.split("t", pattern, -1)))
         .withColumn("_g", F.when(F.col("_hit"), F.regexp_extract_all("t", F.lit(pattern), F.lit(group)))))
    # the text after the last match has no match
    found = _placed(F.slice(F.arrays_zip("_p", "_m", "_g"), F.lit(1), F.size("_m")))
    if group:
        found = F.filter(found, lambda x: F.length(x["key"]) >= 8)
    return d.withColumn(name, F.when(F.col("_hit"), found)).drop("_hit", "_m", "_p", "_g")


def _scanned(s: Column) -> Column:
    """Whether a candidate has a class."""
    return s.rlike("[0-9]") | (s.rlike("[a-z]") & s.rlike("[A-Z]"))


def _high_windows(s: Column) -> Column:
    """(first start, last end) of the windows of ``s`` that reach its class's limit; null bounds if none does."""
    table = F.array(*map(F.lit, PARTS))
    part = lambda n: F.get(table, n)
    limit = (F.when(~s.rlike("[0-9]"), most_sum(LIMITS["letters"])).when(s.rlike("^[0-9a-fA-F]+$"), most_sum(LIMITS["hex"]))
             .otherwise(most_sum(LIMITS["base64"])))
    codes = F.transform(F.split(s, ""), lambda c: F.ascii(c) - LOWEST)
    word = lambda c: F.shiftright(c, 3)
    bits = lambda c: F.shiftleft(c.bitwiseAND(7), 3)
    one = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), bits(c))
    none = F.lit(None).cast("int")
    zero = F.struct(F.array_repeat(F.lit(0).cast("long"), COUNTERS).alias("counts"), F.lit(0).alias("sum"), none.alias("lo"), none.alias("hi"))

    def slide(run: Column) -> Column:
        def step(a: Column, end: Column) -> Column:
            def change(x: Column, y: Column) -> Column:
                n = lambda c: F.call_function("shiftright", F.get(a["counts"], word(c)), bits(c)).bitwiseAND(F.lit(255).cast("long")).cast("int")
                more = part(n(y) + 1) - part(n(y))
                less = F.when(x.isNull(), 0).otherwise(part(n(x) - 1) - part(n(x)))
                same = F.coalesce(x == y, F.lit(False))
                counts = F.transform(a["counts"], lambda v, k: v + F.when(k == word(y), one(y)).otherwise(0) - F.when(k == word(x), one(x)).otherwise(0))
                return F.struct(F.when(same, a["counts"]).otherwise(counts).alias("counts"), F.when(same, a["sum"]).otherwise(a["sum"] + more + less).alias("sum"))

            def seen(now: Column) -> Column:
                ok = (end >= WINDOW) & (now["sum"] <= run["limit"])
                return F.struct(now["counts"].alias("counts"), now["sum"].alias("sum"), F.coalesce(a["lo"], F.when(ok, end - WINDOW)).alias("lo"),
                                F.when(ok, end).otherwise(a["hi"]).alias("hi"))

            return _let(change(F.get(run["codes"], end - (WINDOW + 1)), F.get(run["codes"], end - 1)), seen)

        return F.aggregate(F.sequence(F.lit(1), F.size(run["codes"])), zero, step, lambda a: F.struct(a["lo"].alias("lo"), a["hi"].alias("hi")))

    return _let(F.struct(codes.alias("codes"), limit.alias("limit")), slide)


def with_spans(docs: DataFrame, text_col: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``docs`` with ``t`` (the text, empty for null) and ``spans``: array of (start, kind, end), sorted; kind by number."""
    d = docs.withColumn("t", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    for name, pattern, group in (("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0), ("candidates", CANDIDATE, 0)):
        d = _matches(d, f"_{name}", pattern, group)
    as_spans = lambda kind: F.coalesce(F.transform(F.col(f"_{KINDS[kind]}"), lambda x: F.struct(
        x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"))), F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    d = d.withColumn("_base", F.array_sort(F.concat(*map(as_spans, range(3)))))
    allowed = lambda s: F.array_max(F.array(*[s.rlike(p) for p in allow])) if allow else F.lit(False)
    high = F.transform(F.filter("_candidates", lambda x: _scanned(x["match"]) & ~allowed(x["match"])), lambda x: F.struct(x["start"].alias("at"), _high_windows(x["match"]).alias("w")))
    spans = F.transform(F.filter(high, lambda x: x["w"]["lo"].isNotNull()), lambda x: F.struct(
        (x["at"] + x["w"]["lo"]).alias("start"), F.lit(3).alias("kind"), (x["at"] + x["w"]["hi"]).alias("end")))
    d = d.withColumn("_high", F.when(F.size("_candidates") > 0, spans))
    alone = F.filter("_high", lambda x: ~F.exists("_base", lambda b: (b["start"] <= x["start"]) & (x["end"] <= b["end"])))
    d = d.withColumn("spans", F.when(F.size("_high") > 0, F.array_sort(F.concat("_base", alone))).otherwise(F.col("_base")))
    return d.drop("_assign", "_access", "_hex", "_candidates", "_high")


def written(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every text."""
    d = with_spans(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")), "text", allow)
    n = lambda kind: F.size(F.filter("_base", lambda x: x["kind"] == kind)).cast("long")
    return d.select(F.col("_id").alias("doc_id"), n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                    F.sha2(written("_base"), 256).alias("base_sha256"), written("spans").alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``docs`` with every span of the text replaced by ``mark`` (overlapping spans by one); null stays null."""
    kept = docs.columns
    d = with_spans(docs.select(F.struct(*docs.columns).alias("row")).withColumn("text", F.col(f"row.{text_col}")), "text", allow)

    def step(a: Column, x: Column) -> Column:
        keep = F.array(F.struct(a["at"].alias("from"), x["start"].alias("to")))
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), F.when(x["start"] >= a["at"], F.concat(a["kept"], keep)).otherwise(a["kept"]).alias("kept"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,to:int>>").alias("kept"))
    # the texts that stay are cut from one array of characters; a span that starts where the last one ends has its own mark
    cut = _let(F.split("t", ""), lambda c: F.aggregate("spans", zero, step, lambda a: F.concat_ws(
        mark, F.transform(a["kept"], lambda k: F.array_join(F.slice(c, k["from"] + 1, k["to"] - k["from"]), "")),
        F.array_join(F.slice(c, a["at"] + 1, F.size(c)), ""))))
    text = F.when(F.size("spans") > 0, cut).otherwise(F.col("text"))
    return d.select(*[text.alias(c) if c == text_col else F.col(f"row.{c}").alias(c) for c in kept])


def _sql_spans(name: str, kind: int, pattern: str, group: int, where: str) -> str:
    """DuckDB: (doc_id, start, kind, stop, match) of a pattern."""
    return rf"""
{name}0 AS (SELECT doc_id, unnest(regexp_extract_all(t, '{pattern}', 0)) AS m, unnest(regexp_extract_all(t, '{pattern}', {group})) AS g,
    unnest(string_split_regex(t, '{pattern}')[:-2]) AS p, generate_subscripts(regexp_extract_all(t, '{pattern}', 0), 1) AS i
    FROM d WHERE regexp_matches(t, '{pattern}')),
{name} AS (SELECT doc_id, (stop - length(m))::INT AS start, {kind} AS kind, stop::INT AS stop, m FROM (
    SELECT doc_id, m, g, sum(length(p) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM {name}0) WHERE {where})"""


def oracle_sql() -> str:
    quoted = ASSIGN.replace("'", "''")
    parts = "[" + ", ".join(map(str, PARTS)) + "]"
    allowed = " OR ".join(f"regexp_matches(m, '{p}')" for p in ALLOW[:2])
    run = " OR ".join(f"contains(m, repeat('{c}', 8))" for c in "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_-")
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), {_sql_spans('assign', 0, quoted, 2, 'length(g) >= 8')},
{_sql_spans('access', 1, ACCESS, 0, 'true')}, {_sql_spans('hex', 2, HEX, 0, 'true')},
{_sql_spans('candidates', 3, '[A-Za-z0-9+/_-]{20,}', 0, "regexp_matches(m, '[0-9]') OR (regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]'))")},
base AS (SELECT doc_id, start, kind, stop FROM assign UNION ALL SELECT doc_id, start, kind, stop FROM access UNION ALL SELECT doc_id, start, kind, stop FROM hex),
windows AS (SELECT doc_id, start, m, k, string_split(substr(m, k::INT, {WINDOW}), '') AS w
    FROM (SELECT doc_id, start, m, unnest(range(1, length(m) - {WINDOW - 2})) AS k FROM candidates WHERE NOT ({allowed} OR {run}))),
high AS (SELECT doc_id, start + min(k) - 1 AS lo, start + max(k) - 1 + {WINDOW} AS hi FROM windows
    WHERE list_sum(list_transform(list_distinct(w), lambda c: ({parts})[len(list_filter(w, lambda x: x = c)) + 1]))
        <= CASE WHEN NOT regexp_matches(m, '[0-9]') THEN {most_sum(LIMITS['letters'])} WHEN regexp_full_match(m, '[0-9a-fA-F]+') THEN {most_sum(LIMITS['hex'])} ELSE {most_sum(LIMITS['base64'])} END
    GROUP BY doc_id, start, m),
spans AS (SELECT * FROM base UNION ALL SELECT doc_id, lo, 3, hi FROM high WHERE NOT EXISTS (
    SELECT 1 FROM base b WHERE b.doc_id = high.doc_id AND b.start <= lo AND hi <= b.stop)),
said AS (SELECT doc_id, kind, start, (['assign', 'access', 'hex', 'entropy'])[kind + 1] || ':' || start || ':' || stop AS s FROM spans),
sums AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
    string_agg(s, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(s, ',' ORDER BY start, kind) AS spans FROM said GROUP BY doc_id)
SELECT d.doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN sums ON sums.doc_id = d.doc_id
"""
