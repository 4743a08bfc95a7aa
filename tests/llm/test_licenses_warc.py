"""License scans and revisit resolution against plain Python, with edge cases."""
import re

from pyspark.sql import functions as F

from tsgrid.llm import license_scan as lic
from tsgrid.llm import warc_revisits as warc

SF01 = "/root/testdata/sf0.01"


def words_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def python_base(t):
    w, places = words_of(t), []
    for phrase, label in lic.PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    at = [i for i, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


TEXTS = [None, "", "mit", "MIT License", "mit license mit LICENSE, CC-BY cc by", "the GNU  General\nPublic-License x gnu general public", "É mit licensé mit license ß",
         "Licensed under the Apache License, Version 2.0. " * 3, "licensed under the new apache license version 2 0",
         "Permission is hereby granted, free of charge, to any person getting a copy of this software and associated documentation files (the \"Software\")",
         "of this of this of this to any of the public", "cc by cc by cc by " * 500]


def test_base_places_equal_python_and_methods_add_labels(spark):
    rows = list(enumerate(TEXTS)) + [(100 + r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    rows += [(None, "mit license"), (4, "cc by"), (4, "cc by")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("x")).withColumn("template", F.lit(1)).repartition(3)
    out = lic.license_scan(df).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out), key=str)
    assert got == sorted(((i, *python_base(t)) for i, t in rows), key=str)
    by = {r.doc_id: r for r in out}
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in out)
    assert "apache-2.0" in by[7].labels and by[7].score == 1
    assert "apache-2.0" in by[8].labels, "one added word moves the rest to the next diagonal"
    assert by[9].labels == "mit-text" and by[9].n_base == 0 and 0.8 <= by[9].score < 1
    assert by[10].labels == "" and by[11].n_base == 1500
    assert lic.license_scan(df.limit(0)).count() == 0


def test_diagonals_with_one_vote_count_for_a_template(spark):
    long = "this work is licensed under a creative commons attribution 4 0 international license"
    rows = [(1, "Licensed under the CC BY-NC 4.0"), (2, "This work licensed under a Creative Commons Attribution 4.0 International License"),
            # chance votes on the neighbouring diagonals neither widen nor hide a span, and copies stay apart
            (3, "under a x this x x work is x " + long + " license x 0 x x a creative x"), (4, (long + " ") * 3), (5, "by nc")]
    by = {r.doc_id: r for r in lic.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "cc-by-nc-4.0" in by[1].labels.split(",") and abs(by[1].score - 1) < 1e-9  # the phrase 'cc by' is whole
    assert [(s.label, round(s.share, 2)) for s in by[1].spans if s.label == "cc-by-nc-4.0"] == [("cc-by-nc-4.0", 0.83)]
    assert by[2].labels == "cc-by-4.0" and round(by[2].score, 2) == 0.83
    assert [(s.first_word, s.share) for s in by[3].spans] == [(9, 1.0)]
    assert [s.first_word for s in by[4].spans] == [0, 13, 26] and round(by[5].score, 2) == 0.17


def test_gpl_lines_of_the_documents_are_labelled(spark):
    out = lic.license_scan(spark.read.parquet(f"{SF01}/documents.parquet"))
    assert out.where("base_labels like '%gpl%' and labels not like '%gpl-3.0%'").count() == 0


CANON = [("HTTP://User@WWW.Example.com:80/a//?b=2&a=1&utm_source=x#top", "example.com/a?a=1&b=2"), ("https://example.com:8443/", "example.com:8443"),
         ("example.com/A/b.html", "example.com/A/b.html"), ("", None), (None, None), ("http://", None), ("https://m.x.org?ref=1", "m.x.org")]


def test_canonical_urls(spark):
    df = spark.createDataFrame(CANON, "url string, want string")
    for r in df.select("url", "want", warc.canonical_url(F.col("url")).alias("got")).collect():
        assert r.got == r.want, r


def python_resolve(caps):
    out = []
    for i, u, t, kind, h in caps:
        if kind != "revisit":
            continue
        h = {k.lower(): v for k, v in sorted((h or {}).items())}
        hits = [(t2, i2, h2) for i2, u2, t2, k2, h2 in caps if k2 == "response" and u2 is not None and u2 == u and t is not None and t2 is not None and t2 < t]
        if not hits:
            out.append((i, "no_response", None, None))
            continue
        t2, i2, h2 = max(hits, key=lambda x: x[:2])
        h2 = {k.lower(): v for k, v in sorted((h2 or {}).items())}
        ok = True
        for name in ("etag", "last-modified", "payload-digest"):
            if name in h and name in h2:
                ok = h[name].removeprefix("W/") == h2[name].removeprefix("W/")
                break
        merged = {**h2, **{k: v for k, v in h.items() if k not in warc.FORBIDDEN}}
        out.append((i, "resolved" if ok else "mismatch", i2 if ok else None, merged if ok else None))
    return out


def test_resolution_equals_python(spark):
    import random
    rng = random.Random(2)
    caps = []
    for i in range(600):
        url = rng.choice(["hot.com"] * 6 + ["a.com", "b.com/x", None, ""])
        h = {k: v for k, v in (("ETag", rng.choice(["1", "W/1", "2"])), ("last-modified", rng.choice("ab")), ("Content-Length", "9"), ("X", str(i))) if rng.random() < 0.7}
        caps.append((i, url or None, rng.randint(0, 200) if i % 40 else None, rng.choice(["response", "revisit", "revisit"]) if i % 50 else None, h if i % 30 else None))
    caps.append((9999, "never.com", 5, "revisit", {}))
    df = spark.createDataFrame(caps, "record_id long, url string, captured_at long, kind string, headers map<string,string>").withColumn("bucket", F.lit("x")).withColumn("hit", F.lit(1))
    got = sorted(((r.record_id, r.status, r.response_id, r.headers) for r in warc.resolve_revisits(df).collect()), key=lambda x: x[0])
    assert got == sorted(python_resolve(caps), key=lambda x: x[0])
    assert warc.resolve_revisits(df.limit(0)).count() == 0


def test_duplicate_header_names_and_repeated_records(spark):
    caps = [(1, "a.com", 1, "response", {"ETag": "x", "etag": "y"}), (1, "a.com", 2, "response", {"etag": "z"}), (5, "a.com", 9, "revisit", {"ETAG": "z"}), (5, "a.com", 9, "revisit", {"ETAG": "z"})]
    out = warc.resolve_revisits(spark.createDataFrame(caps, "record_id long, url string, captured_at long, kind string, headers map<string,string>")).collect()
    assert [(r.status, r.response_id, r.response_at) for r in out] == [("resolved", 1, 2)] * 2


def test_captures_at_one_time_and_both_sides_of_a_revisit(spark):
    """All captures at one time: nothing is earlier, and no window holds more than one row of the URL."""
    schema = "record_id long, url string, captured_at long, kind string, headers map<string,string>"
    caps = [(i, "hot.com", 7, "response" if i % 2 else "revisit", {"etag": "1"}) for i in range(400)]
    out = warc.resolve_revisits(spark.createDataFrame(caps, schema)).collect()
    assert len(out) == 200 and {r.status for r in out} == {"no_response"}
    out = warc.resolve_revisits(spark.createDataFrame(caps + [(500, "hot.com", 8, "revisit", {})] * 2, schema)).where("status = 'resolved'").collect()
    assert [(r.record_id, r.response_id) for r in out] == [(500, 399)] * 2


def test_derived_crawl_has_responses_on_both_sides(spark):
    caps = warc.captures_of_pages(spark.read.parquet(f"{SF01}/pages.parquet"))
    status = {r.status: r["count"] for r in warc.resolve_revisits(caps).groupBy("status").count().collect()}
    assert status["no_response"] > 20 and status["resolved"] > 20
    assert warc.captures_of_pages(spark.read.parquet(f"{SF01}/pages.parquet").limit(0)).count() == 0
