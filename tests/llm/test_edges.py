"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import zlib

import pytest
from pyspark.sql import functions as F

from pagelattice.llm import decontam, html_extract, jpeg_media, lpt_shards, pii, queries, simhash, sp_wfst, toxicity, url_rules, warc_revisit

CLASH = ["fp", "key", "a", "b", "size", "shard", "slice", "score", "predicted", "held_out", "media", "ids", "root", "node", "component_id", "__pii_0", "kinds", "m", "total", "n_bytes", "tokens", "best", "index"]
LONG = "long words go on and on " * 20_000


def docs(spark, rows):
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in CLASH})


ROWS = [(1, "one two three four five"), (2, None), (3, ""), (4, "   \n"), (5, LONG), (6, "one two three four five"), (6, "one two three four five"), (None, "one two three four five"), (7, "x"), (8, "\x00 zero ￿ 😀 ▁"), (None, None)]


@pytest.fixture(scope="module")
def edge(spark):
    return docs(spark, ROWS)


@pytest.fixture(scope="module")
def none(spark):
    return docs(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, 1, int(k % 2 == 0)) for k in range(1, 9)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def test_simhash(spark, edge, none):
    got = simhash.near_duplicates(spark, edge).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["fp"], r["component_id"]))
    assert {c for _, c in by[1] | by[6]} == {1} and {c for f, c in by[2] | by[3] | by[4]} == {2} and {f for f, _ in by[2]} == {0}
    assert {c for _, c in by[None]} == {1, 2}
    assert simhash.near_duplicates(spark, none).count() == 0
    lone = simhash.near_duplicates(spark, docs(spark, [(None, "lonely text here")])).collect()
    assert [r["component_id"] for r in lone] == [None]


def test_toxicity(spark, edge, none, labels):
    model = toxicity.fit(edge, labels)
    got = toxicity.score(spark, edge, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (2, 3)}
    assert len(empty) == 1
    untrained = toxicity.fit(none, labels)
    assert toxicity.score(spark, none, untrained).count() == 0
    assert {r["score"] for r in toxicity.score(spark, edge, untrained).collect()} == {0.0}
    assert {r["score"] for r in toxicity.score(spark, edge, toxicity.fit(edge, labels.limit(0))).collect()} == {0.0}


def test_decontamination(spark, edge, none):
    items = spark.createDataFrame([(1, "one two three four five"), (2, None), (3, ""), (None, "one two three four five"), (1, "one two three four five"), (9, "never seen words anywhere here")], "item_id long, text string")
    items = items.withColumns({c: F.lit("clash") for c in CLASH})
    got = decontam.matches(spark, edge, items).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"] or 0) for r in got) == sorted((d or 0, i) for d in (1, 6, 6, None) for i in (0, 1, 1))
    assert decontam.matches(spark, none, items).count() == 0
    assert decontam.matches(spark, edge, items.limit(0)).count() == 0
    assert decontam.matches(spark, edge, items.where("item_id in (2, 3)")).count() == 0


def test_pii(spark, edge, none):
    got = pii.pseudonymise(edge)
    assert got.columns == edge.columns and got.count() == len(ROWS)
    key = lambda r: (r["doc_id"] or 0, r["text"] or "")
    assert sorted(map(key, got.collect())) == sorted((d or 0, t or "") for d, t in ROWS)
    assert pii.pseudonymise(none).count() == 0
    many = pii.pseudonymise(docs(spark, [(1, "call 224.145.138.68 " * 30_000)])).first()["text"]
    assert len(set(many.split())) == 2 and "224.145.138.68" not in many


@pytest.mark.parametrize("text", [
    "x@" + "a." * 500_000 + "com", "x@" + "." * 1_000_000, "x@" + "a-" * 500_000, "a" * 1_000_000 + "@b.com", "é" * 1_000_000 + "@x.org", "@" * 1_000_000,
    "1" * 1_000_000, "1 " * 500_000, "1-" * 500_000, "1." * 500_000, "+1" * 500_000, "12/" * 300_000, "(123) " * 200_000, "AB12 " * 200_000, "A1" * 500_000, "+" * 1_000_000,
], ids=range(16))
def test_pii_of_a_megabyte_without_an_end(spark, text):
    df = spark.createDataFrame([(1, text + " 123-45-6789")], "doc_id long, text string")
    new = pii.pseudonymise(df, "k").first()["text"]
    assert new[1 : len(text)] == text[1:] and new[len(text) :] != " 123-45-6789" and len(new) == len(text) + 12


def test_sentencepiece(spark, edge, none):
    model = queries.tokenizer_bytes()
    got = sp_wfst.encode_documents(edge, model)
    rows = got.collect()
    assert len(rows) == len(ROWS)
    assert all(r["n_pieces"] == len(r["ids"]) for r in rows) and [r["exact"] for r in rows if r["doc_id"] == 8] == [False]
    assert all(r["exact"] for r in rows if r["doc_id"] != 8) and {r["n_pieces"] for r in rows if r["doc_id"] in (2, 3)} == {0}
    assert sp_wfst.encode_documents(none, model).count() == 0
    back = {r["doc_id"]: r["text"] for r in sp_wfst.decode_documents(got.where("doc_id is not null"), model).collect()}
    assert back[1] == ROWS[0][1] and back[2] == "" and back[5] == LONG
    broken = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r["text"] for r in sp_wfst.decode_documents(broken, model).collect()] == ["", ""]


def test_media(spark, edge, none):
    got = jpeg_media.read_media(jpeg_media.store_texts(edge)).collect()
    assert len(got) == len(ROWS) and all(r["payload_bytes"] % 192 == 0 and r["payload_bytes"] > 0 and r["reason"] is None for r in got)
    assert len({(r["payload_sha256"], r["feature"]) for r in got if r["doc_id"] in (1, 6)}) == 1
    assert jpeg_media.read_media(jpeg_media.store_texts(none)).count() == 0
    bad = spark.createDataFrame([(1, 0, None), (2, 0, bytearray(b"")), (3, 0, bytearray(b"\xff\xd8\xff\xd9"))], "doc_id long, n_bytes long, media binary")
    assert all(r["reason"] and r["payload_bytes"] is None for r in jpeg_media.read_media(bad).collect())


def test_shards(spark, edge, none):
    got = lpt_shards.shard(spark, edge, 3).collect()
    assert len(got) == len(ROWS)
    for k in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))
    assert len({r["shard"] for r in got if r["text_crc32"] == 0}) == 1 and {r["size"] for r in got if r["doc_id"] in (2, 3)} == {8}
    assert lpt_shards.shard(spark, none, 3).count() == 0


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({c: F.lit("clash") for c in ["host", "path", "rule", "items", "anchor", "text", *CLASH]})


def test_urls(spark, labels):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://NET/x"), (5, "HTTP://NET/x"), (6, "http://a.net"), (7, "http://x.example.net/en/1?u=http://y.net/"), (8, "http://EXAMPLE.com/de/é#x"), (None, "ftp://notnet/"), (9, "http://a.org/fr/" + "y" * 50_000), (10, "http://anet/")]
    got = {r["page_id"]: r for r in url_rules.judge(spark, pages(spark, [(*r, None) for r in rows]), labels).collect()}
    told = {k: (r["host"], r["rule"], r["verdict"]) for k, r in got.items()}
    assert told[1] == told[2] == told[3] == told[4] == ("", None, "allow")
    assert told[5] == ("net", "net/", "block") and told[6] == ("a.net", None, "allow") and told[7][1:] == ("example.net/en/", "allow")
    assert told[8] == ("example.com", "example.com/de/", "block") and told[9][1:] == ("org/fr/", "allow") and told[10][1:] == (None, "allow") and told[None][1:] == (None, "allow")
    assert url_rules.judge(spark, pages(spark, []), labels).count() == 0
    assert url_rules.judge(spark, pages(spark, [(1, "http://a.net/", None)]), labels.limit(0)).first()["rule"] == "net/"


def test_html(spark):
    rows = [(1, None, None), (2, None, ""), (3, None, "plain < text"), (3, None, "plain < text"), (None, None, "<p>x"), (4, None, "<div>" * 5000 + "deep"), (5, None, "<p>word </p>" * 20_000)]
    got = [(r["page_id"], r["n_chars"]) for r in html_extract.extract_pages(pages(spark, rows)).collect()]
    assert sorted(got, key=lambda x: (x[0] or 0, x[1])) == [(None, 1), (1, 0), (2, 0), (3, 12), (3, 12), (4, 4), (5, 20_000 * 6 - 2)]
    assert html_extract.extract_pages(pages(spark, [])).count() == 0


def test_warc(spark):
    schema = "record_id long, url string, warc_date timestamp, status int, kind string, headers map<string,string>, payload_digest string"
    t = "2024-01-01 00:00:0"
    import datetime as dt

    at = lambda s: dt.datetime.fromisoformat(t + str(s))
    rows = [
        (1, "http://a.org/x", at(1), 200, "response", {"etag": '"1"', "x": "y"}, "d1"), (2, "http://a.org/x", at(2), 304, "revisit", {"etag": 'W/"1"', "x": "z", "expires": "e"}, None),
        (3, None, at(3), 304, "revisit", None, None), (4, "http://a.org/x", None, 304, "revisit", None, None), (5, "http://b.org", at(1), 304, "revisit", {"etag": '"1"'}, None),
        (6, "http://a.org/x", at(3), 304, "revisit", None, None), (6, "http://a.org/x", at(3), 304, "revisit", None, None), (7, "http://a.org/x", at(2), 404, "response", {}, "d7"),
    ]
    df = spark.createDataFrame(rows, schema).withColumns({c: F.lit("clash") for c in ["slice", "own", "carried", "source", "last", "url_key"]})
    got = [(r["record_id"], r["outcome"], r["source_id"], r["headers"]) for r in warc_revisit.resolve(spark, df).collect()]
    assert sorted(x[:3] for x in got if x[0] != 2) == [(3, "no url or date", None), (4, "no url or date", None), (5, "no earlier response", None), (6, "no validator", None), (6, "no validator", None)]
    assert [x[1:] for x in got if x[0] == 2] == [("resolved", 1, {"etag": 'W/"1"', "x": "y", "expires": "e"})]
    assert warc_revisit.resolve(spark, df.limit(0)).count() == 0


def test_media_are_read_where_they_are_made(spark, tiny):
    from pagelattice.llm import jpeg_media, queries

    plan = queries.media_digests(spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1  # one Python worker for each task
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(["", None, "a b", "é" * 5000])], "doc_id long, text string")
    assert sorted(jpeg_media.store_and_read(docs).collect()) == sorted(jpeg_media.read_media(jpeg_media.store_texts(docs)).collect())
