import json

import pytest
from pyspark.sql import functions as F

from pagelattice.models import ports as M
from pagelattice.operators import chunks as K
from pagelattice.sources import documents as D
from pagelattice.sources import files as S
from pagelattice.streaming import ingest as I


def blocks(spark, rows):
    return spark.createDataFrame([("d", k, kind, text) for k, (kind, text) in enumerate(rows)], "doc_id string, ord long, kind string, text string")


def test_chunks(spark):
    rows = [("text", "제1조 목적"), ("text", "가" * 400), ("text", "나" * 400), ("text", "다"), ("table", "a | b"), ("text", "라"), ("text", "제2조 정의"), ("text", " ")]
    got = K.chunk_blocks(blocks(spark, rows), "doc_id").orderBy("chunk_no").collect()
    assert [(r["kind"], r["heading"], len(r["text"])) for r in got] == [
        ("text", "제1조 목적", 6 + 1 + 400 + 1 + 400), ("text", "제1조 목적", 1), ("table", "제1조 목적", 5), ("text", "제1조 목적", 1), ("text", "제2조 정의", 6),
    ]
    assert got[0]["chunk_id"] == "d_c000"


def test_captions_follow_their_anchor(spark):
    chunks = K.chunk_blocks(blocks(spark, [("text", "제1조 a [image:x] [image:y]"), ("table", "t [image:x]")]), "doc_id")
    caps = spark.createDataFrame([("d", "x", 0, "cx"), ("d", "y", 1, "cy"), ("d", "z", 2, None)], "doc_id string, asset_id string, ord int, text string")
    got = K.anchor_captions(chunks, caps, "doc_id").orderBy("place").collect()
    assert [(r["kind"], r["asset_id"], r["notes"]) for r in got] == [("text", None, ""), ("image_caption", "x", ""), ("image_caption", "y", ""), ("table", None, ""), ("image_caption", "z", "no_anchor; caption_failed")]


def test_tables(spark):
    rows = [(0, 0, "구분", None), (0, 1, "고정금리", None), (0, 2, "변동금리", None), (1, 0, "적용요율", None), (1, 1, "0.01%", None), (1, 2, "0.01%", None), (2, 0, " ", None), (3, 0, "x", "a | b\n\nc")]
    cells = spark.createDataFrame([("d", *r) for r in rows], "doc_id string, row int, col int, text string, nested string")
    assert [r["line"] for r in K.table_lines(cells, ["doc_id"]).orderBy("row").collect()] == ["구분 | 고정금리 | 변동금리", "적용요율 | 0.01% | 0.01%", "x a | b / c"]
    text = spark.createDataFrame([("| a | a | b |\n|---|---|---|\n| | c | c |",)], "t string")
    assert text.select(K.markdown_table_lines(F.col("t"))).first()[0] == ["a | b", "c"]


def test_packs_and_overlays(spark, tmp_path):
    field = lambda k, **more: {"field_key": k, "label": k, "obligation": "필수", **more}
    base = {"schema_id": "s", "call_groups": [{"group_id": "G1", "fields": [field("a"), field("b", enum=["x"])]}, {"group_id": "G4", "observation_fields": [field("o")]}]}
    event = {"schema_id": "o", "applies_to": {"ad_type": ["event"]}, "call_groups": [{"group_id": "G5", "cardinality": "many", "fields": [field("a", label="new"), field("e", applicability={"conditions": [{"rule": "conditional", "basis": "derived"}]})]}]}
    for name, pack in (("base.json", base), ("_overlay_event.json", event)):
        (tmp_path / name).write_text(json.dumps(pack))
    read = lambda ad: S.read_pack(spark, str(tmp_path / "base.json"), [str(tmp_path / "_overlay_event.json")], "예금성", ad)
    assert {r["field_key"] for r in read(None).collect()} == {"a", "b", "o"}
    full = read("event")
    assert {r["field_key"] for r in full.collect()} == {"a", "b", "o", "e"}
    assert S.derived_rules(full).count() == 1 and full.where("unverifiable").first()["field_key"] == "b"
    made = S.response_schema([{"field_key": "b", "enum": ["x"]}, {"field_key": "l", "type": "list"}], "events")
    assert made["items"]["properties"]["b"]["properties"]["value"]["enum"] == ["x", ""]


def test_documents_read_back(spark, tmp_path):
    doc = {"doc_id": "d1", "pages": [{"page_no": 1, "regions": [{"region_id": "p1_r000", "lines": [{"text": "a", "bbox": [0, 0, 5, 5]}]}], "unassigned_lines": [{"text": "b"}]}]}
    (tmp_path / "d1.json").write_text(json.dumps(doc))
    rows = S.lines_of(S.read_documents(spark, str(tmp_path))).orderBy("text").collect()
    assert [(r["text"], r["region_id"], r["x1"]) for r in rows] == [("a", "p1_r000", 5), ("b", None, None)]
    view = {"doc_id": "d1", "pages": [{"page_number": 1, "regions": [{"region_id": "p1_r000", "role": "본문", "text": "a", "vlm_reading": "aa"}], "unassigned": "b"}]}
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "d1.json").write_text(json.dumps(view))
    views = S.read_views(spark, str(tmp_path / "v"))
    assert {(r["region_id"], r["text"]) for r in S.view_texts(views).collect()} == {("p1_r000", "a aa"), ("p1_unassigned", "b")}
    assert "[p1_r000|본문] a <aa>" in S.prompt_of(views).first()["prompt"]


def test_file_routes(spark, tmp_path):
    for n in ("a.PDF", "b.hwpx", "c.jpeg", "d.txt"):
        (tmp_path / n).write_bytes(b"x")
    assert sorted(r["track"] for r in S.scan_files(spark, str(tmp_path)).collect()) == ["hwp", "image", "pdf", "unreadable"]


def test_missing_backends_say_so(spark):
    D.register(spark)
    with pytest.raises(Exception, match="not installed"):
        spark.read.format("pdf_pages").option("paths", "x.pdf").load().collect()


def test_cache_modes(spark):
    asked = spark.createDataFrame([("k1", "a"), ("k2", "b"), ("k3", "c")], "key string, text string")
    cache = spark.createDataFrame([("k1", '{"x":1}'), ("k2", "{broken")], "key string, answer string")
    hits, misses = M.split_by_cache(asked, cache)
    assert [r["key"] for r in hits.collect()] == ["k1"] and sorted(r["key"] for r in misses.collect()) == ["k2", "k3"]
    assert M.split_by_cache(asked, cache, M.OFF)[1].count() == 3
    with pytest.raises(M.ReplayMiss):
        M.split_by_cache(asked, cache, M.REPLAY)
    parts = spark.createDataFrame([([("text", "a")],), ([("image", "a")],)], "p array<struct<kind:string,body:string>>")
    keys = [r[0] for r in parts.select(M.request_key(F.col("p"), "s", {"b": 1, "a": 2}, 100, "m")).collect()]
    assert keys[0] != keys[1] and len(keys[0]) == 64


def test_ports_keep_errors_as_rows(spark):
    rows = spark.createDataFrame([("a  b",)], "text string")
    assert M.ask(rows, M.echo_reader).first()["answer"] == "a b"

    def broken(texts):
        raise ValueError("no")

    assert M.ask(rows, broken, retries=1, pause=0).first()["error"] == "ValueError: no"


def test_streamed_chunks_are_the_batch_ones(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"doc_id": "d", "ord": k, "kind": "text", "text": t} for k, t in enumerate(["제1조 a", "b", "제2조 c"])]
    (tmp_path / "in" / "d.json").write_text("\n".join(map(json.dumps, rows)))
    I.stream_chunks(I.read_blocks(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {(r["chunk_no"], r["text"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(r["chunk_no"], r["text"]) for r in K.chunk_blocks(spark.read.schema(I.BLOCK).json(str(tmp_path / "in")), "doc_id").collect()}
    assert got == want
