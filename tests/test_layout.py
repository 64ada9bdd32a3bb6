import random

from pyspark.sql import functions as F

from pagelattice.functions import geometry as G
from pagelattice.operators import clusters as C
from pagelattice.operators import layout as L

LINE = "page int, ord long, text string, x0 int, y0 int, x1 int, y1 int, confidence double"


def lines(spark, boxes, conf=0.9):
    return spark.createDataFrame([(0, k, f"t{k}", *(b or (None,) * 4), conf) for k, b in enumerate(boxes)], LINE)


def test_lines_go_to_the_first_block_and_repeats_leave_gaps(spark):
    blocks = spark.createDataFrame([(0, 0, "text", 0, 0, 50, 50), (0, 1, "text", 0, 0, 50, 50), (0, 2, "text", 0, 0, 100, 100)], "page int, block long, label string, x0 int, y0 int, x1 int, y1 int")
    got = L.build_regions(lines(spark, [(0, 0, 20, 20), (60, 60, 80, 80), (200, 200, 210, 210), None]), blocks, ["page"]).orderBy("block").collect()
    assert [(r["block"], r["text"]) for r in got] == [(0, "t0"), (2, "t1")]
    assert sorted(r["ord"] for r in L.assign_lines(lines(spark, [(200, 200, 210, 210), None]), blocks, ["page"]).where("block is null").collect()) == [0, 1]


def test_scores_need_a_close_match(spark):
    schema = "page int, block long, x0 int, y0 int, x1 int, y1 int, score double"
    primary = spark.createDataFrame([(0, 0, 70, 84, 399, 150, None), (0, 1, 0, 0, 100, 90, None), (0, 2, 900, 900, 950, 950, None)], schema)
    found = spark.createDataFrame([(0, 0, 71, 85, 398, 149, 0.72), (0, 1, 0, 0, 100, 88, 0.5), (0, 2, 0, 0, 100, 90, 0.9)], schema)
    assert {r["block"]: r["score"] for r in L.attach_scores(primary, found, ["page"]).collect()} == {0: 0.72, 1: 0.9, 2: None}


def test_roles(spark):
    rows = [(0, "doc_title", "제목 글", 10), (1, "text", "글", 10), (2, "text", "※ 유의사항", 10), (3, "text", "준법감시인 심의필 2025-0000", 10), (4, "text", "글", 850), (5, "nonesuch", "글", 10)]
    got = L.apply_role_rules(spark.createDataFrame(rows, "block int, label string, text string, y0 int").withColumn("canvas_h", F.lit(1000)), "canvas_h").orderBy("block").collect()
    assert [(r["role"], r["role_confidence"]) for r in got] == [("제목", None), ("본문", None), ("유의사항", 0.9), ("고지문구", 0.9), ("유의사항", 0.5), ("본문", None)]


def test_reading_order(spark):
    rows = lines(spark, [(408, 1216, 562, 1275), (69, 1218, 241, 1272), None, (0, 1300, 10, 1310)])
    got = L.reading_order(rows, ["page"]).orderBy("pos").collect()
    assert [r["ord"] for r in got] == [1, 0, 3, 2]
    assert L.merged_text(rows, ["page"]).first()["text"] == "t1 t0\nt3\nt2"


def _greedy(boxes):
    def inter(a, b):
        return max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))

    area = lambda a: (a[2] - a[0]) * (a[3] - a[1])
    kept = []
    for k, (b, _) in sorted(enumerate(boxes), key=lambda x: (-x[1][1], x[0])):
        if all(inter(b, boxes[j][0]) / max(1, area(b) + area(boxes[j][0]) - inter(b, boxes[j][0])) < 0.5 and inter(b, boxes[j][0]) / min(max(1, area(b)), max(1, area(boxes[j][0]))) < 0.7 for j in kept):
            kept.append(k)
    return sorted(kept)


def test_suppression_is_greedy_and_idempotent(spark):
    rng = random.Random(3)
    boxes = []
    for _ in range(120):
        x, y = rng.randrange(300), rng.randrange(300)
        boxes.append(((x, y, x + rng.randrange(5, 90), y + rng.randrange(5, 60)), rng.randrange(20) / 20))
    rows = spark.createDataFrame([(0, k, "t", *b, c) for k, (b, c) in enumerate(boxes)], LINE)
    once = L.suppress(rows, ["page"])
    got = sorted(r["ord"] for r in once.collect())
    assert got == _greedy(boxes)
    assert sorted(r["ord"] for r in L.suppress(once, ["page"]).collect()) == got


def test_pseudo_regions(spark):
    rows = lines(spark, [(0, 0, 10, 20), (0, 25, 10, 45), (0, 100, 10, 120), None])
    assert [(r["n_lines"], r["y0"], r["y1"]) for r in L.pseudo_regions(rows, ["page"]).orderBy("region").collect()] == [(2, 0, 45), (1, 100, 120)]
    assert L.pseudo_regions(lines(spark, [None, None]), ["page"]).first()["label"] == "page"


def test_absorbing_grows_regions(spark):
    regions = spark.createDataFrame([(0, 0, 0, 0, 100, 20, 1000)], "page int, block long, x0 int, y0 int, x1 int, y1 int, canvas_h int")
    rows = lines(spark, [(0, 310, 100, 330), (0, 620, 100, 640), (500, 0, 600, 20), None])
    got = L.absorb_unassigned(rows, regions, ["page"]).orderBy("ord").collect()
    assert [r["block"] for r in got] == [0, 0, None, None]  # the second is only near once the first was taken in


def test_wide_lines_stay_out_of_narrow_regions(spark):
    regions = spark.createDataFrame([(0, 0, 0, 0, 50, 20, 1000)], "page int, block long, x0 int, y0 int, x1 int, y1 int, canvas_h int")
    rows = lines(spark, [(0, 30, 400, 50), (0, 60, 90, 80), (0, 60, 90, 80)]).withColumn("source", F.expr("if(ord = 2, 'vlm_sweep', 'ocr')"))
    got = L.absorb_unassigned(rows, regions, ["page"]).orderBy("ord").collect()
    assert [r["block"] for r in got] == [None, 0, None]


def test_tall_pages_join_by_strips(spark):
    blocks = spark.createDataFrame([(0, 0, 0, 0, 100, 5000), (0, 1, 0, 5000, 100, 5100)], "page int, block long, x0 int, y0 int, x1 int, y1 int")
    rows = lines(spark, [(0, y, 50, y + 10) for y in (0, 1019, 2040, 4989, 4995, 5050, 5200)])
    assert {r["ord"]: r["block"] for r in L.assign_lines(rows, blocks, ["page"]).collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 1, 6: None}


def test_phantoms(spark):
    rows = spark.createDataFrame([(0, 0, "a", 0, 0, 100, 20, 0.5), (0, 1, "b", 0, 0, 40, 20, 0.9), (0, 2, "c", 30, 0, 70, 20, None), (0, 3, "d", 0, 50, 100, 70, 0.5)], LINE)
    assert [(r["ord"], r["covered"]) for r in L.phantom_lines(rows, ["page"]).collect()] == [(0, 70)]


def clusters(spark, boxes):
    rows = lines(spark, boxes)
    return C.clusters(rows, C.cluster_lines(rows, ["page"], "page int, ord long, cluster long"), ["page"])


def test_line_clusters(spark):
    row = lambda *ys, h=30: [(0, y, 200, y + h) for y in ys]
    assert clusters(spark, row(100, 140, 180, 220)).count() == 1
    assert clusters(spark, row(100, 140, 900, 940)).count() == 2
    assert clusters(spark, [(0, 0, 100, 30), (130, 0, 230, 30), (260, 0, 360, 30)]).count() == 1
    assert clusters(spark, row(0, 320, h=200)).count() == 1
    assert clusters(spark, row(0, 140, h=20)).count() == 2
    assert clusters(spark, []).count() == 0


def missed(spark, owned, orphans):
    boxes = [(0, y, 200, y + 30) for y in owned + orphans]
    rows = lines(spark, boxes).withColumn("assigned", F.col("ord") < len(owned))
    return [r["orphans"] for r in C.missed_blocks(rows, clusters(spark, boxes), ["page"]).collect()]


def test_missed_blocks(spark):
    assert missed(spark, [100, 140], [900, 940, 980]) == [3]
    assert missed(spark, [100, 140, 180], []) == []
    assert missed(spark, [], [100, 900, 1700]) == []
    assert missed(spark, [100, 140, 180], [220]) == []
    assert missed(spark, [100], [140, 180, 220]) == [3]


def test_cards(spark):
    regions = spark.createDataFrame([(0, 0, 100, 60, 900, 120), (0, 1, 100, 200, 600, 900), (0, 2, 1300, 200, 1800, 900)], "page int, block long, x0 int, y0 int, x1 int, y1 int")
    votes = [(0, o, b, c) for o in range(3) for b, c in ((0, 0), (1, 1), (2, 2))]
    obs = spark.createDataFrame(votes, "page int, obs int, block long, card_no int")
    got = {r["block"]: r["card"] for r in C.card_votes(obs, regions, ["page"], 3).collect()}
    assert got == {0: 0, 1: 1, 2: 2}
    assert C.card_votes(obs.where("obs = 0"), regions, ["page"], 3).count() == 0


def test_geometry_of_points(spark):
    rows = spark.createDataFrame([([10, 5, 200, 5, 200, 50, 10, 50],), ([5, 5, 5, 9],), ([1, 2],), ([-5, -5, 30, 40],), ([100, 100, 50, 50],), ([0, 0, 9, 0, 9, 9],)], "p array<int>")
    got = [tuple(r[0]) if r[0] else None for r in rows.select(G.from_points(F.col("p"), F.lit(100), F.lit(100))).collect()]
    assert got == [(10, 5, 100, 50), None, None, (0, 0, 30, 40), None, None]
    points = spark.createDataFrame([([[9, 1], [2, 8], [5, 200]],), ([],)], "p array<array<int>>")
    assert [tuple(r[0]) if r[0] else None for r in points.select(G.around(F.col("p"), F.lit(100), F.lit(100))).collect()] == [(2, 1, 9, 100), None]


def test_texts_stay_out_of_the_steps_on_boxes(spark, tiny, monkeypatch):
    from pagelattice.plans import pipelines as P

    staged = {}
    monkeypatch.setattr(P, "stage_table", lambda df, tag, keep=P.stage_table: staged.setdefault(tag, keep(df, tag)))
    P.parse_pipeline(spark, tiny)
    assert not any("text" in staged[tag].columns for tag in ("kept", "placed", "clean", "readings"))
    assert staged["readings"].count() == staged["roles"].select("text").distinct().count()


def test_absorbing_makes_no_frame_for_each_page(spark, monkeypatch):
    import pandas as pd

    held = {}
    monkeypatch.setattr(L, "by_pages", lambda rows, keys, run, schema: held.update(run=run, columns=rows.columns))
    box = "0 as x0, 0 as y0, 10 as x1, 10 as y1"
    L.absorb_unassigned(spark.sql(f"select 1L as page, 0L as ord, {box}"), spark.sql(f"select 1L as page, 0L as block, {box}, 900 as canvas_h"), ["page"])
    one = [(0, 0, 0, 10, 10, True, None), (1, 0, 310, 10, 320, True, None), (1, 0, 0, 20, 10, None, 900), (2, 0, 700, 10, 710, True, None), (3, 0, 0, 10, 10, False, None)]
    rows = pd.DataFrame([(p, *r) for p in range(500) for r in one], columns=held["columns"]).astype({"precise": object})
    calls = []
    monkeypatch.setattr(pd.DataFrame, "__getitem__", lambda df, k, get=pd.DataFrame.__getitem__: calls.append(1) or get(df, k))
    out = held["run"](rows)
    # the second line grows the region, so that the third is no further than 400 rows from it, but over the reach of 300
    assert len(calls) < 100
    assert [None if pd.isna(b) else int(b) for b in out.block][:8] == [1, 1, None, None] * 2


def test_pseudo_regions_deal_out_boxes_once(spark, tiny):
    from pagelattice.plans import layout as queries

    plan = queries.pseudo_regions(spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    rows = spark.sql("select * from values (1, 0L, 0, 0, 9, 10), (1, 1L, null, null, null, null), (1, 2L, 0, 26, 9, 36), (2, 0L, null, null, null, null) as t(page, ord, x0, y0, x1, y1)")
    got = {(r["page"], r["region"], r["y1"], r["n_lines"], r["label"]) for r in L.pseudo_regions(rows, ["page"]).collect()}
    assert got == {(1, 0, 10, 1, "text_cluster"), (1, 1, 36, 1, "text_cluster"), (2, 0, None, 1, "page")}


def test_documents_deal_out_their_texts_once(spark):
    from pagelattice.sources import files as S

    lines = spark.sql("select * from values ('a', 0L, 0L, 't'), ('a', null, 1L, 'u'), ('b', null, 0L, 'v') as t(doc_id, block, ord, text)").selectExpr("*", "0.5D as confidence", "'ocr' as source", "0 as x0", "0 as y0", "9 as x1", "9 as y1")
    regions = spark.sql("select 'a' as doc_id, k as block, concat('r', k) as region_id, 'text' as label, 'x' as role, 0 as x0, 0 as y0, 9 as x1, 9 as y1, null as vlm_reading from (select explode(array(0L, 1L)) as k)")
    documents = S.documents_of(lines, regions)
    assert documents._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    pages = {r["doc_id"]: r["pages"][0] for r in documents.collect()}
    assert [[x["text"] for x in r["lines"]] for r in pages["a"]["regions"]] == [["t"], []] and pages["b"]["regions"] == []
    assert [x["text"] for x in pages["a"]["unassigned_lines"]] == ["u"] and [x["text"] for x in pages["b"]["unassigned_lines"]] == ["v"]
