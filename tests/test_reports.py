from pyspark.sql import functions as F

from pagelattice.operators import layout as L
from pagelattice.operators import reports as R


def test_sentences_are_found_where_they_stand(spark):
    lines = spark.createDataFrame([(0, 0, "Rate 3.1%"), (0, 1, "for all")], "p int, ord long, text string")
    regions = spark.createDataFrame([(0, 0, "Rate 3.1%\nfor all", None), (0, 1, "who join", "who joins now")], "p int, block long, text string, vlm_reading string")
    view = spark.createDataFrame([(0, 1, "Rate 3.1% for all", None)], "p int, place int, text string, vlm_reading string")
    gold = [(0, 0, "«rate» 3.1 %"), (0, 1, "3.1% for ALL"), (0, 2, "for all who"), (0, 3, "joins now"), (0, 4, "rate 31%"), (0, 5, " · ")]
    got = R.sentence_recall(spark.createDataFrame(gold, "p int, item_id int, text string"), lines, regions, "p", view).orderBy("item_id").collect()
    assert [(r["item_id"], r["found"], r["in_view"]) for r in got] == [(0, "missed", False), (1, "region", True), (2, "page", False), (3, "candidate", False), (4, "missed", False)]
    plain = spark.createDataFrame([(0, 0, "“rate” 3.1 %")], "p int, item_id int, text string")
    assert R.sentence_recall(plain, lines, regions, "p").first()["found"] == "line"


def test_totals_come_once(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "f string, g string, n int")
    got = {(r["f"], r["g"]): r["s"] for r in R.with_total(rows, ["f", "g"], s=F.sum("n")).collect()}
    assert got == {("a", "x"): 1, ("a", "y"): 2, ("b", "x"): 3, (None, None): 6}


def test_worst_differences_first(spark):
    rows = spark.createDataFrame([(0, "same", True), (1, "same", False), (2, "expanded", False), (3, "tail_cut", False), (4, "diverged", False)], "ord long, kind string, identical boolean")
    assert [r["ord"] for r in R.risk_first(rows).collect()] == [3, 4, 2, 1]


def test_labels_dont_overlap(spark):
    rows = spark.createDataFrame([(0, k, 0, 0) for k in range(4)] + [(0, 4, 100, 0)], "p int, ord long, x int, y int")
    assert [(r["ord"], r["y"]) for r in L.push_down_labels(rows, ["p"]).orderBy("ord").collect()] == [(0, 0), (1, 24), (2, 48), (3, 72), (4, 0)]


def test_verdicts_keep_the_rule(spark):
    regions = spark.createDataFrame([(0, "본문", 0.5), (1, "표", None)], "block long, role string, role_confidence double")
    verdicts = spark.createDataFrame([(0, "제목", 0.9)], "block long, role string, confidence double")
    got = {r["block"]: (r["role"], r["role_rule"], r["role_source"], r["role_confidence"]) for r in L.judged_roles(regions, verdicts, ["block"]).collect()}
    assert got == {0: ("제목", "본문", "vlm", 0.9), 1: ("표", "표", "rules", None)}


def test_forms_are_made_once(spark, tiny):
    from pagelattice.functions import text as T
    from pagelattice.plans import reports

    plan = reports.sentence_recall(spark, tiny)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(T.EVAL_PICTURES) == 3  # of sentences, of lines, and of regions with their candidates
