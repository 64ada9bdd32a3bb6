from pyspark.sql import functions as F

from pagelattice.operators import rules as R

CELL = "doc_id long, scope string, event_no long, field_key string, value string, status string, ord long"
DEPOSIT, SAVING = "입출금", "적금"


def cells(spark, rows):
    return spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], CELL)


def test_statuses_follow_values(spark):
    rows = [(1, "field", 0, "a", v, s) for v, s in [("not_found", "found"), ("연 2.3%", "found"), ("연 최고 7.1%", "not_found"), (None, "uncertain"), ("-", "not_found")]]
    got = R.normalise_status(cells(spark, rows)).orderBy("ord").collect()
    assert [(r["value"], r["status"]) for r in got] == [("", "not_found"), ("연 2.3%", "found"), ("연 최고 7.1%", "found"), ("", "not_found"), ("", "not_found")]
    assert got[1]["corrected"] is None and "found to not_found" in got[0]["corrected"]
    assert R.normalise_status(cells(spark, [(1, "event", 1, "a", "-", "found")])).first()["status"] == "found"


def absences(spark, rows, subtype):
    spec = spark.createDataFrame([("early", "필수"), ("base", "필수"), ("max", "필수"), ("amount", "권장"), ("mentions", "수집"), ("prize", "필수"), ("cond", None)], "field_key string, obligation string")
    cond = spark.createDataFrame([("early", 0, "subtype_not_in", [DEPOSIT], []), ("base", 0, "trigger_any", [], ["max"]), ("cond", 0, "conditional", [], ["x"])], "field_key string, ord int, rule string, choices array<string>, fields array<string>")
    docs = spark.createDataFrame([(1, subtype, None)], "doc_id long, subtype string, ad_type string")
    return {(r["event_no"], r["field_key"]): (r["kind"], r["rule"]) for r in R.classify_absences(cells(spark, rows), spec, cond, docs).collect()}


def test_four_kinds_of_absence(spark):
    gone = lambda k: (1, "field", 0, k, "", "not_found")
    assert absences(spark, [gone("early")], SAVING)[0, "early"] == (R.MISSING, "applicable")
    assert absences(spark, [gone("early")], DEPOSIT)[0, "early"] == (R.NOT_APPLICABLE, "subtype_not_in")
    assert absences(spark, [gone("early")], "판단불가")[0, "early"] == (R.UNKNOWN, "subtype_unknown")
    assert absences(spark, [gone("early")], None)[0, "early"] == (R.UNKNOWN, "subtype_unknown")
    assert absences(spark, [gone("base"), (1, "field", 0, "max", "3%", "found")], SAVING)[0, "base"] == (R.MISSING, "applicable")
    assert absences(spark, [gone("base")], SAVING)[0, "base"] == (R.NOT_APPLICABLE, "trigger_any")
    assert absences(spark, [gone("cond"), gone("mentions"), gone("amount"), gone("stranger")], SAVING) == {
        (0, "cond"): (R.NOT_APPLICABLE, "conditional"), (0, "mentions"): (R.OUT_OF_SCOPE, "not_judged"), (0, "amount"): (R.MISSING, "applicable"), (0, "stranger"): (R.UNKNOWN, "spec_missing"),
    }
    events = [(1, "event", 1, "prize", "", "not_found"), (1, "event", 2, "prize", "x", "found"), (1, "event", 2, "base", "", "not_found"), (1, "event", 2, "max", "y", "found"), (1, "event", 1, "base", "", "not_found")]
    got = absences(spark, events, SAVING)
    assert got[1, "prize"][0] == R.MISSING and got[2, "base"][0] == R.MISSING and got[1, "base"][0] == R.NOT_APPLICABLE


def test_empty_events_go(spark):
    rows = [(1, "event", 1, "a", "x", "found"), (1, "event", 1, "b", "", "not_found"), (1, "event", 2, "a", "", "not_found"), (1, "event", 3, "a", "z", "uncertain"), (1, "field", 0, "f", "", "not_found")]
    kept, dropped = R.prune_events(cells(spark, rows))
    assert {(r["event_no"], r["field_key"]) for r in kept.collect()} == {(1, "a"), (1, "b"), (2, "a"), (0, "f")}
    assert [(r["dropped"], r["reported"]) for r in dropped.collect()] == [([2], 3)]


def test_unmapped_findings_already_handled(spark):
    found = R.REVIEW_RELATED
    items = spark.createDataFrame([(1, 0, "준법감시인 심의필 제2025-1호", found), (1, 1, "신규 고객 이벤트 당첨 안내문", found), (1, 2, "전혀 다른 문장입니다", found), (1, 3, "예", found), (1, 4, "준법감시인 심의필 제2025-1호", "무관")], "doc_id long, ord long, text string, kind string")
    values = spark.createDataFrame([(1, "준법감시인 심의필 제2025-1호"), (1, "이벤트 당첨 안내문 신규고객"), (1, "예금")], "doc_id long, value string")
    got = {r["ord"]: r["kind"] for r in R.reclassify_handled(items, values, ["doc_id"]).collect()}
    assert got == {0: R.ALREADY_HANDLED, 1: R.ALREADY_HANDLED, 2: found, 3: found, 4: "무관"}  # other kinds stay, whatever their text


def test_input_gap(spark):
    parsed = spark.createDataFrame([(1, "r000", "a", False), (1, "r001", "빠진 문구", True), (1, "r002", " ", False)], "doc_id long, region_id string, text string, is_illustrative boolean")
    view = spark.createDataFrame([(1, "r000")], "doc_id long, region_id string")
    assert [(r["region_id"], r["reason"]) for r in R.input_gap(parsed, view, ["doc_id"]).collect()] == [("r001", "illustrative")]


def test_contract_rejects_whole_groups(spark):
    good, bad, extra = '"value":"1","evidence":[],"status":"found"', '"value":"1","evidence":[],"status":"maybe"', '"value":"1","status":"found","more":1'
    rows = spark.createDataFrame([("a", '{"x":{%s}}' % good), ("b", '{"x":{%s},"y":{%s}}' % (good, bad)), ("c", '{"x":{%s}}' % extra), ("d", "nonsense")], "g string, raw string")
    assert {r["g"]: r["ok"] for r in R.check_contract(rows, ["g"]).collect()} == {"a": True, "b": False, "c": False, "d": False}


def test_merged_findings(spark):
    rows = [(1, 0, " a ", "무관", "r0", "G1", ["x"]), (1, 1, "a", R.REVIEW_RELATED, "r1", "G2", ["y", "x"]), (1, 2, "a", "무관", "r2", "G1", None), (1, 3, " ", "무관", "", None, None)]
    row = R.merge_unmapped(spark.createDataFrame(rows, "doc_id long, ord long, text string, kind string, reason string, group string, evidence array<string>"), ["doc_id"]).collect()
    assert [(r["text"], r["kind"], r["reason"], r["groups"], r["evidence"]) for r in row] == [("a", R.REVIEW_RELATED, "r1", ["G1", "G2"], ["x", "y"])]


def test_schema_check(spark):
    rows = spark.createDataFrame([("a", "필수", [1]), ("b", None, [1]), ("c", "필수", [])], "field_key string, obligation string, conditions array<int>")
    assert {r["field_key"]: r["problems"] for r in R.check_schema(rows).collect()} == {"b": ["no_obligation"], "c": ["no_conditions"]}


def test_flattened_names(spark):
    got = R.flatten_values(cells(spark, [(1, "event", 2, "a", "v", "found"), (1, "field", 0, "b", "w", "found")]), spark.createDataFrame([(1, "o", "q")], "doc_id long, field_key string, quote string"), spark.createDataFrame([(1, "u")], "doc_id long, text string"))
    assert {r["field"] for r in got.collect()} == {"event2.a", "b", "obs.o", "unmapped"}
    assert got.where(F.col("value") == "").count() == 0
