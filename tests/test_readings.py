import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelattice.functions import text as T
from pagelattice.operators import readings as R
from pagelattice.operators import triage as G

RELATIONS = [
    ("경품안내 총777명추첨 N pay 포인트 쿠폰 가상페이 20,000원", "총 777명 추첨", "tail_cut"),
    ("상품명 AB두루e적금", "AB두루e적금", "head_drop"),
    ("가입기간 12 개월", "12 개월", "head_drop"),
    ("[AB큰복7적금]가입고객", "「AB큰복7적금」 가입고객", "same"),
    ("최대 연3.6%(기본3.1%)", "최대 연 3.6% (기본 3.1%)", "same"),
    ("가" * 100 + "나", "가" * 100, "same"),
    ("최고연", "최고 연 7.1% 인생 큰복적금이 온다", "expanded"),
    ("", "아무 글", "expanded"),
    ("아무 글", "", "tail_cut"),
    (None, None, "same"),
    ("가입기간 12개월", "연이자율 3.6퍼센트", "diverged"),
    ("최고연71%", "최고연 7.1%", "diverged"),
    ("10.1%p 조건", "① 0.1%p 조건", "diverged"),
    ("참여방법 1", "참여 방법 ①", "same"),
    ("우리아이 계좌개설", "① 우리아이 계좌개설", "same"),
    ("마을은행이 777명에게 쓴다!", "마을은행이 777명에게 쏜다!", "diverged"),
    ("연 3% 적용", "연 5% 적용", "diverged"),
]


def test_relations(spark):
    rows = spark.createDataFrame([(k, a, b, e) for k, (a, b, e) in enumerate(RELATIONS)], "k int, ocr string, cand string, expected string")
    got = R.classify_readings(rows).select("k", "expected", "relation.kind").collect()
    assert len(got) == len(RELATIONS)
    assert [(r["k"], r["kind"]) for r in got if r["kind"] != r["expected"]] == []


@pytest.mark.parametrize("full", [False, True])
def test_filters_dont_normalise_again(spark, full):
    rows = spark.createDataFrame([(k, a, b) for k, (a, b, _) in enumerate(RELATIONS)], "k int, ocr string, cand string")
    found = R.classify_readings(rows, full=full).where("relation is not null and relation.kind <> 'same'").select("k", "relation.kind")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[" + T.LOWER + "가-힣]+") == 2
    want = {k for k, (_, _, e) in enumerate(RELATIONS) if e != "same"}
    assert {r["k"] for r in found.collect()} <= want and (not full or found.count() == len(want))


def test_forms_keep_what_they_kept(spark):
    texts = ["".join(map(chr, range(k, k + 64))) for k in [*range(1, 0x2500, 64), 0x3000, 0xAC00, 0xD780, 0xFF00]] + ["Ab p9 ①x「y」—z -[q]{r}\\ \t\x0b\x0c\r\nend"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.lower(F.regexp_replace("t", r"[0-9①②③④⑤⑥⑦⑧⑨⑩\s%p.,:;·「」『』\"'`~()\[\]{}\-—]+", ""))
    kept = F.regexp_replace(T.casefold(T.plain_numbers(F.col("t"))), "[^0-9A-Za-z가-힣]+", "")
    token = F.regexp_replace(T.casefold(F.col("t")), "[^0-9a-z가-힣.%]+", "")
    coarse = F.lower(F.regexp_replace("t", r"[\s,.~:：%()\[\]{}'\"`「」『』<>·※*!?|#-]", ""))
    scored = F.regexp_replace("t", r"[\s,~:：%()\[\]{}'\"`´『』「」〈〉<>【】·※*ㆍ■□|“”‘’]", "")
    assert rows.where((T.coarse(F.col("t")) != coarse) | (F.regexp_replace("t", T.EVAL_DROPS, "") != scored)).count() == 0
    assert rows.where((T.stable_core(F.col("t")) != plain) | (T.norm(F.col("t")) != kept) | (T.token_norm(F.col("t")) != token)).count() == 0
    # no range below 256, which would be tried by itself for each character
    assert "0-9" not in T.STABLE_DROPS and "\\s" not in T.STABLE_DROPS


def test_norm(spark):
    row = spark.createDataFrame([("0.1%p : 「AB두루e통장」", "⑩ ⑴ ⓽ ①")], "a string, b string").select(T.norm(F.col("a")), T.norm(F.col("b"))).first()
    assert tuple(row) == ("01pab두루e통장", "10191")


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=12), st.text(max_size=12)), min_size=60, max_size=60))
def test_relation_is_total(spark, pairs):
    clean = [(a.replace("\x00", ""), b.replace("\x00", "")) for a, b in pairs]
    clean = [(a, b) for a, b in clean if not any(0xD800 <= ord(c) < 0xE000 for c in a + b)]
    rows = spark.createDataFrame(clean, "ocr string, cand string")
    kinds = {r["kind"] for r in R.classify_readings(rows).select("relation.kind").collect()}
    assert kinds <= {"same", "tail_cut", "head_drop", "expanded", "diverged"}


def test_autojunk_is_a_choice(spark):
    base = "".join(chr(97 + (k * 7 + k // 26) % 26) for k in range(260))
    rows = spark.createDataFrame([("x" * 10 + base[:230] + "yy", base[:230] + "z")], "ocr string, cand string")
    loose = R.classify_readings(rows, autojunk=False).select("relation.kind").first()[0]
    assert loose in ("tail_cut", "diverged")


def test_order_changes_the_label(spark):
    lines = spark.createDataFrame([(0, 0, 69, 1218, "가입기간", "12 개월"), (0, 1, 408, 1216, "12 개월", "12 개월")], "region int, ord long, x0 int, y0 int, text string, cand string")
    row = R.order_flips(lines, ["region"], "text", "cand").first()
    assert (row["placed"], row["stored_order"], row["flips"]) == ("tail_cut", "head_drop", True)


def test_sentinels(spark):
    rows = spark.createDataFrame([(v,) for v in ["not_found", "없음", "해당 없음", "미표시", "-", "  ", '"none"', None, "연 2.3%"]], "v string")
    assert [r[0] for r in rows.select(T.is_empty_text(F.col("v"))).collect()] == [True] * 8 + [False]


def test_lists_are_empty_if_all_items_are(spark):
    rows = spark.createDataFrame([(["없음"],), (["1.0%p : 첫거래"],), ([],), (None,)], "v array<string>")
    assert [r[0] for r in rows.select(T.is_empty_value(F.col("v"))).collect()] == [True, False, True, True]


@pytest.mark.parametrize(("prior", "model", "source", "group"), [
    ("예금성", "기타", "filename_vlm_abstained", "예금성"), ("예금성", None, "filename_vlm_failed", "예금성"), ("예금성", "예금성", "filename_and_vlm", "예금성"),
    ("예금성", "대출성", "vlm_overrode_filename", "대출성"), (None, "대출성", "vlm", "대출성"), (None, "판단불가", "vlm_abstained", None), (None, None, "none", None),
])
def test_classification(spark, prior, model, source, group):
    row = G.classify(spark.createDataFrame([(prior, model)], "prior string, model_group string")).first()
    assert (row["category_source"], row["product_group"]) == (source, group)


def test_json_repair(spark):
    rows = spark.createDataFrame([('```json\n{"a": 1}\n```',), ('{"a": 2}',), ('{"a": 3}\\',), ("nonsense",)], "v string")
    got = [r[0] for r in rows.select(T.repaired_json(F.col("v"), "a int")["a"]).collect()]
    assert got == [1, 2, 3, None]


def test_sweep_counts_what_it_accepted(spark):
    known = spark.createDataFrame([(0, 0, "abc def")], "p int, ord long, text string")
    swept = spark.createDataFrame([(0, 0, "c d"), (0, 1, "new one"), (0, 2, "NEW, one"), (0, 3, " ")], "p int, ord long, text string")
    assert [r["ord"] for r in R.sweep_new_lines(swept, known, ["p"]).collect()] == [1]


def test_shares_round_by_their_exact_value(spark):
    rows = spark.createDataFrame([(k / 400,) for k in range(401)] + [(k / 7,) for k in range(8)] + [(0.5,), (0.125,), (0.375,), (1 / 3,)], "x double")
    assert all(r["t"] == f"{r['x']:.2f}" for r in rows.select("x", T.two_places(F.col("x")).alias("t")).collect())
