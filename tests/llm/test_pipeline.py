"""The corpus pipeline against a plain version of itself."""

import random

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from pagelattice.llm import decontam, pii, queries, toxicity  # noqa: E402
from .test_results import sets_of  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shingled(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, tiny):
    path = str(tmp_path_factory.mktemp("in"))
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    bench = [r["text"] for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    rng = random.Random(1)
    rows = [r["text"] for r in docs.collect()]
    extra = [(100_000 + k, rows[rng.randrange(len(rows))]) for k in range(20)] + [(100_100 + k, "pre " + bench[k] + " post") for k in range(10)] + [(100_200, None), (100_201, "")]
    more = spark.createDataFrame([(d, t, "en", "s", None) for d, t in extra], docs.schema)
    docs.unionByName(more).write.parquet(f"{path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{tiny}/{t}.parquet").write.parquet(f"{path}/{t}.parquet")
    return path


def test_stages(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "sentencepiece"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    # 1: what the classifier rejects goes
    scores = toxicity.score(spark, docs, toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))
    rejected = {r["doc_id"] for r in scores.collect() if r["score"] >= 0.7}
    one = stage["toxicity"](spark, docs, folder)
    assert one.columns == COLUMNS
    left = {r["doc_id"]: r["text"] for r in one.collect()}
    assert left == {d: t for d, t in rows.items() if d not in rejected}
    # 2: one of each component of all pairs that share 0.8 of their five-word shingles
    two = stage["near_duplicates"](spark, one, folder)
    own = {d: shingled(t) for d, t in left.items()}
    root = sets_of(own, [(a, b) for a in own for b in own if a < b and len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b])])
    assert any(root[d] != d for d in own)
    kept = {r["doc_id"]: r["text"] for r in two.collect()}
    assert set(kept) == {d for d in left if root[d] == d} and two.columns == COLUMNS
    # 3: texts that hold an item's words in a row go, texts that share little with any stay
    three = stage["decontamination"](spark, two, folder)
    items = [decontam.tokens(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = {r["doc_id"]: r["text"] for r in three.collect()}
    for d, t in kept.items():
        words = " " + " ".join(decontam.tokens(t)) + " "
        if any(" " + " ".join(q) + " " in words for q in items):
            assert d not in clean
    gone = set(kept) - set(clean)
    assert all(max(decontam.lcs(q, decontam.tokens(kept[d])) / len(q) for q in items) >= 0.5 for d in gone)
    # 4: texts as the operator makes them, no row lost
    four = stage["pii"](spark, three, folder)
    assert four.columns == COLUMNS
    want = {r["doc_id"]: r["text"] for r in pii.pseudonymise(three).collect()}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in four.collect()} == {d: (t, None if t is None else len(t)) for d, t in want.items()}
    # 5: the library's pieces
    import public_tokenizers
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.TOKENIZER))
    five = {r["doc_id"]: r["ids"] for r in stage["sentencepiece"](spark, four, folder).collect()}
    assert five == {d: lib.encode(t or "") for d, t in want.items()}


def test_run_is_the_stages_in_turn(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, folder)
    key = lambda df: sorted((r["doc_id"], r["n_pieces"]) for r in df.collect())
    assert key(corpus_pipeline.run(spark, folder)) == key(docs)


def test_stages_keep_null_ids_and_empty_tables(spark, folder):
    docs = spark.createDataFrame([(None, "a b c d", None, None, None), (1, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, f in corpus_pipeline.STAGES[:-1]:
        docs = f(spark, docs, folder)
        assert docs.columns == COLUMNS and docs.count() == 2
    none = docs.limit(0)
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, none, folder).count() == 0
    assert docs.where(F.col("doc_id").isNull()).count() == 1


def test_near_copies_stage_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    rows, k = [], 0
    for group in range(60):
        base = rng.choices(vocabulary, k=rng.randrange(30, 200))
        for change in range(4):  # similarities on both sides of 0.8
            text = base[:]
            for _ in range(change * rng.randrange(0, 3)):
                text[rng.randrange(len(text))] = "x"
            rows.append((k, " ".join(text)))
            k += 1
    base = rng.choices(vocabulary, k=100)
    for _ in range(40):  # a large group whose members are all a little different
        text = base[:]
        text[rng.randrange(100)] = rng.choice(vocabulary)
        rows.append((k := k + 1, " ".join(text)))
    rows += [(9001, "Two words"), (9002, "two  WORDS"), (9003, None), (9004, ""), (9005, "a b c d e"), (9006, "a b c d e f"), (None, rows[0][1])]

    own = {d: shingled(t) for d, t in rows if d is not None}
    pairs = [(a, b) for a in own for b in own if a < b and len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b])]
    assert any(own[a] != own[b] and len(own[a] & own[b]) < 0.85 * len(own[a] | own[b]) for a, b in pairs)
    root = sets_of(own, pairs)
    docs = spark.createDataFrame([(d, t, "en", "s", None) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "").collect()]
    # the row without an id is a copy of another, so it goes as well
    assert set(kept) == {d for d in own if root[d] == d} and len(kept) == len(set(kept))


def test_decisions_fall_on_rows(spark, folder):
    """Repeated rows, rows without an id, two texts under one id and clashing columns, through all filtering stages."""
    item = spark.read.parquet(f"{folder}/benchmark.parquet").where("length(text) > 150").first()["text"]
    clean = [f"w{k} " + " ".join(f"c{k}x{j}" for j in range(60)) for k in range(6)]
    rows = [(1, clean[0]), (1, clean[0]), (None, clean[1]), (None, clean[1]), (2, clean[2]), (2, "so " + item + " yes"), (None, "see " + item), (3, clean[3]), (None, clean[3]), (4, clean[4]), (4, clean[5])]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit("clash") for c in ("fp", "component", "stays", "predicted", "n", "bands")})
    stage = dict(corpus_pipeline.STAGES)
    two = stage["near_duplicates"](spark, docs, folder)
    assert two.columns == docs.columns
    key = lambda df: sorted(((r["doc_id"] or 0), r["text"]) for r in df.collect())
    once = sorted({((d or 0), t) for d, t in rows} - {(0, clean[3])})
    without = [x for x in once if x != (0, "see " + item)]  # a near copy of the other text that holds the item, or not
    assert key(two) in (once, without)
    three = stage["decontamination"](spark, two, folder)
    assert key(three) == sorted(x for x in once if item not in x[1]) and three.columns == docs.columns
    one = stage["toxicity"](spark, docs, folder)
    assert one.columns == docs.columns and one.count() == len(rows)


def test_near_copies_in_blocks(spark, monkeypatch):
    from pagelattice.llm import near_copies

    words = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(words[:k] + ["x"] + words[k + 1 :])) for k in range(60)]
    monkeypatch.setattr(near_copies, "BLOCK", 7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["component_id"] for r in near_copies.near_copies(spark, docs).collect()} == {0}


def test_simhash_spares_comparisons_and_loses_none(monkeypatch):
    """Sets of one band: the Gray index opens few groups, and the links are those of all pairs."""
    import numpy as np

    from pagelattice.llm import near_copies

    rng = np.random.default_rng(6)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 1 << 63, 120, dtype=np.uint64)
        for k in range(4):
            mine = base.copy()
            mine[rng.choice(120, 6 * k, replace=False)] = rng.integers(0, 1 << 63, 6 * k, dtype=np.uint64)
            sets.append(np.unique(mine))
    flat, ends = np.concatenate(sets), np.cumsum([len(s) for s in sets])
    prints = near_copies.simhashes(flat, ends)
    own = [set(s.tolist()) for s in sets]
    pairs = [(a, b) for a in range(len(own)) for b in range(a) if len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b])]
    want = sets_of(range(len(own)), pairs)
    calls = []
    search = near_copies.GrayIndex.search_for
    monkeypatch.setattr(near_copies.GrayIndex, "search_for", lambda self, *a, **k: calls.append(found := search(self, *a, **k)) or found)
    assert sets_of(range(len(own)), near_copies.linked(sets, prints)) == want
    assert sum(len(j) for _, j in calls) < 0.35 * len(sets) ** 2
