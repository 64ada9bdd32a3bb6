import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelattice.functions import profiles as P
from pagelattice.operators import bands as B


def page(height, width, rows):
    luma = np.full((height, width), 255)
    for a, b in rows:
        for x in range(0, width, 6):
            luma[a:b, x : x + 2] = 0
    return luma


def table(spark, *profiles):
    rows = [(k, i, float(v)) for k, p in enumerate(profiles) for i, v in enumerate(p)]
    return spark.createDataFrame(rows, "p long, pos long, mass double")


def cuts_of(spark, profile, n):
    rows = table(spark, profile)
    found = B.plan_cuts(B.snap_to_clean(B.equal_mass_targets(rows, ["p"], n), rows, ["p"]), ["p"]).first()
    return [(c["cut"], c["snapped"]) for c in found["cuts"]]


def test_cuts_follow_the_mass(spark):
    p = P.edge_profile(page(1200, 40, [(100, 200), (700, 1150)]))
    ((cut, _),) = cuts_of(spark, p, 2)
    assert cut > 600 and abs(p[:cut].sum() - p[cut:].sum()) < 0.25 * p.sum()
    ((cut, snapped),) = cuts_of(spark, P.edge_profile(page(1200, 40, [(0, 560), (640, 1200)])), 2)
    assert 545 <= cut <= 650 and snapped
    assert not all(ok for _, ok in cuts_of(spark, P.edge_profile(page(1200, 40, [(0, 1200)])), 3))
    assert P.edge_profile(np.full((50, 60), 90)).max() <= P.CLEAN


def test_even_cuts_without_mass(spark):
    assert [c for c, _ in cuts_of(spark, np.zeros(100), 4)] == [25, 50, 75]


def test_spans(spark):
    p = P.edge_profile(page(900, 60, [(20, 260), (330, 570), (640, 860), (880, 890)]))
    got = B.content_spans(table(spark, p, P.edge_profile(page(900, 60, [(20, 800)]))), ["p"]).collect()
    assert sorted(r["p"] for r in got) == [0, 0, 0, 1]
    assert abs(sum(r["share"] for r in got if r["p"] == 0) - 1) < 1e-9


def test_span_cap(spark):
    rows = table(spark, P.edge_profile(page(6000, 12, [(200, 2600), (3400, 5800)])))
    long = lambda bands: max(r["stop"] - r["offset"] for r in bands)
    free, capped = (B.content_bands(rows, ["p"], 3, max_span=m).collect() for m in (None, 1600))
    assert long(free) > 1600 >= long(capped) and len(capped) > len(free)
    hard = B.content_bands(rows, ["p"], 3, max_span=250).collect()  # overlaps alone are longer than that
    assert long(hard) > 250 and sorted(r["offset"] for r in hard)[0] == 0


@pytest.mark.parametrize("n", [1, 2, 5])
def test_bands_cover(spark, n):
    rng = np.random.default_rng(n)
    profiles = [np.where(rng.random(150) < 0.4, 0, rng.integers(0, 6, 150)) for _ in range(5)]
    got = B.content_bands(table(spark, *profiles), ["p"], n, overlap=4, window=5).orderBy("p", "band").collect()
    for k, p in enumerate(profiles):
        own = [r for r in got if r["p"] == k]
        assert own[0]["offset"] == 0 and own[-1]["stop"] == 150
        assert all(b["offset"] == a["stop"] - 4 for a, b in zip(own, own[1:], strict=False))
        assert abs(sum(r["mass"] for r in own) - p.sum()) < 1e-9


def test_tables_agree_with_scanning(spark):
    rng = np.random.default_rng(5)
    profiles = [np.where(np.arange(300) % 90 < 30, 0, rng.integers(0, 5, 300)) for _ in range(3)]
    rows = table(spark, *profiles)
    snapped = B.snap_to_clean(B.equal_mass_targets(rows, ["p"], 5), rows, ["p"], 20).collect()
    for r in snapped:
        p = profiles[r["p"]]
        target = next(i for i in range(300) if p[: i + 1].sum() * 5 >= p.sum() * r["k"])
        clean = [i for i in range(max(1, target - 20), target + 21) if i < 300 and p[i] == 0]
        assert r["target"] == target and r["snapped"] == bool(clean)
        assert r["pos"] == (min(clean, key=lambda i: (abs(i - target), i)) if clean else target)


@pytest.mark.parametrize("overlap", [50, 200])
def test_band_count(spark, overlap):
    rows = spark.createDataFrame([(length, span) for length in range(1, 9000, 97) for span in (901, 1440, 3000)], "length long, span long")
    for r in rows.select("length", "span", B.band_count(F.col("length"), F.col("span"), overlap).alias("n")).collect():
        # the least number of bands that reach to within an overlap of the end
        reach = lambda n: r["span"] + (n - 1) * (r["span"] - overlap)
        assert r["n"] == next(n for n in range(1, 99) if reach(n) >= r["length"] - (overlap if r["length"] > r["span"] else 0))


def test_sweeps(spark):
    rows = table(spark, np.ones(1120), np.ones(6554), np.ones(6554), np.ones(6554))
    widths = spark.createDataFrame([(0, 1990), (1, 720), (2, 720), (3, 720)], "p long, width long")
    none = spark.createDataFrame([], "p long, top long, bottom long")
    plain = B.sweep_bands(rows, widths, none, ["p"]).orderBy("p", "band").collect()
    assert [(r["offset"], r["stop"]) for r in plain if r["p"] == 0] == [(0, 1120)]
    own = [r for r in plain if r["p"] == 1]
    assert own[-1]["stop"] == 6554 and len(own) > 2 and all(a["stop"] - b["offset"] == P.OVERLAP for a, b in zip(own, own[1:], strict=False))
    cut = own[0]["stop"]
    walls = spark.createDataFrame([(2, cut - 20, cut + 30), (3, cut - 400, cut + 400)], "p long, top long, bottom long")
    first = {r["p"]: r["stop"] for r in B.sweep_bands(rows, widths, walls, ["p"]).where("band = 0").collect()}
    assert first == {0: 1120, 1: cut, 2: cut - 20, 3: cut}


def test_tiles(spark):
    got = B.tiles(table(spark, np.ones(4000), np.ones(4500)), ["p"]).orderBy("p", "band").collect()
    assert [(r["offset"], r["stop"]) for r in got if r["p"] == 0] == [(0, 4000)]
    assert all(r["stop"] - r["offset"] <= P.TILE for r in got if r["p"] == 1)


def test_pictures_to_profiles(spark):
    luma = page(40, 30, [(5, 15)])
    got = B.edge_profiles(spark.createDataFrame([(1, luma.tolist())], "page long, luma array<array<int>>"), "page").first()["profile"]
    assert np.allclose(got, P.edge_profile(luma)) and got[3] == 0 < got[4] and got[30] == 0


@pytest.mark.parametrize("name", ["line_clusters", "missed_blocks"])
def test_blank_lines_cluster_as_the_sql_says(spark, tmp_path, name):
    import duckdb

    from pagelattice.plans import bands as queries

    texts = ["\nfirst line is blank", "", "\n" * 62 + "x", "one\ntwo\n\nthree\nfour\nfive\nsix\nseven\neight\nnine\nten"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    query, sql = queries.QUERIES[name]
    df = query(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    other = con.execute(f"select {', '.join(df.columns)} from ({sql})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(other)
