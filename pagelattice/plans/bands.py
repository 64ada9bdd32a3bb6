"""Queries over density profiles, bands, clusters and votes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bands as B
from ..operators import clusters as C
from .adapters import table, v_block, v_line, v_profile, with_views

KEYS = ["profile"]
PARTS, WINDOW = 5, 20


def _targets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    profile = v_profile(spark, sf_dir)
    return profile, B.equal_mass_targets(profile, KEYS, PARTS)


def content_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.content_spans(v_profile(spark, sf_dir), KEYS).select("profile", "start", "stop", "mass", "share")


def equal_mass_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _targets(spark, sf_dir)[1].select("profile", F.col("k").cast("bigint").alias("k"), "target")


def snap_to_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile, targets = _targets(spark, sf_dir)
    return B.snap_to_clean(targets, profile, KEYS, WINDOW).select("profile", F.col("k").cast("bigint").alias("k"), "pos", "snapped")


def _cuts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    profile = v_profile(spark, sf_dir)
    targets = B.clamp_targets(B.equal_mass_targets(profile, KEYS, 12), 0.5)
    return profile, B.plan_cuts(B.snap_to_clean(targets, profile, KEYS, WINDOW), KEYS)


def plan_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cuts(spark, sf_dir)[1].select("profile", F.posexplode("cuts").alias("i", "c")).select("profile", F.col("i").cast("bigint").alias("i"), "c.cut", "c.snapped")


def bands_from_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile, cuts = _cuts(spark, sf_dir)
    out = B.bands_from_cuts(cuts, profile, KEYS, overlap=25)
    return out.select("profile", *[F.col(c).cast("bigint").alias(c) for c in ("band", "offset", "stop", "mass")])


def band_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = v_line(spark, sf_dir).groupBy("doc_id").agg((F.max("y1") * 37 % 9000 + 100).alias("height"), (F.max("x1") % 700 + 200).alias("width"))
    return pages.select("doc_id", F.col("height").cast("bigint").alias("height"), B.reader_span(F.col("width")).alias("span"), B.band_count(F.col("height"), B.reader_span(F.col("width"))).alias("bands"))


def content_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = B.content_bands(v_profile(spark, sf_dir), KEYS, 3, max_span=120, overlap=10, window=WINDOW)
    return out.select("profile", *[F.col(c).cast("bigint").alias(c) for c in ("n", "band", "offset", "stop", "mass")])


def band_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands of 240 rows every 200; blocks as regions, moved so that some lie between bands."""
    blocks = v_block(spark, sf_dir).withColumn("y0", F.expr("cast(y0 + doc_id % 50 as int)")).withColumn("y1", F.expr("cast(y1 + doc_id % 50 as int)"))
    tops = blocks.groupBy("doc_id").agg(F.max("block").alias("top"))
    bands = tops.select("doc_id", F.explode(F.expr("sequence(0L, top div 3)")).alias("band")).withColumn("offset", F.expr("band * 200")).withColumn("stop", F.expr("band * 200 + 140"))
    owned = B.band_owner(blocks, bands, ["doc_id"])
    grown = B.band_extent(owned, bands, blocks, ["doc_id"])
    return owned.join(grown, ["doc_id", "band"]).select("doc_id", "block", "band", F.col("regions").cast("bigint").alias("regions"), F.col("top").cast("bigint").alias("top"), F.col("bottom").cast("bigint").alias("bottom"), "grown")


def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines spread out so that clusters part: every third row is moved down, every fifth line far right."""
    down, right = F.expr("cast((ord div 9) * 40 as int)"), F.expr("cast(if(ord % 5 = 0, 900, 0) as int)")
    lines = v_line(spark, sf_dir)
    moved = lines.withColumn("y0", F.col("y0") + down).withColumn("y1", F.col("y1") + down)
    return moved.withColumn("x0", F.col("x0") + right).withColumn("x1", F.col("x1") + right)


def line_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _gappy(spark, sf_dir)
    found = C.clusters(lines, C.cluster_lines(lines, ["doc_id"], "doc_id bigint, ord bigint, cluster bigint"), ["doc_id"])
    return found.select("doc_id", "cluster", *[F.col(c).cast("bigint").alias(c) for c in ("x0", "y0", "x1", "y1", "n_lines", "place")])


def missed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _gappy(spark, sf_dir).withColumn("assigned", F.expr("(doc_id + ord div 9) % 3 <> 0"))
    found = C.clusters(lines, C.cluster_lines(lines, ["doc_id"], "doc_id bigint, ord bigint, cluster bigint"), ["doc_id"])
    return C.missed_blocks(lines, found, ["doc_id"])


def card_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = v_block(spark, sf_dir)
    observations = blocks.select("doc_id", "block", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("obs"))
    observations = observations.withColumn("card_no", F.expr("case when block = 0 then if(obs = 1, 1, 0) when (doc_id + block + obs) % 7 = 0 then 3 else block % 2 + 1 end"))
    out = C.card_votes(observations, blocks, ["doc_id"], 3)
    return out.select("doc_id", "block", F.col("card").cast("bigint").alias("card"))


def card_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = v_line(spark, sf_dir).withColumns({"canvas_w": F.lit(1400), "canvas_h": F.expr("cast(600 + doc_id % 4 * 900 as int)")})
    pages = regions.select("doc_id", "canvas_w", "canvas_h").distinct().withColumn("density_count", F.expr("if(doc_id % 3 = 0, doc_id % 4, null)"))
    return C.should_detect_cards(pages.join(C.separable(regions, ["doc_id"]), "doc_id"), ["doc_id"]).select("doc_id", "separable", "detect")


def card_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles as densities by column, some of them empty; and whether a page of each is asked about cards."""
    profile = v_profile(spark, sf_dir).withColumn("mass", F.expr("if(profile % 3 = 2, 0L, mass)"))
    pages = B.card_counts(profile, KEYS).withColumns({"canvas_w": F.lit(400), "canvas_h": F.lit(300), "separable": F.expr("profile % 2 = 0")})
    return C.should_detect_cards(pages, KEYS).select("profile", "density_count", "hint", "detect")


def edge_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edge densities, in steps of 255, of small pictures made of part numbers, along both axes."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("bigint").alias("picture"))
    luma = F.expr("transform(sequence(0, 6), r -> transform(sequence(0, 4), c -> cast((picture * (7 * r + 3 * c * c + 1)) % 256 as int)))")
    pictures = parts.withColumn("luma", luma)
    rows = B.edge_profiles(pictures, "picture").select("picture", F.posexplode("profile").alias("pos", "share"))
    return rows.select("picture", F.col("pos").cast("bigint").alias("pos"), F.bround(F.col("share") * 255, 0).cast("bigint").alias("steps"))


def sweep_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tall canvases of repeated profiles, with boxes at every hundredth position that cuts have to leave."""
    tall = v_profile(spark, sf_dir).withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(10)))).select("profile", (F.col("pos") + 400 * F.col("turn")).alias("pos"), "mass")
    names = tall.select("profile").distinct()
    boxes = names.select("profile", F.explode(F.sequence(F.lit(0), F.lit(43))).alias("k")).select("profile", (F.col("k") * 100 + 40).alias("top"), (F.col("k") * 100 + 90).alias("bottom"))
    return B.sweep_bands(tall, names.withColumn("width", F.lit(500)), boxes, KEYS).select("profile", F.col("band").cast("bigint").alias("band"), F.col("offset").cast("bigint").alias("offset"), "stop")


def canvas_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second profile's canvas is too tall for one tile."""
    turns = F.expr("sequence(0, if(profile % 2 = 0, 10, 0))")
    tall = v_profile(spark, sf_dir).withColumn("turn", F.explode(turns)).select("profile", (F.col("pos") + 400 * F.col("turn")).alias("pos"), "mass")
    return B.tiles(tall, KEYS).select("profile", F.col("band").cast("bigint").alias("band"), F.col("offset").cast("bigint").alias("offset"), F.col("stop").cast("bigint").alias("stop"))


_TARGETS = """
a AS (SELECT *, sum(mass) OVER (PARTITION BY profile ORDER BY pos) AS acc, sum(mass) OVER (PARTITION BY profile) AS total, max(pos) OVER (PARTITION BY profile) + 1 AS length FROM v_profile),
t AS (SELECT profile, k, length, CASE WHEN max(total) > 0 THEN min(pos) FILTER (acc * {n} >= total * k) ELSE CAST(floor(length * 1.0 / {n} * k) AS BIGINT) END AS target FROM a, (SELECT unnest(range(1, {n})) AS k) GROUP BY profile, k, length)"""
_SNAP = """
c AS (SELECT t.profile, t.k, arg_min(p.pos, struct_pack(d := abs(p.pos - target), p := p.pos)) AS cand FROM t JOIN v_profile p ON t.profile = p.profile AND p.mass = 0 AND abs(p.pos - target) <= 20 AND (p.pos = target OR (p.pos > 0 AND p.pos < length)) GROUP BY ALL),
s AS (SELECT t.*, coalesce(cand, target) AS pos, cand IS NOT NULL AS snapped FROM t LEFT JOIN c ON t.profile = c.profile AND t.k = c.k)"""
_CUTS = (
    _TARGETS.format(n=12).replace("t AS (", "t0 AS (", 1)
    + """, t AS (SELECT profile, k, length, CAST(floor(least(greatest(target, length / 12.0::DOUBLE * (k - 0.5::DOUBLE)), length / 12.0::DOUBLE * (k + 0.5::DOUBLE))) AS BIGINT) AS target FROM t0),"""
    + _SNAP
    + """, g AS (SELECT profile, length, list(struct_pack(t := target, p := pos, s := snapped) ORDER BY k) AS xs FROM s GROUP BY ALL),
f AS (SELECT profile, length, list_reduce(list_prepend([struct_pack(c := CAST(-1 AS BIGINT), s := false)], list_transform(xs, lambda x: [struct_pack(c := CAST(x.p AS BIGINT), s := x.s), struct_pack(c := CAST(x.t AS BIGINT), s := false)])),
  lambda acc, x: CASE WHEN x[1].c > acc[-1].c THEN list_append(acc, x[1]) WHEN x[2].c > acc[-1].c OR len(acc) = 1 THEN list_append(acc, x[2]) ELSE acc END)[2:] AS cuts FROM g)"""
)
_GAPPY = """
l AS (SELECT doc_id, ord, x0 + r AS x0, y0 + d AS y0, x1 + r AS x1, y1 + d AS y1 FROM (SELECT *, (ord // 9) * 40 AS d, CASE WHEN ord % 5 = 0 THEN 900 ELSE 0 END AS r FROM v_line)),
e AS (SELECT a.doc_id, a.ord AS a, b.ord AS b FROM l a JOIN l b ON a.doc_id = b.doc_id AND a.x0 - 30 < b.x1 + 30 AND b.x0 - 30 < a.x1 + 30 AND a.y0 - 12 < b.y1 + 12 AND b.y0 - 12 < a.y1 + 12),
reach AS (SELECT doc_id, a, b FROM e UNION SELECT r.doc_id, r.a, e.b FROM reach r JOIN e ON r.doc_id = e.doc_id AND r.b = e.a),
m AS (SELECT doc_id, a AS ord, min(b) AS cluster FROM reach GROUP BY ALL),
k AS (SELECT l.doc_id, cluster, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS n_lines FROM l JOIN m ON l.doc_id = m.doc_id AND l.ord = m.ord GROUP BY ALL)"""

# spans between the middles of empty runs of 20 or more that hold a tenth of the mass
_SPANS = """
p AS (SELECT profile, pos, CASE WHEN profile % 3 = 2 THEN 0 ELSE mass END AS mass FROM v_profile),
i AS (SELECT profile, pos - row_number() OVER (PARTITION BY profile ORDER BY pos) AS island, pos FROM p WHERE mass = 0),
u AS (SELECT profile, (min(pos) + max(pos) + 1) // 2 AS pos FROM i GROUP BY profile, island HAVING count(*) >= 20),
n AS (SELECT p.*, (SELECT count(*) FROM u WHERE u.profile = p.profile AND u.pos <= p.pos) AS span FROM p),
s AS (SELECT profile, span, min(pos) AS start, max(pos) + 1 AS stop, sum(mass) AS mass FROM n GROUP BY ALL),
t AS (SELECT profile, greatest(sum(mass), 1) AS total FROM p GROUP BY ALL),
k AS (SELECT s.profile, start, stop, row_number() OVER (PARTITION BY s.profile ORDER BY start) AS k FROM s JOIN t ON s.profile = t.profile WHERE s.mass * 10 >= total),
c AS (SELECT profile, count(*) AS n, string_agg(k || '번 x_ratio ' || printf('%.2f', start / 400.0::DOUBLE) || '~' || printf('%.2f', stop / 400.0::DOUBLE), ', ' ORDER BY k) AS ranges FROM k GROUP BY ALL)"""

QUERIES = {
    "card_counts": (card_counts, with_views("v_profile", _SPANS + """
        SELECT t.profile, n AS density_count, CASE WHEN n >= 2 THEN ranges END AS hint, CASE WHEN n IS NULL THEN t.profile % 2 = 0 ELSE n >= 2 END AS detect FROM t LEFT JOIN c ON t.profile = c.profile""")),
    "edge_profile": (edge_profile, """
        WITH l AS (SELECT p_partkey AS picture, r, c, (p_partkey * (7 * r + 3 * c * c + 1)) % 256 AS v FROM part, (SELECT unnest(range(7)) AS r), (SELECT unnest(range(5)) AS c)),
        e AS (SELECT a.picture, a.r AS pos, count(*) FILTER (abs(b.v - a.v) > 25 OR abs(d.v - a.v) > 25) AS n FROM l a LEFT JOIN l b ON b.picture = a.picture AND b.r = a.r AND b.c = a.c + 1 LEFT JOIN l d ON d.picture = a.picture AND d.r = a.r + 1 AND d.c = a.c
          WHERE a.c < 4 AND a.r < 6 GROUP BY ALL)
        SELECT picture, pos, 51 * n AS steps FROM e UNION ALL SELECT DISTINCT picture, 6, 0 FROM l"""),
    "sweep_bands": (sweep_bands, None),
    "canvas_tiles": (canvas_tiles, None),
    "content_spans": (content_spans, with_views("v_profile", """
        z AS (SELECT profile, pos - row_number() OVER (PARTITION BY profile ORDER BY pos) AS island, pos FROM v_profile WHERE mass = 0),
        r AS (SELECT profile, min(pos) AS a, max(pos) + 1 AS b FROM z GROUP BY profile, island),
        c AS (SELECT profile, (a + b) // 2 AS pos FROM r WHERE b - a >= 20),
        n AS (SELECT p.*, (SELECT count(*) FROM c WHERE c.profile = p.profile AND c.pos <= p.pos) AS span FROM v_profile p),
        s AS (SELECT profile, span, min(pos) AS start, max(pos) + 1 AS stop, CAST(sum(mass) AS BIGINT) AS mass, sum(sum(mass)) OVER (PARTITION BY profile) AS total FROM n GROUP BY profile, span)
        SELECT profile, start, stop, mass, mass * 1.0::DOUBLE / CASE WHEN total = 0 THEN 1 ELSE total END AS share FROM s WHERE mass * 1.0::DOUBLE / CASE WHEN total = 0 THEN 1 ELSE total END >= 0.1""")),
    "equal_mass_targets": (equal_mass_targets, with_views("v_profile", _TARGETS.format(n=PARTS) + " SELECT profile, k, target FROM t")),
    "snap_to_clean": (snap_to_clean, with_views("v_profile", _TARGETS.format(n=PARTS) + "," + _SNAP + " SELECT profile, k, pos, snapped FROM s")),
    "plan_cuts": (plan_cuts, with_views("v_profile", _CUTS + " SELECT profile, i - 1 AS i, cuts[i].c AS cut, cuts[i].s AS snapped FROM (SELECT profile, cuts, unnest(range(1, len(cuts) + 1)) AS i FROM f)")),
    "bands_from_cuts": (bands_from_cuts, with_views("v_profile", _CUTS + """,
        d AS (SELECT profile, list_concat([CAST(0 AS BIGINT)], list_transform(cuts, lambda c: c.c), [CAST(length AS BIGINT)]) AS edges FROM f),
        b AS (SELECT profile, i - 1 AS band, edges[i] AS start, edges[i + 1] AS stop FROM (SELECT profile, edges, unnest(range(1, len(edges))) AS i FROM d))
        SELECT b.profile, band, CASE WHEN band > 0 THEN greatest(0, start - 25) ELSE 0 END AS offset, stop, coalesce((SELECT CAST(sum(mass) AS BIGINT) FROM v_profile p WHERE p.profile = b.profile AND p.pos >= start AND p.pos < stop), 0) AS mass FROM b""")),
    "band_count": (band_count, with_views("v_line", """
        p AS (SELECT doc_id, CAST(max(y1) * 37 % 9000 + 100 AS BIGINT) AS height, greatest(900, CAST((max(x1) % 700 + 200) * 2 AS BIGINT)) AS span FROM v_line GROUP BY ALL),
        w AS (SELECT doc_id, height, span, CAST(0 AS BIGINT) AS y, CAST(1 AS BIGINT) AS n, CASE WHEN height <= span OR height - least(span, height) <= 200 THEN true ELSE false END AS done FROM p
              UNION ALL SELECT doc_id, height, span, y + span - 200, n + 1, height - least(y + span - 200 + span, height) <= 200 FROM w WHERE NOT done)
        SELECT doc_id, height, span, max(n) AS bands FROM w GROUP BY ALL""", recursive=True)),
    "content_bands": (content_bands, None),
    "band_owner": (band_owner, with_views("v_block", """
        r AS (SELECT doc_id, block, y0 + doc_id % 50 AS y0, y1 + doc_id % 50 AS y1 FROM v_block),
        b AS (SELECT doc_id, band, band * 200 AS top, band * 200 + 140 AS bottom FROM (SELECT doc_id, unnest(range(max(block) // 3 + 1)) AS band FROM r GROUP BY doc_id)),
        j AS (SELECT r.doc_id, block, band, y0, y1, top, bottom, greatest(0, least(y1, bottom) - greatest(y0, top)) AS c, abs((y0 + y1) // 2 - (top + (bottom - top) // 2)) AS away FROM r JOIN b ON r.doc_id = b.doc_id),
        o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, block ORDER BY c DESC, CASE WHEN c = 0 THEN away ELSE 0 END, band) AS rn FROM j) WHERE rn = 1),
        x AS (SELECT doc_id, band, count(*) AS regions, greatest(0, least(any_value(top), min(y0))) AS t, greatest(any_value(bottom), max(y1)) AS bt, min(y0) < any_value(top) OR max(y1) > any_value(bottom) AS grown FROM o GROUP BY doc_id, band)
        SELECT o.doc_id, block, o.band, regions, t AS top, bt AS bottom, grown FROM o JOIN x ON o.doc_id = x.doc_id AND o.band = x.band""")),
    "line_clusters": (line_clusters, with_views("v_line", _GAPPY + " SELECT doc_id, cluster, x0, y0, x1, y1, n_lines, row_number() OVER (PARTITION BY doc_id ORDER BY y0, x0, cluster) AS place FROM k", recursive=True)),
    "missed_blocks": (missed_blocks, with_views("v_line", _GAPPY + """,
        a AS (SELECT *, max(CASE WHEN (doc_id + ord // 9) % 3 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, x0, y0, x1, y1) AS orphan FROM l),
        i AS (SELECT k.doc_id, cluster, count(*) AS n, CAST(sum(orphan) AS BIGINT) AS orphans FROM k JOIN a ON k.doc_id = a.doc_id AND a.x0 >= k.x0 AND a.y0 >= k.y0 AND a.x1 <= k.x1 AND a.y1 <= k.y1 GROUP BY ALL)
        SELECT doc_id, cluster, orphans, round_even(1 - orphans * 1.0::DOUBLE / n, 3) AS covered FROM i WHERE n >= 2 AND orphans * 2 >= n""", recursive=True)),
    "card_votes": (card_votes, with_views("v_block", """
        o AS (SELECT doc_id, block, obs, CASE WHEN block = 0 THEN CASE WHEN obs = 1 THEN 1 ELSE 0 END WHEN (doc_id + block + obs) % 7 = 0 THEN 3 ELSE block % 2 + 1 END AS card_no FROM v_block, (SELECT unnest(range(3)) AS obs)),
        k AS (SELECT doc_id, count(DISTINCT obs) AS k FROM o GROUP BY ALL),
        common AS (SELECT o.doc_id, block FROM o JOIN k ON o.doc_id = k.doc_id GROUP BY o.doc_id, block, k HAVING count(*) FILTER (card_no = 0) * 2 > k),
        mem AS (SELECT * FROM v_block b WHERE NOT EXISTS (SELECT 1 FROM common c WHERE c.doc_id = b.doc_id AND c.block = b.block)),
        e AS (SELECT a.doc_id, a.block AS a, b.block AS b FROM o a JOIN o b ON a.doc_id = b.doc_id AND a.obs = b.obs AND a.card_no = b.card_no AND a.card_no > 0 JOIN k ON a.doc_id = k.doc_id
          JOIN mem ma ON ma.doc_id = a.doc_id AND ma.block = a.block JOIN mem mb ON mb.doc_id = b.doc_id AND mb.block = b.block GROUP BY a.doc_id, a.block, b.block, k HAVING count(*) * 2 > k),
        reach AS (SELECT doc_id, block AS a, block AS b FROM mem UNION SELECT r.doc_id, r.a, e.b FROM reach r JOIN e ON r.doc_id = e.doc_id AND r.b = e.a),
        comp AS (SELECT r.doc_id, r.a AS block, min(r.b) AS component, min(m.y0) AS top, min(m.x0) AS lft FROM reach r JOIN mem m ON m.doc_id = r.doc_id AND m.block = r.b GROUP BY r.doc_id, r.a),
        c AS (SELECT doc_id, block, dense_rank() OVER (PARTITION BY doc_id ORDER BY top, lft, component) AS card FROM comp),
        u AS (SELECT doc_id, block, card FROM c UNION ALL SELECT doc_id, block, 0 FROM common)
        SELECT * FROM u WHERE doc_id IN (SELECT doc_id FROM c GROUP BY doc_id HAVING max(card) >= 2)""", recursive=True)),
    "card_routing": (card_routing, with_views("v_line", """
        b AS (SELECT doc_id, 'x' AS axis, x0 AS a, x1 AS b, 1400 AS span FROM v_line UNION ALL SELECT doc_id, 'y', y0, y1, 600 + doc_id % 4 * 900 FROM v_line),
        f AS (SELECT *, max(b) OVER (PARTITION BY doc_id, axis ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM b WHERE b - a < 0.6 * span),
        p AS (SELECT doc_id, bool_or(coalesce(a - far >= 0.05 * span, false)) AS parted FROM f GROUP BY ALL),
        n AS (SELECT doc_id, count(*) AS n FROM v_line GROUP BY ALL),
        s AS (SELECT n.doc_id, n >= 3 AND coalesce(parted, false) AS separable FROM n LEFT JOIN p ON n.doc_id = p.doc_id)
        SELECT doc_id, separable, CASE WHEN (600 + doc_id % 4 * 900) / 1400.0 >= 2.0 THEN false ELSE coalesce(CASE WHEN doc_id % 3 = 0 THEN doc_id % 4 >= 2 END, separable) END AS detect FROM s""")),
}
