"""Voxel-table operators over vectors unfolded to 4 x 4 x 4 grids."""

from pyspark.sql import functions as F

from stratiform.operators import voxels as X
from stratiform.queries.base import query, r6, table

_VOX = "vox AS (SELECT vec_id AS scan_id, i % 4 AS x, (i // 4) % 4 AS y, i // 16 AS z, CAST(embedding[i + 1] AS DOUBLE) AS value, label FROM (SELECT *, unnest(range(0, 64)) AS i FROM embeddings))"
_A, _B = "a AS (SELECT * FROM vox WHERE value > 0)", "b AS (SELECT * FROM vox WHERE value > 0.05 OR (x = 0 AND value > -0.1))"


def _voxels(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("scan_id"), "label", F.posexplode("embedding").alias("i", "v"))
    return e.select("scan_id", (F.col("i") % 4).alias("x"), (F.floor(F.col("i") / 4) % 4).cast("int").alias("y"), F.floor(F.col("i") / 16).cast("int").alias("z"), F.col("v").cast("double").alias("value"), "label")


def _masks(spark, sf_dir):
    v = _voxels(spark, sf_dir)
    a = v.filter("value > 0").select(*X.VOXEL, F.lit("a").alias("mask"))
    return v, a.union(v.filter("value > 0.05 or (x = 0 and value > -0.1)").select(*X.VOXEL, F.lit("b").alias("mask")))


def _only(masks, name):
    return masks.filter(F.col("mask") == name).select(X.VOXEL)


_COUNT = "SELECT scan_id, count(*) AS n FROM ({}) GROUP BY 1"
_P = "scan_id, x, y, z"


@query(f"WITH {_VOX}, {_A}, {_B} " + " UNION ALL ".join(f"SELECT '{n}' AS how, * FROM (" + _COUNT.format(s) + ")" for n, s in {
    "union": f"SELECT {_P} FROM a UNION SELECT {_P} FROM b", "intersection": f"SELECT {_P} FROM a INTERSECT SELECT {_P} FROM b", "difference": f"SELECT {_P} FROM a EXCEPT SELECT {_P} FROM b",
    "xor": f"(SELECT {_P} FROM a UNION SELECT {_P} FROM b) EXCEPT (SELECT {_P} FROM a INTERSECT SELECT {_P} FROM b)", "not": f"SELECT {_P} FROM vox EXCEPT SELECT {_P} FROM a"}.items()))
def x01_mask_algebra(spark, sf_dir):
    v, m = _masks(spark, sf_dir)
    out = None
    for how in ("union", "intersection", "difference", "xor", "not"):
        part = X.combine(m, ["a", "b"], how, v).groupBy("scan_id").agg(F.count("*").alias("n")).select(F.lit(how).alias("how"), "scan_id", "n")
        out = part if out is None else out.union(part)
    return out


_N6 = "n6 AS (SELECT * FROM (VALUES (0,0,0),(1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)) t(i,j,k))"


@query(f"WITH {_VOX}, {_A}, {_N6}, d AS (SELECT DISTINCT a.scan_id, a.x + i AS x, a.y + j AS y, a.z + k AS z FROM a, n6 WHERE a.x + i BETWEEN 0 AND 3 AND a.y + j BETWEEN 0 AND 3 AND a.z + k BETWEEN 0 AND 3), o AS (SELECT {_P} FROM vox EXCEPT SELECT {_P} FROM a), e AS (SELECT {_P} FROM a EXCEPT SELECT o.scan_id, o.x + i, o.y + j, o.z + k FROM o, n6) SELECT 'dilate' AS how, * FROM (" + _COUNT.format("SELECT * FROM d") + ") UNION ALL SELECT 'erode', * FROM (" + _COUNT.format("SELECT * FROM e") + ")")
def x03_dilate_erode(spark, sf_dir):
    v, m = _masks(spark, sf_dir)
    a = _only(m, "a")
    parts = [X.morphology(a, v, how, 1.0).groupBy("scan_id").agg(F.count("*").alias("n")).select(F.lit(how).alias("how"), "scan_id", "n") for how in ("dilate", "erode")]
    return parts[0].union(parts[1])


@query(f"""WITH RECURSIVE {_VOX}, m AS (SELECT {_P} FROM vox WHERE value > 0.05), n6 AS (SELECT * FROM (VALUES (1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)) t(i,j,k)),
r AS (SELECT {_P}, x * 16 + y * 4 + z AS root FROM m UNION SELECT m.scan_id, m.x, m.y, m.z, r.root FROM r, n6, m WHERE m.scan_id = r.scan_id AND m.x = r.x + i AND m.y = r.y + j AND m.z = r.z + k),
l AS (SELECT {_P}, min(root) AS root FROM r GROUP BY ALL), s AS (SELECT scan_id, root, count(*) AS n FROM l GROUP BY 1, 2) SELECT scan_id, n FROM s QUALIFY row_number() OVER (PARTITION BY scan_id ORDER BY n DESC, root) = 1""")
def x04_largest_component(spark, sf_dir):
    v = _voxels(spark, sf_dir).filter("value > 0.05")
    return X.largest_component(v).groupBy("scan_id").agg(F.count("*").alias("n"))


@query(f"""WITH RECURSIVE {_VOX}, m AS (SELECT {_P} FROM vox WHERE value > -0.1), o AS (SELECT {_P} FROM vox EXCEPT SELECT * FROM m), n6 AS (SELECT * FROM (VALUES (1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)) t(i,j,k)),
r AS (SELECT * FROM o WHERE x IN (0, 3) OR y IN (0, 3) OR z IN (0, 3) UNION SELECT o.scan_id, o.x, o.y, o.z FROM r, n6, o WHERE o.scan_id = r.scan_id AND o.x = r.x + i AND o.y = r.y + j AND o.z = r.z + k)
SELECT scan_id, 64 - count(r.x) AS n FROM (SELECT DISTINCT scan_id FROM m) LEFT JOIN r USING (scan_id) GROUP BY 1""")
def x05_fill_holes(spark, sf_dir):
    v = _voxels(spark, sf_dir)
    return X.fill_holes(v.filter("value > -0.1"), v).groupBy("scan_id").agg(F.count("*").alias("n"))


@query(f"WITH {_VOX}, b AS (SELECT scan_id, min(x) - 1 AS x0, max(x) + 1 AS x1, min(y) - 1 AS y0, max(y) + 1 AS y1, min(z) - 1 AS z0, max(z) + 1 AS z1 FROM vox WHERE value > 0.25 GROUP BY 1) SELECT scan_id, count(*) AS n, round(sum(value), 6) AS total FROM vox JOIN b USING (scan_id) WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 AND z BETWEEN z0 AND z1 GROUP BY 1")
def x07_crop(spark, sf_dir):
    v = _voxels(spark, sf_dir)
    return X.crop(v, v.filter("value > 0.25"), 1).groupBy("scan_id").agg(F.count("*").alias("n"), r6(F.sum("value")).alias("total"))


@query(f"""WITH {_VOX}, f AS (SELECT scan_id, value > 0 AS a, value > 0.05 OR (x = 0 AND value > -0.1) AS b, z < 2 AS c FROM vox),
o AS (SELECT scan_id, count(*) FILTER (WHERE a) AS n_a, count(*) FILTER (WHERE b) AS n_b, count(*) FILTER (WHERE a AND b) AS n_both, round(2 * n_both / nullif(n_a + n_b, 0), 6) AS dice,
round(2 * count(*) FILTER (WHERE a AND b AND c) / nullif(count(*) FILTER (WHERE a AND c) + count(*) FILTER (WHERE b AND c), 0), 6) AS dice_common, round(count(*) FILTER (WHERE a AND c) / nullif(n_a, 0), 6) AS common_fraction FROM f WHERE a OR b GROUP BY 1)
SELECT *, CASE WHEN coalesce(dice >= 0.5 AND common_fraction >= 0.05 AND n_a >= 4, false) THEN CASE WHEN dice >= 0.8 THEN 'high' ELSE 'acceptable' END ELSE 'low' END AS confidence FROM o""")
def x08_overlap(spark, sf_dir):
    v, m = _masks(spark, sf_dir)
    o = X.overlap(_only(m, "a"), _only(m, "b"), v.filter("z < 2"))
    o = o.withColumns({c: r6(F.col(c)) for c in ("dice", "dice_common", "common_fraction")})
    return o.withColumn("confidence", X.confidence(F.col("dice"), F.col("common_fraction"), F.col("n_a")))


_TOUCH = ", ".join(f"count(*) FILTER (WHERE {c} = {3 * i}) AS touch_{c}{i}" for c in "xyz" for i in (0, 1))
_AREAS = " UNION ALL ".join(f"SELECT scan_id, '{c}' AS axis, {c} AS pos, count(*) AS area FROM big GROUP BY ALL" for c in "xyz")


@query(f"""WITH RECURSIVE {_VOX}, m AS (SELECT {_P} FROM vox WHERE value > 0.05), n6 AS (SELECT * FROM (VALUES (1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)) t(i,j,k)),
r AS (SELECT {_P}, x * 16 + y * 4 + z AS root FROM m UNION SELECT m.scan_id, m.x, m.y, m.z, r.root FROM r, n6, m WHERE m.scan_id = r.scan_id AND m.x = r.x + i AND m.y = r.y + j AND m.z = r.z + k),
l AS MATERIALIZED (SELECT {_P}, min(root) AS root FROM r GROUP BY ALL), s AS (SELECT scan_id, root, count(*) AS k FROM l GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY scan_id ORDER BY count(*) DESC, root) = 1),
big AS (SELECT l.* FROM l JOIN s USING (scan_id, root)), areas AS ({_AREAS}),
sides AS (SELECT *, lag(pos) OVER w AS a0, lag(area) OVER w AS b0, lead(pos) OVER w AS a1, lead(area) OVER w AS b1, max(area) OVER (PARTITION BY scan_id, axis) AS most, count(*) OVER (PARTITION BY scan_id, axis) AS n FROM areas WINDOW w AS (PARTITION BY scan_id, axis ORDER BY pos)),
cut AS (SELECT scan_id, bool_or(n >= 3 AND area >= greatest(4, 0.25 * most) AND (a0 IS NULL AND area >= 0.9 * (CASE WHEN a1 = pos + 1 THEN b1 ELSE 0 END) OR a1 IS NULL AND area >= 0.9 * (CASE WHEN a0 = pos - 1 THEN b0 ELSE 0 END))) AS straight FROM sides GROUP BY 1),
o AS (SELECT g.scan_id, count(m.x) AS n, min(m.x) AS x0, max(m.x) AS x1, min(m.y) AS y0, max(m.y) AS y1, min(m.z) AS z0, max(m.z) AS z1, {_TOUCH.replace("WHERE ", "WHERE m.")} FROM (SELECT DISTINCT scan_id FROM vox) g LEFT JOIN m USING (scan_id) GROUP BY 1),
q AS (SELECT o.*, coalesce(k / n, 0) AS share, straight FROM o LEFT JOIN s USING (scan_id) LEFT JOIN cut USING (scan_id)),
w AS (SELECT *, list_filter([CASE WHEN n = 0 THEN 'empty' END, CASE WHEN n BETWEEN 1 AND 3 THEN 'insufficient_foreground' END, CASE WHEN n > 0 AND share < 0.8 THEN 'fragmented' END, CASE WHEN n = 64 THEN 'fills_entire_fov' END], lambda e: e IS NOT NULL) AS bad FROM q)
SELECT scan_id, n * 2.0 AS volume, x0, x1, y0, y1, z0, z1, touch_x0, touch_x1, touch_y0, touch_y1, touch_z0, touch_z1, round(share, 6) AS largest_share,
CASE WHEN len(bad) = 0 AND straight THEN ['straight_side'] ELSE bad END AS reasons, CASE WHEN len(bad) > 0 THEN 'invalid' WHEN touch_x0 + touch_x1 + touch_y0 + touch_y1 + touch_z0 + touch_z1 > 0 OR straight THEN 'partial' ELSE 'complete' END AS status FROM w""")
def x10_mask_quality(spark, sf_dir):
    """All statuses and reasons: components below four fifths, sides and straight faces of the largest component."""
    v = _voxels(spark, sf_dir)
    return X.mask_quality(v.filter("value > 0.05"), v, (1, 1, 2), margin=0.0).withColumn("largest_share", r6(F.col("largest_share")))


def _raters(spark, sf_dir):
    v = _voxels(spark, sf_dir).filter("not (scan_id % 5 = 0 and z = 3)")
    seen = v.select(F.col("label").alias("scan_id"), F.col("scan_id").alias("rater"), *X.XYZ, "value")
    return seen, seen.filter("value > 0")


_RATED = f"{_VOX}, seen AS (SELECT label AS scan_id, scan_id AS rater, x, y, z, value FROM vox WHERE NOT (scan_id % 5 = 0 AND z = 3)), f AS (SELECT {_P}, count(*) AS observed, count(*) FILTER (WHERE value > 0) AS votes FROM seen GROUP BY ALL)"


@query(f"WITH {_RATED} SELECT {_P}, observed, votes, round(votes / observed, 6) AS probability, votes / observed > 0.5 AS fused FROM f")
def x12_vote_fusion(spark, sf_dir):
    return X.fuse(*_raters(spark, sf_dir)).withColumn("probability", r6(F.col("probability")))


def _given(one: str, other: str) -> str:
    """SQL: the product over three raters, of `one` where the pattern has the rater's vote, else of `other`."""
    return " * ".join(f"CASE WHEN (ps[i] >> {r}) & 1 = 1 THEN {one.format(r + 1)} ELSE {other.format(r + 1)} END" for r in range(3))


_QUALITY = lambda sign, weight: "[" + ", ".join(f"list_sum(list_transform(range(1, len(ps) + 1), lambda i: CASE WHEN (ps[i] >> {r}) & 1 = {sign} THEN ks[i] * {weight} ELSE 0 END)) / greatest(list_sum(list_transform(range(1, len(ps) + 1), lambda i: ks[i] * {weight})), 1e-12)" for r in range(3)) + "]"


@query(f"""WITH RECURSIVE {_VOX}, v AS (SELECT scan_id, x, y, z, CAST(value > 0 AS INT) + 2 * CAST(value > 0.05 AS INT) + 4 * CAST(value > -0.05 AS INT) AS pattern FROM vox),
c AS (SELECT scan_id, pattern, count(*) AS k FROM v GROUP BY 1, 2), s AS (SELECT scan_id, list(pattern ORDER BY pattern) AS ps, list(k ORDER BY pattern) AS ks, sum(k * bit_count(pattern) / 3) / sum(k) AS prior FROM c GROUP BY 1),
em AS (SELECT scan_id, ps, ks, prior, 0 AS step, [0.99::DOUBLE, 0.99, 0.99] AS se, [0.99::DOUBLE, 0.99, 0.99] AS sp, NULL::DOUBLE[] AS w, 1::DOUBLE AS change FROM s
UNION ALL SELECT scan_id, ps, ks, prior, step + 1, se2, sp2, w2, list_max(list_transform(range(1, 4), lambda r: greatest(abs(se2[r] - se[r]), abs(sp2[r] - sp[r])))) FROM (
 SELECT *, {_QUALITY(1, "w2[i]")} AS se2, {_QUALITY(0, "(1 - w2[i])")} AS sp2 FROM (
 SELECT *, list_transform(range(1, len(ps) + 1), lambda i: CASE WHEN ones[i] + zeros[i] > 0 THEN ones[i] / (ones[i] + zeros[i]) ELSE 0 END) AS w2 FROM (
 SELECT *, list_transform(range(1, len(ps) + 1), lambda i: prior * {_given("se[{}]", "(1 - se[{}])")}) AS ones, list_transform(range(1, len(ps) + 1), lambda i: (1 - prior) * {_given("(1 - sp[{}])", "sp[{}]")}) AS zeros FROM em WHERE step < 100 AND change >= 1e-6)))),
f AS (SELECT scan_id, arg_max(ps, step) AS ps, arg_max(w, step) AS w FROM em GROUP BY 1)
SELECT v.scan_id, x, y, z, pattern, round(w[list_position(ps, pattern)], 6) AS probability, w[list_position(ps, pattern)] >= 0.5 AS fused FROM v JOIN f USING (scan_id)""")
def x13_staple(spark, sf_dir):
    """Three thresholds as raters of every scan; each scan has its own rater qualities."""
    v = _voxels(spark, sf_dir)
    rater = F.explode(F.array(*(F.struct(F.lit(n).alias("rater"), F.lit(t).alias("cut")) for n, t in (("r1", 0.0), ("r2", 0.05), ("r3", -0.05)))))
    seen = v.select("scan_id", *X.XYZ, "value", rater.alias("r")).select("scan_id", *X.XYZ, "value", "r.*")
    return X.staple(seen, seen.filter("value > cut"), ["r1", "r2", "r3"]).withColumn("probability", r6(F.col("probability")))


@query(f"WITH {_RATED}, s AS (SELECT {_P}, list_sort(list(value)) AS d FROM seen GROUP BY ALL) SELECT {_P}, round(d[len(d) // 2 + 1], 6) AS median, CAST(len(d) AS BIGINT) AS observed FROM s")
def x14_upper_median(spark, sf_dir):
    return X.upper_median(_raters(spark, sf_dir)[0]).withColumn("median", r6(F.col("median")))


_BALL = "(a.x - b.x) ** 2 * 1.0 + (a.y - b.y) ** 2 * 2.25 + (a.z - b.z) ** 2 * 6.25"


@query(f"WITH {_VOX}, f AS (SELECT *, value > 0.1 AS fg FROM vox) SELECT {', '.join('a.' + c for c in _P.split(', '))}, a.fg, round(any_value(CASE WHEN a.fg THEN -1 ELSE 1 END) * sqrt(min({_BALL})), 6) AS value FROM f a JOIN f b ON a.scan_id = b.scan_id AND a.fg <> b.fg GROUP BY a.scan_id, a.x, a.y, a.z, a.fg")
def x14_signed_distances(spark, sf_dir):
    """Each voxel's distance to the nearest voxel of the other side, by the plain minimum over all of them in the SQL."""
    v = _voxels(spark, sf_dir)
    out = X.signed_distances(v.filter("value > 0.1"), v, (1, 1.5, 2.5)).filter("abs(value) < double('infinity')")
    return out.select(*X.VOXEL, (F.col("value") < 0).alias("fg"), r6(F.col("value")).alias("value"))


@query(f"""WITH {_RATED}, g AS (SELECT *, value > 0 AS fg FROM seen), d AS (SELECT a.scan_id, a.rater, a.x, a.y, a.z, a.fg, sqrt(min({_BALL}) FILTER (WHERE b.fg <> a.fg)) AS far FROM g a JOIN g b ON a.scan_id = b.scan_id AND a.rater = b.rater GROUP BY ALL),
s AS (SELECT {_P}, list_sort(list(CASE WHEN fg THEN -1 ELSE 1 END * coalesce(far, 'infinity'::DOUBLE))) AS v FROM d GROUP BY ALL)
SELECT {_P}, round(v[len(v) // 2 + 1], 6) AS value, CAST(len(v) AS BIGINT) AS observed, round(len(list_filter(v, lambda e: e <= 0)) / len(v), 6) AS probability, v[len(v) // 2 + 1] <= 0 AS fused FROM s""")
def x14_fused_organs(spark, sf_dir):
    seen, masks = _raters(spark, sf_dir)
    out = X.fuse_organs(masks, seen, (1, 1.5, 2.5))
    return out.withColumns({"value": r6(F.col("value")), "probability": r6(F.col("probability"))})


@query(f"WITH {_VOX}, {_A}, e AS (SELECT a.* FROM a WHERE NOT EXISTS (SELECT 1 FROM vox b WHERE b.scan_id = a.scan_id AND NOT b.value > 0 AND {_BALL} <= 2.25)), o AS (SELECT DISTINCT a.scan_id, a.x, a.y, a.z FROM vox a JOIN e b ON a.scan_id = b.scan_id AND {_BALL} <= 2.25), d AS (SELECT DISTINCT a.scan_id, a.x, a.y, a.z FROM vox a JOIN a b ON a.scan_id = b.scan_id AND {_BALL} <= 6.25) SELECT 'dilate' AS how, * FROM (" + _COUNT.format("SELECT * FROM d") + ") UNION ALL SELECT 'open', * FROM (" + _COUNT.format("SELECT * FROM o") + ")")
def x03_balls(spark, sf_dir):
    """Radii in millimetres over voxels of 1 x 1.5 x 2.5."""
    v, m = _masks(spark, sf_dir)
    a = _only(m, "a")
    parts = [X.morphology(a, v, how, radius, (1, 1.5, 2.5)).groupBy("scan_id").agg(F.count("*").alias("n")).select(F.lit(how).alias("how"), "scan_id", "n") for how, radius in (("dilate", 2.5), ("open", 1.5))]
    return parts[0].union(parts[1])


@query(f"WITH {_RATED}, n AS (SELECT {_P}, count(*) AS n FROM seen GROUP BY ALL), s AS (SELECT a.scan_id, a.n <> b.n AS seam FROM n a JOIN n b ON a.scan_id = b.scan_id AND ((b.x = a.x + 1 AND b.y = a.y AND b.z = a.z) OR (b.x = a.x AND b.y = a.y + 1 AND b.z = a.z) OR (b.x = a.x AND b.y = a.y AND b.z = a.z + 1))) SELECT scan_id, count(*) FILTER (WHERE seam) AS seams FROM s GROUP BY 1")
def x15_seams(spark, sf_dir):
    return X.seams(_raters(spark, sf_dir)[0])


@query(f"WITH {_VOX} SELECT scan_id, round(quantile_cont(value, 0.01), 6) AS low, round(quantile_cont(value, 0.99), 6) AS high FROM vox GROUP BY 1")
def x16_window_levels(spark, sf_dir):
    return X.window_levels(_voxels(spark, sf_dir)).withColumns({"low": r6(F.col("low")), "high": r6(F.col("high"))})


@query(f"WITH {_VOX}, m AS (SELECT scan_id, x * 2.0 + 1 AS x, y * 3.0 + 1 AS y, z * 1.0 + 1 AS z FROM vox WHERE value > 0) SELECT scan_id, " + ", ".join(f"round(avg({c}), 6) AS c{c}" for c in "xyz") + ", " + ", ".join(f"round(covar_samp({a}, {b}), 6) AS cov_{a}{b}" for a, b in ("xx", "xy", "xz", "yy", "yz", "zz")) + " FROM m GROUP BY 1")
def x17_moments(spark, sf_dir):
    out = X.moments(_voxels(spark, sf_dir).filter("value > 0"), (2, 3, 1), (1, 1, 1))
    return out.withColumns({c: r6(F.col(c)) for c in out.columns if c != "scan_id"})


@query(f"""WITH {_VOX}, {_A}, {_B}, roi AS (SELECT 'organ' AS mask, * FROM a UNION ALL SELECT 'minus', * FROM a WHERE NOT (value > 0.05 OR (x = 0 AND value > -0.1))),
s AS (SELECT scan_id, mask, count(*) AS n, round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS variance, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.75), 6) AS p75, round(sum(value * value), 6) AS energy FROM roi GROUP BY 1, 2),
h AS (SELECT scan_id, mask, floor(value / 0.05) AS bin, count(*) AS k FROM roi GROUP BY 1, 2, 3), e AS (SELECT scan_id, mask, round(-sum(p * log2(p)), 6) AS entropy FROM (SELECT scan_id, mask, k / sum(k) OVER (PARTITION BY scan_id, mask) AS p FROM h) GROUP BY 1, 2) SELECT s.*, entropy FROM s JOIN e USING (scan_id, mask)""")
def q12_first_order(spark, sf_dir):
    """Organ, and organ without tumour (an anti-join), each with its statistics."""
    v, m = _masks(spark, sf_dir)
    organ, tumour = _only(m, "a"), _only(m, "b")
    rois = organ.withColumn("mask", F.lit("organ")).union(organ.join(tumour, X.VOXEL, "left_anti").withColumn("mask", F.lit("minus")))
    out = X.first_order(v.drop("label"), rois, 0.05)
    return out.withColumns({c: r6(F.col(c)) for c in ("min", "max", "mean", "variance", "p25", "p75", "energy", "entropy")})
