"""Consensus fits, mosaics, warps, correlation, rotation and similarity against plain loops."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from strataflow.operators import fits, rasters

MATCHES = "pair string, k int, x double, y double, u double, v double"


def sheets():
    r = random.Random(6)
    rows = []
    for p in range(12):
        s, tx, ty = r.uniform(0.9, 1.1), r.uniform(-500, 500), r.uniform(-500, 500)
        for k in range(r.choice((2, 5, 9, 14))):
            x, y = r.uniform(0, 6000), r.uniform(0, 5000)
            wild = r.random() < 0.35
            off = (lambda: r.uniform(-900, 900)) if wild else (lambda: r.uniform(-1.5, 1.5))
            rows.append((f"p{p}", k, x, y, s * x + tx + off(), s * y + ty + off()))
    return rows + [("p0", 99, None, 1.0, 1.0, 1.0), ("same", 0, 5.0, 5.0, 5.0, 5.0), ("same", 1, 5.0, 5.0, 5.0, 5.0)]


def consensus(points, apart, scales, within):
    """Votes and members of the first hypothesis with most votes, by loops over pairs."""
    best = (0, None, [])
    for a, p in enumerate(points):
        for q in points[a + 1 :]:
            d = math.dist(p[1:3], q[1:3])
            if d < apart:
                continue
            s = math.dist(p[3:5], q[3:5]) / d
            if not scales[0] <= s <= scales[1]:
                continue
            tx, ty = p[3] - s * p[1], p[4] - s * p[2]
            near = [m for m in points if math.hypot(m[3] - s * m[1] - tx, m[4] - s * m[2] - ty) < within]
            if len(near) > best[0]:
                best = (len(near), s, near)
    return best


def test_similarity_consensus(spark):
    rows = sheets()
    got = {r.pair: r for r in fits.similarity_consensus(spark.createDataFrame(rows, MATCHES).repartition(5), "pair").collect()}
    of = {}
    for r in rows:
        if None not in r:
            of.setdefault(r[0], []).append(r[1:])
    assert set(got) == set(of)
    statuses = set()
    for p, points in of.items():
        points.sort()
        n, _, near = consensus(points, 500.0, (0.93, 1.07), 4.0)
        want = "too few matches" if len(points) < 4 else "no consensus" if n < 4 else "ok"
        statuses.add(want)
        assert (got[p].status, got[p].matches, got[p].inliers) == (want, len(points), n), p
        if want == "ok":
            a = np.array(near)
            cs, ct = a[:, 1:3].mean(0), a[:, 3:5].mean(0)
            s = ((a[:, 3:5] - ct) * (a[:, 1:3] - cs)).sum() / ((a[:, 1:3] - cs) ** 2).sum()
            t = ct - s * cs
            assert np.allclose([got[p].scale, got[p].tx, got[p].ty], [s, *t]) and math.isclose(got[p].max_residual, np.linalg.norm(a[:, 3:5] - s * a[:, 1:3] - t, axis=1).max(), rel_tol=1e-6)
        else:
            assert got[p].scale is None and got[p].max_residual is None
    assert statuses == {"ok", "too few matches", "no consensus"} or statuses == {"ok", "too few matches"}


def test_affine_consensus(spark):
    r = random.Random(2)
    rows = []
    for p, (a, b, c, d, e, f) in enumerate([(0.9, 0.2, 10, -0.2, 0.9, 30), (1.0, 0.0, 0, 0.0, 1.0, 0)]):
        for k in range(10):
            x, y = r.uniform(0, 4000), r.uniform(0, 3000)
            wild = r.uniform(-700, 700) if k % 4 == 3 else 0.0
            rows.append((f"p{p}", k, x, y, a * x + b * y + c + wild, d * x + e * y + f - wild))
    rows += [("line", k, 100.0 * k, 50.0 * k, 100.0 * k, 50.0 * k) for k in range(6)]
    got = {x.pair: x for x in fits.affine_consensus(spark.createDataFrame(rows, MATCHES), "pair").collect()}
    assert (got["p0"].status, got["p0"].inliers) == ("ok", 8) and np.allclose([got["p0"][c] for c in "abcdef"], (0.9, 0.2, 10, -0.2, 0.9, 30), atol=1e-6)
    assert (got["line"].status, got["line"].inliers, got["line"].a) == ("no consensus", 0, None)  # points on a line span no triangle


def test_hypotheses_are_searched_once(spark):
    """The best hypothesis is read once: not anew for each count, sum and residual of the matches that agree with it."""
    rows = spark.createDataFrame(sheets(), MATCHES)
    for fit in (fits.similarity_consensus(rows, "pair"), fits.affine_consensus(rows, "pair")):
        assert fit._jdf.queryExecution().optimizedPlan().toString().count("max_by(") == 1


def test_sampled_windows(spark):
    rows = spark.createDataFrame([("a", 1000, 500), ("b", 100, 500)], "key string, width int, height int")
    got = [(r.window, r.x, r.y) for r in fits.sample_windows(rows, "key", [0.0, 0.5, 0.95], [0.5], 192).orderBy("window").collect()]
    assert got == [(0, 0, 154), (1, 404, 154), (2, 808, 154)]


def test_corners_and_footprint(spark):
    cone = "33.0 as lat1, 45.0 as lat2, 23.0 as lat0, -96.0 as lon0"
    rows = spark.sql(f"""select *, {cone}, -100000.0 as x0, 50.0 as dx, 1500000.0 as y0, -50.0 as dy, 4000 as width, 3000 as height from values
      ('all', 'ok', 1.0, 0.0, 0.0, named_struct('west', -98.0, 'south', 34.0, 'east', -94.0, 'north', 38.0)), ('off', 'ok', 1.0, 0.0, 0.0, named_struct('west', -80.0, 'south', 34.0, 'east', -78.0, 'north', 38.0)),
      ('none', 'no consensus', null, null, null, named_struct('west', -98.0, 'south', 34.0, 'east', -94.0, 'north', 38.0)), ('bare', 'ok', 2.0, 10.0, 20.0, null) as t(id, status, scale, tx, ty, extent)""")
    rows = rows.select(*[F.col(c).cast("double").alias(c) if c in ("scale", "tx", "ty", "lat1", "lat2", "lat0", "lon0", "x0", "dx", "y0", "dy", "width", "height") else F.col(c) for c in rows.columns])
    out = {r.id: r for r in fits.footprint_check(fits.corner_points(rows)).collect()}
    assert {k: (v.status, v.overlaps) for k, v in out.items()} == {"all": ("ok", True), "off": ("cutline-mismatch", False), "none": ("no consensus", None), "bare": ("ok", None)}
    assert out["none"].corners is None and [(c.px, c.py) for c in out["all"].corners] == [(0, 0), (4000, 0), (4000, 3000), (0, 3000)]
    west, east = out["all"].corners[0], out["all"].corners[1]
    assert west.lon < -96 < east.lon and abs(west.lat - east.lat) < 0.1 and west.lat == round(west.lat, 7)


def test_mosaic(spark):
    """Last opaque layer by loops; a group without opaque pixels, or clipped away, is reported."""
    r = random.Random(1)
    rows = [(g, l, y, x, r.randint(0, 255), r.choice((0, 255))) for g in ("a", "b") for l in range(5) for y in range(4) for x in range(6) if r.random() < 0.7]
    rows += [("clear", 0, 0, 0, 9, 0), ("out", 0, 50, 0, 9, 255)]
    clip = {"b": (1, 1, 4, 3), "out": (0, 0, 9, 9)}
    df = spark.createDataFrame([(*x, clip.get(x[0])) for x in rows], "g string, layer int, y int, x int, v int, a int, w struct<x0:int,y0:int,x1:int,y1:int>").repartition(4)
    got = rasters.mosaic(df, "g", ["layer"], ["v"], "a", "w")
    want = {}
    for g, l, y, x, v, a in sorted(rows):
        c = clip.get(g, (0, 0, 99, 99))
        if a and c[0] <= x < c[2] and c[1] <= y < c[3]:
            want[g, y, x] = v
    assert {(p.g, p.y, p.x): p.v for p in got.collect()} == want
    assert sorted((e.g, e.layers) for e in rasters.empty_groups(df, got, "g").collect()) == [("clear", 1), ("out", 1)]


def test_palette(spark):
    px = spark.createDataFrame([("i", 0, 0, 1), ("i", 0, 1, 7)], "image string, y int, x int, v int")
    pal = spark.createDataFrame([("i", 1, 10, 20, 30, 255), ("j", 7, 1, 1, 1, 1)], "image string, v int, r int, g int, b int, a int")
    assert sorted((p.x, p.r, p.g, p.b, p.a) for p in rasters.apply_palette(px, pal, "image").collect()) == [(0, 10, 20, 30, 255), (1, 0, 0, 0, 0)]


def test_warp(spark):
    """A turned, stretched and shifted sheet, cell by cell through the inverse fit; a ring masks another; a fit without inverse gives nothing."""
    px = spark.createDataFrame([(s, y, x, 100 * y + x if (x, y) != (2, 2) else None) for s in ("t", "m") for y in range(5) for x in range(7)], "sheet string, y int, x int, v int")
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (0.0, 3.0), (0.0, 0.0)]
    fit = [("t", 1.5, 0.5, 3.25, -0.5, 1.25, 2.75, 7, 5, None), ("m", 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 7, 5, ring), ("flat", 1.0, 2.0, 0.0, 2.0, 4.0, 0.0, 7, 5, None)]
    df = spark.createDataFrame(fit, "sheet string, a double, b double, c double, d double, e double, f double, width int, height int, ring array<struct<lon:double,lat:double>>")
    got = {(p.y, p.x): (p.v, p.alpha) for p in rasters.warp(px, df, "sheet").where("sheet = 't'").collect()}
    _, a, b, c, d, e, f, w, h, _ = fit[0]
    want, det = {}, a * e - b * d
    for y in range(-20, 40):
        for x in range(-20, 40):
            u, v = x + 0.5 - c, y + 0.5 - f
            sx, sy = math.floor((e * u - b * v) / det), math.floor((a * v - d * u) / det)
            if 0 <= sx < w and 0 <= sy < h:
                want[y, x] = (None, 0) if (sx, sy) == (2, 2) else (100 * sy + sx, 255)
    assert got == want
    masked = rasters.warp(px, df.where("sheet <> 't'"), "sheet", ring="ring").collect()
    assert {(p.sheet, p.y, p.x) for p in masked} == {("m", y, x) for y in range(3) for x in range(4)}


def peak(image, template, places=None, floor=0.04):
    th, tw = template.shape
    t = template - template.mean()
    norm = math.sqrt((t * t).sum())
    best = None
    for oy in range(image.shape[0] - th + 1):
        for ox in range(image.shape[1] - tw + 1):
            if places and not (places[0] <= ox <= places[1] and places[2] <= oy <= places[3]):
                continue
            w = image[oy : oy + th, ox : ox + tw]
            var = max((w * w).sum() - w.sum() ** 2 / (th * tw), floor * norm * norm)
            score = (w * t).sum() / (math.sqrt(var) * norm)
            if best is None or score > best[2] + 1e-12:
                best = (ox, oy, score)
    return best


def pixels(spark, images, key):
    return spark.createDataFrame([(k, y, x, float(v)) for k, a in images.items() for (y, x), v in np.ndenumerate(a)], f"{key} string, y int, x int, v double")


def test_correlation_peaks(spark):
    rng = np.random.default_rng(3)
    images = {"a": rng.integers(0, 50, (9, 12)).astype(float), "b": rng.integers(0, 50, (7, 7)).astype(float), "tiny": np.ones((2, 2))}
    templates = {"t": images["a"][3:6, 5:9] * 2 + 7, "flat": np.full((2, 3), 4.0), "u": rng.integers(0, 50, (3, 3)).astype(float)}
    asked = [("1", "a", "t", None, None, None, None), ("2", "b", "t", None, None, None, None), ("3", "a", "u", 2, 4, 1, 30), ("4", "a", "flat", None, None, None, None), ("5", "tiny", "t", None, None, None, None), ("6", "a", "u", 5, 4, 0, 1), ("7", "b", "u", -3, 2, None, 1)]
    df = spark.createDataFrame(asked, "k string, image string, template string, x0 int, x1 int, y0 int, y1 int")
    got = {r.k: (r.x, r.y, r.score) for r in rasters.correlation_peaks(df, rasters.image_rows(pixels(spark, images, "image"), "image"), rasters.image_rows(pixels(spark, templates, "template"), "template"), "k").collect()}
    want = {"1": peak(images["a"], templates["t"]), "2": peak(images["b"], templates["t"]), "3": peak(images["a"], templates["u"], (2, 4, 1, 30)), "7": peak(images["b"], templates["u"], (0, 2, 0, 1))}
    assert set(got) == set(want) and got["1"][:2] == (5, 3) and abs(got["1"][2] - 1) < 1e-9
    for k, w in want.items():
        assert got[k][:2] == w[:2] and math.isclose(got[k][2], w[2], abs_tol=1e-9), k


def test_two_step_peaks(spark):
    """A smooth image's piece is found where it was cut, by way of the smaller images."""
    y, x = np.mgrid[0:48, 0:64]
    image = 50 * np.sin(x / 7.0) + 40 * np.cos(y / 5.0) + 30 * np.sin((x + 2 * y) / 11.0)
    piece = image[13:29, 22:46]
    got = rasters.two_step_peaks(spark.createDataFrame([("s", "i", "t")], "k string, image string, template string"), pixels(spark, {"i": image}, "image"), pixels(spark, {"t": piece}, "template"), "k", by=4, pad=5).collect()
    assert [(r.x, r.y) for r in got] == [(22, 13)] and got[0].score > 0.999


def turned(a, degrees):
    """The turned image, pixel by pixel."""
    h, w = a.shape
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    big_w, big_h = int(abs(w * c) + abs(h * s)) + 2, int(abs(w * s) + abs(h * c)) + 2
    out = np.full((big_h, big_w), a.mean())
    for y in range(big_h):
        for x in range(big_w):
            fx, fy = c * (x - big_w / 2) + s * (y - big_h / 2) + w / 2, -s * (x - big_w / 2) + c * (y - big_h / 2) + h / 2
            if 0 <= fx <= w - 1 and 0 <= fy <= h - 1:
                out[y, x] = a[round(fy), round(fx)]
    return out


def test_rotation(spark):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 90, (9, 13)).astype(float)
    got = {}
    for p in rasters.rotated(pixels(spark, {"i": a}, "image"), spark.createDataFrame([("q", "i", 0.0), ("r", "i", 30.0), ("s", "i", -7.5)], "turn string, image string, degrees double")).collect():
        got.setdefault(p.turn, {})[p.y, p.x] = p.v
    for t, d in (("q", 0.0), ("r", 30.0), ("s", -7.5)):
        want = turned(a, d)
        assert set(got[t]) == set(np.ndindex(want.shape)) and all(math.isclose(got[t][at], want[at]) for at in got[t]), t


def test_rotation_search(spark):
    """A piece of an image that was turned by a known angle is found at that angle, round by round; what `rotated` moves, `turn_forward` finds."""
    a = np.kron(np.random.default_rng(5).integers(0, 90, (6, 8)), np.ones((4, 4)))
    t = turned(a, 13.0)
    piece = t[9:23, 10:26]
    rounds = []

    def write(df):
        rounds.append(df.collect())
        return df.sparkSession.createDataFrame(rounds[-1], df.schema)

    pairs = spark.createDataFrame([("p", "i", "t"), ("none", "i", "flat")], "pair string, image string, template string")
    got = rasters.rotation_search(pairs, pixels(spark, {"i": a}, "image"), pixels(spark, {"t": piece, "flat": np.ones((3, 3))}, "template"), write, steps=((18.0, 6.0), (3.0, 1.0))).collect()
    assert len(rounds) == 2 and [(r.pair, r.degrees, r.x, r.y) for r in got] == [("p", 13.0, 10, 9)] and got[0].score > 0.999
    at = spark.range(1).select(rasters.turn_forward(F.lit(16.0), F.lit(12.0), F.lit(12.0), F.lit(32.0), F.lit(24.0)).alias("p")).first().p
    assert (at.x, at.y) == (t.shape[1] / 2, t.shape[0] / 2)


def test_pair_similarity(spark):
    rng = np.random.default_rng(8)
    side = 4
    a, b = rng.random((side, side)), rng.random((side, side))
    thumbs = {"a": a, "b": b, "a90": np.rot90(a, 1), "a180": np.rot90(a, 2) * 3 + 1, "flat": np.ones((side, side))}
    rows = [(k, v.ravel().tolist()) for k, v in thumbs.items()] + [("short", [1.0]), ("nan", [float("nan")] * 16), ("null", None), ("hole", [None] + [1.0] * 15)]
    claims = [("1", "a", ["b", "a90"]), ("2", "a", ["a180", "a90"]), ("3", "a", ["missing", "nan", "short", "hole", "null"]), ("4", "gone", ["a"]), ("5", "a", []), ("6", "b", ["a"]), ("7", "a", ["a"]), ("8", "flat", ["a"]), ("9", "a", None)]
    done = spark.createDataFrame([("7",)], "rid string")
    got = rasters.pair_similarity(spark.createDataFrame(claims, "rid string, cand string, alts array<string>"), spark.createDataFrame(rows, "path string, vs array<double>"), done, side=side)
    got = {r.rid: (round(r.similarity, 6), r.best_alt) for r in got.collect()}

    def ncc(x, y):
        x, y = x - x.mean(), y - y.mean()
        d = math.sqrt((x * x).sum() * (y * y).sum())
        return (x * y).sum() / d if d else 0.0

    assert got == {"1": (1.0, 1), "2": (1.0, got["2"][1]), "3": (-1.0, 0), "4": (-1.0, 0), "6": (round(max(ncc(np.rot90(b, k), a) for k in range(4)), 6), 0), "8": (0.0, 0)}
