"""Placing a sheet by matched points: consensus fits by joins, corner coordinates, footprint checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.expr import col
from strataflow.functions.geo import lcc_forward, lcc_inverse
from strataflow.operators.logs import AFFINE_MAP, CENTRED_SUMS, MEANS, SIMILARITY_MAP, SIMILARITY_SUMS, with_affine, with_similarity


def sample_windows(sheets: DataFrame, key: str, fractions_x: list[float], fractions_y: list[float], size: int, width: str = "width", height: str = "height") -> DataFrame:
    """J3. (key, window, x, y): upper left corners of square windows of `size`, centred at the given fractions of a sheet and moved inside it; sheets smaller than a window have none.

    Windows are numbered row by row.
    """
    at = [(fx, fy) for fy in fractions_y for fx in fractions_x]
    spots = F.array(*[F.struct(F.lit(i).alias("window"), F.lit(x).alias("fx"), F.lit(y).alias("fy")) for i, (x, y) in enumerate(at)])
    held = lambda c, f: F.least(F.greatest(F.col(c) * F.col(f) - size / 2, F.lit(0.0)), F.col(c) - F.lit(float(size))).cast("int")
    fits = (F.col(width) >= size) & (F.col(height) >= size)
    return sheets.where(fits).select(key, width, height, F.explode(spots).alias("_s")).select(key, width, height, "_s.*").select(key, "window", held(width, "fx").alias("x"), held(height, "fy").alias("y"))


_POINT = ["x", "y", "u", "v"]


def _good(matches: DataFrame, by: tuple, order: str) -> DataFrame:
    known = F.lit(True)
    for c in (*by, *_POINT, order):
        known &= F.col(c).isNotNull()
    return matches.where(known).select(*by, F.col(order).alias("k"), *_POINT)


def _named(points: DataFrame, by: tuple, suffix: str) -> DataFrame:
    return points.select(*by, *[F.col(c).alias(c + suffix) for c in ("k", *_POINT)])


def _most_agreed(hypotheses: DataFrame, points: DataFrame, by: tuple, order: list[str], off: Column, within: float) -> DataFrame:
    """For each group the first hypothesis (by `order`) with most points within `within`."""
    model = [c for c in hypotheses.columns if c not in (*by, *order)]
    votes = hypotheses.join(points, list(by)).groupBy(*by, *order).agg(F.count_if(off < within).alias("votes"), *[F.first(c).alias(c) for c in model])
    # most votes, then the first: orders are compared downwards
    best = votes.groupBy(*by).agg(F.max_by(F.struct(*model), F.struct(F.col("votes"), *[-F.col(c) for c in order])).alias("b"))
    return best.select(*by, "b.*")


def _off(u: str, v: str) -> Column:
    return F.sqrt(F.pow(F.expr(f"u - ({u})"), 2) + F.pow(F.expr(f"v - ({v})"), 2))


def _told(points: DataFrame, by: tuple, best: DataFrame, off: Column, within: float, sums: list[dict], fitted, fit_map: tuple, names: list[str], least: int) -> DataFrame:
    """One row for each group of matches: its status, how many matches it has, how many agree with its best hypothesis, and the fit of these if they are enough.

    sums: what is added up (n: counted, m: averaged) over the matches that agree, one window after the other; fitted adds the fit's columns to them. Windows keep the matches beside their
    group's sums, so the search for hypotheses, which costs most, has one reader: with a join for each count, sum and residual it would run for each of these.
    """
    group = Window.partitionBy(*by)
    held = points.join(best, list(by), "left").withColumn("_in", F.coalesce(off < within, F.lit(False)))
    held = held.withColumns({"matches": F.count("*").over(group), "inliers": F.count_if("_in").over(group)})
    for some in sums:
        held = held.withColumns({n: (F.avg if n in MEANS else F.sum)(F.when(F.col("_in"), F.expr(e))).over(group) for n, e in some.items()})
    held = fitted(held).withColumn("_off", F.when(F.col("_in"), _off(*fit_map)))
    out = held.groupBy(*by).agg(*[F.first(c).alias(c) for c in ("matches", "inliers", *names)], F.max("_off").alias("max_residual"))
    status = F.when(F.col("matches") < least, "too few matches").when(F.col("inliers") < least, "no consensus").otherwise("ok")
    out = out.withColumn("status", status)
    return out.select(*by, "status", "matches", "inliers", *[F.when(F.col("status") == "ok", F.col(c)).alias(c) for c in [*names, "max_residual"]])


def similarity_consensus(matches: DataFrame, *by: str, order: str = "k", apart: float = 500.0, scales: tuple[float, float] = (0.93, 1.07), within: float = 4.0, least: int = 4) -> DataFrame:
    """D14. (by, status, matches, inliers, scale, tx, ty, max_residual) of u = scale x + tx, v = scale y + ty for each group of matches (x, y) -> (u, v).

    Every two matches whose sources are `apart` or more from each other, and whose scale lies in `scales`, are a hypothesis through the first of them (by `order`, a number that tells a group's
    matches apart); the one that most matches agree with, to less than `within`, wins, the first of several. The fit is then that of these matches alone, by least squares (D13).
    status: ok, `too few matches` (fewer than `least`) or `no consensus` (fewer agree). Matches with a null take no part.

    Hypotheses are a self-join inside a group, cut by distance and scale before they meet the points again, and only counted there (partial aggregation), so no group is gathered in a task. A group has as many
    matches as windows were sampled (J3), a few dozen; hypotheses grow with the square of that.
    """
    points = _good(matches, by, order)
    both = _named(points, by, "1").join(_named(points, by, "2"), list(by)).where("k1 < k2")
    span = F.sqrt(F.pow(F.expr("x2 - x1"), 2) + F.pow(F.expr("y2 - y1"), 2))
    both = both.withColumn("span", span).where(F.col("span") >= apart).withColumn("s", F.sqrt(F.pow(F.expr("u2 - u1"), 2) + F.pow(F.expr("v2 - v1"), 2)) / F.col("span"))
    hypotheses = both.where(F.col("s").between(*scales)).select(*by, "k1", "k2", "s", F.expr("u1 - s * x1").alias("sx"), F.expr("v1 - s * y1").alias("sy"))
    hypotheses = hypotheses.select(*by, "k1", "k2", *[F.col(c).alias(f"h{c}") for c in ("s", "sx", "sy")])
    off = _off("hs * x + hsx", "hs * y + hsy")
    best = _most_agreed(hypotheses, points, by, ["k1", "k2"], off, within)
    return _told(points, by, best, off, within, [SIMILARITY_SUMS], with_similarity, SIMILARITY_MAP, ["scale", "tx", "ty"], least)


def affine_consensus(matches: DataFrame, *by: str, order: str = "k", area: float = 1e5, within: float = 12.0, least: int = 4) -> DataFrame:
    """D14. As `similarity_consensus` for u = a x + b y + c, v = d x + e y + f; a hypothesis is three matches that span a parallelogram of `area` or more.

    Triples that lie too close are cut while they are joined, so nearly collinear ones never meet the points.
    """
    points = _good(matches, by, order)
    two = _named(points, by, "1").join(_named(points, by, "2"), list(by)).where("k1 < k2 and (x1 <> x2 or y1 <> y2)")
    three = two.join(_named(points, by, "3"), list(by)).where("k2 < k3")
    three = three.withColumn("det", F.expr("(x2 - x1) * (y3 - y1) - (x3 - x1) * (y2 - y1)")).where(F.abs("det") >= area)
    for p, q, r, w in (("ha", "hb", "hc", "u"), ("hd", "he", "hf", "v")):
        three = three.withColumn(p, F.expr(f"(({w}2 - {w}1) * (y3 - y1) - ({w}3 - {w}1) * (y2 - y1)) / det")).withColumn(q, F.expr(f"(({w}3 - {w}1) * (x2 - x1) - ({w}2 - {w}1) * (x3 - x1)) / det"))
        three = three.withColumn(r, F.expr(f"{w}1 - {p} * x1 - {q} * y1"))
    hypotheses = three.select(*by, "k1", "k2", "k3", "ha", "hb", "hc", "hd", "he", "hf")
    off = _off("ha * x + hb * y + hc", "hd * x + he * y + hf")
    best = _most_agreed(hypotheses, points, by, ["k1", "k2", "k3"], off, within)
    return _told(points, by, best, off, within, [MEANS, CENTRED_SUMS], with_affine, AFFINE_MAP, list("abcdef"), least)


def corner_points(fits: DataFrame, width: str = "width", height: str = "height", cone: tuple = ("lat1", "lat2", "lat0", "lon0"), geo: tuple = ("x0", "dx", "y0", "dy")) -> DataFrame:
    """J7. fits (with scale, tx, ty from a donor's pixels to the sheet's) with corners: array<struct<px, py, lat, lon>> of the sheet's four corners, clockwise from the upper left.

    geo: columns of the donor's left edge, pixel width, upper edge and (negative) pixel height in metres; cone: those of its projection. Degrees are rounded to 7 places. Null without a fit.
    """

    def corner(px: Column, py: Column) -> Column:
        x = F.col(geo[0]) + (px - F.col("tx")) / F.col("scale") * F.col(geo[1])
        y = F.col(geo[2]) + (py - F.col("ty")) / F.col("scale") * F.col(geo[3])
        at = lcc_inverse(x, y, *cone)
        return F.struct(px.alias("px"), py.alias("py"), F.round(at["lat"], 7).alias("lat"), F.round(at["lon"], 7).alias("lon"))

    w, h, zero = F.col(width).cast("double"), F.col(height).cast("double"), F.lit(0.0)
    corners = F.array(corner(zero, zero), corner(w, zero), corner(w, h), corner(zero, h))
    return fits.withColumn("corners", F.when(F.col("scale").isNotNull(), corners))


def footprint_check(fits: DataFrame, extent: str = "extent", width: str = "width", height: str = "height", cone: tuple = ("lat1", "lat2", "lat0", "lon0"), least_w: float = 0.5, least_h: float = 0.35) -> DataFrame:
    """J8. fits (with status and corners) with overlaps, and status `cutline-mismatch` where an ok one's cutline, an extent struct (west, south, east, north), covers too little of it.

    The extent's corners become pixels by the line between the sheet's first and third corner in its projection; more than least_w of the width and least_h of the height must be covered. A sheet
    without an extent, or that isn't ok, stays as it is (overlaps is null).
    """
    own = fits.columns
    m = lambda lon, lat: lcc_forward(lon, lat, *cone)
    g = lambda k: F.get("corners", F.lit(k))
    e = lambda k: F.col(f"{extent}.{k}")
    a, b = m(g(0)["lon"], g(0)["lat"]), m(g(2)["lon"], g(2)["lat"])
    spots = F.array(*[m(e(x), e(y)) for x in ("west", "east") for y in ("south", "north")])
    out = fits.withColumn("_a", a).withColumn("_b", b).withColumn("_s", spots)
    pixels = lambda axis, size: F.transform("_s", lambda s: (s[axis] - F.col(f"_a.{axis}")) / ((F.col(f"_b.{axis}") - F.col(f"_a.{axis}")) / F.col(size)))
    out = out.withColumn("_x", pixels("x", width)).withColumn("_y", pixels("y", height))
    inside = lambda p, size: F.least(F.array_max(p), F.col(size)) - F.greatest(F.array_min(p), F.lit(0.0))
    good = (inside("_x", width) > least_w * F.col(width)) & (inside("_y", height) > least_h * F.col(height))
    out = out.withColumn("overlaps", F.when((F.col("status") == "ok") & col(extent).isNotNull(), good))
    return out.select(*[F.when(~F.col("overlaps"), "cutline-mismatch").otherwise(F.col("status")).alias("status") if c == "status" else F.col(c) for c in own if c != "overlaps"], "overlaps")
