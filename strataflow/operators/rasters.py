"""Images as tables: mosaics, affine warps, palettes, correlation peaks, rotation search and similarity, as joins and aggregates.

A pixel table has a row for each pixel (image, y, x and values); a row table one for each row of an image, with its values as an array. No task holds an image.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mosaic(pixels: DataFrame, group: str, layer: list[str], colour: list[str], alpha: str = "a", window: str | None = None) -> DataFrame:
    """J10. (group, y, x, colour...): of each pixel of a group the colour of its last opaque layer, by the columns of `layer` (nulls first).

    window: a struct column (x0, y0, x1, y1) that clips its group (ends are outside; null: all). Opaque is an alpha above 0. The last layer is taken by a partial aggregate, so a
    group or a tile with most of the pixels is reduced where it is read.
    """
    inside = F.lit(True)
    if window:
        w = F.col(window)
        inside = w.isNull() | ((F.col("x") >= w["x0"]) & (F.col("x") < w["x1"]) & (F.col("y") >= w["y0"]) & (F.col("y") < w["y1"]))
    seen = pixels.where((F.col(alpha) > 0) & inside)
    top = F.max_by(F.struct(*colour), F.struct(*layer)).alias("_c")
    return seen.groupBy(group, "y", "x").agg(top).select(group, "y", "x", "_c.*")


def empty_groups(pixels: DataFrame, made: DataFrame, group: str) -> DataFrame:
    """J10. (group, layers): groups that a mosaic has no pixel of, which is an error, and how many layers they had."""
    return pixels.groupBy(group).agg(F.countDistinct("layer").alias("layers")).join(made.select(group).distinct(), group, "left_anti")


def apply_palette(pixels: DataFrame, palettes: DataFrame, key: str, index: str = "v") -> DataFrame:
    """J11. pixels with r, g, b, a of their index in their image's palette (key, index, r, g, b, a); an index that the palette lacks is transparent black."""
    out = pixels.join(palettes, [key, index], "left")
    return out.select(*pixels.columns, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("r", "g", "b", "a")])


def warp(pixels: DataFrame, fits: DataFrame, key: str, value: str = "v", ring: str | None = None) -> DataFrame:
    """J9. (key, y, x, value, alpha): each sheet on its target grid, by nearest sampling through the inverse of its affine fit.

    fits: key, a to f (u = a x + b y + c, v = d x + e y + f from source pixels to target cells), width, height (of the source, in pixels) and, if named, ring (array<struct<lon, lat>> in target
    cells): cells whose centre is outside it are left out (even-odd). The target cells are those of the box of the source's corners; row by row, each is put back into the source, and met there by an
    equi-join on (key, y, x), whose keys are as many as pixels, so a large sheet is spread over tasks. alpha is 0 where the source pixel is null. Fits without an inverse give nothing.
    """
    good = fits.withColumn("_det", F.expr("a * e - b * d")).where("abs(_det) > 1e-12")
    corners = [F.array(*[F.expr(f"{p} * {x} + {q} * {y} + {r}") for x in ("0", "width") for y in ("0", "height")]) for p, q, r in (("a", "b", "c"), ("d", "e", "f"))]
    span = [c.alias(n) for c, n in zip(corners, ("_u", "_v"), strict=True)]
    box = good.select(key, "a", "b", "c", "d", "e", "f", "_det", "width", "height", *([F.col(ring).alias("_ring")] if ring else []), *span)
    low, high = (lambda c: F.floor(F.array_min(c)).cast("int")), (lambda c: (F.ceil(F.array_max(c)) - 1).cast("int"))
    rows = box.withColumn("y", F.explode(F.sequence(low("_v"), F.greatest(high("_v"), low("_v")))))
    if ring:
        rows = rows.withColumn("_at", _crossings(F.col("_ring"), F.col("y") + 0.5)).where(F.size("_at") > 0)
    cells = rows.select(key, "a", "b", "c", "d", "e", "f", "_det", "width", "height", "y", *(["_at"] if ring else []), F.explode(F.sequence(low("_u"), F.greatest(high("_u"), low("_u")))).alias("x"))
    if ring:
        cells = cells.where(F.size(F.filter("_at", lambda c: c > F.col("x") + 0.5)) % 2 == 1)
    u, v = "(x + 0.5 - c)", "(y + 0.5 - f)"
    cells = cells.withColumn("sx", F.expr(f"cast(floor((e * {u} - b * {v}) / _det) as int)")).withColumn("sy", F.expr(f"cast(floor((a * {v} - d * {u}) / _det) as int)"))
    cells = cells.where("sx >= 0 and sy >= 0 and sx < width and sy < height").select(key, "y", "x", "sy", "sx")
    source = pixels.select(key, F.col("y").alias("sy"), F.col("x").alias("sx"), F.col(value).alias(value))
    met = cells.join(source, [key, "sy", "sx"], "left")
    return met.select(key, "y", "x", value, F.when(F.col(value).isNull(), 0).otherwise(255).alias("alpha"))


def _crossings(ring: Column, y: Column) -> Column:
    """Where the line at y crosses a ring's edges."""
    edges = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    crossed = F.filter(edges, lambda e: (e["a"]["lat"] > y) != (e["b"]["lat"] > y))
    return F.transform(crossed, lambda e: e["a"]["lon"] + (y - e["a"]["lat"]) / (e["b"]["lat"] - e["a"]["lat"]) * (e["b"]["lon"] - e["a"]["lon"]))


def image_rows(pixels: DataFrame, *key: str, value: str = "v") -> DataFrame:
    """(key, y, vs): a row for each row of an image, whose pixels must be whole; vs holds them from left to right as doubles."""
    cells = F.sort_array(F.collect_list(F.struct("x", F.col(value).cast("double").alias("v"))))
    return pixels.groupBy(*key, "y").agg(F.transform(cells, lambda c: c["v"]).alias("vs"))


def decimated(pixels: DataFrame, by: int, *key: str, value: str = "v") -> DataFrame:
    """(key, y, x, value): means of whole squares of `by` pixels; what is left over at the right and lower edge goes."""
    at = lambda c: F.expr(f"cast({c} div {by} as int)")
    means = pixels.groupBy(*key, at("y").alias("_y"), at("x").alias("_x")).agg(F.avg(value).alias(value), F.count("*").alias("_n"))
    return means.where(F.col("_n") == by * by).select(*key, F.col("_y").alias("y"), F.col("_x").alias("x"), value)


def correlation_peaks(searches: DataFrame, images: DataFrame, templates: DataFrame, key: str, image: str = "image", template: str = "template", floor: float = 0.04) -> DataFrame:
    """J4. (key, x, y, score): where in an image the normalised cross-correlation with a template is greatest, the uppermost and then leftmost of several; score is that correlation.

    searches: key, image, template, and x0, x1, y0, y1, the places of the template's upper left corner that are tried (ends included; null: as far as it goes). images and templates: (image or
    template, y, vs) as `image_rows` gives them. A window's variance counts as `floor` of the template's sum of squares at least; templates without variance, and those larger than their image,
    have no peak.

    A template's row meets each image row in which it can lie; there one array expression gives, for each place along the row, the products' sum and, from running sums, the window's sum
    and sum of squares. A partial aggregate adds the rows of a window up. So what moves is a row for each pair of rows and place, and a window's variance costs two look-ups a row.
    """
    n_of = templates.groupBy(template).agg(F.count("*").alias("th"), F.max(F.size("vs")).alias("tw"), F.sum(F.aggregate("vs", F.lit(0.0), lambda a, v: a + v)).alias("ts"), F.sum(F.aggregate("vs", F.lit(0.0), lambda a, v: a + v * v)).alias("tq"))
    size_of = images.groupBy(image).agg(F.count("*").alias("ih"), F.max(F.size("vs")).alias("iw"))
    asked = searches.join(n_of, template).join(size_of, image).where("th <= ih and tw <= iw")
    asked = asked.withColumn("norm", F.expr("sqrt(tq - ts * ts / (th * tw))")).where("norm >= 1e-6")
    bound = lambda c, low, most: F.least(F.greatest(F.coalesce(F.col(c), F.lit(low) if low is not None else F.expr(most)), F.lit(0)), F.expr(most)).cast("int")
    asked = asked.select(key, image, template, "th", "tw", "norm", bound("x0", 0, "iw - tw").alias("x0"), bound("x1", None, "iw - tw").alias("x1"), bound("y0", 0, "ih - th").alias("y0"), bound("y1", None, "ih - th").alias("y1")).where("x0 <= x1 and y0 <= y1")
    means = n_of.select(template, F.expr("ts / (th * tw)").alias("mean"))
    centred = templates.join(means, template).select(template, F.col("y").alias("ty"), F.transform("vs", lambda v: v - F.col("mean")).alias("t"))
    rows = asked.join(centred, template)
    rows = rows.select("*", F.explode(F.sequence("y0", "y1")).alias("oy")).withColumn("y", F.col("oy") + F.col("ty"))
    met = rows.join(images.select(image, "y", "vs"), [image, "y"])
    # only the stretch of the row that is looked at: x0 to x1, and the template's width
    met = met.withColumn("vs", F.expr("slice(vs, x0 + 1, x1 - x0 + tw)"))
    run = lambda f: F.aggregate("vs", F.array(F.lit(0.0)), lambda a, v: F.concat(a, F.array(F.element_at(a, -1) + f(v))))
    met = met.withColumn("s", run(lambda v: v)).withColumn("q", run(lambda v: v * v))
    product = lambda i: F.aggregate(F.zip_with(F.slice("vs", i + 1, F.col("tw")), "t", lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
    window = lambda c, i: F.get(c, i + F.col("tw")) - F.get(c, i)
    places = F.transform(F.sequence(F.lit(0), F.expr("x1 - x0")), lambda i: F.struct((i + F.col("x0")).alias("ox"), product(i).alias("p"), window("s", i).alias("s"), window("q", i).alias("q")))
    each = met.select(key, "oy", "th", "tw", "norm", F.explode(places).alias("w")).groupBy(key, "oy", F.col("w.ox").alias("ox")).agg(
        F.sum("w.p").alias("p"), F.sum("w.s").alias("s"), F.sum("w.q").alias("q"), F.first("norm").alias("norm"), F.first(F.expr("th * tw")).alias("n"),
    )
    score = F.expr(f"p / (sqrt(greatest(q - s * s / n, {floor} * norm * norm)) * norm)")
    best = F.max(F.struct(score.alias("score"), (-F.col("oy")).alias("oy"), (-F.col("ox")).alias("ox"))).alias("b")
    return each.groupBy(key).agg(best).select(key, (-F.col("b.ox")).alias("x"), (-F.col("b.oy")).alias("y"), F.col("b.score").alias("score"))


def two_step_peaks(searches: DataFrame, images: DataFrame, templates: DataFrame, key: str, by: int = 8, pad: int = 160, coarse: float = 0.15, fine: float = 0.2) -> DataFrame:
    """J4. (key, x, y, score) of searches (key, image, template) over pixel tables images (image, y, x, v) and templates (template, y, x, v): a peak in both, made `by` times smaller, then one in full within
    `pad` pixels of where the first says. Peaks under `coarse` and `fine` are none.

    The coarse pass leaves (2 pad + 1) squared places of each search for the fine one.
    """
    small = [image_rows(decimated(t, by, k), k) for t, k in ((images, "image"), (templates, "template"))]
    none = [F.lit(None).cast("int").alias(c) for c in ("x0", "x1", "y0", "y1")]
    seeds = correlation_peaks(searches.select(key, "image", "template", *none), *small, key).where(F.col("score") >= coarse)
    near = [(F.col(c) * by + d * pad).cast("int").alias(f"{c}{k}") for c in ("x", "y") for k, d in ((0, -1), (1, 1))]
    again = searches.select(key, "image", "template").join(seeds.select(key, *near), key)
    return correlation_peaks(again, image_rows(images, "image"), image_rows(templates, "template"), key).where(F.col("score") >= fine)


def rotated(pixels: DataFrame, turns: DataFrame, value: str = "v", image: str = "image") -> DataFrame:
    """J6. (turn, image, y, x, value): each turn (turn, image, degrees) of an image about its centre, nearest pixel, on a grid that holds all of it; outside the image its mean."""
    sizes = pixels.groupBy(image).agg((F.max("x") + 1).alias("w"), (F.max("y") + 1).alias("h"), F.avg(value).alias("mean"))
    t = turns.join(sizes, image).withColumn("c", F.cos(F.radians("degrees"))).withColumn("s", F.sin(F.radians("degrees")))
    t = t.withColumn("wide", F.expr("cast(abs(w * c) + abs(h * s) as int) + 2")).withColumn("high", F.expr("cast(abs(w * s) + abs(h * c) as int) + 2"))
    cells = t.select("*", F.explode(F.expr("sequence(0, high - 1)")).alias("y")).select("*", F.explode(F.expr("sequence(0, wide - 1)")).alias("x"))
    cells = cells.withColumn("fx", F.expr("c * (x - wide / 2) + s * (y - high / 2) + w / 2")).withColumn("fy", F.expr("-s * (x - wide / 2) + c * (y - high / 2) + h / 2"))
    near = cells.select("turn", image, "y", "x", "mean", F.expr("if(fx < 0 or fx > w - 1 or fy < 0 or fy > h - 1, null, cast(rint(fx) as int))").alias("sx"), F.expr("cast(rint(fy) as int)").alias("sy"))
    source = pixels.select(image, F.col("x").alias("sx"), F.col("y").alias("sy"), F.col(value).cast("double").alias("_v"))
    met = near.join(source, [image, "sx", "sy"], "left")
    return met.select("turn", image, "y", "x", F.coalesce("_v", "mean").alias(value))


def rotation_search(pairs: DataFrame, images: DataFrame, templates: DataFrame, write, steps: tuple = ((45.0, 2.5), (2.0, 0.5)), least: float = 0.2) -> DataFrame:
    """J6. (pair, degrees, x, y, score): by how much the image of a pair (pair, image, template) must be turned for its template to correlate best, and where in the turned image it then lies.

    steps: how far to either side of the best so far, and by what step; the first round starts at 0. Each round is one plan over all pairs and angles, of which only the best of each pair (the smallest angle of
    several) is kept and handed to `write` (which cuts the lineage, e.g. by writing a table); pairs that stay under `least` in the first round go.
    """
    best, held = None, image_rows(templates, "template")
    for reach, step in steps:
        angles = F.transform(F.sequence(F.lit(0), F.lit(round(2 * reach / step))), lambda i: i * step - reach)
        tried = (pairs.withColumn("_d", F.lit(0.0)) if best is None else pairs.join(best.select("pair", F.col("degrees").alias("_d")), "pair")).select("pair", "image", "template", F.posexplode(F.transform(angles, lambda a: a + F.col("_d"))).alias("k", "degrees"))
        tried = tried.withColumn("turn", F.concat_ws("|", F.col("pair").cast("string"), "k"))
        turned = rotated(images, tried.select("turn", "image", "degrees"))
        searches = tried.select("turn", F.col("turn").alias("image"), "template", *[F.lit(None).cast("int").alias(c) for c in ("x0", "x1", "y0", "y1")])
        found = correlation_peaks(searches, image_rows(turned.drop("image").withColumnRenamed("turn", "image"), "image"), held, "turn").join(tried.select("turn", "pair", "degrees"), "turn")
        found = found.select("pair", "degrees", "x", "y", "score")
        found = found.unionByName(best) if best is not None else found.where(F.col("score") >= least)
        pick = F.max_by(F.struct("degrees", "x", "y", "score"), F.struct(F.col("score"), -F.col("degrees"))).alias("b")
        best = write(found.groupBy("pair").agg(pick).select("pair", "b.*"))
    return best


def _turns(v: Column, n: int) -> Column:
    """array<array<double>>: a square of n by n values, row by row, and its three turns by 90 degrees anticlockwise."""
    at = lambda f: F.transform(F.sequence(F.lit(0), F.lit(n * n - 1)), lambda i: F.get(v, f(F.floor(i / n).cast("int"), i % n)))
    return F.array(v, at(lambda y, x: x * n + (n - 1 - y)), at(lambda y, x: (n - 1 - y) * n + (n - 1 - x)), at(lambda y, x: (n - 1 - x) * n + y))


def _let(value: Column, f) -> Column:
    """f of value, which is worked out once, also where f uses it for each element of an array."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _unit(v: Column) -> Column:
    """A vector less its mean, at length 1; zeros if it is constant."""
    apart = _let(F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v), lambda mean: F.transform(v, lambda x: x - mean))
    length = lambda w: F.sqrt(F.aggregate(w, F.lit(0.0), lambda a, x: a + x * x))
    scaled = lambda w: _let(length(w), lambda n: F.transform(w, lambda x: F.when(n > 0, x / n).otherwise(0.0)))
    return _let(apart, scaled)


def pair_similarity(claims: DataFrame, thumbs: DataFrame, scored: DataFrame, key: str = "rid", path: str = "path", side: int = 256) -> DataFrame:
    """J5. (key, similarity, best_alt) of claims (key, cand, alts: array of paths) that `scored` (key) lacks and that have alternates: the greatest correlation of the candidate's thumb, in any of four turns, with
    an alternate's, and the place of that alternate (the first of several).

    thumbs: (path, vs), side * side grey values row by row. An alternate without a usable thumb is passed over; a claim whose candidate has none, or that no alternate is left of, is -1 with 0.
    Alternates are exploded and met by equi-joins; turns and products are array expressions. Append what comes back to `scored`, batch by batch: a run that breaks off goes on where it stopped.
    """
    usable = thumbs.where((F.size("vs") == side * side) & ~F.exists("vs", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))).select(path, F.transform("vs", lambda x: x.cast("double")).alias("vs"))
    todo = claims.where(F.size("alts") > 0).join(scored.select(key), key, "left_anti").select(key, "cand", "alts")
    own = todo.select(key, F.col("cand").alias(path), F.posexplode("alts").alias("alt", "other"))
    cand = usable.select(path, _unit(F.col("vs")).alias("cand_v"))
    alts = usable.select(F.col(path).alias("other"), _unit(F.col("vs")).alias("alt_v"))
    met = own.join(cand, path).join(alts, "other")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    score = F.array_max(F.transform(_turns(F.col("cand_v"), side), lambda v: dot(v, F.col("alt_v"))))
    best = met.select(key, "alt", score.alias("s")).groupBy(key).agg(F.max(F.struct("s", (-F.col("alt")).alias("a"))).alias("b"))
    return todo.select(key).join(best, key, "left").select(key, F.coalesce("b.s", F.lit(-1.0)).alias("similarity"), F.coalesce(-F.col("b.a"), F.lit(0)).alias("best_alt"))


def turn_forward(x: Column, y: Column, degrees: Column, w: Column, h: Column) -> Column:
    """J6. struct<x, y>: where a pixel of an image of w by h lies in the image that `rotated` makes."""
    a = degrees * (math.pi / 180)
    c, s = F.cos(a), F.sin(a)
    big_w, big_h = (F.abs(w * c) + F.abs(h * s)).cast("int") + 2, (F.abs(w * s) + F.abs(h * c)).cast("int") + 2
    x0, y0 = x - w / 2, y - h / 2
    return F.struct((c * x0 - s * y0 + big_w / 2).alias("x"), (s * x0 + c * y0 + big_h / 2).alias("y"))
