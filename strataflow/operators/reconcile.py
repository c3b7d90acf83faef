"""Catalogues against files, plans, logs and decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions import expr as X
from strataflow.sources.tables import kept


# The kinds of file that are images.
IMAGES = ["tif", "tiff", "pdf", "png", "jpg", "jpeg"]


def first_by(df: DataFrame, by: list[str], *order) -> DataFrame:
    """The first row of each group in the given order."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_k = 1").drop("_k")


# What stands before the file's own name in names of copies that were kept with their folders.
TAIL_MARKS = ["_content_aeronav_sectional_files_", "_sectional_files_", "/sectional_files/"]


def _bare(path: Column) -> Column:
    """A path without its last extension."""
    return F.regexp_replace(path, r"(?<=[^/.]\.{0,9})\.[^./]*$", "")


def lookup_keys(name: str, parent: bool = False) -> Column:
    """C1. The keys under which a file is looked for: path and basename, and what follows each of TAIL_MARKS in either (from its first place on), all with and without extension; lower case.

    parent: also the folder's name, under which what was unpacked from an archive is found by the archive's stem.
    """
    t = F.lower(F.translate(X.text(name), "\\", "/"))
    base = F.regexp_extract(t, r"([^/]*)$", 1)
    tails = [F.regexp_extract(x, rf"(?s)^.*?{mark}(.+)$", 1) for x in (t, base) for mark in TAIL_MARKS]
    keys = [t, base, *tails, *([F.regexp_extract(t, r"([^/]+)/[^/]*$", 1)] if parent else [])]
    return F.array_distinct(F.filter(F.array(*[y for k in keys for y in (k, _bare(k))]), lambda k: k != ""))


#: Letters of the pieces by which a text is looked for inside others.
GRAM = 5


def _pieces(c: str, n: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(F.col(c), i, n)))


def contained(needles: DataFrame, needle: str, hays: DataFrame, hay: str) -> DataFrame:
    """needles joined with each row of hays whose text (hay) holds theirs (needle, which no row of hays may have as a column). Empty texts are held by none.

    Texts are parted into pieces of GRAM letters (or as many as a shorter needle has) and met on them, but each needle only on that of its pieces which the fewest texts have; texts hand out only such pieces. So
    a piece that most texts and needles share, like `http:`, brings nobody together.
    """
    short = needles.select(needle).where(F.length(needle) > 0).distinct().withColumn("_n", F.least(F.length(needle), F.lit(GRAM)))
    sizes = short.select("_n").distinct()  # GRAM rows at most
    long = hays.select(F.col(hay).alias("_hay")).where("_hay is not null").distinct()
    parts = long.join(F.broadcast(sizes)).where(F.length("_hay") >= F.col("_n")).select("_hay", F.explode(_pieces("_hay", F.col("_n"))).alias("_gram"))
    counts = parts.groupBy("_gram").agg(F.count("*").alias("_k"))
    asked = short.select(needle, F.explode(_pieces(needle, F.col("_n"))).alias("_gram")).join(counts, "_gram")  # pieces that no text has lead nowhere
    rarest = asked.groupBy(needle).agg(F.min(F.struct("_k", "_gram")).alias("_r")).select(needle, "_r._gram")
    met = rarest.join(parts, "_gram").where(F.col("_hay").contains(F.col(needle))).select(needle, "_hay")
    return needles.join(met, needle).join(hays, F.col("_hay") == F.col(hay)).drop("_hay")


def resolve_files(rows: DataFrame, files: DataFrame, row_id: str, name: str, path: str = "path") -> DataFrame:
    """C1. rows with the best file: equal basename, equal stem, a path that holds the stem, kind of file, short path, path.

    Both sides are expanded to keys and joined on them. What is left without a match is found by a path that holds its stem (see `contained`).
    """
    names = rows.select(F.col(name).alias("name")).distinct()  # rows of one name find the same file
    listed = files.select(F.col(path).alias("path"), F.explode(lookup_keys(path, parent=True)).alias("key"))
    met = names.select("name", F.explode(lookup_keys("name")).alias("key")).join(listed, "key").select("name", "path")
    left = names.join(met.select("name").distinct(), "name", "left_anti").select("name", X.stem("name").alias("stem"))
    plain = F.lower(F.translate(X.text("path"), "\\", "/"))
    loose = contained(left, "stem", files.select(F.col(path).alias("path")).distinct().withColumn("plain", plain), "plain").select("name", "path")
    same_base = F.lower(X.basename("name")) == F.lower(X.basename("path"))
    holds = (X.stem("name") != "") & plain.contains(X.stem("name"))
    order = [~same_base, X.stem("name") != X.stem("path"), ~holds, X.extension_rank("path"), F.length("path"), F.col("path")]
    best = met.unionByName(loose).groupBy("name").agg(F.min(F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)])).alias("_b"))
    return rows.join(best.select(F.col("name").alias("_name"), F.col(f"_b._{len(order) - 1}").alias("path")), F.col(name) == F.col("_name"), "left").drop("_name")


def lookup_two_step(rows: DataFrame, files: DataFrame, name: str, path: str = "path") -> DataFrame:
    """C2. rows with the smallest path of equal basename, else of equal letters and digits."""
    exact = files.groupBy(X.basename(path).alias("k")).agg(F.min(path).alias("exact"))
    loose = files.groupBy(X.alnum(X.basename(path)).alias("k2")).agg(F.min(path).alias("loose"))
    out = rows.join(exact, X.basename(name) == F.col("k"), "left").join(loose, X.alnum(X.basename(name)) == F.col("k2"), "left")
    return out.withColumn("path", F.coalesce("exact", "loose")).drop("k", "k2", "exact", "loose")


def _every_candidate(rows: DataFrame, files: DataFrame, row_id: str, name: str) -> DataFrame:
    asked = rows.select(row_id, F.lower(X.basename(name)).alias("base"), X.stem(name).alias("stem"), X.extension(name).alias("ext"))
    own = asked.join(files.select("path", F.lower("base").alias("base")), "base").select(row_id, "path", F.lit(1).alias("priority"))
    zips = asked.where("ext = 'zip'").select(row_id, F.col("stem").alias("parent")).join(files.where("ext in ('tif', 'tiff')").select("path", "parent"), "parent").select(row_id, "path", F.lit(2).alias("priority"))
    pdfs = asked.where("ext in ('tif', 'tiff')").select(row_id, "stem").join(files.where("ext = 'pdf'").select("path", "stem"), "stem").select(row_id, "path", F.lit(3).alias("priority"))
    return own.unionByName(zips).unionByName(pdfs)


def file_candidates(rows: DataFrame, files: DataFrame, row_id: str, name: str) -> DataFrame:
    """C3. (row_id, path, priority): the file itself (1), a zip's unpacked tifs (2), a tif's pdf (3); the best priority that has any."""
    every = _every_candidate(rows, files, row_id, name)
    return every.withColumn("_b", F.min("priority").over(Window.partitionBy(row_id))).where("priority = _b").drop("_b")


def claimed_matches(claims: DataFrame, catalogue: DataFrame, files: DataFrame) -> DataFrame:
    """C4. (rid, matches): the files that each claim's method text finds, sorted. claims: rid, dup, how; catalogue: filename, location, date, edition; files: path, base, stem, parent, ext.

    Methods, with names compared by letters and digits: a name in a cycle's folder (images of that folder whose name holds it), a file name (by basename, else by its letters and
    digits), location and edition of catalogue rows whose file is in `sectional_files`, and location and date (if that leads to no file: rows whose location begins so). The file
    name of a catalogue row leads to that file; a zip's to the images unpacked from it, else to the zip itself. Claims that say `new` are left out, and so are those that find nothing.
    """
    # claims that say the same find the same: each different text is looked up once, and goes by itself instead of by its claims
    told = claims.where("dup is null or dup <> 'new'").groupBy("rid").agg(F.sort_array(F.collect_set("how")).alias("hows"))
    h, none = F.coalesce(F.col("how"), F.lit("")), F.lit("")
    part = lambda p, g=1: F.nullif(F.regexp_extract(h, p, g), none)
    cycle, edition, date = rf"^{X.BY_CYCLE} (\S+) has (.+)$", rf"^{X.BY_EDITION} (.+) ed (\S+)$", rf"^{X.BY_DATE} (.+) (\S+)$"
    a = told.select(F.col("hows").alias("rid"), F.explode("hows").alias("how")).distinct().select(
        "rid", part(cycle).alias("dir"), X.alnum(part(cycle, 2)).alias("want"), X.alnum(part(edition)).alias("place"), part(edition, 2).alias("ed"), X.alnum(part(date)).alias("place2"), part(date, 2).alias("day"),
        F.coalesce(F.when(~h.rlike(cycle), part(rf"^{X.BY_NAME} (.+)$")), part(rf"^{X.BY_BASENAME} (\S+) in {X.BY_NAME}")).alias("file"),
    )
    rows = catalogue.select("filename", X.alnum("location").alias("loc"), X.text("date").alias("date"), X.text("edition").alias("edition")).where(~X.blank("filename")).distinct()
    by_edition = a.join(rows.where(F.col("filename").contains("sectional_files")), (F.col("place") == F.col("loc")) & (F.col("ed") == F.col("edition"))).select("rid", "filename")
    dated = a.where("day is not null")
    by_date = dated.join(rows, (F.col("place2") == F.col("loc")) & (F.col("day") == F.col("date"))).select("rid", "filename")

    images = files.where(F.col("ext").isin(IMAGES))

    def lead_to(named: DataFrame) -> DataFrame:
        """(rid, path) of the files that catalogue names or claimed names (rid, filename) lead to."""
        is_zip = F.lower("filename").endswith(".zip")
        zips = named.where(is_zip).select("rid", F.lower("filename").alias("base"), F.expr("lower(left(filename, length(filename) - 4))").alias("folder"))
        unpacked = zips.join(images, F.col("folder") == F.lower("parent")).select("rid", zips["base"], "path")
        packed = zips.join(unpacked.select("rid", "base").distinct(), ["rid", "base"], "left_anti").join(files.where("ext = 'zip'").select("path", F.lower("base").alias("base")), "base").select("rid", "path")
        return unpacked.select("rid", "path").unionByName(packed).unionByName(by_name(named.where(~is_zip)))

    def by_name(wanted: DataFrame) -> DataFrame:
        exact = wanted.join(images, F.lower("filename") == F.lower("base")).select("rid", "filename", "path")
        loose = wanted.join(exact.select("rid", "filename").distinct(), ["rid", "filename"], "left_anti").join(images, X.alnum("filename") == X.alnum("base")).select("rid", "path")
        return exact.select("rid", "path").unionByName(loose)

    found = kept(lead_to(by_edition.unionByName(by_date).distinct()))  # read twice: what these find, and who still has nothing
    # dated claims without any file so far: met on the day and their location's first letters
    asked = dated.join(found.select("rid").distinct(), "rid", "left_anti").withColumn("first", F.expr("left(place2, 3)"))
    starts = rows.withColumn("first", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda n: F.substring(F.col("loc"), F.lit(1), n)))))
    by_start = asked.join(starts, (F.col("day") == F.col("date")) & (asked["first"] == starts["first"])).where(F.col("loc").startswith(F.col("place2"))).select("rid", "filename").distinct()
    in_cycle = a.where("dir is not null").join(images, F.col("dir") == F.col("parent")).where(X.alnum("base").contains(F.col("want"))).select("rid", "path")
    every = in_cycle.unionByName(found).unionByName(lead_to(by_start)).unionByName(by_name(a.where("file is not null").select("rid", F.col("file").alias("filename"))))
    return told.join(every.groupBy(F.col("rid").alias("hows")).agg(F.sort_array(F.collect_set("path")).alias("matches")), "hows").select("rid", "matches")


def import_rows(plan: DataFrame, catalogue: DataFrame, key: str = "filename") -> DataFrame:
    """C5. Rows of the plan marked yes whose key the catalogue lacks, in the catalogue's columns."""
    new = plan.where(F.lower(X.text("import")) == "yes").join(catalogue.select(key), key, "left_anti")
    return new.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in plan.columns else F.lit("").alias(c) for c in catalogue.columns])


def update_first(rows: DataFrame, results: DataFrame, key: str, line: str, columns: list[str], note: str = "note") -> DataFrame:
    """C6. Values of ok results in the first row of each key; what was done is added to its note."""
    ok = results.where("status = 'ok'").select(key, *[F.col(c).alias(f"_{c}") for c in columns], F.col("note").alias("_note"), F.lit(True).alias("_ok"))
    first = F.row_number().over(Window.partitionBy(key).orderBy(line)) == 1
    out = rows.withColumn("_first", first).join(ok, key, "left").withColumn("_do", F.coalesce("_ok", F.lit(False)) & F.col("_first"))
    for c in columns:
        out = out.withColumn(c, F.when(F.col("_do"), F.coalesce(f"_{c}", c)).otherwise(F.col(c)))
    joined = F.concat_ws("; ", F.nullif(F.col(note), F.lit("")), "_note")
    return out.withColumn(note, F.when(F.col("_do"), joined).otherwise(F.col(note))).select(rows.columns)


def skipped(rows: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """C6. Results that changed nothing, and why."""
    bad = results.where("status <> 'ok'").select(key, F.col("status").alias("reason"))
    return bad.unionByName(results.where("status = 'ok'").join(rows.select(key), key, "left_anti").select(key, F.lit("no such row").alias("reason")))


def replace_and_expand(rows: DataFrame, parts: DataFrame, key: str, line: str, columns: list[str]) -> DataFrame:
    """C7. Each row that has parts becomes one row for each (the first replaces it), in reading order; others stay. Rows never get fewer."""
    p = parts.select(key, F.col("part").alias("_part"), *[F.col(c).alias(f"_{c}") for c in columns])
    out = rows.join(p, key, "left")
    return out.select(*[F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in rows.columns], F.coalesce("_part", F.lit(0)).alias("part")).orderBy(line, "part")


def uploaded_keys(manifest: DataFrame, uploads: DataFrame) -> DataFrame:
    """C8. (location, d, e, key or keys) of manifest entries that are uploaded."""
    keys = manifest.join(uploads.select("key"), "key", "left_semi").groupBy("location", "d", "e").agg(F.sort_array(F.collect_set("key")).alias("all"))
    return keys.select("location", "d", "e", F.when(F.size("all") == 1, F.col("all")[0]).alias("key"), F.when(F.size("all") > 1, F.col("all")).alias("keys"))


def publish_plan(manifest: DataFrame, local: DataFrame, remote: DataFrame, uploads: DataFrame) -> DataFrame:
    """C9. (key, status) of manifest keys: missing_local without a local file, to_upload if the remote size isn't the local one, else in_sync, or preexisting if no upload of it was recorded."""
    out = manifest.select("key").join(local.select("key", F.col("size").alias("l")), "key", "left").join(remote.select("key", F.col("size").alias("r")), "key", "left")
    out = out.join(uploads.select("key", F.lit(True).alias("u")).distinct(), "key", "left")
    status = F.when(F.col("l").isNull(), "missing_local").when(F.col("r").isNull() | (F.col("l") != F.col("r")), "to_upload").when(F.col("u").isNull(), "preexisting").otherwise("in_sync")
    return out.select("key", status.alias("status"))


def key_diff(a: DataFrame, b: DataFrame, key: str, only_a: str = "new", only_b: str = "stale") -> DataFrame:
    """C10. Keys that only one side has."""
    both = a.select(key).distinct().withColumn("_a", F.lit(1)).join(b.select(key).distinct().withColumn("_b", F.lit(1)), key, "full_outer")
    return both.where("_a is null or _b is null").select(key, F.when(F.col("_b").isNull(), only_a).otherwise(only_b).alias("side"))


def disk_audit(files: DataFrame, rows: DataFrame, key: str, bucket: Column) -> DataFrame:
    """C11. (side, bucket, n): files no row names, and rows without a file."""
    loose = files.join(rows.select(key), key, "left_anti").select(F.lit("file").alias("side"), bucket.alias("bucket"))
    lost = rows.join(files.select(key), key, "left_anti").select(F.lit("row").alias("side"), F.lit("missing").alias("bucket"))
    return loose.unionByName(lost).groupBy("side", "bucket").agg(F.count("*").alias("n"))


def variant_lookup(rows: DataFrame, shapes: DataFrame, location: str, filename: str) -> DataFrame:
    """C12. rows with the shape of <location>_<half>, if the name has a half and that shape exists, else of the location."""
    named = rows.withColumn("_loc", X.slug(location)).withColumn("_key", F.concat_ws("_", "_loc", X.half(filename)))
    one = shapes.select(F.col("key").alias("_key"), F.col("shape").alias("_one"))
    two = shapes.select(F.col("key").alias("_loc"), F.col("shape").alias("_two"))
    return named.join(one, "_key", "left").join(two, "_loc", "left").withColumn("shape", F.coalesce("_one", "_two")).select(*rows.columns, "shape")


def same_location_year(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """C22. rows with `collides`: the catalogue has their location and year."""
    keys = catalogue.select("location", F.year("start").alias("_y")).distinct().withColumn("_hit", F.lit(True))
    return rows.withColumn("_y", F.year("start")).join(keys, ["location", "_y"], "left").withColumn("collides", F.coalesce("_hit", F.lit(False))).select(*rows.columns, "collides")


def completeness_grid(rows: DataFrame, date: str, location: str, status: str, order: str) -> DataFrame:
    """C23. Every date with every location, the status of the last row, else `missing`. The report is that product, of two distinct lists, neither of which is gathered: dates meet locations in pairs of
    buckets, 8 by 8."""
    last = rows.groupBy(date, location).agg(F.max_by(status, order).alias(status))
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(8))
    all_ = F.sequence(F.lit(0), F.lit(7)).cast("array<bigint>")
    dates = rows.select(date).distinct().select(date, bucket(date).alias("_a"), F.explode(all_).alias("_b"))
    places = rows.select(location).where(F.col(location).isNotNull()).distinct().select(location, bucket(location).alias("_b"), F.explode(all_).alias("_a"))
    grid = dates.join(places, ["_a", "_b"]).select(date, location)
    return grid.join(last, [date, location], "left").withColumn(status, F.coalesce(status, F.lit("missing")))


def largest_sibling(rows: DataFrame, location: str, cycle_rank: str, area: Column, key: str) -> DataFrame:
    """C25. Per location the row of the earliest cycle, then the largest, then by key."""
    return first_by(rows, [location], cycle_rank, F.desc(area), key)


def new_findings(found: DataFrame, known: DataFrame, url: str = "url") -> DataFrame:
    """C26. Findings none of whose keys (URL, URL inside a capture, flattened basename) is known."""
    keys = F.array_distinct(F.filter(F.array(X.text(url), F.regexp_extract(X.text(url), r"/web/\d{14}[a-z_]*/(.*)$", 1), F.lower(X.flattened_name(X.basename(url)))), lambda k: k != ""))
    seen = known.select(F.explode(keys).alias("k")).distinct()
    hit = found.select(url, F.explode(keys).alias("k")).join(seen, "k", "left_semi").select(url).distinct()
    return found.join(hit, url, "left_anti")


def missing_inputs(rows: DataFrame, files: DataFrame, row_id: str, name: str, link: str, date: str) -> DataFrame:
    """C27. Rows with name and link for which no file stands, newest first.

    Any file will do, so names are only met with the different keys of files, none of which brings its files along.
    """
    asked = rows.where(~X.blank(name) & ~X.blank(link)).withColumn("_base", F.lower(X.basename(name))).withColumn("_stem", X.stem(name)).withColumn("_ext", X.extension(name))
    tif = F.col("_ext").isin("tif", "tiff")
    has = [("_base", F.lit(True), files.select(F.lower("base"))), ("_stem", F.col("_ext") == "zip", files.where("ext in ('tif', 'tiff')").select("parent")), ("_stem", tif, files.where("ext = 'pdf'").select("stem"))]
    for key, of, keys in has:
        asked = asked.join(keys.toDF("_key").distinct(), of & (F.col(key) == F.col("_key")), "left_anti")
    return asked.drop("_base", "_stem", "_ext").orderBy(F.desc(date), row_id)


def pending(keys: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """C28. Keys without output."""
    return keys.select(key).distinct().join(done.select(key), key, "left_anti")


def insert_if_absent(new: DataFrame, state: DataFrame, key: str, source: str, order: str) -> DataFrame:
    """C29. new rows with outcome: inserted, kept (same source), conflict (other source) or repeated (a later row of the same key)."""
    k = F.row_number().over(Window.partitionBy(key).orderBy(order))
    out = new.withColumn("_k", k).join(state.select(key, F.col(source).alias("_old")), key, "left")
    outcome = F.when(F.col("_k") > 1, "repeated").when(F.col("_old").isNull(), "inserted").when(F.col("_old") == F.col(source), "kept").otherwise("conflict")
    return out.withColumn("outcome", outcome).drop("_k", "_old")


def with_decision(rows: DataFrame, decisions: DataFrame, keys: list[str], default: str = "chart") -> DataFrame:
    """C30. rows with their role; `default` without a decision."""
    return rows.join(decisions.select(*keys, "role"), keys, "left").withColumn("role", F.coalesce("role", F.lit(default)))


def upsert_decisions(old: DataFrame, new: DataFrame, key: str, order: str, allowed: list[str]) -> DataFrame:
    """C31. The latest decision of each key; a blank one deletes; values outside the set are left out."""
    every = old.unionByName(new).where(X.blank("decision") | F.col("decision").isin(allowed))
    return first_by(every, [key], F.desc(order)).where(~X.blank("decision"))


def work_list(items: DataFrame, decisions: DataFrame, similarity: DataFrame, key: str) -> DataFrame:
    """C32. items with decision ('' without one) and similarity (-1 without one)."""
    out = items.join(decisions.select(key, "decision"), key, "left").join(similarity.select(key, "similarity"), key, "left")
    return out.withColumn("decision", F.coalesce("decision", F.lit(""))).withColumn("similarity", F.coalesce("similarity", F.lit(-1.0)))


def patch_rows(rows: DataFrame, updates: DataFrame, line: str, editable: list[str]) -> DataFrame:
    """B40. rows with the updates' non-null values in editable columns."""
    use = [c for c in editable if c in updates.columns]
    out = rows.join(updates.select(line, *[F.col(c).alias(f"_{c}") for c in use]), line, "left")
    return out.select(*[F.coalesce(f"_{c}", c).alias(c) if c in use else F.col(c) for c in rows.columns])


def targets(rows: DataFrame, files: DataFrame, siblings: DataFrame, key: str, location: str) -> DataFrame:
    """B43. rows with the first reason that excludes them, else ok."""
    out = rows.join(files.select(key, "readable", "georeferenced"), key, "left").join(siblings.select(location).distinct().withColumn("_s", F.lit(1)), location, "left")
    status = (
        F.when(~X.extension(key).isin("tif", "tiff", "jpg", "jpeg"), "extension").when(~F.col("has_gcps"), "no GCPs").when(F.col("readable").isNull(), "file missing")
        .when(~F.col("readable"), "unreadable").when(F.col("georeferenced"), "already georeferenced").when(F.col("_s").isNull(), "no sibling").otherwise("ok")
    )
    return out.withColumn("status", status).drop("_s")


def winners(candidates: DataFrame, group: str, rank: str, line: str, usable: str, stops: str | None = None) -> DataFrame:
    """E4, D16. (group, winner line, attempts, outcome): the first usable candidate by rank and line; `exhausted` without one.

    stops: a column; a candidate for which it is true ends its group, so that later ones aren't tried.
    """
    w = Window.partitionBy(group).orderBy(rank, line)
    tried = candidates.withColumn("_try", F.row_number().over(w))
    if stops:
        ended = F.max(F.col(stops).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
        tried = tried.withColumn("_ended", F.coalesce(ended, F.lit(0))).where("_ended = 0")
    ok = F.when(F.col(usable), F.col("_try"))
    out = tried.groupBy(group).agg(F.min(ok).alias("_win"), F.count("*").alias("_n"), F.min_by(line, F.coalesce(ok, F.lit(2**31 - 1))).alias("_line"))
    won = F.col("_win").isNotNull()
    return out.select(group, F.when(won, F.col("_line")).alias("winner"), F.coalesce("_win", "_n").alias("attempts"), F.when(won, "winner").otherwise("exhausted").alias("outcome"))


def latest(log: DataFrame, key: str | list[str], seq: str, first: bool = False) -> DataFrame:
    """E5. The last (or first) entry of each key; partial aggregation, no sort."""
    keys = [key] if isinstance(key, str) else key
    rest = F.struct(*[c for c in log.columns if c not in keys])
    pick = F.min_by if first else F.max_by
    return log.groupBy(*keys).agg(pick(rest, seq).alias("_r")).select(*keys, "_r.*")


def best_captures(captures: DataFrame, big: int = 2_000_000) -> DataFrame:
    """E12. Per URL the largest capture, then the newest; captures shorter than declared, or of about 1 MB of a big file, don't count."""
    size, declared = F.col("captured_length"), F.col("declared_length")
    cut = (size < declared) | ((declared > big) & size.between(1_000_000, 1_050_000))
    return first_by(captures.where(~F.coalesce(cut, F.lit(False))), ["url"], F.desc(size), F.desc("ts"))
