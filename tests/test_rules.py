"""Rules of file look-up, claims, donors, groups, names, rings and bundles, each on the case that it is about."""

import random

import pytest
from pyspark.sql import functions as F

from strataflow.functions import expr as X
from strataflow.functions import geo as G
from strataflow.operators import cells as C
from strataflow.operators import logs as L
from strataflow.operators import reconcile as R
from strataflow.operators import resolve as E


def test_files_by_tails_and_folders(spark):
    files = spark.createDataFrame([("r/Denver_90.tif",), ("r/Denver_90/other.jpg",), ("arch/Salt_12/in.tif",), ("x/y_sectional_files_Reno 7.pdf",)], "path string")
    names = [("1", "x_content_aeronav_sectional_files_Denver_90.tif"), ("2", "http://a/b/sectional_files/Denver_90.TIF"), ("3", "Salt_12.zip"), ("4", "Reno 7.tif"), ("5", "none.tif"), ("6", ""), ("7", None), ("8", "a_sectional_files_b_sectional_files_Denver_90.tif")]
    got = {r.id: r.path for r in R.resolve_files(spark.createDataFrame(names, "id string, name string"), files, "id", "name").collect()}
    # 4: by the tail of the file's name; 8: only what follows the first mark is a key
    assert got == {"1": "r/Denver_90.tif", "2": "r/Denver_90.tif", "3": "arch/Salt_12/in.tif", "4": "x/y_sectional_files_Reno 7.pdf", "5": None, "6": None, "7": None, "8": None}


def test_contained(spark):
    """Every pair that plain search finds, with needles shorter than a piece and pieces that all share."""
    r = random.Random(3)
    hays = ["http://" + "".join(r.choices("abc/", k=r.randint(0, 25))) for _ in range(60)] + [None, "", "ab"]
    needles = ["http:", "a", "bc", "", None, *["".join(r.choices("abc/", k=r.randint(1, 8))) for _ in range(60)]]
    got = R.contained(spark.createDataFrame([(n,) for n in needles], "needle string"), "needle", spark.createDataFrame(list(enumerate(hays)), "id int, hay string"), "hay")
    assert sorted((x.needle, x.id) for x in got.collect()) == sorted((n, i) for n in needles if n for i, h in enumerate(hays) if h and n in h)


def test_claims_fall_back_when_no_file_is_found(spark):
    """A row of the place stands in the catalogue but its file is nowhere: rows whose place begins so are tried."""
    claims = spark.createDataFrame([("1", "dup", "dole location/date Big Bend 1950-01-02"), ("2", "dup", "dole location/date Reno 1950-01-02"), ("3", "new", "dole location/date Reno 1950-01-02"), ("4", "dup", "dole location/date Re 1950-01-02")], "rid string, dup string, how string")
    rows = spark.createDataFrame([("gone.tif", "Big Bend", "1950-01-02", "1"), ("there.tif", "Big Bend East", "1950-01-02", "1"), ("reno.tif", "Reno", "1950-01-02", "1"), ("reno2.tif", "Reno West", "1950-01-02", "1")], "filename string, location string, date string, edition string")
    paths = [("r/there.tif", "there.tif"), ("r/reno.tif", "reno.tif"), ("r/reno2.tif", "reno2.tif")]
    files = spark.createDataFrame([(p, b, b[:-4], "r", "tif") for p, b in paths], "path string, base string, stem string, parent string, ext string")
    assert {r.rid: r.matches for r in R.claimed_matches(claims, rows, files).collect()} == {"1": ["r/there.tif"], "2": ["r/reno.tif"], "4": ["r/reno.tif", "r/reno2.tif"]}


FIELD = "row_id int, state string, lat double, lon double, precision int, idents array<string>, aliases array<struct<tokens:array<string>,variant:boolean>>, city_tokens array<string>, skip boolean"
DONOR = "donor_id string, title string, state string, lat double, lon double, idents array<string>, names array<struct<tokens:array<string>,variant:boolean>>, name_ok boolean"


def test_donors_without_an_id_are_told_apart_by_name(spark):
    """Two donors without id, of different names, are claimed by one row each; a third row claims one of them from farther off and gives it up."""
    words = lambda *w: [(list(w), False)]
    rows = [(1, "S", 30.0, -90.0, 1, [], words("alpha", "one"), [], False), (2, "S", 30.01, -90.0, 1, [], words("beta", "two"), [], False), (3, "S", 30.02, -90.0, 1, [], words("beta", "two"), [], False), (4, "S", 50.0, -90.0, 1, ["K9"], words("gamma"), [], False), (5, "S", 60.0, -90.0, 3, [], words("none"), [], False)]
    donors = [("", "Alpha One", "S", 30.0, -90.001, [], words("alpha", "one"), True), ("", "Beta Two", "S", 30.01, -90.001, [], words("beta", "two"), True), ("d4", "Gamma", "S", 50.001, -90.0, ["K9"], words("x", "y"), True)]
    out = E.unique_claims(E.cascade(spark.createDataFrame(rows, FIELD), [("list", spark.createDataFrame(donors, DONOR))]))
    got = {r.row_id: (r.match_via, r.match_name, r.coord_source, r.reverted, r.lon) for r in out.collect()}
    assert got == {
        1: ("name", "Alpha One", "list", False, -90.001), 2: ("name", "Beta Two", "list", False, -90.001), 3: ("collision-reverted", "Beta Two", "own", True, -90.0), 4: ("ident:K9", "Gamma", "list", False, -90.0),
        5: (None, None, "own", False, -90.0),
    }


def test_donors_that_repeat_an_id_add_no_rows(spark):
    words = [(["alpha", "one"], False)]
    rows = spark.createDataFrame([(1, "S", 30.0, -90.0, 1, ["K1"], words, [], False)], FIELD)
    donors = spark.createDataFrame([("d", "Near", "S", 30.001, -90.0, ["K1"], words, True), ("d", "Far", "S", 30.05, -90.0, ["K1"], words, True)], DONOR)
    out = E.cascade(rows, [("list", donors)]).collect()
    assert [(r.match_id, r.match_name, r.lat) for r in out] == [("d", "Near", 30.001)]


def test_names_meet_by_their_rarest_word(spark):
    """All pairs that a comparison of all with all finds, where one word is in every name; no pair is lost by meeting on rarer words."""
    r = random.Random(7)
    pick = lambda: list({"common", *r.choices("pqrstu", k=r.randint(0, 3))})
    rows = [(i, "S", 30.0 + r.random() * 0.05, -90.0, 1, [], [(pick(), False), (pick(), True)], [], False) for i in range(30)]
    donors = [(f"d{i}", "", "S", 30.0 + r.random() * 0.05, -90.0, [], [(pick(), False)], True) for i in range(30)]
    got = {x.row_id: (x.donor_id, x.shared) for x in E.match_names(spark.createDataFrame(rows, FIELD), spark.createDataFrame(donors, DONOR)).collect()}
    want = {}
    for row in rows:
        found = []
        for d in donors:
            km = abs(row[2] - d[3]) * 111.19492664
            for tokens, variant in row[6]:
                a, b = set(tokens), set(d[6][0][0])
                both = a & b
                if km <= 6 and both and both in (a, b) and (len(both) >= 2 or (a == b and km <= 4)) and not (variant and km > 3):
                    found.append((-len(both), km, d[0]))
        if found:
            want[row[0]] = (min(found)[2], -min(found)[0])
    assert got == want


def test_lifespans_say_where_they_come_from(spark):
    rows = spark.createDataFrame([(1, [["a", "b"]], 30.0, -90.0, None, None, "unknown", "none", "none"), (2, [["a", "b"]], 30.0, -90.0, 1920, None, "open", "built", "oa_open")], "row_id int, aliases array<array<string>>, lat double, lon double, start_year int, stop_year int, status string, start_basis string, end_basis string")
    spans = spark.createDataFrame([(2, ["a"], 30.0, -90.0, 1930, 1950), (5, ["a"], 30.0, -90.0, 1900, 1999)], "line int, tokens array<string>, lat double, lon double, start_year int, stop_year int")
    assert sorted(tuple(r)[4:] for r in E.nearby_lifespans(rows, spans).collect()) == [(1920, None, "open", "built", "oa_open"), (1930, 1950, "gone", "lifespan_csv", "lifespan_csv")]


def test_group_is_named_after_its_first_location(spark):
    places = spark.createDataFrame([("Zeta", "sectional/a", "1980-01-01", 1), ("Alpha", "sectional/a", "1980-01-01", 2), ("Old", None, "1950-01-01", 0)], "location string, ref string, last_date string, line int")
    none = spark.createDataFrame([], "old string, modern string"), spark.createDataFrame([("Old", "sectional/a")], "location string, group string")
    assert [tuple(r) for r in C.group_members(places, *none).collect()] == [("sectional/a", "Zeta", ["Alpha", "Zeta"], ["Old"])]


@pytest.mark.parametrize("name,place,want", [
    ("key_west_north_87.tif", "Key_West", ("north", 87)), ("utah.west+1955(12).tif", "utah", ("west", 12)), ("utah utah-3.tif", "utah", (None, 3)), ("southern 5.tif", "", (None, 5)), ("a.b(south)=007.pdf", "zz", ("south", 7)), ("east east 1234.tif", "east", ("east", None)),
])
def test_half_and_edition(spark, name, place, want):
    r = spark.createDataFrame([(name, place)], "n string, p string").select(X.half_and_edition("n", "p").alias("h")).first().h
    assert (r.half, r.edition) == want


def test_long_parentheses_are_words(spark):
    long = "Smith (" + "word " * 9 + ")"
    got = spark.createDataFrame([("Smith (ABC) Dale",), (long,), ("Hill () x",)], "n string").select(F.array_sort(X.name_tokens("n")).alias("w")).collect()
    assert [r.w for r in got] == [["dale", "smith"], ["smith", "word"], ["hill", "x"]]


def area(ring):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False))) / 2


def test_rings_across_the_antimeridian(spark):
    """Slanted quads: parts are closed, lie on their side of the meridian, and have the area of the whole together; others stay as they are."""
    r = random.Random(12)
    rings = []
    for i in range(60):
        w, wide, s = r.uniform(130, 200), r.uniform(1, 40), r.uniform(-50, 50)
        quad = [(w, s), (w + wide, s + r.uniform(-3, 3)), (w + wide + r.uniform(-0.9, 4), s + 5), (w + r.uniform(-4, 0.4), s + 6)]
        rings.append((i, [((x + 180) % 360 - 180, y) for x, y in [*quad, quad[0]]], [*quad, quad[0]]))
    df = spark.createDataFrame([(i, q) for i, q, _ in rings] + [(99, None)], "id int, ring array<struct<lon:double,lat:double>>")
    got = {x.id: [[tuple(p) for p in part] for part in x.parts] for x in df.select("id", G.split_ring("ring").alias("parts")).collect()}
    assert got.pop(99) == []
    split = 0
    for i, quad, whole in rings:
        parts = got[i]
        lons = [p[0] for p in quad]
        if max(lons) - min(lons) <= 180:
            assert parts == [quad]
            continue
        split += 1
        assert len(parts) == 2 and all(p[0] == p[-1] for p in parts) and all(0 < x <= 180 for x, _ in parts[0]) and all(-180 <= x < 0 for x, _ in parts[1])
        assert abs(area(parts[0]) + area(parts[1]) - area(whole)) < 1e-6
    assert split > 10
    # a quad that only touches the meridian has no second part
    touch = spark.createDataFrame([(1, [(170.0, 0.0), (-180.0, 0.0), (-180.0, 5.0), (170.0, 5.0), (170.0, 0.0)])], "id int, ring array<struct<lon:double,lat:double>>").select(G.split_ring("ring").alias("p")).first().p
    assert [[tuple(p) for p in part] for part in touch] == [[(170.0, 0.0), (180.0, 0.0), (180.0, 5.0), (170.0, 5.0), (170.0, 0.0)]]


def test_bundle_and_groups(spark):
    entries = spark.createDataFrame([("g", "a", 0, 0, 10), ("g", "b", 1, 10, 5), ("h", "c", 2, 15, 7), ("h", "d", 3, 23, 1)], "grp string, key string, index long, offset long, len long")
    source = spark.createDataFrame([("a", 10, 9), ("b", 5, 5), ("c", 8, 99)], "key string, len long, tile_data_offset long")
    assert sorted((r.key, r.fault) for r in L.verify_bundle(entries, source, "grp", "key").collect()) == [("a", "overrun"), ("c", "size"), ("d", "offset")]
    groups = spark.createDataFrame([("g", 0, 15, 0, 2), ("h", 15, 8, 2, 4), ("i", 0, 0, 4, 4), ("k", 1, 10, 0, 1)], "grp string, off long, len long, i0 long, i1 long")
    assert sorted(map(tuple, L.verify_groups(entries, groups, "grp").collect())) == [("h", "length"), ("i", "empty"), ("k", "empty")]


def test_equal_rows_have_offsets_of_their_own(spark):
    from strataflow.sources.tables import kept

    rows = spark.createDataFrame([("a", 1, 10)] * 50 + [("b", 2, 3)] * 30, "g string, o int, n long").repartition(7)
    out = L.running_offsets(rows, "g", ["o"], "n", kept).collect()
    assert sorted(r["index"] for r in out) == list(range(80)) and sorted(r.offset for r in out) == [10 * i for i in range(50)] + [500 + 3 * i for i in range(30)]


def test_verify_other_untested_orders(spark):
    """F3 to F5."""
    rows = spark.createDataFrame([("2001-01-01_to_2001-02-01", "b", "2001"), ("odd", "B", None), ("2003-05-05", "a", "2003"), ("2002-01-01", "B", "1999")], "key string, place string, date string")
    assert [r.key for r in L.newest_first(rows, "key").collect()] == ["2003-05-05", "2002-01-01", "2001-01-01_to_2001-02-01", "odd"]
    assert [(r.place, r.date) for r in L.by_location(rows, "place", "date").collect()] == [("a", "2003"), ("B", "1999"), ("B", None), ("b", "2001")]
    assert [r.key for r in L.first_n(rows, 2, F.desc("date")).collect()] == ["2003-05-05", "2001-01-01_to_2001-02-01"]


def test_overlaps_send_no_cells_through_the_driver(spark):
    cells = spark.range(40).select((F.col("id") % 4).alias("old"), F.col("id").alias("cell"))
    out = C.overlaps(cells, cells.withColumnRenamed("old", "modern"))
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r.old, r.modern, r["share"], r["rank"], r.best) for r in out.orderBy("old").collect()] == [(k, k, 1.0, 1, True) for k in range(4)]


def most_joined(df):
    """The most rows that a join of df's plan hands on, after a run."""

    def nodes(p):
        kind = p.getClass().getSimpleName()
        below = [p.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [p.plan()] if kind.endswith("QueryStageExec") else [p.children().apply(i) for i in range(p.children().size())]
        yield p
        for q in below:
            yield from nodes(q)

    df.collect()
    return max(p.metrics().apply("numOutputRows").value() for p in nodes(df._jdf.queryExecution().executedPlan()) if "Join" in p.nodeName() and p.metrics().contains("numOutputRows"))


def test_rows_of_one_location_do_not_meet_all_its_donors(spark):
    rows = spark.range(300).select(F.col("id").alias("row_id"), F.lit("ohio").alias("location"), F.when(F.col("id") % 3 == 0, "north").alias("half"))
    donors = spark.range(1, 301).select(F.col("id").alias("donor_id"), F.lit("ohio_sheet").alias("name"), F.when(F.col("id") % 2 == 0, "north").when(F.col("id") % 5 == 0, "south").alias("half"), F.when(F.col("id") > 2, F.col("id") % 7).cast("int").alias("edition"))
    out = E.donor_pool(rows, donors, spark.createDataFrame([(1, "ohio")], "position int, location string"))
    assert {r.row_id: r.donor_id for r in out.collect()} == {k: 14 if k % 3 == 0 else 7 for k in range(300)}
    assert most_joined(out) <= 1_000


def test_rows_of_one_name_find_their_file_once(spark):
    rows = spark.range(300).select("id", F.concat(F.lit("own_"), (F.col("id") % 2).cast("string"), F.lit(".pdf")).alias("name"))
    files = spark.range(300).select(F.concat(F.lit("r/big_own_"), F.col("id").cast("string"), F.lit("_x.jpg")).alias("path"))
    out = R.resolve_files(rows, files, "id", "name")
    assert {r.id: r.path for r in out.collect()} == {k: f"r/big_own_{k % 2}_x.jpg" for k in range(300)}
    assert most_joined(out) <= 1_000


def test_claims_that_say_the_same_are_looked_up_once(spark):
    claims = spark.range(400).select("id", F.lit("dup").alias("dup"), F.when(F.col("id") < 200, "dole location/date Reno 1950-01-02").otherwise("rawtiffs cycle c1 has Re").alias("how")).withColumnRenamed("id", "rid")
    rows = spark.range(200).select(F.lit("reno.tif").alias("filename"), F.lit("Reno").alias("location"), F.lit("1950-01-02").alias("date"), F.lit("1").alias("edition"))
    files = spark.createDataFrame([("r/c1/reno.tif", "reno.tif", "reno", "c1", "tif")], "path string, base string, stem string, parent string, ext string")
    out = R.claimed_matches(claims, rows, files)
    assert {r.rid: r.matches for r in out.collect()} == {k: ["r/c1/reno.tif"] for k in range(400)}
    assert most_joined(out) <= 1_000


def test_missing_inputs_meet_no_file_more_than_once(spark):
    rows = spark.range(100).select("id", F.when(F.col("id") == 7, "gone.tif").when(F.col("id") == 8, "p.zip").when(F.col("id") == 9, "s.tif").when(F.col("id") == 10, "s.zip").otherwise("a.TIF").alias("name"), F.lit("x").alias("link"), F.lit("d").alias("date"))
    files = spark.range(100).select(F.lit("r/a.tif").alias("path"), F.lit("A.tif").alias("base"), F.lit("a").alias("stem"), F.lit("p").alias("parent"), F.lit("tif").alias("ext"))
    files = files.union(spark.createDataFrame([("r/s.pdf", "s.pdf", "s", "r", "pdf")], files.schema))
    out = R.missing_inputs(rows, files, "id", "name", "link", "date")
    assert [r.id for r in out.collect()] == [7, 10]
    assert most_joined(out) <= 200


def test_places_that_several_share_are_looked_at_once(spark):
    """Identifiers, names and lifespans: rows and donors of one place don't meet one by one."""
    alias = F.array(F.struct(F.array(F.lit("old"), F.lit("town")).alias("tokens"), F.lit(False).alias("variant")))
    place = [F.lit("S").alias("state"), F.lit(30.0).alias("lat"), F.lit(-90.0).alias("lon"), F.array(F.lit("K1")).alias("idents")]
    rows = spark.range(200).select(F.col("id").alias("row_id"), *place, F.lit(1).alias("precision"), alias.alias("aliases"), F.array().cast("array<string>").alias("city_tokens"))
    donors = spark.range(5, 205).select(F.col("id").alias("donor_id"), *place, alias.alias("names"), F.lit(True).alias("name_ok"))
    for out in (E.match_idents(rows, donors), E.match_names(rows, donors)):
        assert {r.donor_id for r in out.collect()} == {5} and most_joined(out) <= 1_000
    spare = rows.select("row_id", "lat", "lon", F.expr("array(array('old'))").alias("aliases"), F.lit(None).cast("int").alias("start_year"), F.lit(1960).alias("stop_year"), F.lit("x").alias("status"))
    spans = donors.select(F.col("donor_id").alias("line"), "lat", "lon", F.expr("array('old', 'town')").alias("tokens"), F.col("donor_id").cast("int").alias("start_year"), F.lit(1).alias("stop_year"))
    out = E.nearby_lifespans(spare, spans)
    assert {r.start_year for r in out.collect()} == {5} and most_joined(out) <= 1_000
