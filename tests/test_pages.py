"""Page text operators on hand-made pages and against plain reimplementations."""

import random
import re

import pytest
from pyspark.sql import functions as F

from strataflow.operators import pages as P
from strataflow.plans import pages as pages_plan
from strataflow.plans import upkeep as upkeep_plan

PAGE = """<!DOCTYPE html><html><head><title> Old <!-- x --> Fields </title><style>p{}</style></head><body>
<p> One &amp; two <a name=" first ">here</a><!-- gone --> and</p><a name="second"></a><script>var a = "<b>";</script> end <a href="x.HTML">l</a></body></html>"""


def test_stream_and_anchors(spark):
    rows = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "plain <b> text")], "id int, html string")
    out = {r.id: r for r in P.page_streams(rows).collect()}
    r = out[1]
    assert r.page_text == "# OldFields\n\nOld\nFields\nOne & two\nhere\nand\nend\nl"
    assert r.stream == 'Old\nFields\np{}\nOne & two\nhere\nand\nvar a = "<b>";\nend\nl'
    assert [(a.offset, a.name) for a in r.anchors] == [(r.stream.index("\nhere"), "first"), (r.stream.index("\nvar"), "second")]
    assert (out[2].stream, out[2].page_text, out[3].anchors, out[4].stream) == ("", "# \n\n", [], "plain\ntext")
    assert [x.link for x in P.link_set(rows, "id").collect()] == ["x.html"]


def test_bare_marks_stay_in_their_text():
    """A text node is one string, however the parser hands it over; tags, comments and declarations part strings."""
    assert P.read_page("<p>5 < 6 & 7</p>")[2] == "5 < 6 & 7"
    assert P.read_page("a < b<!-- x -->c &lt; d<br>e & f < ")[2] == "a < b\nc < d\ne & f <"
    assert P.read_page("<title>x < y</title><p>1<2</p>") == ("x < y", "x < y\n1<2", "x < y\n1<2", [])


def windows_by_force(text, size, overlap):
    """(start, end) of each window, found letter by letter."""
    out, start = [], 0
    while start < len(text):
        end = min(start + size, len(text))
        if end < len(text):
            spaces = [i for i in range(start + 1, end) if text[i] == " "]
            end = spaces[-1] if spaces else end
        out.append((start, end))
        if end == len(text):
            break
        start = max(end - overlap, start + 1) if end - overlap > start else end
    return out


@pytest.mark.parametrize("block", [P.BLOCK, 20])
def test_chunks_by_force(spark, monkeypatch, block):
    """Random texts of few letters, many spaces and none, in windows of several sizes, also held in many blocks."""
    monkeypatch.setattr(P, "BLOCK", block)
    r = random.Random(9)
    texts = ["".join(r.choices("ab \n", weights=[4, 4, w, 1], k=r.randint(0, 90))) for w in (0, 1, 1, 3, 20) for _ in range(60)] + ["a" * 301 + " " * 2 + "b" * 5000 + " c" * 900, "\u00a0x\U0001f600 y \u2003"]
    rows = spark.createDataFrame(list(enumerate(texts)), "key int, text string").cache()
    for size, overlap in ((4, 0), (5, 4), (9, 3), (20, 8)):
        got: dict = {}
        for x in P.chunks(rows, "key", size=size, overlap=overlap).orderBy("key", "chunk").collect():
            got.setdefault(x.key, []).append(x.text)
        for k, t in enumerate(texts):
            want = windows_by_force(t, size, overlap)
            assert got.get(k, []) == [t[a:b].strip() for a, b in want if t[a:b].strip()], (k, size, overlap)
            assert all(b - a <= size for a, b in want) and (not t or want[-1][1] == len(t)) and all(x[1] >= y[0] for x, y in zip(want, want[1:], strict=False))


def test_chunk_rows(spark):
    rows = spark.createDataFrame([("a/b", "x" * 5 + " " + "y" * 5), ("c", None), ("d", "  ")], "key string, text string")
    out = P.chunks(rows, "key", size=8, overlap=2).collect()
    assert [(r.id, r.text) for r in out] == [("a/b:::0", "xxxxx"), ("a/b:::1", "xx yyyyy")]


def test_sections(spark):
    text = "_" * 19 + "a" + "_" * 20 + "b\n" + "_" * 30
    rows = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, text string")
    out = [(r.id, r.section, r.section_start, r.section_text) for r in P.sections(rows, "text").collect()]
    assert out == [(1, 0, 0, "_" * 19 + "a"), (1, 1, 40, "b\n"), (1, 2, 72, ""), (3, 0, 0, "")]
    assert all(text[s : s + len(t)] == t for i, _, s, t in out if i == 1)


PAIRS = [
    ("at 42.2\n24, -87.954 x", [(42.224, -87.954)]), ("at 35.\n28, -81.5", [(35.28, -81.5)]), ("in 1944\n42.19, -87.9", [(42.19, -87.9)]), ("it was 95.\n28.36, -81.52", [(28.36, -81.52)]), ("39.79, -86", [(39.79, -86.0)]),
    ("25.86 North / 80.21 West", [(25.86, -80.21)]), ("25.86 N. / 80.21 W.", [(25.86, -80.21)]), ("13.5 North / 144.8 East", []), ("15.5 North / 144.8 East", [(15.5, 144.8)]), ("12.5, -80.1", []), ("40.1, -59.9", []), ("40.1, 80.2", []),
    ("1.40.1, -80.2", []), ("40.1, -80.2.3", []), ("40.1 , -80.2 and 41.5, -90.25", [(40.1, -80.2), (41.5, -90.25)]), ("42.\n2\n4, -80.5", [(42.24, -80.5)]), ("", []), (None, []),
]


def test_coordinates(spark):
    """Each text's pairs, and places that are those in the text as it is."""
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(PAIRS)], "id int, t string").select("id", P.coordinates("t").alias("c"))
    got = {r.id: r.c for r in rows.collect()}
    for i, (text, found) in enumerate(PAIRS):
        assert [(h.lat, h.lon) for h in got[i]] == found, text
        for h in got[i]:
            span = re.sub(r"\s", "", text[h.pos : h.end])
            assert span.startswith(str(h.lat).split(".")[0]) and text[h.pos].isdigit()


LONG = "n" * 400
SECTIONS = [
    ("__\n Hill Field (XYZ), Dale, QQ (revised 3/15)\n40.1, -80.2 (North of\n Dale, QQ) text", 1000, [(700, "far"), (900, "near"), (1005, "own"), (9000, "after")], ("Hill Field (XYZ), Dale, QQ", 40.1, -80.2, "North of Dale, QQ", "own", 0)),
    ("Name 40.1, -80.2", 1000, [(700, "far")], ("Name", 40.1, -80.2, "", "", 0)), ("Name 40.1, -80.2", 1000, [(880, "near")], ("Name", 40.1, -80.2, "", "near", 0)), ("Name 40.1, -80.2", 1000, None, ("Name", 40.1, -80.2, "", "", 0)),
    ("40.1, -80.2\nName\n41.1, -81.2 (x)", 0, [], ("Name", 41.1, -81.2, "x", "", 1)),  # a stray pair has no title before it
    ("Name, QQ 39.497, -75.645\n28.35, -81.55 (Far off, QQ)", 0, [], ("Name, QQ", 28.35, -81.55, "Far off, QQ", "", 1)),  # the pair with the parenthesis counts
    ("Name 39.497, -75.645 " + "x" * 130 + " 28.35, -81.55 (far)", 0, [], ("Name", 39.497, -75.645, "", "", 1)), (LONG + " 39.497, -75.645", 0, [], (LONG[:300], 39.497, -75.645, "", "", 0)),
    ("no pair", 0, [], None), ("40.1, -80.2 after", 0, [], None), (None, 0, [], None),
]


def test_entries(spark):
    rows = spark.createDataFrame([(i, t, s, a) for i, (t, s, a, _) in enumerate(SECTIONS)], "id int, section_text string, section_start int, anchors array<struct<offset:int,name:string>>")
    got = {e.id: (e["name"], e.lat, e.lon, e.rel_location, e.anchor, e.extra_coord_matches) for e in P.entries(rows).collect()}
    assert got == {i: x[3] for i, x in enumerate(SECTIONS) if x[3]}


def test_entry_rows(spark):
    text = "Smith 40.1, -80.2" + "_" * 20 + "nothing" + "_" * 20 + "Jones\n41.1, -81.2 (w)"
    rows = spark.createDataFrame([(1, text, [(0, "a"), (45, "b")])], "id int, stream string, anchors array<struct<offset:int,name:string>>")
    out = P.entries(P.sections(rows, "stream")).select("section", "name", "lat", "anchor").collect()
    assert [tuple(r) for r in out] == [(0, "Smith", 40.1, "a"), (2, "Jones", 41.1, "b")]


EVIDENCE = [
    ("The airport was built in 1942 and closed in 1957 & 1960.", {"built": 1942, "closed": 1960}), ("The hangar was closed in 1957.", {}), ("Smith was abandoned in 1950.", {"closed": 1950}), ("It was abandoned in 1950.", {"closed": 1950}),
    ("Runway closed in 1950.", {}), ("The field was closed at some point. It was 1990.", {}), ("The earliest known photo was a 3/44 sectional chart", {"earliest": 1944}), ("The earliest chart was from 12/5/26.", {"earliest": 2026}),
    ("the earliest chart of the proposed field was 1950", {}), ("Runway 9/27 view. The earliest chart: none", {}), ("not yet depicted on the 1938 chart", {"notyet": 1938}), ("no longer depicted in 1971 or 1975", {"nolonger": 1971}),
    ("The last photo was from 1966.", {"lastseen": 1966}), ("The last photo was a 2016 view of the abandoned site.", {}), ("It was still listed in 1960.", {"lastseen": 1960}),
    ("no longer shown in 1970. " + "x " * 80 + "The field was closed in 1950. " + "x " * 40 + "The field was closed in 1969.", {"nolonger": 1970, "closed": 1969}), ("", {}), (None, {}),
]


def test_evidence_and_lifespans(spark):
    rows = spark.createDataFrame([(i, t, ["smith"]) for i, (t, _) in enumerate(EVIDENCE)], "id int, t string, w array<string>")
    rows = P.with_evidence(rows, "t", "w", "e")
    out = rows.select("id", "e.*", P.lifespan("e", F.lit(False), F.lit(False)).alias("l"), P.lifespan("e", F.lit(True), F.lit(False)).alias("listed"), P.lifespan("e", F.lit(False), F.lit(True)).alias("opened")).orderBy("id").collect()
    for r, (_, found) in zip(out, EVIDENCE, strict=True):
        assert {k: r[k] for k in ("earliest", "built", "notyet", "nolonger", "lastseen", "closed") if r[k] is not None} == found
    assert tuple(out[0].l) == (1942, "built", 1960, "closed_stated", "gone") and tuple(out[7].l) == (None, None, None, None, "unknown")  # 2026 is no first depiction
    assert tuple(out[10].l) == (1939, "after_absence", None, None, "unknown") and tuple(out[10].listed) == (1939, "after_absence", 1988, "faa1988_listed", "gone")
    assert tuple(out[12].opened) == (None, None, None, "oa_open", "open") and tuple(out[17].listed) == (None, None, 1988, "faa1988_listed", "gone")
    clash = spark.createDataFrame([(None, 1990, None, None, None, 1950)], P.EVIDENCE).select(F.struct("*").alias("e"))
    assert tuple(clash.select(P.lifespan("e", F.lit(False), F.lit(False)).alias("l")).first()["l"]) == (1990, "built", None, "conflict", "unknown")
    assert clash.select(P.lifespan("e", F.lit(True), F.lit(False)).alias("l")).first()["l"]["start_year"] == 1988


def test_images(spark):
    html = "<IMG SRC='../a%20b.gif'><img alt=\"x\" src=\"./c.png\"><img src=\"http://x/y.gif\"><img src=\"data:x\"><img src=\"../../../out.gif\"><img src='./c.png'>"
    rows = spark.createDataFrame([(html, "st/deep"), (None, "x")], "html string, folder string")
    bare = "<img src=a.gif width=3><img alt='>' src = q?x=1&amp;y=2.gif /><imgx src=no.gif><img data-src='no.png' src='yes.png'><img src=''>"
    assert spark.createDataFrame([(bare, "d")], "h string, f string").select(P.image_refs("h", "f").alias("i")).first()["i"] == ["d/a.gif", "d/q?x=1&y=2.gif", "d/yes.png"]
    assert [r.i for r in rows.select(P.image_refs("html", "folder").alias("i")).collect()] == [["st/a b.gif", "st/deep/c.png"], []]


def test_references_without_a_semicolon_stand_as_they_are(spark):
    html = "<title>a &amp; b&amp</title><p>x &ampy; &copy <a name='p&amp'></a>q<script>a&amp;&b</script>"
    r = page_streams_of(spark, html)
    assert (r.title, r.stream, [a["name"] for a in r.anchors]) == ("a & b&amp", "a & b&amp\nx &ampy; &copy\nq\na&amp;&b", ["p&amp"])


def page_streams_of(spark, html):
    return P.page_streams(spark.createDataFrame([(html,)], "html string")).first()


def test_pairs_are_searched_for_once_however_often_they_are_named(spark):
    """A filter on the pairs must not be moved below them: each mention would then search the text anew, also for every pair."""
    rows = spark.createDataFrame([("Name 40.1, -80.2", 0, [(0, "a")])], "section_text string, section_start int, anchors array<struct<offset:int,name:string>>")
    plan = P.entries(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(P._INSIDE_NUMBER) == 1


def test_placed_customers_are_dealt_out(spark):
    """One row group is no single task."""
    assert pages_plan.index_entries(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 4


def test_texts_to_be_searched_are_dealt_out(spark):
    """Documents and orders of one row group are no single task."""
    assert upkeep_plan.text_evidence(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 4
    assert pages_plan.dated_evidence(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 4
