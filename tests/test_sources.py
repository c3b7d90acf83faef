"""Files written and read back."""

import datetime
import json
import struct

import pytest
from pyspark.sql import functions as F

from strataflow.operators import reconcile as R
from strataflow.operators import resolve as E
from strataflow.sources import readers, writers
from strataflow.sources.byte_ranges import file_heads
from strataflow.sources.readers import CATALOGUE
from strataflow.sources.tables import PLAN, Publication
from strataflow.sources.writers import write_catalogue


def write(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def test_catalogue_round_trip(spark, tmp_path):
    columns = [c for c in readers.CATALOGUE if c not in readers.OPTIONAL]
    rows = [{c: "" for c in columns} | {"filename": f"f{i}.tif", "location": 'Salt "Lake", City' if i == 1 else "X", "note": "two\nlines" if i == 2 else "é"} for i in range(5)]
    quoted = lambda v: '"' + v.replace('"', '""') + '"'
    text = "﻿" + ",".join(columns) + "\n" + "\n".join(",".join(quoted(r[c]) for c in columns) for r in rows) + "\n"
    df = readers.catalogue(spark, write(tmp_path / "c.csv", text))
    got = df.orderBy("line").collect()
    assert [r.line for r in got] == [2, 3, 4, 5, 6] and all(r[c] == rows[i][c] for i, r in enumerate(got) for c in columns) and got[0].rotation == "" and df.columns[:-1] == readers.CATALOGUE
    writers.write_catalogue(df, str(tmp_path / "out"))
    again = readers.read_csv(spark, str(tmp_path / "out")).na.fill("")
    assert again.columns == readers.CATALOGUE and sorted(r.note for r in again.collect()) == sorted(r["note"] for r in rows)
    with pytest.raises(Exception, match="exists"):
        writers.write_catalogue(df, str(tmp_path / "out"))
    with pytest.raises(ValueError, match="lacks download_link"):
        readers.catalogue(spark, write(tmp_path / "d.csv", "filename,location\na,b\n"))


def test_numbered_over_many_parts(spark):
    out = readers.numbered(spark.range(100).repartition(7).select("id"), "n", 5).collect()
    assert sorted(r.n for r in out) == list(range(5, 105))


def test_airports(spark, tmp_path):
    line = lambda site, ident, name, city, state, lat, lon: f"{site:<11}{ident:<5}{name:<65}{city:<26}{state:<2}".ljust(115) + f"{lat:<8}{lon:<9}"
    text = "\r\n".join([line("00001.1A", "ABC", "SMITH", "TOWN", "ST", "N4030300", "W10030000"), line("00001.1B", "X", "NO PLACE", "T", "ST", "", ""), "short"])
    out = readers.fixed_width_airports(spark, write(tmp_path / "a.dat", text)).collect()
    assert len(out) == 1 and (out[0].ident, out[0].name, out[0].state) == ("ABC", "SMITH", "ST") and out[0].lat == pytest.approx(40.508333, abs=1e-6) and out[0].lon == pytest.approx(-100.5)
    head = "ident,type,name,latitude_deg,longitude_deg,iso_country,iso_region,icao_code,iata_code,gps_code,local_code,keywords\n"
    rows = [
        'k1,small_airport,One,40.1234,-80.1234,US,US-PA,kabc,,,9x9,"old field, xyz, 7b7"', "k2,closed,Two,18.1234,-66.1234,PR,PR-U-A,,,,,", "k3,heliport,Three,40.1234,-80.1234,US,US-NY,,,,,", "k4,small_airport,Coarse,40.12,-80.1234,US,US-NY,,,,,",
        "k5,other,Five,40.1234,-80.1234,US,US-NY,,,,,", "k6,closed,Six,40.1234,-80.1234,CA,CA-ON,,,,,", "k7,closed,Seven,,,US,US-NY,,,,,",
    ]
    out = {r.id: r for r in readers.csv_airports(spark, write(tmp_path / "o.csv", head + "\n".join(rows) + "\n")).collect()}
    assert set(out) == {"k1", "k2", "k3"} and out["k2"].state == "PR" and out["k1"].state == "PA" and (out["k1"].name_ok, out["k3"].name_ok) == (True, False)
    assert sorted(out["k1"].idents) == ["7B7", "9X9", "K1", "KABC", "XYZ"] and out["k1"].names == ["One", "old field"]


def test_trees_and_logs(spark, tmp_path):
    for name, data in {"s/index.htm": "a", "s/index.html": "b", "t/index.HTML": "c", "t/x.txt": "d", "t/odd.htm": b"\xff ok"}.items():
        write(tmp_path / "tree" / name, data)
    out = {r.path.rsplit("tree/", 1)[1]: r.html for r in readers.html_tree(spark, str(tmp_path / "tree")).collect()}
    assert set(out) == {"s/index.htm", "t/index.HTML", "t/odd.htm"} and out["t/odd.htm"].endswith(" ok")
    log = write(tmp_path / "m.jsonl", '{"key": "a", "size": 1}\n\nnot json\n{"key": "a", "size": 2}\n{"key": "b", "size": 3}\n')
    rows = readers.jsonl(spark, log, "key string, size long")
    assert [tuple(r) for r in R.latest(rows, "key", "seq").select("key", "size").orderBy("key").collect()] == [("a", 2), ("b", 3)]
    inv = {r.base: r for r in readers.inventory(spark, str(tmp_path / "tree")).collect()}
    assert (inv["x.txt"].parent, inv["x.txt"].ext, inv["x.txt"].size, inv["odd.htm"].stem) == ("t", "txt", 1, "odd")


def test_timeline_files(spark, tmp_path):
    doc = {"locations": {"A": {"ref": "extents/a", "charts": [{"d": "1950-01-01", "e": None, "ed": "1"}, {"d": "1951-01-01", "e": "1952-01-01", "ed": "2"}]}, "B": {"ref": None, "charts": []}}, "rings": {"extents/a": [[-100.0, 40.0], [-99.0, 40.0], [-99.0, 41.0], [-100.0, 40.0]]}}
    path = write(tmp_path / "t.json", json.dumps(doc))
    charts = readers.timeline_json(spark, path)
    assert [tuple(r) for r in charts.orderBy("start").collect()] == [("A", "extents/a", datetime.date(1950, 1, 1), None, "1"), ("A", "extents/a", datetime.date(1951, 1, 1), datetime.date(1952, 1, 1), "2")]
    ring = readers.timeline_rings(spark, path).first()
    assert ring.ref == "extents/a" and [tuple(p) for p in ring.ring] == [tuple(p) for p in doc["rings"]["extents/a"]]
    notes = ["latest-in-collection; BLANK_MAP; GAP 90d before next (1952-05-06); typ30d", "x"]
    rows = spark.createDataFrame([("A", "1950-01-01", "", "1", notes[0], 9), ("A", "1951-01-01", "1952-01-01", " 5 ", None, 2), ("A", "1951-01-01", None, "1600", notes[1], 3), ("B", "1940-01-01", None, "x", "", 4)], "location string, date string, end_date string, edition string, note string, line int")
    uploads = spark.createDataFrame([("A", "1950-01-01", None, ["k1", "k2"]), ("A", "1951-01-01", "1952-01-01", ["k3"])], "location string, d string, e string, keys array<string>")
    places = spark.createDataFrame([("A", "old", "extents/a", 0.25, "m")], "location string, era string, ref string, modern_share double, overlaps string")
    records = writers.timeline_records(rows, places, uploads)
    a = records.where("location = 'A'").first()
    assert [(c.d, c.e, c.ed, c.f, c.pm) for c in a.charts] == [("1950-01-01", None, "1", "LB", ["k1", "k2"]), ("1951-01-01", "1952-01-01", "5", "", ["k3"]), ("1951-01-01", None, "1600", "", None)]
    assert [tuple(g) for g in a.gaps] == [("1950-01-01", "1952-05-06", 90, 2)] and a.missing_eds == [2, 3, 4] and (a.era, a.modern_share) == ("old", 0.25)
    b = records.where("location = 'B'").first()
    assert (b.era, b.gaps, b.missing_eds, b.charts[0].ed) == (None, [], [], "x")
    writers.write_timeline(records, spark.createDataFrame([("g", "G")], "ref string, name string"), readers.timeline_rings(spark, path), str(tmp_path / "out"))
    assert [len(r.charts) for r in spark.read.json(str(tmp_path / "out/locations")).orderBy("location").collect()] == [3, 1] and spark.read.json(str(tmp_path / "out/rings")).count() == 1


def test_archive_headers(spark, tmp_path):
    fields = [127, 50, 177, 20, 197, 30, 227, 400, 9]
    head = b"PMTiles\x03" + struct.pack("<9Q", *fields) + bytes(22) + struct.pack("<4i", -1_000_000_000, 400_000_000, -990_000_000, 410_000_000) + bytes(9)
    write(tmp_path / "a.pmtiles", head.ljust(700, b"\0")), write(tmp_path / "b.pmtiles", "no archive")
    out = {r.key: r for r in readers.archive_headers(spark, str(tmp_path)).collect()}
    assert [out["a"][n] for n in ("root_offset", "root_length", "metadata_offset", "metadata_length", "leaf_offset", "leaf_length", "tile_offset", "tile_length", "tiles")] == fields
    assert (out["a"].size, out["a"].min_lon, out["a"].max_lat, out["b"].tiles) == (700, -1_000_000_000, 410_000_000, None)


def test_polygons(spark):
    rows = [("a", "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))"), ("b", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5), (5.1 5.1, 5.2 5.1, 5.2 5.2, 5.1 5.1)))")]
    out = readers.wkt_rings(spark.createDataFrame(rows, "ref string, wkt string")).orderBy("ref", "ring_no").collect()
    assert [(r.ref, r.ring_no, r.ring[0].lon) for r in out] == [("a", 0, 0.0), ("b", 0, 0.0), ("b", 1, 5.0)]  # holes are no rings
    with pytest.raises(Exception, match="not a polygon"):
        readers.wkt_rings(spark.createDataFrame([("c", "POINT (1 1)")], "ref string, wkt string")).collect()


def test_other_writers(spark, tmp_path):
    rows = spark.createDataFrame([("a", -80.5, 40.25), ("b", -81.0, 41.0)], "name string, lon double, lat double")
    writers.write_geojson(rows, str(tmp_path / "g"))
    assert sorted(json.loads(r.value)["geometry"]["coordinates"][1] for r in spark.read.text(str(tmp_path / "g")).collect()) == [40.25, 41.0]
    writers.write_chunks(rows, str(tmp_path / "c"))
    assert spark.read.json(str(tmp_path / "c")).count() == 2
    writers.write_dates(spark.createDataFrame([("1950-01-01", "u"), ("1960-01-01", "v")], "key string, url string"), str(tmp_path / "d"))
    assert [r.key for r in spark.read.csv(str(tmp_path / "d"), header=True).collect()] == ["1960-01-01", "1950-01-01"]
    matrix = writers.review_matrix(spark.createDataFrame([("1950", "A", 1, 1, "d/abc.tif"), ("1950", "A", 2, 0, ""), ("1951", "B", 3, 2, "x, y"), ("1951", "A", 4, 1, "d/a name too long.tif")], "date string, location string, line int, num_files int, source_files string"), "line")
    assert [tuple(r) for r in matrix.select("date", "A", "B").collect()] == [("1951", "a name to...", "(2 files)"), ("1950", "---", "---")]


def test_reconciliation(spark):
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    manifest = df([("k1", "A", "d", "e"), ("k2", "A", "d", "e"), ("k3", "B", "d", "e"), ("k4", "B", "x", "e")], "key string, location string, d string, e string")
    up = R.uploaded_keys(manifest, df([("k1",), ("k2",), ("k3",)], "key string")).orderBy("location").collect()
    assert [(r.location, r.key, r["keys"]) for r in up] == [("A", None, ["k1", "k2"]), ("B", "k3", None)]
    audit = R.disk_audit(df([("a", "tif"), ("b", "zip"), ("c", "zip")], "key string, ext string"), df([("a",), ("z",)], "key string"), "key", F.col("ext"))
    assert {(r.side, r.bucket, r.n) for r in audit.collect()} == {("file", "zip", 2), ("row", "missing", 1)}
    shapes = df([("new_york", "whole"), ("new_york_north", "half")], "key string, shape string")
    rows = df([("New York", "x_North.tif"), ("New York", "x-south.tif"), ("Nowhere", "x.tif")], "location string, filename string")
    assert {r.filename: r.shape for r in R.variant_lookup(rows, shapes, "location", "filename").collect()} == {"x_North.tif": "half", "x-south.tif": "whole", "x.tif": None}
    years = R.same_location_year(df([("A", datetime.date(1950, 1, 1)), ("A", datetime.date(1951, 1, 1))], "location string, start date"), df([("A", datetime.date(1950, 6, 1))], "location string, start date"))
    assert sorted((r.start.year, r.collides) for r in years.collect()) == [(1950, True), (1951, False)]
    big = R.largest_sibling(df([("A", 2, 9, "x"), ("A", 1, 5, "y"), ("A", 1, 7, "z")], "location string, cycle int, size int, key string"), "location", "cycle", F.col("size"), "key")
    assert big.first().key == "z"
    known = df([("http://a/x.pdf",), ("http://web/web/20200101000000/http://b/y.pdf",)], "url string")
    found = df([("http://a/x.pdf",), ("http://b/y.pdf",), ("http://c/z.pdf",)], "url string")
    assert [r.url for r in R.new_findings(found, known).collect()] == ["http://c/z.pdf"]
    roles = R.with_decision(df([("a",), ("b",)], "key string"), df([("a", "index")], "key string, role string"), ["key"])
    assert {r.key: r.role for r in roles.collect()} == {"a": "index", "b": "chart"}
    seg = E.with_segment(df([("p", "n")], "page string, name string"), df([("p", "n", 1, "old"), ("p", "n", 2, "new")], "page string, name string, line int, text string"))
    assert seg.first().segment == "new"


def test_resolution_by_containment(spark):
    """Names that no key meets are found inside whole paths, also short ones; the rank prefers paths that hold the stem."""
    rows = spark.createDataFrame([(1, "sub/Alpha.tif"), (2, "lph.zip"), (3, "q.tif"), (4, "zz.tif"), (5, "")], "id int, name string")
    files = spark.createDataFrame([("r/My_Alpha_Sheet.pdf",), ("r/alphabet/x.tif",), ("r/q/other.jpg",)], "path string")
    out = {r.id: r.path for r in R.resolve_files(rows, files, "id", "name").collect()}
    assert out == {1: "r/alphabet/x.tif", 2: "r/alphabet/x.tif", 3: "r/q/other.jpg", 4: None, 5: None}


def test_publication_swaps_all_tables_and_keeps_a_backup(spark, tmp_path):
    root = str(tmp_path / "site")
    site = Publication(spark, root)
    one = lambda v: spark.createDataFrame([(v,)], "v int")
    first = site.publish({"dates": one(1), "charts": one(10)})
    assert not (tmp_path / "site" / PLAN).exists() and [spark.read.parquet(f"{root}/{t}").first().v for t in ("dates", "charts")] == [1, 10]
    second = site.publish({"dates": one(2), "charts": one(20)})
    assert [spark.read.parquet(f"{root}/{t}").first().v for t in ("dates", "charts")] == [2, 20] and [spark.read.parquet(f"{second}/{t}").first().v for t in ("dates", "charts")] == [1, 10]
    assert first != second and not list((tmp_path / "site").glob(".staging-*"))


def test_publication_of_bad_tables_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "site")
    site = Publication(spark, root)
    one = spark.createDataFrame([(1,)], "v int")
    site.publish({"a": one})
    with pytest.raises(ValueError, match="2 rows were written, not 3|1 rows were written, not 3"):
        site.publish({"a": one.unionByName(one), "b": one}, expected={"b": 3})
    broken = spark.createDataFrame([("x",)], "v string").select(F.raise_error("no").alias("v"))
    with pytest.raises(Exception, match="no"):
        site.publish({"a": one.unionByName(one), "b": broken})
    assert spark.read.parquet(f"{root}/a").count() == 1 and not (tmp_path / "site" / "b").exists() and not list((tmp_path / "site").glob(".[sb]*"))


@pytest.mark.parametrize("stop", range(1, 5))
def test_publication_recovers_a_half_done_swap(spark, tmp_path, monkeypatch, stop):
    """Broken off after each of the four renames of two tables, the next run (or recover alone) ends where an unbroken one does."""
    root = str(tmp_path / "site")
    site, moves = Publication(spark, root), []
    one = lambda v: spark.createDataFrame([(v,)], "v int")
    site.publish({"a": one(1), "b": one(10)})
    move = site.files.move

    def breaks(old, new):
        if not new.endswith(PLAN):
            moves.append(new)
            if len(moves) == stop:
                raise OSError("lost")
        move(old, new)

    monkeypatch.setattr(site.files, "move", breaks)
    with pytest.raises(OSError, match="lost"):
        site.publish({"a": one(2), "b": one(20)})
    again = Publication(spark, root)
    assert again.recover() and not again.recover()
    assert [spark.read.parquet(f"{root}/{t}").first().v for t in ("a", "b")] == [2, 20]
    backup = next(p for p in sorted((tmp_path / "site").glob(".backup-*")) if (p / "a").exists())
    assert [spark.read.parquet(f"{backup}/{t}").first().v for t in ("a", "b")] == [1, 10]


def test_publication_of_a_catalogue_and_a_timeline(spark, tmp_path):
    """A10 and A13 under the protocol: rows of CSV and JSON files are counted, also where they have line feeds."""
    rows = spark.createDataFrame([(i, "x\ny" if i else "z", "Town") for i in range(3)], "line long, note string, location string")
    rows = rows.select("line", *[F.col(c) if c in ("note", "location") else F.lit("v").alias(c) for c in CATALOGUE])
    write = lambda df, path: write_catalogue(df, path) if "line" in df.columns else df.write.json(path)
    Publication(spark, str(tmp_path / "s")).publish({"catalogue": rows, "timeline": rows.groupBy("location").count()}, write)
    assert spark.read.csv(str(tmp_path / "s/catalogue"), header=True, multiLine=True, quote='"', escape='"').count() == 3 and spark.read.json(str(tmp_path / "s/timeline")).count() == 1


def test_heads_cost_their_own_bytes(spark, tmp_path):
    """Sparse files of 3 GB are no burden; filters on the path leave files out before any is opened."""
    for n in ("a", "b", "sub/c"):
        p = tmp_path / "t" / f"{n}.pmtiles"
        p.parent.mkdir(parents=True, exist_ok=True)
        with open(p, "wb") as f:
            f.write(b"PMTiles" + bytes([3]) + struct.pack("<9Q", *range(127, 136)) + bytes(22) + struct.pack("<4i", -10, 20, 30, -40) + bytes(9))
            f.truncate(3 << 30)
    (tmp_path / "t" / "short.pmtiles").write_bytes(b"PMTiles")
    got = {r.key: r for r in readers.archive_headers(spark, str(tmp_path / "t")).collect()}
    assert set(got) == {"a", "b", "c", "short"} and got["a"].size == 3 << 30 and got["short"].root_offset is None
    assert (got["c"].root_offset, got["c"].tiles, got["c"].min_lon, got["c"].max_lat) == (127, 135, -10, -40)
    (tmp_path / "t" / "b.pmtiles").chmod(0)
    some = file_heads(spark, f"file://{tmp_path}/t", "*.pmtiles|*.other", files_per_task=1).where(F.col("path").endswith("c.pmtiles"))
    assert [(r.path.rpartition("/")[2], r.size, len(r.head)) for r in some.collect()] == [("c.pmtiles", 3 << 30, 127)] and some.rdd.getNumPartitions() == 1
    assert file_heads(spark, str(tmp_path / "t"), "*.none").count() == 0


def test_geojson_rings(spark):
    square = lambda x: [[x, 0.0], [x + 1, 0.0], [x + 1, 1.0], [x, 0.0]]
    hole = [[0.2, 0.2], [0.3, 0.2], [0.3, 0.3], [0.2, 0.2]]
    texts = {
        "bare": {"type": "Polygon", "coordinates": [square(0), hole]}, "one": {"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": [[square(0), hole], [square(5)]]}},
        "many": {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [square(2)]}}, {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[square(3)], [square(4)]]}}]},
    }
    rows = spark.createDataFrame([(k, json.dumps(v)) for k, v in texts.items()] + [("null", None)], "ref string, geojson string")
    got = sorted((r.ref, r.ring_no, r.ring[0].lon, len(r.ring)) for r in readers.geojson_rings(rows).collect())
    assert got == [("bare", 0, 0.0, 4), ("many", 0, 2.0, 4), ("many", 1, 3.0, 4), ("many", 2, 4.0, 4), ("one", 0, 0.0, 4), ("one", 1, 5.0, 4)]
    with pytest.raises(Exception, match="not a polygon: Point"):
        readers.geojson_rings(spark.createDataFrame([("x", '{"type": "Point", "coordinates": [1, 2]}')], "ref string, geojson string")).collect()
