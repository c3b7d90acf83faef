"""Column expressions on hand-made rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from strataflow.functions import expr as X
from strataflow.functions import geo as G


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'double' if isinstance(v, float) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items()) or "z string"
    return spark.createDataFrame([tuple(values.values()) or ("",)], schema).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("raw,wanted", [(" 1.5 ", 1.5), ("", None), (None, None), ("x", None), ("nan", None), ("inf", None)])
def test_number(spark, raw, wanted):
    assert one(spark, X.number("a"), a=raw) == wanted


@pytest.mark.parametrize("raw,wanted", [("90", 90), ("450.0", 90), ("-90", 270), ("45", 0), ("", 0), ("x", 0)])
def test_rotation(spark, raw, wanted):
    assert one(spark, X.rotation("a"), a=raw) == wanted


@pytest.mark.parametrize("turn", [0, 90, 180, 270])
def test_frames_round_trip(spark, turn):
    df = spark.createDataFrame([(3.0, 5.0, 20, 10, turn)], "x double, y double, w int, h int, t int")
    d = df.withColumn("d", X.to_display("x", "y", "w", "h", "t")).withColumn("r", X.to_raw("d.x", "d.y", "w", "h", "t")).first()
    assert (d["r"]["x"], d["r"]["y"]) == (3.0, 5.0)
    size = df.select(X.turned_size("w", "h", "t").alias("s")).first()["s"]
    assert 0 <= d["d"]["x"] <= size["w"] and 0 <= d["d"]["y"] <= size["h"]


@pytest.mark.parametrize("raw,wanted", [("1950-03-04", "1950-03-04"), ("1950/3/4", "1950-03-04"), ("1950-03-04T05:06:07Z", "1950-03-04"), ("1950-03-04T23:30:00-05:00", "1950-03-04"), ("March", None), ("", None)])
def test_dates(spark, raw, wanted):
    got = one(spark, X.parse_date("a"), a=raw)
    assert (got and got.isoformat()) == wanted


def test_keys(spark):
    assert one(spark, X.validity_key("a", "b"), a="1950-01-01", b="1951-01-01") == "1950-01-01_to_1951-01-01"
    assert one(spark, X.validity_key("a", "b"), a="1950-01-01", b="") == "1950-01-01"
    k = one(spark, X.key_dates("a"), a="1950-01-01_to_1951-01-01")
    assert (k["start"], k["end"], k["decade"]) == (datetime.date(1950, 1, 1), datetime.date(1951, 1, 1), "1950s")
    assert one(spark, X.key_dates("a"), a="undated_x")["start"] is None
    assert one(spark, X.chart_key("l", "d", "f"), l="St. Louis", d="1950-01-01", f="a b-North.tif") == "chart/st_louis/1950-01-01-north"
    assert one(spark, X.chart_key("l", "d", "f"), l="Zürich", d="1950-01-01", f="a.tif") is None


def test_note(spark):
    n = one(spark, X.note_gap("a"), a="latest-in-collection; L B GAP 400d before next (1951-02-03); typ80d")
    assert (n["latest"], n["blank_map"], n["days"], n["next"], n["typical"], n["missing"]) == (True, False, 400, datetime.date(1951, 2, 3), 80, 4)
    assert one(spark, X.note_gap("a"), a="GAP 40d before next (1951-02-03); typ0d")["missing"] is None


def test_idents_and_names(spark):
    assert one(spark, X.title_idents("a"), a="Old Field (NAS / 3C2, ABC) (original)") == ["3C2", "ABC"]
    assert one(spark, X.name_tokens("a"), a="Smith Municipal Airport (X01)") == ["smith"]
    assert one(spark, X.decimals("a"), a="42.500") == 1 and one(spark, X.decimals("a"), a="42") == 0
    assert one(spark, X.dms("a"), a="N4030300") == pytest.approx(40.508333, abs=1e-6)
    assert one(spark, X.dms("a", 3), a="W10030000") == pytest.approx(-100.5)


def test_ranges_and_issues(spark):
    assert one(spark, X.byte_range("a"), a="bytes=10-19")["size"] == 10
    assert one(spark, X.byte_range("a"), a="bytes=10-") is None and one(spark, X.byte_range("a"), a="bytes=9-1") is None
    assert one(spark, X.row_issues("l", "s", "e"), l="", s="x", e="1950-01-01") == ["missing location"]
    assert one(spark, X.row_issues("l", "s", "e"), l="a", s="1951-01-01", e="1950-01-01") == ["end_date before date"]
    assert one(spark, X.row_issues("l", "s", "e"), l="a", s="", e="x") == ["invalid end_date"] and one(spark, X.row_issues("l", "s", "e"), l="a", s="", e="") == []
    assert one(spark, X.end_missing("s", "e"), s="1951-01-01", e="") is True and one(spark, X.end_missing("s", "e"), s="", e="") is False
    assert one(spark, X.edition_or_unknown("n"), n=" ") == "Unknown"


def test_projection_round_trip(spark):
    df = spark.createDataFrame([(-97.3, 41.2), (-80.0, 33.5)], "lon double, lat double")
    cone = [F.lit(x) for x in (33.0, 45.0, 39.0, -96.0)]
    xy = df.withColumn("p", G.lcc_forward("lon", "lat", *cone)).withColumn("q", G.lcc_inverse("p.x", "p.y", *cone))
    for r in xy.collect():
        assert r["q"]["lon"] == pytest.approx(r["lon"], abs=1e-9) and r["q"]["lat"] == pytest.approx(r["lat"], abs=1e-9)


def test_haversine(spark):
    assert one(spark, G.haversine_km("a", "b", "c", "d"), a=0.0, b=0.0, c=0.0, d=1.0) == pytest.approx(111.195, abs=1e-2)


def test_titles(spark):
    t = one(spark, X.split_title("a", "s"), a="Old Field / (X) / Smith AAF, Old Town, ST.", s="ST")
    assert (t["aliases"], t["city"]) == (["Smith AAF"], "Old Town")  # no words but stop words in the first, none in the second
    t = one(spark, X.split_title("a", "s"), a="Smith / Jones", s="")
    assert (t["aliases"], t["city"]) == (["Smith", "Jones"], "")
    assert one(spark, X.clean_title("a"), a="_ A\n B (revised 3/15) -") == "A B" and one(spark, X.clean_title("a"), a="A; revised 12/2001") == "A"


def test_archives(spark):
    at = dict(r=127, rn=100, m=300, mn=50, le=350, ln=50, t=400, z=1000)
    length = X.prefix_length("r", "rn", "m", "mn", "le", "ln", "t", "z")
    assert one(spark, length, **at) == 400 and one(spark, length, **at | dict(le=350, ln=300_000, t=300_350, z=400_000)) == 350
    assert one(spark, length, **at | dict(ln=0, t=300_000, z=400_000)) == 300_000  # no leaves: nothing to leave out
    assert [one(spark, length, **at | d) for d in (dict(r=126), dict(m=200), dict(le=349), dict(t=399), dict(z=399))] == [None] * 5
    box = lambda *b: one(spark, X.header_bounds("w", "s", "e", "n"), **dict(zip("wsen", b, strict=True)))
    assert box(-10_000_001, -5, 20_000_001, 5) == [-1.01, -0.01, 2.01, 0.01] and box(0, 0, 10, 870_000_000) is None and box(5, 0, 5, 1) is None


def test_claim_strength(spark):
    how = {"dole location/date x 1950-01-01": 1, "rawtiffs cycle c has x": 2, "dole sectional_files x ed 3": 2, "rawtiffs x": 3, "basename x in rawtiffs": 3, "": 3}
    assert [one(spark, X.match_confidence("a"), a=h) for h in how] == list(how.values())
    assert [one(spark, X.extension_rank("a"), a=f"x{e}") for e in (".TIF", ".pdf", ".png", ".jp2", ".zip", "")] == [0, 1, 2, 4, 3, 4]


def test_pixels_and_lists(spark):
    df = spark.createDataFrame([([0, 257, 65535, 300], ["b", "a", "b"])], "p array<int>, l array<string>")
    assert df.select(X.rescaled_8bit("p").alias("r")).first()["r"] == [0, 1, 255, 1] and df.select(X.inverted_8bit(X.rescaled_8bit("p")).alias("r")).first()["r"] == [255, 254, 0, 254]
    assert df.select(X.distinct_in_order("l").alias("r")).first()["r"] == ["b", "a"]
