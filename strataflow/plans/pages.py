"""Queries on page text, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.operators import pages as P
from strataflow.plans.timeline import spread, table


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url", "html")


def page_text(spark, sf_dir):
    out = P.page_streams(_pages(spark, sf_dir))
    return out.select("page_id", "title", F.length("page_text").cast("long").alias("chars"), F.md5(F.col("page_text").cast("binary")).alias("page_md5"), F.md5(F.col("stream").cast("binary")).alias("stream_md5"))


def page_anchors(spark, sf_dir):
    """Anchors of pages whose links are read as named anchors, at their offsets in the text."""
    named = _pages(spark, sf_dir).withColumn("html", F.regexp_replace("html", 'href="/', 'name="'))
    return P.page_streams(named).select("page_id", F.posexplode("anchors").alias("place", "a")).select("page_id", "place", F.col("a.offset").alias("text_offset"), F.col("a.name").alias("name"))


def page_links(spark, sf_dir):
    linked = _pages(spark, sf_dir).withColumn("html", F.regexp_replace("html", 'href="/([^".,]*)[^"]*"', 'HREF="x/$1.HTM"'))
    return P.link_set(linked, "page_id")


def text_chunks(spark, sf_dir):
    out = P.chunks(table(spark, sf_dir, "documents"), "doc_id")
    return out.select("doc_id", "chunk", "id", F.length("text").cast("long").alias("chars"), F.md5(F.col("text").cast("binary")).alias("md5"))


def text_sections(spark, sf_dir):
    """Documents parted at full stops, question and exclamation marks with the white space after them."""
    out = P.sections(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", r"[.!?]+[ \n]+")
    return out.select("doc_id", "section", "section_start", F.length("section_text").alias("chars"), F.md5(F.col("section_text").cast("binary")).alias("md5"))


_HUNDREDTHS = "10 * 100 + (c_custkey * 37) % 7000 AS la, 50 * 100 + (c_custkey * 91) % 14000 AS lo"
_TWO = "lpad(CAST({0} % 100 AS VARCHAR(2)), 2, '0')"


def _placed(spark, sf_dir):
    """Customers with hundredths of a latitude and a longitude, and the texts `12.34` of both."""
    c = spread(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey").select("c_custkey", (1000 + F.col("c_custkey") * 37 % 7000).alias("la"), (5000 + F.col("c_custkey") * 91 % 14000).alias("lo"))
    number = lambda x: F.concat(F.expr(f"cast({x} div 100 as string)"), F.lit("."), F.lpad((F.col(x) % 100).cast("string"), 2, "0"))
    return c.withColumn("lat_s", number("la")).withColumn("lon_s", number("lo"))


def coordinate_pairs(spark, sf_dir):
    """Pairs found in one sentence for each customer; every third latitude is broken by a line feed, every other pair is written with compass points."""
    c = _placed(spark, sf_dir)
    lat = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.substring("lat_s", 1, 4), F.lit("\n"), F.expr("substring(lat_s, 5)"))).otherwise(F.col("lat_s"))
    pair = F.when(F.col("c_custkey") % 2 == 0, F.concat(lat, F.lit(", -"), "lon_s")).otherwise(F.concat(lat, F.lit(" North / "), "lon_s", F.lit(" West")))
    text = F.concat(F.lit("Field "), F.col("c_custkey").cast("string"), F.lit(", 1944\n"), pair, F.lit(" (West of 12, X)"))
    out = c.select("c_custkey", F.explode(P.coordinates(text)).alias("h"))
    return out.select("c_custkey", "h.pos", F.col("h.end").alias("stop"), "h.lat", "h.lon", "h.style")


def index_entries(spark, sf_dir):
    """An entry for each customer whose pair is plausible: a section with an anchor before it, every fifth with a stray pair first, some with a revision date, some without a parenthesis."""
    c = _placed(spark, sf_dir)
    key = F.col("c_custkey")
    stray = F.when(key % 5 == 0, "40.5, -90.25\n").otherwise("")
    revised = F.when(key % 4 == 0, " (revised 3/15)\n").otherwise(" -\n")
    where = F.when(key % 7 == 0, "").otherwise(" (West\nof Town)")
    text = F.concat(F.lit(" \n"), stray, F.lit("Smith  Field "), key.cast("string"), F.lit(",\nTown"), revised, "lat_s", F.lit(", -"), "lon_s", where, F.lit(" text"))
    anchors = F.expr("array(named_struct('offset', cast(300 as int), 'name', 'far'), named_struct('offset', cast(450 as int), 'name', 'near'), named_struct('offset', cast(9000 as int), 'name', 'after'))")
    parts = c.select("c_custkey", text.alias("section_text"), F.lit(500).alias("section_start"), anchors.alias("anchors"))
    return P.entries(parts).select("c_custkey", "name", "lat", "lon", "anchor", "rel_location", "coord_style", "extra_coord_matches")


def image_references(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.concat_ws("", F.lit('<IMG src="a/../b%20'), "c_custkey", F.lit('.gif"><img alt=x src=\'./c.png\'><img src="http://x/y.gif"><img src="../../../out.gif"><img src="'), F.when(F.col("c_custkey") % 2 == 0, "../up.gif").otherwise("c.png"), F.lit('">')).alias("html"), F.lit("st/deep").alias("folder"))
    return c.select("c_custkey", F.concat_ws("|", P.image_refs("html", "folder")).alias("images"))


def _histories(spark, sf_dir):
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.year(F.col("o_orderdate").cast("date")).alias("y")), "o_orderkey")
    year = lambda n: (F.col("y") + n).cast("string")
    said = [
        F.concat(F.lit("The airport was\nbuilt in "), year(0), F.lit(". The airport was closed in "), year(3), F.lit(" & "), year(4), F.lit(". End")),
        F.concat(F.lit("The earliest known depiction was a "), year(0), F.lit(" chart. The last photo was from "), year(2), F.lit(". End")),
        F.concat(F.lit("It was not yet depicted on the "), year(0), F.lit(" map. "), F.lit("x" * 130), F.lit(". The field was no longer depicted in "), year(5), F.lit(". End")),
        F.concat(F.lit("The hangar was closed in "), year(0), F.lit(". "), F.lit("x" * 60), F.lit(". Runway 9/27 remains. It was abandoned in "), year(1), F.lit(". End")),
        F.concat(F.lit("The last photo was a "), year(9), F.lit(" view of the abandoned site. "), F.lit("x" * 90), F.lit(". The strip was still listed in the 3/95 directory. End")),
        F.lit(None).cast("string"),
    ]
    text = said[5]
    for k in range(5):
        text = F.when(F.col("o_orderkey") % 6 == k, said[k]).otherwise(text)
    return P.with_evidence(o.withColumn("text", text).withColumn("words", F.array(F.lit("smith"))), "text", "words")


def dated_evidence(spark, sf_dir):
    """What a text for each order says of a field's years."""
    return _histories(spark, sf_dir).select("o_orderkey", "found.*")


def lifespans(spark, sf_dir):
    """Start, end and status from that evidence; finished orders stand for fields of the 1988 list, pending ones for open fields."""
    h = _histories(spark, sf_dir)
    return h.select("o_orderkey", P.lifespan("found", F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P").alias("l")).select("o_orderkey", "l.*")


QUERIES = {f.__name__: f for f in (page_text, page_anchors, page_links, text_chunks, text_sections, coordinate_pairs, index_entries, image_references, dated_evidence, lifespans)}

_DECODED = "replace(replace(replace(replace({0}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"
_TRIM = "trim({0}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160))"
_STRINGS = "list_filter(list_transform(string_split({0}, chr(1)), lambda x: " + _TRIM.format(_DECODED.format("replace(x, chr(4), '\"</p>\"')")) + "), lambda x: x <> '')"
_MARKUP = r"(?s)<!--.*?-->|<[!/a-zA-Z][^>]*>"
_CODE = r"(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"
_PLACED = f"p AS (SELECT c_custkey, la, lo, (la // 100) || '.' || {_TWO.format('la')} AS lat_s, (lo // 100) || '.' || {_TWO.format('lo')} AS lon_s FROM (SELECT c_custkey, {_HUNDREDTHS} FROM customer))"
_EVIDENCE = """e AS (SELECT o_orderkey, o_orderstatus, CASE WHEN k = 1 THEN y END AS earliest, CASE WHEN k = 0 THEN y END AS built, CASE WHEN k = 2 THEN y END AS notyet, CASE WHEN k = 2 THEN y + 5 END AS nolonger,
  CASE WHEN k = 1 THEN y + 2 WHEN k = 4 THEN 1995 END AS lastseen, CASE WHEN k = 0 THEN y + 4 WHEN k = 3 THEN y + 1 END AS closed
  FROM (SELECT o_orderkey, o_orderstatus, o_orderkey % 6 AS k, CAST(year(CAST(o_orderdate AS DATE)) AS INTEGER) AS y FROM orders))"""

ORACLE = {
    "page_text": f"""WITH s AS (SELECT page_id, coalesce(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '') AS title,
  {_STRINGS.format(f"regexp_replace(regexp_replace(coalesce(html, ''), '{_CODE}', chr(1), 'g'), '{_MARKUP}', chr(1), 'g')")} AS body,
  {_STRINGS.format(f"regexp_replace(replace(coalesce(html, ''), '\"</p>\"', chr(4)), '{_MARKUP}', chr(1), 'g')")} AS every FROM pages),
t AS (SELECT page_id, {_TRIM.format(_DECODED.format("title"))} AS title, array_to_string(body, chr(10)) AS body, array_to_string(every, chr(10)) AS stream FROM s)
SELECT page_id, title, length('# ' || title || chr(10) || chr(10) || body) AS chars, md5('# ' || title || chr(10) || chr(10) || body) AS page_md5, md5(stream) AS stream_md5 FROM t""",
    "page_anchors": f"""WITH m AS (SELECT page_id, string_split(regexp_replace(regexp_replace(replace(html, '"</p>"', chr(4)), '<a href="/([^"]*)">', chr(1) || chr(2) || '\\1' || chr(1), 'g'), '{_MARKUP}', chr(1), 'g'), chr(1)) AS l FROM pages),
u AS (SELECT page_id, unnest(l) AS x, unnest(range(len(l))) AS i FROM m),
t AS (SELECT page_id, i, x LIKE chr(2) || '%' AS is_anchor, {_TRIM.format(_DECODED.format("replace(replace(x, chr(2), ''), chr(4), '\"</p>\"')"))} AS x FROM u),
o AS (SELECT *, sum(CASE WHEN NOT is_anchor AND x <> '' THEN length(x) + 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM t)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS place, CAST(greatest(coalesce(before, 0) - 1, 0) AS INTEGER) AS text_offset, x AS name FROM o WHERE is_anchor AND x <> ''""",
    "page_links": """SELECT DISTINCT page_id, lower(l) || '.htm' AS link FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="/([^".,]*)[^"]*"', 1)) AS l FROM pages)""",
    "text_chunks": r"""WITH RECURSIVE w(doc_id, t, n, s, e) AS (
  SELECT doc_id, text, length(text), 0, CASE WHEN length(text) <= 3000 THEN length(text) WHEN substr(text, 1, 3000) LIKE '_% %' THEN 3000 - strpos(reverse(substr(text, 1, 3000)), ' ') ELSE 3000 END FROM documents WHERE text <> ''
  UNION ALL
  SELECT doc_id, t, n, b, CASE WHEN b + 3000 >= n THEN n WHEN substr(t, b + 1, 3000) LIKE '_% %' THEN b + 3000 - strpos(reverse(substr(t, b + 1, 3000)), ' ') ELSE b + 3000 END
  FROM (SELECT *, CASE WHEN e - 300 > s THEN e - 300 ELSE e END AS b FROM w WHERE e < n)),
p AS (SELECT doc_id, s, trim(substr(t, s + 1, e - s), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x FROM w)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INTEGER) AS chunk, doc_id || ':::' || (row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1) AS id, length(x) AS chars, md5(x) AS md5 FROM p WHERE x <> ''""",
    "text_sections": r"""WITH l AS (SELECT doc_id, string_split_regex(text, '[.!?]+[ \n]+') AS p, list_transform(regexp_extract_all(text, '[.!?]+[ \n]+'), lambda g: length(g)) AS g FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, unnest(p) AS x, unnest(list_append(g, 0)) AS gap, unnest(range(len(p))) AS section FROM l)
SELECT doc_id, CAST(section AS INTEGER) AS section, CAST(coalesce(sum(length(x) + gap) OVER (PARTITION BY doc_id ORDER BY section ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS section_start, CAST(length(x) AS INTEGER) AS chars, md5(x) AS md5 FROM u""",
    "coordinate_pairs": f"""WITH {_PLACED}, q AS (SELECT *, length('Field ' || c_custkey || ', 1944' || chr(10)) AS pre, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS gap FROM p WHERE la BETWEEN 1500 AND 7500 AND lo BETWEEN 6000 AND 18000)
SELECT c_custkey, CAST(pre AS INTEGER) AS pos, CAST(pre + length(lat_s) + gap + length(lon_s) + CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 14 END AS INTEGER) AS stop, CAST(lat_s AS DOUBLE) AS lat, -CAST(lon_s AS DOUBLE) AS lon,
  CASE WHEN c_custkey % 2 = 0 THEN 'decimal' ELSE 'north_west' END AS style FROM q""",
    "index_entries": f"""WITH {_PLACED} SELECT c_custkey, 'Smith Field ' || c_custkey || ', Town' AS name, CAST(lat_s AS DOUBLE) AS lat, -CAST(lon_s AS DOUBLE) AS lon, 'near' AS anchor, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'West of Town' END AS rel_location,
  'decimal' AS coord_style, CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS extra_coord_matches FROM p WHERE la BETWEEN 1500 AND 7500 AND lo BETWEEN 6000 AND 18000""",
    "image_references": "SELECT c_custkey, 'st/deep/b ' || c_custkey || '.gif|st/deep/c.png' || CASE WHEN c_custkey % 2 = 0 THEN '|st/up.gif' ELSE '' END AS images FROM customer",
    "dated_evidence": f"WITH {_EVIDENCE} SELECT * EXCLUDE (o_orderstatus) FROM e",
    "lifespans": f"""WITH {_EVIDENCE}, s AS (SELECT *, coalesce(least(built, earliest), notyet + 1) AS s0, CASE WHEN built IS NOT NULL THEN 'built' WHEN earliest IS NOT NULL THEN 'earliest' WHEN notyet IS NOT NULL THEN 'after_absence' END AS sb,
  coalesce(closed, nolonger, lastseen) AS e0, CASE WHEN closed IS NOT NULL THEN 'closed_stated' WHEN nolonger IS NOT NULL THEN 'no_longer_by' WHEN lastseen IS NOT NULL THEN 'last_seen' END AS eb FROM e),
t AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' AND s0 > 1988 THEN 1988 ELSE s0 END AS s1, CASE WHEN o_orderstatus = 'F' AND s0 > 1988 THEN 'faa1988_listed' ELSE sb END AS sb,
  CASE WHEN e0 IS NULL AND o_orderstatus = 'F' THEN 1988 ELSE e0 END AS e1, CASE WHEN e0 IS NULL AND o_orderstatus = 'F' THEN 'faa1988_listed' ELSE eb END AS eb FROM s)
SELECT o_orderkey, s1 AS start_year, sb AS start_basis, CASE WHEN o_orderstatus = 'P' OR e1 < s1 THEN NULL ELSE e1 END AS end_year,
  CASE WHEN o_orderstatus = 'P' THEN 'oa_open' WHEN e1 < s1 THEN 'conflict' ELSE eb END AS end_basis, CASE WHEN o_orderstatus = 'P' THEN 'open' WHEN e1 < s1 OR e1 IS NULL THEN 'unknown' ELSE 'gone' END AS status FROM t""",
}
