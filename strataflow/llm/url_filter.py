"""URL filters: host-suffix and path-prefix expressions, joined to rules on short hash prefixes and confirmed by full digests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import lower_ascii, small_enough

#: Hex digits of the digest that the join compares; the full digest is compared afterwards.
PREFIX_HEX = 8
#: For rules too many to broadcast: each rule is repeated so often, so that a hash prefix that most pages share is spread over tasks.
SALTS = 16


def split_url(url):
    """Columns (host, path): after the first `://` up to `/ ? #`, A-Z lower-cased; then up to `? #`. Both empty without `://` or for null."""
    url = F.coalesce(url, F.lit(""))
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    return lower_ascii(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict.

    rules has host, path and verdict (allow or block). A rule fits its host and all subdomains if the path starts with the rule's; the
    longest rule (host and path together) wins, block before allow between rules equal in host and path. Without a fitting rule, rule
    is null and verdict is `default`. Null or schemeless urls have an empty host, which no rule fits. Rules with nulls are left out, repeated ones count once;
    empty rules or pages work. Repeated pages are judged one by one, urls of any length whole. Columns of pages named like the new four are replaced.

    Expressions are built only for those label counts and path lengths that rules have (distinct lists, as short as the longest rule), so a
    page makes (rule label counts) x (rule path lengths) rows at most, however long its host is; they meet the rules on PREFIX_HEX digits of SHA-256. The rules are
    broadcast only if a count shows that they are few; else they are shuffled, salted against hash prefixes that most pages share.
    Partial aggregation folds a page's rows back into one before the only shuffle of the usual plan.
    """
    new = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c not in new]
    rules = rules.select("host", "path", "verdict").dropna()
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    counts = [r[0] for r in rules.select(_labels("host")).distinct().collect()]
    listed = (
        rules.groupBy("host", "path").agg(F.max("verdict").alias("said"))  # block comes after allow
        .select("said", F.concat("host", "path").alias("said_by"), F.length("host").alias("host_length"), _digest(F.col("host"), F.col("path")).alias("full_rule"))
        .withColumn("short", F.substring("full_rule", 1, PREFIX_HEX))
    )
    host, path = split_url(F.col(f"`{url}`"))
    base = pages.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("page"), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row"))
    hosts = F.array_compact(F.array(*[F.when(_labels("host") >= n, F.substring_index("host", ".", -n)) for n in sorted(counts)], F.lit(None).cast("string")))
    paths = F.array_compact(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths)], F.lit(None).cast("string")))
    asked = (
        base.withColumn("h", F.explode_outer(hosts)).withColumn("p", F.explode_outer(paths))
        .withColumn("full", _digest(F.col("h"), F.col("p"))).withColumn("short", F.substring("full", 1, PREFIX_HEX)).drop("h", "p")
    )
    if small_enough(listed, 200_000):
        met = asked.join(F.broadcast(listed), "short", "left")
    else:
        salted = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = asked.withColumn("salt", (F.col("row") % SALTS).cast("int")).join(salted, ["short", "salt"], "left")
    fit = F.when(F.col("full") == F.col("full_rule"), F.struct(F.length("said_by"), "host_length", "said_by", "said"))
    best = met.groupBy("row").agg(F.any_value("page").alias("page"), F.any_value("host").alias("host"), F.any_value("path").alias("path"), F.max(fit).alias("best"))
    out = best.select(*[F.col(f"page.c{i}") for i in range(len(kept))], "host", "path", F.col("best.said_by"), F.coalesce("best.said", F.lit(default)))
    return out.toDF(*kept, *new)


def _labels(host: str):
    return F.length(host) - F.length(F.replace(F.col(host), F.lit("."))) + 1


def _digest(host, path):
    """SHA-256 of an expression; line feeds can't be confused with what they part, as the host's length leads."""
    return F.sha2(F.concat(F.length(host).cast("string"), F.lit(":"), host, path).cast("binary"), 256)
