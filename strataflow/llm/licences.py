"""License scans: TF-IDF cosine of lines and whole files to templates, then inheritance from the nearest directory with a licence file."""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import attach, discard, written

#: Statements of common licences, by SPDX name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
#: Whole licence texts, by SPDX name. Only whole files are compared with them.
TEXTS = {p.stem: p.read_text("utf-8") for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}
#: Least cosine of a header line, and of a whole file that counts as a licence file.
HEADER_COSINE, FILE_COSINE = 0.8, 0.5
_SEPARATORS = "[^0-9a-z]+"


def words_of(c):
    """Words of a column: lower case, runs of 0-9 and a-z."""
    return F.filter(F.split(F.lower(c), _SEPARATORS), lambda w: w != "")


def _template_words(templates: dict[str, str]) -> dict[str, dict[str, int]]:
    out = {}
    for name, text in templates.items():
        words = [w for w in re.split(_SEPARATORS, text.lower()) if w]
        out[name] = {w: words.count(w) for w in words}
    return out


def idf(n: int, df: int) -> float:
    return math.log((1 + n) / (1 + df)) + 1


def scan_licences(files: DataFrame, path: str = "path", text: str = "text", templates: dict[str, str] | None = None, texts: dict[str, str] | None = None) -> DataFrame:
    """files without their text, with header_license, header_score, file_license, file_score, inherited_license, inherited_from, license and basis.

    Vectors: term count times idf, idf = ln((1 + n) / (1 + df)) + 1 over all files with text, for every word of a file, of a template or
    not. header_license is the template with the greatest cosine to any line, or to a line and the next one together (a statement may be wrapped), if that is
    HEADER_COSINE or more; file_license the template or licence text with the greatest cosine to the whole text, if FILE_COSINE or more
    (ties: smaller name). A file with
    file_license is a licence file and governs its directory and all below that have none nearer; several in a directory: the smallest
    path. license is header's, else the file's own, else the inherited one; basis says which (header, file, inherited, none).

    Null or empty texts match nothing but inherit; null paths are the root directory. Texts are taken whole, however long. Repeated rows give a row each. Columns of files
    named like the new eight are replaced; empty input gives an empty result.

    What is found in a text is brought back to its rows by the text's SHA-256, so it doesn't matter in which order rows are read again.

    Only texts and lines are scanned that hold a word without which no cosine can reach the threshold (by Cauchy-Schwarz, a template's
    commonest words may add up to less, and are not looked for); their words go through a join with the templates' postings. Document frequencies are counted once for all words, with partial aggregation, and only those of template words reach the
    driver; the words of scanned texts get theirs by a join in which common words are broadcast. Directories are expanded to ancestors once each.
    """
    new = ["header_license", "header_score", "file_license", "file_score", "inherited_license", "inherited_from", "license", "basis"]
    kept = [c for c in files.columns if c not in [*new, text]]
    spark, of_line, of_file = files.sparkSession, _template_words(templates or TEMPLATES), _template_words(TEXTS if texts is None else texts)
    vocabulary = sorted({w for words in [*of_line.values(), *of_file.values()] for w in words})
    at = F.coalesce(F.col(f"`{path}`").cast("string"), F.lit(""))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    base = files.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("own"), at.alias("at"), body.alias("body")).withColumn("digest", F.sha2("body", 256))
    dfs = written(base.where("body <> ''").select(F.explode(F.concat(F.array(F.lit("")), F.array_distinct(words_of("body")))).alias("w")).groupBy("w").agg(F.count("*").alias("df")), "licence-dfs")
    df = {r["w"]: r["df"] for r in dfs.where(F.col("w").isin(["", *vocabulary])).collect()}  # a row for each template word, and "" for the files
    n = df.get("", 0)
    weight = {w: idf(n, df.get(w, 0)) for w in vocabulary}

    postings, in_lines, in_files = [], set(), set()
    for name, words, is_line in [*((k, v, True) for k, v in of_line.items()), *((k, v, False) for k, v in of_file.items())]:
        norm = math.sqrt(sum((k * weight[w]) ** 2 for w, k in words.items()))
        postings += [(w, name, is_line, k * weight[w] / norm) for w, k in words.items()]
        passed = 0.0
        for w, k in sorted(words.items(), key=lambda x: (-df.get(x[0], 0), x[0])):
            passed += (k * weight[w] / norm) ** 2
            if is_line and passed >= (HEADER_COSINE - 1e-6) ** 2:
                in_lines.add(w)
            if passed >= (FILE_COSINE - 1e-6) ** 2:
                in_files.add(w)
    holds = lambda c, words: F.exists(words_of(c), lambda w: w.isin(sorted(words)))
    posted = F.broadcast(spark.createDataFrame(postings, "w string, template string, is_line boolean, t double"))

    # a row's number tells copies of a text apart within this one plan
    found = base.where(holds("body", in_lines | in_files)).select("digest", F.monotonically_increasing_id().alias("row"), "body")
    lines = F.split("body", "\n")
    single = F.transform(lines, lambda x, i: F.struct((2 * i).alias("pos"), x.alias("col")))
    double = F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), lambda x, i: F.struct((2 * i + 1).alias("pos"), F.concat(F.get(lines, i), F.lit(" "), x).alias("col")))
    parts = F.concat(F.array(F.struct(F.lit(-1).alias("pos"), F.col("body").alias("col"))), single, double)
    units = found.select("digest", "row", F.explode(parts).alias("u")).select("digest", "row", "u.pos", "u.col").where(F.when(F.col("pos") == -1, holds("col", in_files)).otherwise(holds("col", in_lines)))
    counted = written(units.select("digest", "row", "pos", F.explode(words_of("col")).alias("w")).groupBy("digest", "row", "pos", "w").agg(F.count("*").alias("tf")), "licence-terms")
    used = counted.groupBy("w").agg(F.count("*").alias("uses")).join(dfs, "w")
    used = written(used.select("w", "uses", (F.log(F.lit(float(1 + n)) / (F.col("df") + 1)) + 1).alias("idf")), "licence-idfs")
    terms = attach(counted, used, "w", "uses").withColumn("v", F.col("tf") * F.col("idf"))
    norms = Window.partitionBy("digest", "row", "pos")
    scored = (
        terms.withColumn("norm", F.sqrt(F.sum(F.col("v") * F.col("v")).over(norms))).join(posted, "w").where("is_line or pos = -1")
        .groupBy("digest", "row", "pos", "template", "is_line").agg((F.sum(F.col("v") * F.col("t")) / F.max("norm")).alias("cosine"))
    )
    scored = scored.withColumn("cosine", F.round("cosine", 6)).withColumn("whole", F.col("pos") == -1)
    scored = scored.where(F.col("cosine") >= F.when(F.col("whole"), FILE_COSINE).otherwise(HEADER_COSINE))
    best = lambda whole: F.min(F.when(F.col("whole") == whole, F.struct((-F.col("cosine")).alias("minus"), "template")))
    licensed = written(scored.groupBy("digest").agg(best(False).alias("h"), best(True).alias("f"), F.count_distinct("row").alias("copies")), "licence-found")

    narrow = base.select("digest", "own", "at", F.regexp_replace("at", "/?[^/]*$", "").alias("dir"))
    rows = written(
        attach(narrow, licensed, "digest", "copies").select("own", "at", "dir", F.col("h.template").alias("header_license"), (-F.col("h.minus")).alias("header_score"), F.col("f.template").alias("file_license"), (-F.col("f.minus")).alias("file_score")),
        "licences",
    )
    governs = rows.where("file_license is not null").groupBy("dir").agg(F.min(F.struct("at", "file_license")).alias("g")).select(F.col("dir").alias("above"), F.col("g.file_license").alias("inherited_license"), F.col("g.at").alias("inherited_from"))
    dirs = written(rows.groupBy("dir").agg(F.count("*").alias("n")), "licence-dirs")
    names = F.split("dir", "/")
    above = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(names)), lambda i: F.array_join(F.slice(names, 1, i), "/")))
    nearest = (
        dirs.select("dir", "n", F.explode(F.array_distinct(above)).alias("above")).join(governs, "above")
        .groupBy("dir", "n").agg(F.max_by(F.struct("inherited_license", "inherited_from"), F.length("above")).alias("i"))
    )
    nearest = written(dirs.join(nearest.drop("n"), "dir", "left").select("dir", "n", "i.*"), "licence-nearest")
    own = [F.col(f"own.c{i}").alias(f"c{i}") for i in range(len(kept))]
    said = F.coalesce("header_license", "file_license", "inherited_license")
    basis = F.when(F.col("header_license").isNotNull(), "header").when(F.col("file_license").isNotNull(), "file").when(F.col("inherited_license").isNotNull(), "inherited").otherwise("none")
    discard(dfs, counted, used, licensed, dirs)
    return attach(rows, nearest, "dir", "n").select(*own, *new[:6], said, basis).toDF(*kept, *new)
