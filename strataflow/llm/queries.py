"""The registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import decontamination, language, licences, near_dup, packing, quality, resampling, sharding, spelling, token_store, top_k, url_filter, warc
from strataflow.llm.common import table_path

#: The rules that op6 judges by (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_files(docs: DataFrame) -> DataFrame:
    """Documents as files: source, language and the hundred of the id are directories."""
    return docs.withColumn("path", F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = as_files(_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"))
    out = licences.scan_licences(files)
    return out.select("doc_id", "path", "header_license", F.round("header_score", 4).alias("header_score"), "file_license", F.round("file_score", 4).alias("file_score"), "inherited_license", "inherited_from", "license", "basis")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    sha = F.sha2(F.concat_ws(",", "items").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), sha.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.exact_top_k(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("text").cast("binary")
    docs = _table(spark, sf_dir, "documents").select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"), F.crc32(F.coalesce(body, F.lit(b""))).alias("text_crc32"))
    out = sharding.assign_shards(docs, shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = table_path(spark, "token-store")
    token_store.write_store(_table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_store.read_store(spark, path)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.round_trip(_table(spark, sf_dir, "pages"))
    return out.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs.select("doc_id", "text"), language.fit_dictionaries(language.training_rows(docs)))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "lang_rejected")


def op10_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), size=2, least=80)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resampling.importance_ranks(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"), percent=10, least_words=20)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = quality.quality_rules(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_best_fit_packing, op3_decontamination, op4_exact_top_k, op5_sharding, op6_url_filter, op7_token_store, op8_warc, op9_language_id,
    op10_minhash_near_dup, op11_importance_resampling, op12_spelling_variants, op13_quality_rules, pipeline,
)}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _licence_sql() -> str:
    said = [(name, text, "true") for name, text in sorted(licences.TEMPLATES.items())] + [(name, text, "false") for name, text in sorted(licences.TEXTS.items())]
    values = ", ".join(f"('{name}', '{text.replace(chr(39), chr(39) * 2)}', {line})" for name, text, line in said)
    words = "list_filter(string_split_regex(lower({}), '[^0-9a-z]+'), lambda w: w <> '')"
    return f"""
WITH files AS (SELECT doc_id, coalesce(text, '') AS body, concat_ws('/', source, lang, CAST(floor(doc_id / 100) AS BIGINT), doc_id || '.txt') AS path FROM documents),
placed AS (SELECT doc_id, body, path, regexp_replace(path, '/?[^/]*$', '') AS dir FROM files),
templates(template, said, is_line) AS (VALUES {values}),
tt AS (SELECT template, is_line, w, count(*) AS k FROM (SELECT template, is_line, unnest({words.format('said')}) AS w FROM templates) GROUP BY ALL),
n AS (SELECT count(*) AS n FROM placed WHERE body <> ''),
dfs AS (SELECT w, count(*) AS df FROM (SELECT unnest(list_distinct({words.format('body')})) AS w FROM placed) GROUP BY w),
idfs AS (SELECT v.w, ln((1 + n.n) / (1 + coalesce(df, 0))) + 1 AS idf FROM (SELECT w FROM tt UNION SELECT w FROM dfs) v CROSS JOIN n LEFT JOIN dfs ON dfs.w = v.w),
post AS (SELECT template, is_line, tt.w, k * idf / sqrt(sum((k * idf) * (k * idf)) OVER (PARTITION BY template, is_line)) AS t FROM tt JOIN idfs USING (w)),
split AS (SELECT doc_id, string_split(body, chr(10)) AS l FROM placed),
lines AS (SELECT doc_id, -1 AS pos, body AS line FROM placed UNION ALL SELECT doc_id, 2 * unnest(range(len(l))) AS pos, unnest(l) AS line FROM split
  UNION ALL SELECT doc_id, 2 * i - 1 AS pos, l[i] || ' ' || l[i + 1] AS line FROM (SELECT doc_id, l, unnest(range(1, len(l))) AS i FROM split)),
words AS (SELECT doc_id, pos, w, count(*) AS tf FROM (SELECT doc_id, pos, unnest({words.format('line')}) AS w FROM lines) GROUP BY ALL),
vec AS (SELECT doc_id, pos, w, tf * idf AS v FROM words JOIN idfs USING (w)),
norms AS (SELECT doc_id, pos, sqrt(sum(v * v)) AS norm FROM vec GROUP BY ALL),
cosines AS (SELECT doc_id, pos, template, is_line, round(sum(v * t) / max(norm), 6) AS c FROM vec JOIN post USING (w) JOIN norms USING (doc_id, pos) WHERE is_line OR pos = -1 GROUP BY ALL),
heads AS (SELECT doc_id, arg_min(template, (-c, template)) AS header_license, max(c) AS header_score FROM cosines WHERE pos >= 0 AND c >= {licences.HEADER_COSINE} GROUP BY doc_id),
wholes AS (SELECT doc_id, arg_min(template, (-c, template)) AS file_license, max(c) AS file_score FROM cosines WHERE pos = -1 AND c >= {licences.FILE_COSINE} GROUP BY doc_id),
governs AS (SELECT dir AS above, arg_min(file_license, path) AS inherited_license, min(path) AS inherited_from FROM placed JOIN wholes USING (doc_id) GROUP BY dir),
dirs AS (SELECT DISTINCT dir FROM placed),
nearest AS (SELECT dir, arg_max(inherited_license, length(above)) AS inherited_license, arg_max(inherited_from, length(above)) AS inherited_from
  FROM dirs JOIN governs ON above = '' OR dir = above OR starts_with(dir, above || '/') GROUP BY dir)
SELECT doc_id, path, header_license, round(header_score, 4) AS header_score, file_license, round(file_score, 4) AS file_score, inherited_license, inherited_from,
  coalesce(header_license, file_license, inherited_license) AS license,
  CASE WHEN header_license IS NOT NULL THEN 'header' WHEN file_license IS NOT NULL THEN 'file' WHEN inherited_license IS NOT NULL THEN 'inherited' ELSE 'none' END AS basis
FROM placed LEFT JOIN heads USING (doc_id) LEFT JOIN wholes USING (doc_id) LEFT JOIN nearest USING (dir)"""


_DECONTAMINATION = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT DISTINCT item_id, regexp_extract_all(translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + 9], ' ') AS x FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
runs AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS x FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw CROSS JOIN sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, runs.n, item_id FROM runs JOIN win ON runs.x = win.x AND runs.n = win.n),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit_words USING (doc_id) LEFT JOIN found USING (doc_id)"""

_TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(q.v, p.v) AS BIGINT) AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, p.v) DESC, p.vec_id) AS rank
  FROM v q JOIN v p ON q.vec_id <> p.vec_id AND len(q.v) = len(p.v) WHERE q.vec_id % 100 = 0) WHERE rank <= 10"""

_URLS = rf"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)([^?#]*)', 1), {_LOWER}) AS host, regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
r(r_host, r_path, r_verdict) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
m AS (SELECT page_id, host, path, r_host || r_path AS rule, r_verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(r_host || r_path) DESC NULLS LAST) AS k
  FROM u LEFT JOIN r ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict FROM m WHERE k = 1"""

_WARC = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to FROM f"""

_NEAR_DUP = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, x FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS x FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, other) AS (SELECT doc_id, doc_id FROM w UNION SELECT reach.id, edges.b FROM reach JOIN edges ON edges.a = reach.other),
c AS (SELECT id AS doc_id, min(other) AS component_id FROM reach GROUP BY id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)"""


def _crc_table() -> list[int]:
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text's UTF-8 bytes, for a query that has `crc` with the table in `tab`."""
    bytes_ = f"list_transform(range(1, strlen({text}) + 1), lambda i: CAST('0x' || substr(hex({text}), 2 * i - 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {bytes_}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


_CRC = f"crc AS (SELECT {_crc_table()}::BIGINT[] AS tab)"

_RESAMPLE = rf"""
WITH {_CRC}, dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT doc_id, w, count(*) AS k FROM (SELECT doc_id, unnest(w) AS w FROM dw) GROUP BY ALL),
b AS (SELECT w, count(*) AS k FROM (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark) GROUP BY w),
words AS (SELECT w, {_crc32("w")} % 10000 AS bucket FROM (SELECT w FROM d UNION SELECT w FROM b) CROSS JOIN crc),
s AS (SELECT bucket, sum(k) AS s FROM d JOIN words USING (w) GROUP BY bucket), t AS (SELECT bucket, sum(k) AS t FROM b JOIN words USING (w) GROUP BY bucket),
totals AS (SELECT coalesce((SELECT sum(s) FROM s), 0)::DOUBLE + 10000 AS big_s, coalesce((SELECT sum(t) FROM t), 0)::DOUBLE + 10000 AS big_t),
gains AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * big_s / ((s + 1)::DOUBLE * big_t))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket) CROSS JOIN totals),
weights AS (SELECT doc_id, CAST(sum(k * gain) AS BIGINT) AS weight FROM d JOIN words USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
noise AS (SELECT doc_id, len(w) AS n, CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS UBIGINT)::DOUBLE AS h FROM dw),
scores AS (SELECT doc_id, n, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM noise LEFT JOIN weights USING (doc_id)),
ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS n FROM scores WHERE n >= 20)
SELECT doc_id, CAST(scores.n AS BIGINT) AS n_features, weight, score, CASE WHEN k <= 10 * ranks.n // 100 THEN k END AS rank FROM scores LEFT JOIN ranks USING (doc_id)"""

_SPELLING = rf"""
WITH RECURSIVE {_CRC}, runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')), {_LOWER}) AS r FROM documents),
each AS (SELECT doc_id, r, count(*) AS k FROM runs GROUP BY ALL),
hashed AS (SELECT r, k, {_crc32("x")} AS h FROM (SELECT r, k, doc_id || ':' || r AS x FROM each) CROSS JOIN crc),
typed AS (SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, CAST(h % length(r) AS BIGINT)) || substr(r, CAST(h % length(r) AS BIGINT) + 2) ELSE r END AS word, k FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
less AS MATERIALIZED (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
holes AS MATERIALIZED (SELECT word, n, substr(word, 1, i - 1) || chr(0) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word UNION ALL SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form, max(other_n) AS form_n FROM near GROUP BY word),
forms AS MATERIALIZED (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * words.n THEN form END AS form, CASE WHEN form_n >= 10 * words.n THEN form_n END AS form_n FROM words LEFT JOIN best USING (word)),
chain(word, last, depth) AS (SELECT word, form, 1 FROM forms WHERE form IS NOT NULL UNION ALL SELECT chain.word, forms.form, depth + 1 FROM chain JOIN forms ON forms.word = chain.last WHERE forms.form IS NOT NULL),
ends AS (SELECT word, arg_max(last, depth) AS root FROM chain GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN ends USING (word)"""

ORACLE = {
    "op1_license_scan": _licence_sql(), "op3_decontamination": _DECONTAMINATION, "op4_exact_top_k": _TOP_K, "op6_url_filter": _URLS, "op8_warc": _WARC,
    "op10_minhash_near_dup": _NEAR_DUP, "op11_importance_resampling": _RESAMPLE, "op12_spelling_variants": _SPELLING,
}
