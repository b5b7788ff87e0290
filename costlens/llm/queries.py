"""The registered query of each training-data operator, with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.llm import (decontaminate, embedding_dup, filter_audit, html_extract, language, merkle, near_dup, packing, quality,
                          sharding, toxicity, url_filter, warc)
from costlens.llm.common import bound_batches, table

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            bound_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


OP1_SQL = r"""
WITH dw AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
iw AS (
  SELECT item_id, w, least(len(w), 10) AS n FROM (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
iwin AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM iw)),
spans AS (SELECT DISTINCT n FROM iwin),
dwin AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, spans WHERE len(w) >= n)),
hits AS (SELECT d.doc_id, d.i, d.n, t.item_id FROM dwin d JOIN iwin t ON d.n = t.n AND d.win = t.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query("op1_decontaminate", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item."""
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.drop("spans")


@query("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 2,048 tokens that hold no source or exact copy twice."""
    return packing.pack(table(spark, sf_dir, "documents"))


def fold(id_col: str, of: int):
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % of


def language_model(docs: DataFrame) -> language.LanguageModel:
    return language.fit_language_model(docs, fold("doc_id", 3) != 1)


@query("op3_language")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    out = language.predict_language(docs, language_model(docs))
    return out.select(F.col("id").alias("doc_id"), F.coalesce(fold("id", 3) == 1, F.lit(False)).alias("held_out"),
                      "lang_pred", "score", "cosine", "rejected")


@query("op4_html")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract_text(pages, html_extract.fit_labeller(pages))


# The rules that the query is given.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

OP5_SQL = r"""
WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
             FROM pages),
hp AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
              regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(rule, h, p, action) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fit AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
        FROM hp JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT hp.page_id, host, path, fit.rule, coalesce(fit.action, 'allow') AS verdict FROM hp LEFT JOIN fit USING (page_id)
"""


@query("op5_url_filter", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict for the URL of every page."""
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(URL_RULES, "rule string, action string")
    return url_filter.judge_urls(pages, url_filter.fit_url_filter(pages, rules))


OP6_SQL = r"""
WITH RECURSIVE dw AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM dw WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT u, v FROM pairs JOIN size x ON u = x.doc_id JOIN size y ON v = y.doc_id WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach(u, v) AS (SELECT doc_id, doc_id FROM dw UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u),
comp AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
SELECT dw.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, dw.doc_id = component_id AS kept
FROM dw JOIN comp USING (doc_id) LEFT JOIN size USING (doc_id)
"""


@query("op6_minhash", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, links at a shingle similarity of 0.85."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


OP7_SQL = r"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes
           FROM pages),
k AS (SELECT payload_digest, payload_bytes, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN top > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top > page_id THEN top END AS refers_to
FROM p LEFT JOIN k USING (payload_digest, payload_bytes)
"""


@query("op7_warc", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page as a record of dictionary-compressed archives and read the archives back."""
    manifest = warc.write_warc(warc.with_roles(table(spark, sf_dir, "pages")))
    return warc.read_warc(manifest).drop("payload", "url")


SHARDS = [f"shard-{i:03d}" for i in range(64)]


@query("op8_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document by its id, over 64 shards."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    out = sharding.assign_shards(docs, ["doc_id"], SHARDS, spread=["source", "n_chars"])
    return out.select("doc_id", "slot", "shard", "shard_name")


OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
sound AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS u, b.vec_id AS v FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
         AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(u, v) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u),
comp AS (SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u),
n AS (SELECT u AS vec_id, count(*) AS n_links FROM link GROUP BY u)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)
"""


@query("op9_embedding", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding, compared within its label at a cosine of 0.98."""
    return embedding_dup.near_embeddings(table(spark, sf_dir, "embeddings"), threshold=0.98)


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.QualityModel:
    return quality.fit_quality_model(docs, labels, fold("doc_id", 4) != 2)


@query("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels of three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    out = quality.score_quality(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return out.select(F.col("id").alias("doc_id"), F.coalesce(fold("id", 4) == 2, F.lit(False)).alias("held_out"),
                      "score", "predicted")


@query("op11_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels of four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity_model(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    out = toxicity.score_toxicity(docs, model)
    return out.select(F.col("id").alias("doc_id"), F.coalesce(fold("id", 5) == 0, F.lit(False)).alias("held_out"),
                      "score", "predicted")


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS caps FROM d),
m AS (SELECT doc_id, part,
        CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
        + CASE WHEN 100 * caps > 3 * length(t) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask FROM w),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
        FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM m LEFT JOIN lab USING (doc_id) GROUP BY part, mask),
f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS filter, CAST(1 << (instr('ABCDE', substr(filter_order, step, 1)) - 1) AS INTEGER) AS bit,
        list_sum(list_transform(range(1, step), lambda i: CAST(1 << (instr('ABCDE', substr(filter_order, i, 1)) - 1) AS INTEGER))) AS prior
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
j AS (SELECT c.*, filter_order, step, filter, bit, mask & bit <> 0 AS fails, mask & CAST(coalesce(prior, 0) AS INTEGER) <> 0 AS gone FROM c, s)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter,
       CAST(sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(CASE WHEN fails THEN n * (120 // bit_count(mask)) ELSE 0 END) AS BIGINT) AS shapley
FROM j GROUP BY part, filter_order, step, filter
"""


@query("op12_filter_audit", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in every order, by language."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, list_reduce([4294967295] || list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
           lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT)),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) AS crc,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
         || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
         || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head, text,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents),
leaf AS (
  SELECT doc_id, lang, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS h,
         sha256(head || coalesce(octet_length(encode(low)) || ':' || low, '-')) AS t, xor(crc, 4294967295) % 3 = 0 AS touched FROM d),
base AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM leaf),
lv(g, k, i, n, h) AS (
  SELECT g, 0, i, n, h FROM base
  UNION ALL SELECT g, k + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM lv WHERE n > 1 GROUP BY g, k, i // 8, n),
sub AS (SELECT g, h AS subroot FROM lv WHERE n = 1),
up(k, i, n, h) AS (
  SELECT 0, g, count(*) OVER (), subroot FROM sub
  UNION ALL SELECT k + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY k, i // 8, n),
step AS (
  SELECT a.g, a.k, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM lv a JOIN lv b ON a.g = b.g AND a.k = b.k AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.g, a.k, a.i),
upstep AS (
  SELECT a.k, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM up a JOIN up b ON a.k = b.k AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.k, a.i),
path AS (
  SELECT b.g, b.i, s.k, s.l, s.r FROM base b JOIN step s ON s.g = b.g AND s.i = b.i // CAST(pow(8, s.k) AS BIGINT)
  UNION ALL SELECT b.g, b.i, 1000 + s.k, s.l, s.r FROM base b JOIN upstep s ON s.i = b.g // CAST(pow(8, s.k) AS BIGINT)),
proof AS (SELECT g, i, list([l, r] ORDER BY k) AS p FROM path GROUP BY g, i),
whole AS (
  SELECT b.*, coalesce(p, []) AS p, subroot, (SELECT h FROM up WHERE n = 1) AS root
  FROM base b LEFT JOIN proof USING (g, i) JOIN sub USING (g)),
folded AS (
  SELECT *, list_reduce([[CASE WHEN coalesce(touched, false) THEN t ELSE h END, '']] || p,
           lambda a, s: [sha256(s[1] || a[1] || s[2]), ''])[1] AS folded_root FROM whole)
SELECT doc_id, h AS leaf, subroot, root, sha256(array_to_string(list_transform(p, lambda s: s[1] || s[2]), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified FROM folded
"""


@query("op13_merkle", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of the documents, checked against rows of which a third have their text lower-cased."""
    return merkle.manifest(table(spark, sf_dir, "documents"), fold("doc_id", 3) == 0)
