"""The operators as named queries over the test tables, with production parameters: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    bagminhash,
    collocations,
    language,
    mixing,
    negatives,
    packing,
    permutations,
    quality,
    token_store,
    toxicity,
    urls,
    vectors,
    warc,
)
from shelfwise.llm.common import held_out, importable, table
from shelfwise.llm.tokens import with_token_counts
from shelfwise.llm.urls import ALLOW, BLOCK, Rule

Query = Callable[[SparkSession, str], DataFrame]
LLM_CATALOG: dict[str, Query] = {}
LLM_ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        importable(spark)
        return function(spark, folder)

    LLM_CATALOG[function.__name__] = run
    return run


@query
def op1_token_store(spark, folder):
    docs = table(spark, folder, "documents")
    store = token_store.write_store(docs)
    return token_store.read_back(store, token_store.locate(store, token_store.keys_of(docs)))


@query
def op2_hnsw_near_dedup(spark, folder):
    return vectors.near_vectors(table(spark, folder, "embeddings"))


URL_RULES = [
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
]


@query
def op3_url_filter(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


LLM_ORACLE["op3_url_filter"] = r"""
WITH parts AS (
  SELECT page_id, contains(url, '://') AS whole,
    translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS p
  FROM pages),
u AS (SELECT page_id, CASE WHEN whole THEN h ELSE '' END AS host, CASE WHEN whole THEN p ELSE '' END AS path FROM parts),
r(verdict, rule_host, rule_path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))
SELECT u.page_id, u.host, u.path, best.rule, coalesce(best.verdict, 'allow') AS verdict
FROM u LEFT JOIN LATERAL (
  SELECT r.rule_host || r.rule_path AS rule, r.verdict FROM r
  WHERE (u.host = r.rule_host OR ends_with(u.host, '.' || r.rule_host)) AND starts_with(u.path, r.rule_path)
  ORDER BY length(r.rule_host || r.rule_path) DESC, length(r.rule_host) DESC LIMIT 1) AS best ON true
"""


@query
def op4_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), toxicity.train(docs, table(spark, folder, "labels")))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


@query
def op5_bagminhash(spark, folder):
    return bagminhash.near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", "class_id", F.col("representative").alias("kept")
    )


@query
def op6_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    judged = language.identify(docs.select("doc_id", "text"), language.train(docs))
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op7_best_fit_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"))


@query
def op8_quality_rules(spark, folder):
    return quality.judge_quality(table(spark, folder, "documents"))


@query
def op9_warc(spark, folder):
    archives, index = warc.write_warc(table(spark, folder, "pages"))
    return warc.read_warc(archives, index).drop("url")


@query
def op10_temperature_mixing(spark, folder):
    docs = with_token_counts(table(spark, folder, "documents").select("doc_id", "source", "text"), "n_tokens")
    return mixing.mix(docs.select("doc_id", "source", "n_tokens"))


@query
def op11_permutation_index(spark, folder):
    return permutations.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op12_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


LLM_ORACLE["op12_collocations"] = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]'), lambda x: x <> '') AS w FROM pieces),
g AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
grams AS (
  SELECT lang, 1 AS size, w[i] AS phrase FROM g
  UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM g WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM g WHERE i + 2 <= len(w)),
f AS (SELECT lang, size, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM grams GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, size, phrase, f AS a, w FROM f WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, a, 1 AS k, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM cand
  UNION ALL SELECT lang, phrase, a, 2, array_to_string(w[1:2], ' '), w[3] FROM cand WHERE size = 3),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, fx.f AS l, fy.f AS r,
    CAST(1000000::HUGEINT * c.a * c.a // (fx.f::HUGEINT * fy.f) AS BIGINT) AS score
  FROM cuts c JOIN f fx ON fx.lang = c.lang AND fx.phrase = c.x JOIN f fy ON fy.lang = c.lang AND fy.phrase = c.y),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
spans AS (
  SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM cand WHERE size = 3
  UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE size = 3),
held AS (SELECT lang, phrase, max(a) AS longer FROM spans GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN held USING (lang, phrase) WHERE held.longer IS NULL OR 100 * held.longer < 50 * low.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept JOIN n USING (lang))
WHERE rank <= 2000
"""


@query
def op13_hard_negatives(spark, folder):
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


LLM_ORACLE["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
    CAST(list_dot_product(a.c, b.c) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.c) = len(b.c) WHERE a.vec_id % 50 = 0),
pos AS (SELECT * FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT pos.anchor_id, pos.vec_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY pos.anchor_id, pos.vec_id ORDER BY n.score DESC, n.vec_id) AS INT) AS rank,
  n.vec_id AS negative_id, pos.score AS positive_score, n.score AS negative_score
FROM pos JOIN p n ON n.anchor_id = pos.anchor_id AND NOT n.same
  AND 50 * pos.score <= 100 * n.score AND 100 * n.score <= 95 * pos.score
QUALIFY rank <= 3
"""
