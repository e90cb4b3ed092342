"""Named queries of the training-data operators over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe_codec, hard_negatives, html_blocks, language_id, licenses, outliers, packing
from . import personal_data, reputation, simhash, substrings, topk
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_crf_language(spark, d):
    return language_id.identify(table(spark, d, "documents"))


@query
def op2_best_fit_packing(spark, d):
    return packing.pack(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


URL_RULES = [
    reputation.Rule("org", "/", "allow"),
    reputation.Rule("example.org", "/es/", "block"),
    reputation.Rule("example.org", "/en/1", "block"),
    reputation.Rule("com", "/fr/", "allow"),
    reputation.Rule("com", "/de/", "block"),
]


@query
def op3_host_reputation(spark, d):
    judged = reputation.judge(table(spark, d, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _level(name: str, counts: str) -> str:
    """SQL of one level: counts with a prior, then their posterior rates."""
    return f"""
{name}_in AS ({counts}),
{name}_weight AS (
    SELECT coalesce(CASE WHEN pairs > 0 AND over > 0
        THEN least(1000.0, greatest(0.5, pairs / over - 1)) END, 1000.0) AS weight
    FROM (SELECT sum(pow(bad - n * prior, 2) - n * prior * (1 - prior)) AS over,
                 sum((n - 1) * n * prior * (1 - prior)) AS pairs FROM {name}_in WHERE n > 0)
),
{name} AS (
    SELECT *, (prior * weight + bad) / (weight + n) AS rate FROM {name}_in, {name}_weight
)"""


SQL["op3_host_reputation"] = (
    r"""
WITH rest AS (
    SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
    SELECT page_id, regexp_extract(r, '^[^/?#]*') AS raw,
           regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM rest
), split AS (
    SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts
), rules (h, p, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), ruled AS (
    SELECT page_id, host, path,
           (SELECT max({'size': length(h || p), 'rule': h || p, 'verdict': verdict}) FROM rules
            WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best
    FROM split
), labelled AS (
    SELECT host, count(best) AS n, count(*) FILTER (best.verdict = 'block') AS bad FROM ruled GROUP BY host
), named AS (
    SELECT *, CASE WHEN two IN ('co.jp', 'co.uk', 'com.au', 'com.br', 'org.uk') THEN three ELSE two END AS domain,
           CASE WHEN two IN ('co.jp', 'co.uk', 'com.au', 'com.br', 'org.uk') THEN two ELSE one END AS suffix
    FROM (SELECT *, regexp_extract(host, '[^.]*$') AS one, regexp_extract(host, '([^.]*\.)?[^.]*$') AS two,
                 regexp_extract(host, '([^.]*\.)?([^.]*\.)?[^.]*$') AS three FROM labelled)
), by_domain AS (
    SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM named GROUP BY domain, suffix
), by_suffix AS (
    SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM by_domain GROUP BY suffix
),"""
    + _level("s", "SELECT *, (SELECT CASE WHEN sum(n) > 0 THEN sum(bad) / sum(n) END FROM by_suffix) AS prior FROM by_suffix")
    + ","
    + _level("o", "SELECT d.*, s.rate AS prior FROM by_domain d JOIN s USING (suffix)")
    + ","
    + _level("t", "SELECT h.host, h.n, h.bad, o.rate AS prior FROM named h JOIN o USING (domain, suffix)")
    + """
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN t.rate - 1.645 * sqrt(t.rate * (1 - t.rate) / (t.weight + t.n + 1)) > 0.5
                                   THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN t USING (host)
"""
)


@query
def op4_byte_bpe(spark, d):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_codec.round_trip(table(spark, d, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op5_mcd_outliers(spark, d):
    return outliers.judge(table(spark, d, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op6_simhash(spark, d):
    return simhash.near_duplicates(table(spark, d, "documents"))


@query
def op7_super_kmers(spark, d):
    return substrings.removal_digest(table(spark, d, "documents"))


SQL["op7_super_kmers"] = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
    SELECT doc_id, unnest(generate_series(1, len(w) - 12)) AS i, w FROM words WHERE len(w) >= 13
), windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS k FROM starts
), judged AS (
    SELECT doc_id, i, doc_id > min(doc_id) OVER (PARTITION BY k) AS late FROM windows
), covered AS (
    SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS i FROM judged WHERE late
), gone AS (
    SELECT doc_id, list(i) AS gone FROM covered GROUP BY doc_id
), kept AS (
    SELECT doc_id, len(w) AS n_words, list_filter(w, lambda x, i: gone IS NULL OR NOT list_contains(gone, i)) AS k
    FROM words LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n_words, n_words - len(k) AS n_removed, sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256
FROM kept
"""


@query
def op8_block_lstm(spark, d):
    return html_blocks.extract(table(spark, d, "pages"))


@query
def op9_top_k(spark, d):
    return topk.top_k(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


SQL["op9_top_k"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(
        CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op10_license_scan(spark, d):
    return licenses.scan(table(spark, d, "documents"))


@query
def op11_slot_negatives(spark, d):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, d, "embeddings").withColumn("label", label)
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0, positives=5, negatives=3, low=50, high=95)


SQL["op11_slot_negatives"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v a JOIN v c ON c.vec_id <> a.vec_id AND len(c.v) = len(a.v) WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth FROM scored WHERE same
), negatives AS (
    SELECT anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
           CAST(row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
    FROM positives p JOIN scored n USING (anchor_id)
    WHERE p.nth <= 5 AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""


@query
def op12_pair_alignment(spark, d):
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, d, "documents"), *paths)


@query
def op13_personal_data(spark, d):
    return personal_data.find(table(spark, d, "documents"))
