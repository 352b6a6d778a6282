"""The registered queries of the numbered operators and their DuckDB SQL."""

from __future__ import annotations

from functools import wraps
from typing import Callable, Dict

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, contamination, exact_dedup, filter_audit, lm_hmm, ngram_join, packing, quality_ftrl, substring_fm, token_counts, toxicity, training_order, url_filter
from .common import shared_path, ship, table


#: The rules of the contract, as verdict and rule.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents as shards in training order, then reads every slot back."""
    out = shared_path(spark, "shards")
    path = public_tokenizers.path("word_bpe_49k.json")
    training_order.materialise(table(spark, sf_dir, "documents"), out, path, length=2048, end_id=1, seed=20_240)
    return training_order.read_slots(spark, out).drop("ids")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_lm_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_hmm.lm_scores(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ftrl.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_fm.repeated_windows_removed(table(spark, sf_dir, "documents"), length=50)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, top=2_000)


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: Dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: _shipped(q)
    for q in (
        op1_url_filter, op2_training_order, op3_toxicity, op4_ngram_join, op5_decontamination,
        op6_lm_hmm, op7_exact_dedup, op8_packing, op9_quality, op10_token_counts,
        op11_filter_audit, op12_substring_dedup, op13_collocations,
    )
}

ORACLE: Dict[str, str] = {
    "op5_decontamination": r"""
WITH d AS (
  SELECT DISTINCT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL
), b AS (
  SELECT DISTINCT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), bs AS (
  SELECT DISTINCT item_id, g, array_to_string(w[i:i + g - 1], ' ') AS s
  FROM (SELECT item_id, w, g, unnest(range(1, len(w) - g + 2)) AS i FROM (SELECT item_id, w, least(5, len(w)) AS g FROM b WHERE len(w) > 0))
), ds AS (
  SELECT DISTINCT doc_id, g, array_to_string(w[i:i + g - 1], ' ') AS s
  FROM (SELECT doc_id, w, g, unnest(range(1, len(w) - g + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT g FROM bs) WHERE len(w) >= g)
), n AS (SELECT item_id, count(*) AS item_shingles FROM bs GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS shared FROM ds JOIN bs USING (g, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared, item_shingles, shared / item_shingles AS containment
FROM m JOIN n USING (item_id) WHERE shared / item_shingles >= 0.8
""",
    "op11_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, min(doc_id) OVER (PARTITION BY text) AS first_id FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
         len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > first_id, false) AS e
  FROM w LEFT JOIN l USING (doc_id)
), m AS (
  SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
         || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS mask,
         count(*) AS n, sum(good) AS good, sum(bad) AS bad
  FROM f GROUP BY ALL
), s AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT s1.x || s2.x || s3.x || s4.x || s5.x AS filter_order
  FROM s s1 JOIN s s2 ON s2.x <> s1.x JOIN s s3 ON s3.x NOT IN (s1.x, s2.x)
       JOIN s s4 ON s4.x NOT IN (s1.x, s2.x, s3.x) JOIN s s5 ON s5.x NOT IN (s1.x, s2.x, s3.x, s4.x)
), p AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS x, mask, n, good, bad,
         length(regexp_replace(substr(filter_order, 1, step - 1), CASE WHEN mask = '' THEN 'x' ELSE '[' || mask || ']' END, '', 'g')) < step - 1 AS gone
  FROM m CROSS JOIN o CROSS JOIN (SELECT unnest(range(1, 6)) AS step)
), r AS (
  SELECT part, filter_order, step, x,
         coalesce(sum(n) FILTER (NOT gone AND NOT contains(mask, x)), 0) AS kept,
         coalesce(sum(n) FILTER (NOT gone AND contains(mask, x)), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND contains(mask, x)), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = x), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND contains(mask, x)), 0) AS good_lost,
         coalesce(sum(bad) FILTER (NOT gone AND contains(mask, x)), 0) AS toxic_lost
  FROM p GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM r
""",
    "op12_substring_dedup": r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), g AS (
  SELECT doc, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS s
  FROM (SELECT doc, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), r AS (SELECT doc, i FROM (SELECT doc, i, doc_id, min(doc_id) OVER (PARTITION BY s) AS least FROM g) WHERE doc_id > least),
p AS (SELECT DISTINCT doc, unnest(range(i, i + 50)) AS i FROM r),
x AS (SELECT doc, list(i) AS gone FROM p GROUP BY doc)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda y: NOT list_contains(gone, y[2])), lambda y: y[1]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN x USING (doc)
""",
    "op13_collocations": r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), p AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)
), g AS (
  SELECT lang, k AS words, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p CROSS JOIN (SELECT unnest(range(1, 5)) AS k) WHERE len(w) >= k)
), f AS (SELECT lang, words, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
i AS (
  SELECT lang, array_to_string(w[s:s + k - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, k, unnest(range(1, words - k + 2)) AS s FROM f CROSS JOIN (SELECT unnest([2, 3]) AS k) WHERE words > k)
  GROUP BY ALL
), c AS (
  SELECT lang, phrase, a, w, unnest(range(1, words)) AS k
  FROM f LEFT JOIN i USING (lang, phrase) WHERE words > 1 AND (longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT)
), s AS (
  SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, (2000000 * c.a::HUGEINT // (x.a + y.a))::BIGINT AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
         JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
), b AS (SELECT lang, phrase, a, arg_min(struct_pack(l := l, r := r, score := score), score * 10 + k) AS x FROM s GROUP BY ALL),
o AS (SELECT lang, phrase, a, x.l AS l, x.r AS r, x.score AS score, row_number() OVER (PARTITION BY lang ORDER BY x.score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000
""",
    "op7_exact_dedup": """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), w AS (
  SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size, text_sha256
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM w
""",
}
