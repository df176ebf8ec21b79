"""The queries of the training-data operators, with production parameters, and DuckDB SQL
for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import compression, embed_dedup, hmm, langid, minhash, mixing, packing, pii, toxicity, url_reputation
from .common import load

MIN_COSINE = 0.95


def good_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the label table calls good and not toxic."""
    return load(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


def op2_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.reputable_pages(load(spark, sf_dir, "pages"), load(spark, sf_dir, "labels"))


def op3_embedding_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_links(load(spark, sf_dir, "embeddings"), MIN_COSINE)


def embedding_links_of_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op3, over the table with a copy and a slightly moved copy of every vector, so
    that there are links at every size."""
    v = load(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    moved = F.transform("embedding", lambda x, i: F.when(i == 0, x + F.lit(0.2)).otherwise(x))
    more = v.select((F.col("vec_id") + 1_000_000_000).alias("vec_id"), "embedding").union(v.select((F.col("vec_id") + 2_000_000_000).alias("vec_id"), moved))
    return embed_dedup.near_links(v.union(more), MIN_COSINE)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(load(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.with_surrogates(load(spark, sf_dir, "documents"), pii.session_key(spark))


def op6_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.within_bands(load(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    chain = toxicity.train_chain(docs, labels.withColumn("poor", 1 - F.col("quality")), ["poor", "toxic"])
    return toxicity.toxic_documents(docs, chain)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    out = mixing.document_rates(docs, mixing.train_domains(docs, load(spark, sf_dir, "labels")))
    return out.withColumn("rate", F.round("rate", 6))


def op9_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_documents(load(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return langid.identify(docs, langid.profiles(docs, good_ids(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_packing, op2_url_reputation, op3_embedding_pairs, op4_minhash, op5_pii, op6_compression, op7_toxicity, op8_mixing, op9_hmm, op10_language, embedding_links_of_copies)}

_SUFFIX_LIST = ", ".join(f"'{s}'" for s in url_reputation.SUFFIXES)
_ADDRESS = r"(starts_with(host, '[') OR regexp_matches(host, '^\d{1,3}(\.\d{1,3}){3}$'))"


def _strength(k: str, n: str, mu: str) -> str:
    v = f"{mu} * (1 - {mu})"
    num = f"sum(pow({k} - {n} * {mu}, 2) - {n} * {v})"
    return f"1 / least(0.99, greatest(0.001, coalesce({num} / nullif(sum({n} * ({n} - 1) * {v}), 0), 0.001))) - 1"


_LINKS = f"""
WITH v AS ({{v}}), c AS (SELECT e, min(vec_id) AS class_id, count(*) AS copies FROM v GROUP BY e),
l AS (SELECT a.e, sum(b.copies)::BIGINT AS near FROM c a JOIN c b ON a.e <> b.e AND list_cosine_similarity(a.e, b.e) >= {MIN_COSINE} GROUP BY a.e)
SELECT vec_id, class_id, copies, copies - 1 + coalesce(near, 0) AS links FROM v JOIN c USING (e) LEFT JOIN l USING (e)"""

ORACLES: dict[str, str] = {
    "op2_url_reputation": f"""
WITH p AS (
  SELECT page_id, url, regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.\\-]*://(?:[^/?#@]*@)?(\\[[0-9a-f:.]+\\]|[^/?#:@\\[\\]]+)', 1), '^www\\.|\\.$', '', 'g') AS host FROM pages
), cut AS (
  SELECT *, array_to_string(string_split(host, '.')[-3:], '.') AS three, array_to_string(string_split(host, '.')[-2:], '.') AS two, string_split(host, '.')[-1] AS one
  FROM p WHERE host <> ''
), named AS (
  SELECT page_id, url, host, CASE WHEN {_ADDRESS} THEN host WHEN three IN ({_SUFFIX_LIST}) THEN three WHEN two IN ({_SUFFIX_LIST}) THEN two ELSE one END AS suffix FROM cut
), parted AS (
  SELECT *, CASE WHEN host = suffix THEN host ELSE string_split(left(host, length(host) - length(suffix) - 1), '.')[-1] || '.' || suffix END AS domain FROM named
), hosts AS (
  SELECT host, domain, suffix, coalesce(sum(quality), 0) AS k, count(quality) AS n
  FROM parted LEFT JOIN (SELECT doc_id, quality FROM labels WHERE quality IN (0, 1)) l ON page_id = doc_id GROUP BY ALL
), domains AS (SELECT domain, suffix, sum(k) AS k, sum(n) AS n FROM hosts GROUP BY ALL
), sufs AS (SELECT suffix, sum(k) AS k, sum(n) AS n, (sum(sum(k)) OVER () + 1.0) / (sum(sum(n)) OVER () + 2.0) AS mu FROM domains GROUP BY suffix
), m0 AS (SELECT {_strength("k", "n", "mu")} AS m FROM sufs
), sufs1 AS (SELECT suffix, (m * mu + k) / (m + n) AS mu FROM sufs, m0
), domains0 AS (SELECT d.*, mu FROM domains d JOIN sufs1 USING (suffix)
), m1 AS (SELECT {_strength("k", "n", "mu")} AS m FROM domains0
), domains1 AS (SELECT domain, (m * mu + k) / (m + n) AS mu FROM domains0, m1
), hosts0 AS (SELECT h.*, mu FROM hosts h JOIN domains1 USING (domain)
), m2 AS (SELECT {_strength("k", "n", "mu")} AS m FROM hosts0
), whole AS (SELECT (sum(k) + 1.0) / (sum(n) + 2.0) AS mu0 FROM hosts
), bare AS (SELECT round(greatest(0.0, mu0 - 1.645 * sqrt(mu0 * (1 - mu0) / (m + 1))), 6) AS unknown FROM m2, whole
), ab AS (SELECT host, domain, suffix, m * mu + k AS a, m * (1 - mu) + n - k AS b FROM hosts0, m2
), post AS (SELECT host, domain, suffix, round(a / (a + b), 6) AS mean, round(greatest(0.0, a / (a + b) - 1.645 * sqrt(a * b / (pow(a + b, 2) * (a + b + 1)))), 6) AS bound FROM ab)
SELECT page_id, url, host, post.domain, post.suffix, mean, bound FROM parted JOIN post USING (host), bare WHERE bound >= unknown * {1 - url_reputation.SLACK}::DOUBLE""",
    "op3_embedding_pairs": _LINKS.format(v="SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings"),
    "embedding_links_of_copies": _LINKS.format(
        v="""SELECT vec_id + k * 1000000000 AS vec_id, CASE WHEN k < 2 THEN embedding::DOUBLE[] ELSE list_prepend(embedding[1]::DOUBLE + 0.2::DOUBLE, (embedding::DOUBLE[])[2:]) END AS e
FROM embeddings, (VALUES (0), (1), (2)) t(k)"""
    ),
}
