"""Queries that apply the training-data operators to the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lakemart.llm import (bpe, centroids, exact, gam, html, mixing, neighbours, phrases, pii, sharding, simhash, toxicity,
                          warc)
from lakemart.llm.common import table
from lakemart.session import cut_lineage, scratch_path

SHARDS = 8
DOMAINS, WEIGHTS = corpus_pipeline.DOMAINS, corpus_pipeline.WEIGHTS
ANCHOR, MARGIN, RANKS = corpus_pipeline.ANCHOR, corpus_pipeline.MARGIN, corpus_pipeline.RANKS


def op1_warc(spark: SparkSession, d: str) -> DataFrame:
    """Every page written to WARC archives, normalised and read back."""
    back = warc.round_trip(table(spark, d, "pages"), "page_id", "url", "html", scratch_path(spark, "warc"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_html(spark: SparkSession, d: str) -> DataFrame:
    """Visible text of every page."""
    pages = table(spark, d, "pages").select("page_id", "url", "html")
    return html.extract(pages, "html").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_pii(spark: SparkSession, d: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.find(table(spark, d, "documents").select("doc_id", "text"), "text", "found")
    base = F.filter("found", lambda x: x["base"])
    return found.select("doc_id", *[pii.count_of(base, k.name).alias(f"n_{k.name}") for k in pii.KINDS if k.base],
                        F.sha2(pii.listed(base), 256).alias("base_sha256"),
                        pii.listed(F.col("found")).alias("spans"),
                        F.array_join(F.transform("found", lambda x: F.format_string("%.2f", x["score"])), ",")
                        .alias("scores"))


def op5_quality(spark: SparkSession, d: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, d, "documents")
    rows = cut_lineage(docs.select("doc_id", gam.signals_of("text").alias("signals")), "signals")
    model = gam.fit(rows, table(spark, d, "labels"), "doc_id", "quality")
    scored = rows.select("doc_id", gam.is_held_out("doc_id").alias("held_out"),
                         gam.score_signals(model, "signals").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_simhash(spark: SparkSession, d: str) -> DataFrame:
    """Fingerprint and near-copy component of every document."""
    found = simhash.near_groups(table(spark, d, "documents"), "doc_id", "text", shingle=3, distance=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_bpe(spark: SparkSession, d: str) -> DataFrame:
    """Digests of every document's token ids and of the bytes decoded from them."""
    t = bpe.Tokenizer(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    coded = t.encode(table(spark, d, "documents").select("doc_id", "text"), "text", "ids")
    back = t.decode(coded.select("doc_id", "ids"), "ids", "decoded")
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_mixing(spark: SparkSession, d: str) -> DataFrame:
    """Posteriors, rate and copies of every document for the target mix."""
    return mixing.mix(table(spark, d, "documents"), "doc_id", "text", mixing.label_domains(table(spark, d, "labels")),
                      DOMAINS, WEIGHTS, ANCHOR, MARGIN)


def op7_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    return neighbours.nearest(table(spark, d, "embeddings"), "vec_id", "embedding", F.pmod("vec_id", F.lit(20)) == 0, k=20)


def op8_rendezvous(spark: SparkSession, d: str) -> DataFrame:
    """All documents over eight equal shards, and where nine would put them."""
    return sharding.assign(table(spark, d, "documents"), "doc_id", "text",
                           [1.0] * SHARDS, [1.0] * (SHARDS + 1))


def op10_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Owner (largest doc_id) and group of every document's text."""
    return exact.groups(table(spark, d, "documents"), "doc_id", "text", keep="largest")


def op11_centroids(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of all vectors around 16 centroids after three rounds."""
    return centroids.cluster(table(spark, d, "embeddings"), "vec_id", "embedding", k=16, rounds=3, dims=64, scale=64)


def op12_phrases(spark: SparkSession, d: str) -> DataFrame:
    """The best collocations of two and three words in every language."""
    return phrases.collocations(table(spark, d, "documents"), "text", "lang", longest=3, least=10, inside=50, top=2000)


def op13_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, d, "documents")
    model = toxicity.fit(docs, table(spark, d, "labels"), "doc_id", "text", "toxic")
    scored = docs.select("doc_id", toxicity.is_held_out("doc_id").alias("held_out"),
                         toxicity.score_text(model, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_html": op2_html,
    "op3_pii": op3_pii,
    "op4_simhash": op4_simhash,
    "op5_quality": op5_quality,
    "op6_mixing": op6_mixing,
    "op7_neighbours": op7_neighbours,
    "op8_rendezvous": op8_rendezvous,
    "op9_bpe": op9_bpe,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_centroids": op11_centroids,
    "op12_phrases": op12_phrases,
    "op13_toxicity": op13_toxicity,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op1_warc": """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
kept AS (
  SELECT body, max(page_id) AS keep FROM sized WHERE payload_bytes >= 1000 GROUP BY body)
SELECT s.page_id, s.payload_bytes, sha1(s.body) AS payload_digest,
       CASE WHEN k.keep IS NULL OR k.keep IS NOT DISTINCT FROM s.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k.keep IS DISTINCT FROM s.page_id THEN k.keep END AS refers_to
FROM sized s LEFT JOIN kept k ON s.body = k.body""",
    "op10_exact_dedup": """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op11_centroids": centroids.sql(k=16, rounds=3, dims=64, scale=64),
    "op12_phrases": phrases.sql(least=10, inside=50, top=2000),
}
