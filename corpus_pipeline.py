"""Corpus pipeline: documents in, token statistics of the prepared corpus out.

``STAGES`` lists (name, function) in order; each function takes
(spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``.  All stages but the last return the
columns of ``documents``:

1. quality: documents the additive model scores below one half go;
2. exact_dedup: of equal texts the row with the largest identifier stays;
3. near_dedup: of each component of near copies the smallest identifier stays;
4. mixing: documents are thinned by the rates that match the target weights
   (rates above one keep a document once; the clean domain's rates are at
   least one);
5. tokens: identifiers, token count and digests of ids and decoded bytes.

Null texts count as empty throughout; see the operators for the other defined
results.  An empty ``documents`` gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import bpe, exact, gam, mixing, simhash
from lakemart.llm.common import short_batches, table
from lakemart.session import cut_lineage

RANKS = "byte_bpe_50k.tiktoken"
DOMAINS, WEIGHTS = ["clean", "toxic", "low"], [0.92, 0.07, 0.01]
ANCHOR, MARGIN = "clean", 0.02


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose quality score is at least one half."""
    model = gam.fit_on_documents(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality")
    return docs.filter(gam.score_text(model, "text") >= 0.5)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each distinct text."""
    return exact.keep_rows(docs, "doc_id", "text", keep="largest")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of near copies."""
    return simhash.keep_rows(docs, "doc_id", "text", shingle=3, distance=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Thin the domains above their target share."""
    labels = mixing.label_domains(table(spark, sf_dir, "labels"))
    return mixing.thin(docs, "doc_id", "text", labels, DOMAINS, WEIGHTS, ANCHOR, MARGIN)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every document left."""
    t = bpe.Tokenizer(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    coded = t.encode(docs.select("doc_id", "text"), "text", "ids")
    back = t.decode(coded.select("doc_id", "ids"), "ids", "decoded")
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mix),
          ("tokens", tokens)]

# The quality model and the tokenizer have no SQL form; tests compare each
# stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next begins."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        short_batches(spark)
        docs = cut_lineage(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
