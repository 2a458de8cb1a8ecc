"""From raw documents to token ids: each stage works on all that the one before it kept.

1. quality: texts that the base rule or the repetition rule rejects go.
2. near_duplicates: of each group of texts linked at a similarity of 0.75, one row stays: that of smallest id,
   then of smallest set key. Rows are told apart by id and text; null ids come last.
3. secrets: found spans are replaced in the text, and `n_chars` is counted anew.
4. mixing: domains that are larger than their target are thinned by rates of at most one. Targets are set at
   what the clean domain has, and documents that are more likely clean than not stay whatever their rate. Each row
   is decided for itself; the draw is a hash of id and text, so rows alike in both share it.
5. tokens: the rest is encoded; the result has `token_ids` and `n_tokens` in place of the text. Where documents
   have a column of such a name, theirs keeps it, and the new one's name ends in an underscore.

Stages 1 to 4 return the columns of `documents` as they came, further columns included, whatever their names
(but for names that begin with two underscores).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe, mixing, ngram_join, quality, secrets
from tillroll.llm.common import stored, table

RANKS = "byte_bpe_50k.tiktoken"
MIX = {"clean": 0.97, "low": 0.02, "toxic": 0.01}

# Training of the secret scanner and the mixing rates cannot be written in SQL; tests hold the stages
# against plain versions of themselves.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.passing(docs)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    first = stored(ngram_join.firsts(docs), "first-rows")

    def those(of: DataFrame) -> DataFrame:
        own = docs["doc_id"].cast("long").eqNullSafe(of["id"]) & (ngram_join.text_mark(docs["text"]) == of["mark"])
        return docs.join(of, own, "left_semi")

    # Rows alike in id and text: one of them.
    twice = first.where("n_rows > 1")
    if twice.isEmpty():
        return those(first)
    return those(first.where("n_rows = 1")).unionByName(those(twice).dropDuplicates(["doc_id", "text"]))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs, secrets.fit(docs))
    if "n_chars" not in docs.columns:
        return clean
    counted = F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", counted)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", "text")
    mixed = mixing.mix(rows, table(spark, sf_dir, "labels"), MIX, ["__row"], most=1.0)
    drawn = mixing.chosen(F.struct("__row.doc_id", "__row.text"), F.col("rate"))
    return mixed.where(drawn | (F.col("p")[0] >= 0.5)).select("__row.*")


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keep = [c for c in docs.columns if c != "text"]
    ids, number = (name + "_" * (name in keep) for name in ("token_ids", "n_tokens"))
    return bpe.encode(docs, public_tokenizers.path(RANKS), keep, names=(ids, number))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("tokens", tokens_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
