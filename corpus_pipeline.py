"""Corpus pipeline: documents -> token ids, through five of the training-data operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.  Stages cover every row their predecessor
kept.  Null doc_ids, null texts, empty tables and extra columns are handled as
the operators' docstrings say; rows that repeat a doc_id are one document.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.block_anchors import substring_dedup
from riskloom.llm.bpe import encode_documents
from riskloom.llm.jaccard_groups import BROADCAST_IDS, jaccard_components
from riskloom.llm.mixing import soft_mixture
from riskloom.llm.quality_rules import quality_rules
from riskloom.session import ensure_checkpoint_dir, materialize

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def apart(stage):
    """Other columns of ``docs`` go through the stage under names that none of its own can have."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        mark = "in_"
        while any(c.startswith(mark) for c in docs.columns):
            mark += "_"
        others = {c: mark + c for c in docs.columns if c not in COLUMNS}
        out = stage(spark, docs.withColumnsRenamed(others), sf_dir)
        return out.withColumnsRenamed({new: c for c, new in others.items() if new in out.columns})

    return run


@apart
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the threshold table."""
    return quality_rules(docs).where("kept").select(*docs.columns)


@apart
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every group of near duplicates."""
    groups = jaccard_components(docs.select("doc_id", "text"))
    gone = materialize(groups.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct(), "gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(gone, F.col("doc_id") == F.col("gone"), "left_anti")


@apart
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller doc_id has too."""
    out = substring_dedup(docs)
    changed = F.col("n_removed") > 0
    return out.withColumns({
        "n_chars": F.when(changed, F.char_length("kept_text").cast(docs.schema["n_chars"].dataType))
        .otherwise(F.col("n_chars")),
        "text": F.col("kept_text"),
    }).select(*docs.columns)


@apart
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of every document as its mixing rate says."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rated = soft_mixture(docs, labels).where("copies > 0")
    return rated.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts; ``exact`` tells that decoding gives the text's bytes back."""
    import public_tokenizers

    enc = encode_documents(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN, exact_col="exact",
                           keep=["doc_id", "lang", "source", "n_chars"])
    return enc.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids", "exact")


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("mixing", mixture),
    ("byte_level_bpe", tokens),
]

#: No SQL: classifier, gradient fit and tokenizer cannot be expressed in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
