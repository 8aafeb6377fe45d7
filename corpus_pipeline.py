"""The corpus pipeline: from ``documents`` to token ids.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; its rows are
written as Parquet and read again as the next stage's documents.  All stages
but the last return the columns of ``documents``.

1. quality: documents that the rule ensemble rejects go; all stay where the
   labels teach it nothing (none usable, or of one class only).
2. near-duplicates: one document of each SimHash component stays.
3. mixing: documents are repeated so that sources meet their weights; every
   document is read at least once, none more than twice as often as others.
4. pieces: SentencePiece ids of every document.

Null and empty texts, null ids, repeated rows, empty tables and extra columns
are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorewright.llm import mixing, pieces, rule_quality, simhash
from scorewright.llm.catalog import tokenizer_path
from scorewright.llm.common import table, written

QUALITY_THRESHOLD = 0.7
MAX_REPETITION = 2.0


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score at least ``QUALITY_THRESHOLD``; the rule
    ensemble learns from the labelled documents that are not held out.  All
    stay where nothing can be learnt.  Null and empty texts are scored like
    others; no documents give none."""
    model = rule_quality.train(docs, table(spark, sf_dir, "labels"))
    return rule_quality.accepted(docs, model, "text", QUALITY_THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest id (null ids
    last), then the smallest hash of the text, then of the row."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; those of small sources again, up to
    ``MAX_REPETITION`` times as often.  A null source is a source."""
    return mixing.mix(docs, max_ratio=MAX_REPETITION, carry=docs.columns)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_pieces, ids_crc32, round_trip, ids`` of every row;
    null and empty texts have no pieces."""
    return pieces.encode(docs, tokenizer_path("piece_bpe_32k.model"), keep={"doc_id": "doc_id", "source": "source"})


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("mixing", mix_sources),
          ("pieces", piece_ids)]

# trees, hashes and the vocabulary are beyond SQL: tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
