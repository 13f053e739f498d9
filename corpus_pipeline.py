"""A corpus pipeline of five stages over `documents`.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's docs. All but the last return
the columns of documents.

Edge cases: null texts count as empty in every stage and stay null up to the
last, which gives them no ids. Rows that repeat an id are rows of their own,
but of one group (and so of one text) one row stays; rows without id are never
dropped as copies. A null source is a source. Ties go to the smaller id, or the
smaller hash of the text. Columns beyond those of documents, whatever their
names, are passed on by all stages but the last. Very long texts are handled
one at a time. An empty table gives an empty table.

SQL cannot express the classifier, the fingerprints or the pieces, so
ORACLE_SQL is None; the tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skysift.llm import crf_quality, golay_dedup, mixing, pii_bootstrap, suffix_pieces
from skysift.llm.common import table, written
from skysift.llm.queries import tokenizer_path

ORACLE_SQL = None

#: A document passes the first stage with this score or more.
LEAST_QUALITY = 0.7
#: No source is passed more often than this in the mix, and none less than once.
MOST_REPETITION = 1.25


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the line classifier rejects."""
    model = crf_quality.train(docs, table(spark, sf_dir, "labels"))
    return crf_quality.keep_good(docs, model, LEAST_QUALITY)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of linked documents the one with the least id."""
    return golay_dedup.keep_first(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind; n_chars follows the text."""
    return pii_bootstrap.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources towards equal weights; every document stays."""
    return mixing.mixed_documents(docs, max_repetition=MOST_REPETITION)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and the piece ids of every text."""
    encoded = suffix_pieces.encode_pieces(docs, tokenizer_path("piece_bpe_32k.model"), also=["source"])
    return encoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [("quality", quality), ("deduplicate", deduplicate), ("private", private), ("mix", mix), ("pieces", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
