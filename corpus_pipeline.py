"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; `run` writes
a stage's rows to the shared folder and reads them back as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import exact_dedup, packing, secrets, simhash, toxicity
from waybill.llm.common import Shelf, pick
from waybill.operators.staging import cleared_afterwards

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: The toxicity model and its threshold, the near-duplicate rule, the secrets' owners.
TOXIC_FROM = 0.7
SHINGLE, DISTANCE = 3, 3
EXAMPLE_OWNERS = 3
REDACTED = "[SECRET]"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from `labels` of documents here."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(pick(docs, *COLUMNS), labels, TOXIC_FROM)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    rest = tuple(c for c in COLUMNS if c != "doc_id")
    return exact_dedup.radix_groups(docs, carry=rest).filter("kept").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return simhash.keep_one(pick(docs, *COLUMNS), SHINGLE, DISTANCE)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are overwritten; documents and widely copied examples stay."""
    return secrets.redact(docs, EXAMPLE_OWNERS, REDACTED).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs, length=2048, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scans", hide_secrets),
    ("packing", pack),
]

ORACLE_SQL = None  # classifier and tokenizer have no SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    shelf = Shelf(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        with cleared_afterwards():  # what a stage kept on its way goes once its rows are written
            docs = shelf.put(stage(spark, docs, sf_dir), name)
        if before:
            shelf.drop(before)
        before = name
    name, last = STAGES[-1]
    return last(spark, docs, sf_dir)
