"""The training corpus built from `documents`, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.llm import bpe, mixing, suffix, toxicity
from postsieve.llm.base import staged, table
from postsieve.llm.queries import tokenizer_path
from postsieve.llm.simhash import MAX_BITS, SHINGLE, one_per_group

#: bytes of a repeated passage, and of the part by which equal ones meet
REPEAT, REPEAT_ANCHOR = 200, 112
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _counted(docs: DataFrame) -> DataFrame:
    """`n_chars` of texts that a stage has changed."""
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the cut, learned from the labels of these rows."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints."""
    return one_per_group(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without byte strings of some forty words that occur anywhere else."""
    return _counted(suffix.deduplicated(docs, length=REPEAT, anchor=REPEAT_ANCHOR))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix of sources takes their words."""
    return _counted(mixing.mixed_documents(docs, weights=(5, 2, 1), share=1.5))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it."""
    coded = bpe.round_trip(docs.select("doc_id", "text", "lang", "source", "n_chars"), tokenizer_path())
    return coded.select(
        "doc_id", "lang", "source", "n_chars", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("mixing", mix),
    ("bpe", encode),
]

#: hashes, compression and tokenizers are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on all documents, each reading what the one before has written."""
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
