"""Cleans, dedups, mixes and encodes the documents table, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns the columns of documents; the
last one returns what encoding gives. Between stages the rows are written as Parquet below ``spark.checkpoint.dir`` and
read again, so a lost executor never costs more than a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from modrisk.llm import bpe, exact_dedup, mixing, quality, simhash
from modrisk.llm.queries import tokenizer
from modrisk.llm.shared import work_folder, written

# Sources are evened out, none is read more than twice, and every document is kept at least once.
MIX = mixing.Target(entropy=0.97, repetition=2.0)

# Entries of a generation of the encoder's caches. A Python worker keeps them from stage to stage beside what other stages need,
# and copies of a document, which the mix makes, follow each other: a quarter of what encoding alone takes is enough.
CHUNKS, WORDS = bpe.CHUNKS // 4, bpe.WORDS // 4


def drop_junk(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that a rule rejects go."""
    return quality.keep_good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the one with the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup by its contract: four-word shingles, fingerprints linked at 4 or fewer differing bits; of each
    component the document with the smallest doc_id stays."""
    return simhash.keep_one(docs, shingle=4, bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Temperature mixing: documents are repeated as their source's weight asks."""
    return mixing.mixed(docs, target=MIX)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding and decoding of every document, each as often as the mix has it."""
    rows = docs.select("doc_id", "text", "source")
    return bpe.digests(bpe.encoded(rows, tokenizer("word_bpe_49k.json"), carry=["source"], apart=True, chunks=CHUNKS, words=WORDS))


STAGES = [
    ("quality_rules", drop_junk),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# Near-duplicate components, tries of exponents and byte-pair merges are not SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{i}-{name}")
    return docs
