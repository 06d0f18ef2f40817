"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before it left and returns documents, the last one
packed pieces. Results are written between stages, so a stage that fails is run again from the
written table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import lines, neardup, packing, quality, suffixes
from meterlake.llm.common import Scratch, documents
from meterlake.session import configure

# None: near duplicates, suffix arrays and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, with ``n_chars`` of the text as it is now."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    configure(spark)
    return quality.filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines, or lines of 50 words or more, that came before; one left
    without text stays, empty."""
    configure(spark)
    return _counted(lines.remove_repeated_lines(docs, long_words=50, counts=False), docs.columns)


def minhash_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of smallest id. A null id is in no group."""
    configure(spark)
    found = neardup.near_duplicates(docs)
    later = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(later, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte strings that an earlier one holds."""
    configure(spark)
    return _counted(suffixes.remove_repeated_bytes(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 ids."""
    configure(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-duplicates", minhash_neardup),
    ("suffix-array dedup", suffix_dedup),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    scratch = Scratch(spark)
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, scratch.store(stage(spark, docs, sf_dir))
        if k:
            scratch.drop(before)
    return docs
