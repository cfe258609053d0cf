"""The corpus pipeline: each stage reads what the one before it has kept, from a written table.

``STAGES`` has the stages in order; each takes ``(spark, docs, sf_dir)``. All but the last return the columns
of ``documents``. Texts that are null or empty have no language and go in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weirflow.llm import contamination, language, line_dedup, packing, simhash
from weirflow.llm.common import stored, table
from weirflow.llm.queries import tokenizer_path

#: What a Python worker keeps of words here, where executors still hold what the stages before have left.
WORD_BYTES = 32 << 20


def recognise_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language."""
    return language.keep_recognised(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that occur earlier; a text that loses all of them is empty."""
    return line_dedup.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in windows of the benchmark."""
    return contamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of tokens."""
    return packing.pack(docs, tokenizer_path(), word_bytes=WORD_BYTES)


STAGES = [
    ("language identification", recognise_language),
    ("line dedup", dedup_lines),
    ("near-duplicate removal", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]

# Language models, components and token ids can't be put in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
