"""A corpus pipeline of five stages over ``documents``; registered as query ``pipeline``.

Each stage gets what the one before has kept. Documents that the quality rules reject go;
lines that ten documents or more hold go; of near duplicates one document stays; strings
of 100 bytes that also start earlier go; the rest is packed into sequences.

All stages take null ids, repeated rows and ids, texts of any length as a whole, columns
beside those of documents (whatever their names; they are left out), and tables without
rows, which give none.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import jaccard, lines, packing, quality, suffixes
from eventmart.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of documents, with the number of characters as it is now."""
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose verdict is to keep them, each row on its own.

    A null or empty text has too few words and is rejected. Rows of one id or text are
    judged alike, so a repeated row stays as often as it came.
    """
    return quality.judge(docs, keep=tuple(COLUMNS[1:])).filter("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that at least ten of them hold.

    Each row counts as a document, repeated ones too. A text that loses all its lines, a null
    and an empty one stay as empty texts.
    """
    return _documents(lines.drop_frequent_lines(docs, keep=("lang", "source")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near duplicates.

    A null id is less than others. Of rows with that id one stays, so repeated rows become
    one. Texts without words, null and empty ones too, are near to none and all stay.
    """
    return jaccard.one_of_each(docs, keep=tuple(COLUMNS[2:])).select(*COLUMNS)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the characters that have a byte in a repeated string.

    The string stays in the document of the least id, a null id being the least, and there
    in its first place. Repeated rows are the same document and lose nothing to each other.
    A null text becomes an empty one.
    """
    return _documents(suffixes.remove_repeats(docs, keep=("lang", "source"), as_text=True))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids and places in sequences of 1024.

    Every row is packed, repeated ones too; a null or empty text is the end id alone. Pieces
    of equal length take places in the order in which they come.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# SQL can express neither the packing nor the tokens.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
EXPECTED: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
