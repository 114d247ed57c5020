"""A training corpus from raw documents: language, boilerplate, near duplicates, secrets, packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. Stages but the last return the columns of
documents. The result of a stage is written as Parquet to the session's shared folder and read again by the next. Empty
tables go through as empty tables; extra columns are dropped at the start.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import langid, line_dedup, ngram_join, packing, secrets
from tabloom.llm.frames import DOCUMENT_COLUMNS, table
from tabloom.llm.queries import WORD_MODEL
from tabloom.session import shared_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null, empty, no letter) go; a null `lang` becomes the predicted one."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    return langid.in_known_language(docs, langid.fit(docs))


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand at many sources are cut but for their first occurrence; documents of which nothing is left go.

    The lines around private keys stay, since the secret scan finds the keys by them.
    """
    cut = line_dedup.dedup_lines(docs, spare=secrets.KEY_LINE)
    kept = cut.where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at 0.8 or more, the one of smallest id stays."""
    return ngram_join.one_of_each(docs, n=5, percent=80).select(*DOCUMENT_COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by the name of their kind; no document goes."""
    clean = secrets.redact(docs.select(*DOCUMENT_COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and offset."""
    packed = packing.pack(packing.pieces(docs, WORD_MODEL))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language ID", identify_language),
    ("line dedup", remove_boilerplate),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack_sequences),
]

#: Language ID and tokenisation have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over `documents`."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for place, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{place}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
