"""Documents to token ids in five stages, each written as Parquet and read again.

language ID -> near-duplicates -> benchmark decontamination -> personal data -> BPE

A stage works on all rows its predecessor kept and returns the columns of ``documents``;
the last one returns tokens.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import bpe, decontam, langid, neardup, pii
from tickforge.llm.common import kept, rows_without, small_batches, table
from tickforge.llm.queries import TOKENIZER
from tickforge.session import run_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model, fitted on these documents, does not reject."""
    small_batches(spark)
    return langid.known_languages(docs.select(*COLUMNS))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of documents linked at 0.8 on shingles of five words.

    Rows that repeat an id count as one document and stay or go together. Rows without an
    id are in no group and stay.
    """
    small_batches(spark)
    groups = neardup.near_duplicates(docs, words=5, percent=80)
    gone = groups.where("doc_id <> component_id").select("doc_id")
    return rows_without(docs.select(*COLUMNS), gone, "doc_id", kept(spark, "gone"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, not even re-parameterised."""
    small_batches(spark)
    found = decontam.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return rows_without(docs.select(*COLUMNS), found, "doc_id", kept(spark, "gone"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data redacted; n_chars follows the text."""
    small_batches(spark)
    clean = pii.without_personal_data(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), and whether they decode back."""
    small_batches(spark)
    encoded = bpe.encode(docs, public_tokenizers.path(TOKENIZER), decoded=True)
    return encoded.select(
        "doc_id",
        bpe.token_count("ids").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", known_language),
    ("near-duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("bpe", tokens),
]

#: Fitted models and token ids are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    folder = run_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{number}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{number}")
    return docs
