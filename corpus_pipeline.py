"""Documents to packed training sequences, in five stages.

Every stage gets what its predecessor kept, written as Parquet and read again;
all but the last return the columns of documents.

For all stages: rows without doc_id are left out, from the first stage on.  A null
or empty text is a document like any other until the near duplicates: it has
no words, is in no group, and stays.  Repeated rows come out alike, as often as they
stand; rows of one doc_id with different texts are judged one by one, and where a
stage chooses by doc_id (quality, near duplicates, mixture) all of them stay if one
does.  Further columns are dropped, whatever their names; a table without rows
gives one without rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import importance, mixing, ngram_join, packing, pii
from tidemark.llm.session import new_path, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling takes; the others go.  A null or empty text has log weight 0, and is taken or not by that."""
    taken = importance.resampled(docs, table(spark, sf_dir, "labels")).where("sampled").select("doc_id").distinct()
    return docs.join(taken, "doc_id", "left_semi").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of similar ones; texts without words are in no group, and stay."""
    first = ngram_join.similar_documents(docs).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(first, "doc_id", "left_semi").select(COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind, and n_chars of the new text (null for a null text)."""
    return pii.redact(docs.select(COLUMNS), pii.find_personal_data(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn with chances raked to source, language and topic shares; a null source or language is a value of its own."""
    drawn = mixing.mixed(docs).where("sampled").select("doc_id").distinct()
    return docs.join(drawn, "doc_id", "left_semi").select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place; a null or empty text is one piece, the end token."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near duplicates", near_duplicates), ("personal data", personal_data), ("mixture", mixture), ("packing", packed)]
#: Models, components and packing are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
