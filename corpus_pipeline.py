"""The corpus pipeline: language, exact and near duplicates, privacy, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of ``documents``. Null or empty texts have no language and go in the
first stage; empty tables pass through; further columns pass all stages but the
last.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import exact, langid, minhash, packing, pii
from tracewright.llm._common import renamed, staged, table

#: Texts whose language is less certain are rejected.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language that was learned, with some certainty.

    Null and empty texts and texts without letters go. If no row outside the
    held-out fifth has a language, all texts with a letter stay. Ties go to the
    language first by name; repeated rows fare alike; empty tables stay empty;
    further columns pass.
    """
    names, docs = docs.columns, renamed(docs, "doc_id", "text", "lang")
    return langid.keep_certain(docs, langid.fit(docs), LEAST_SCORE).toDF(*names)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact.keep_one(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest doc_id stays."""
    return minhash.keep_one(docs)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become surrogates; n_chars follows the new text."""
    names, plain = docs.columns, renamed(docs, "doc_id", "text", "n_chars")
    out = pii.replace(plain).select(*plain.columns)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.toDF(*names)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents, packed."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("privacy", privacy),
    ("packing", windows),
]

#: No stage but the second can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; stage results lie in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
