"""Corpus pipeline: language ID, near-dedup, suffix-array dedup, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept;
all but the last return the columns of ``documents``.  ``run`` writes each stage's rows as
Parquet in the shared checkpoint folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofit.llm import language_id, mixing, near_dedup, packing, suffix_dedup
from chronofit.llm.common import materialise, read
from chronofit.llm.queries import tokenizer_path


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; null texts and texts without letters go."""
    found = language_id.predict_languages(docs, carry=tuple(docs.columns))
    found = found.filter(F.col("lang_pred") != language_id.UNKNOWN)
    return found.select(*[F.col(f"carry_{c}").alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8 or more)."""
    return near_dedup.keep_one_of_each(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 100-byte strings that start earlier; documents of which nothing is left go.

    ``n_chars`` is counted again; a null text stays null.
    """
    others = [c for c in docs.columns if c != "text"]
    out = suffix_dedup.remove_repeats(docs.withColumn("__null", F.col("text").isNull()), carry=(*others, "__null"), with_text=True)
    out = out.filter((F.col("n_removed") == 0) | (F.col("kept_text") != ""))
    text = F.when(~F.col("carry___null"), F.col("kept_text"))
    columns = {c: F.col(f"carry_{c}") for c in others} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("carry_n_chars")).cast(
            docs.schema["n_chars"].dataType)
    return out.select(*[columns[c].alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, by source weights 1, 2, 3, ... and quality weights."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", identify_languages),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", remove_repeated_passages),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: Learned profiles, hashes and tokens: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
