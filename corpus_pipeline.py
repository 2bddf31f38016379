"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept:
language identification drops what it rejects, the n-gram join keeps one
document of each group (the one of smallest id), decontamination drops documents
with a verified benchmark overlap, personal data is replaced in the texts, and
packing returns the boundary records of all that is left. All stages but the
last return the columns of ``documents``, further ones included.

Rows of one doc_id are one document: its decisions hold for all of them, and
equal rows fall into one. Rows of null doc_id are kept or dropped one by one by
language and, by their texts, by decontamination, and are never copies of
another. An empty table passes all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import decontam, jaccard, langid, packing, pii
from revlens.llm.tables import stored, table

#: Word shingles and similarity (in percent) of near duplicates in the pipeline.
SHINGLE, PERCENT = 5, 80


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that language identification rejects."""
    return langid.accepted(docs, langid.fit_languages(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    groups = jaccard.similarity_components(docs, SHINGLE, PERCENT)
    copies = groups.where("component_id <> doc_id").select("doc_id").distinct()
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    once = docs.join(copies.unionByName(repeated), "doc_id", "left_anti")
    again = docs.join(repeated, "doc_id", "left_semi").join(copies, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"])
    return once.unionByName(again).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that overlap with a benchmark item."""
    # A null id equals no other: such a row is known by its text besides. A row without either has no key and no overlap.
    text = F.col("text").cast("string")
    key = F.when(F.col("doc_id").isNull() & text.isNotNull(), F.xxhash64(text))
    name = "text_key"
    while {name, f"{name}_id", f"{name}_of"} & set(docs.columns):
        name += "_"
    found = decontam.overlaps(docs.select("doc_id", key.alias(name), "text"), table(spark, sf_dir, "benchmark"), keys=("doc_id", name))
    found = found.select(F.col("doc_id").alias(f"{name}_id"), F.col(name).alias(f"{name}_of")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(f"{name}_id")) & F.col(name).eqNullSafe(F.col(f"{name}_of"))
    return docs.withColumn(name, key).join(found, same, "left_anti").select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts."""
    return pii.redact(docs, pii.fit_field())


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of the packed sequences."""
    import public_tokenizers  # only this stage needs the vocabulary files

    return packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", by_language),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminated),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: Models and components cannot be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
