"""Review sources: declared-schema parquet scans, category tags and the union."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from revlens.sources.schemas import (
    BOOKS,
    CATEGORY_COL,
    MUSIC,
    NEIGHBOUR_LIST_SCHEMA,
    NEIGHBOUR_PAIR_SCHEMA,
    PAIR_SCHEMA,
    PURCHASE_SCHEMA,
    PARTITION_COL,
    REVIEW_SCHEMA,
)


def read_reviews(spark: SparkSession, path: str, category: str | None = None) -> DataFrame:
    """Scan one category's review files with the declared schema.

    ``path`` may be a directory, a file or a glob. A glob inside a hive
    partition directory loses the partition column, so the category is added
    back as a constant column when ``category`` is given.
    """
    df = spark.read.schema(REVIEW_SCHEMA).parquet(path)
    if category is not None:
        df = df.withColumn(CATEGORY_COL, F.lit(category))
    return df


def read_partitioned_reviews(
    spark: SparkSession, root: str, categories: Iterable[str] = (BOOKS, MUSIC)
) -> DataFrame:
    """Scan a review root partitioned as ``product_category=<name>/``.

    The filter on the partition column lets Catalyst prune whole directories
    (``PartitionFilters`` in the scan), so only the asked-for categories are
    listed and read. The partition value becomes ``productCategory``.
    """
    schema = StructType(list(REVIEW_SCHEMA.fields) + [StructField(PARTITION_COL, StringType(), True)])
    df = spark.read.schema(schema).option("basePath", root).parquet(root)
    df = df.where(F.col(PARTITION_COL).isin(list(categories)))
    return df.withColumnRenamed(PARTITION_COL, CATEGORY_COL)


def union_reviews(*frames: DataFrame) -> DataFrame:
    """Positional union of category frames; duplicates are kept (UNION ALL)."""
    first, *rest = frames
    for other in rest:
        if other.columns != first.columns:
            raise ValueError(f"union needs equal column order: {first.columns} vs {other.columns}")
        first = first.union(other)
    return first


def split_categories(reviews: DataFrame, books: str = BOOKS, music: str = MUSIC) -> tuple[DataFrame, DataFrame]:
    """Books and Music halves of a unified review frame (filters reach the scan)."""
    cat = F.col(CATEGORY_COL)
    return reviews.where(cat == books), reviews.where(cat == music)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Staged common-customer pairs (stage 1 -> stage 2 hand-off)."""
    return spark.read.schema(PAIR_SCHEMA).parquet(path)


def read_purchases(spark: SparkSession, path: str) -> DataFrame:
    """Purchases of common customers (optional stage 1 -> stage 2 hand-off)."""
    return spark.read.schema(PURCHASE_SCHEMA).parquet(path)


def read_neighbour_lists(spark: SparkSession, path: str) -> DataFrame:
    """Neighbour lists (stage 2 -> stage 3 hand-off)."""
    return spark.read.schema(NEIGHBOUR_LIST_SCHEMA).parquet(path)


def read_neighbour_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Neighbour pairs, the long form of the lists (optional stage 2 -> 3 hand-off)."""
    return spark.read.schema(NEIGHBOUR_PAIR_SCHEMA).parquet(path)
