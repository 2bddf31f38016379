"""Declared schemas (never inferred) for reviews and the staged tables."""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# The review columns, their types and their order, as the
# review source declares them. All fields are nullable.
REVIEW_SCHEMA = StructType(
    [
        StructField("marketplace", StringType(), True),
        StructField("customer_id", StringType(), True),
        StructField("review_id", StringType(), True),
        StructField("product_id", StringType(), True),
        StructField("product_parent", StringType(), True),
        StructField("product_title", StringType(), True),
        StructField("star_rating", IntegerType(), True),
        StructField("helpful_votes", IntegerType(), True),
        StructField("total_votes", IntegerType(), True),
        StructField("vine", StringType(), True),
        StructField("verified_purchase", StringType(), True),
        StructField("review_headline", StringType(), True),
        StructField("review_body", StringType(), True),
        StructField("review_date", DateType(), True),
        StructField("year", IntegerType(), True),
    ]
)

# Optional column of a review frame: the code points of the body, where only they are asked for.
BODY_LENGTH_COL = "review_body_length"

# Name of the constant column that tags each review with its category.
CATEGORY_COL = "productCategory"
# Name of the hive partition column in a category-partitioned review root.
PARTITION_COL = "product_category"

BOOKS = "Books"
MUSIC = "Music"

# Fixed values, as are the other hand-off schemas below.
# Staged common-customer pairs handed from stage 1 to stage 2.
PAIR_SCHEMA = StructType(
    [
        StructField("customer_id_books", StringType(), True),
        StructField("product_id_books", StringType(), True),
        StructField("customer_id_music", StringType(), True),
        StructField("product_id_music", StringType(), True),
    ]
)

# Purchases of common customers (optional stage 1 -> stage 2 hand-off).
PURCHASE_SCHEMA = StructType(
    [
        StructField("customer_id", StringType(), True),
        StructField("product_id", StringType(), True),
    ]
)

# Neighbour lists handed from stage 2 to stage 3; list elements are never null.
NEIGHBOUR_LIST_SCHEMA = StructType(
    [
        StructField("customer_id", StringType(), True),
        StructField("neighbouring_user_ids", ArrayType(StringType(), False), True),
    ]
)

# Long form of the neighbour lists (optional stage 2 -> stage 3 hand-off).
NEIGHBOUR_PAIR_SCHEMA = StructType(
    [
        StructField("customer_id", StringType(), True),
        StructField("neighbour_customer_id", StringType(), True),
        StructField("n_shared", LongType(), True),
    ]
)

# The same pairs as stage 2 hands them on: with their customer's number of neighbours.
COUNTED_PAIR_SCHEMA = StructType([*NEIGHBOUR_PAIR_SCHEMA.fields, StructField("n_neighbours", LongType(), True)])
