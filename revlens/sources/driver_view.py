"""Review view over the TPC-H-like driver tables.

A ``lineitem`` row plays one review if its part is of type ECONOMY or STANDARD
(Books), or PROMO or SMALL (Music); the rest, a third, is dropped. Lookups that only add
columns (order -> customer -> nation -> region, document text) are LEFT joins
on key columns (unique in the driver tables), so they neither drop nor
duplicate reviews; they are planned only when a caller asks for the columns
they provide, since Spark does not remove an unused join by itself.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.sources.schemas import BODY_LENGTH_COL, BOOKS, CATEGORY_COL, MUSIC, REVIEW_SCHEMA

# Part types that make up each category.
BOOK_TYPES = ("ECONOMY", "STANDARD")
MUSIC_TYPES = ("PROMO", "SMALL")

REVIEW_COLUMNS = tuple(f.name for f in REVIEW_SCHEMA.fields) + (CATEGORY_COL,)
_NEEDS_CUSTOMER_DIM = {"marketplace"}
_NEEDS_ORDERS = {"customer_id", "marketplace"}
_NEEDS_DOCUMENTS = {"review_body", BODY_LENGTH_COL}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def driver_reviews(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Unified review frame (15 review columns + ``productCategory``).

    ``columns`` names the columns the caller uses; the others come back as
    typed NULLs and their lookup joins are left out of the plan. The body's
    length comes as one column more where it is named: it is taken before the
    documents are joined, so no text crosses a join for it.
    """
    wanted = set(REVIEW_COLUMNS if columns is None else columns) | {CATEGORY_COL}
    unknown = wanted - set(REVIEW_COLUMNS) - {BODY_LENGTH_COL}
    if unknown:
        raise ValueError(f"unknown review columns: {sorted(unknown)}")

    part = (
        _table(spark, sf_dir, "part")
        .where(F.col("p_type").isin(*BOOK_TYPES, *MUSIC_TYPES))
        .select(
            "p_partkey",
            "p_name",
            "p_size",
            F.when(F.col("p_type").isin(*BOOK_TYPES), F.lit(BOOKS)).otherwise(F.lit(MUSIC)).alias(CATEGORY_COL),
        )
    )
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"
    )
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")

    marketplace = F.lit(None).cast("string")
    if wanted & _NEEDS_CUSTOMER_DIM:
        # customer -> nation -> region is a dimension chain; it is joined to
        # the orders (a quarter of the line rows) on the customer key, so the
        # line stream is shuffled by the order key only.
        customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
        region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
        market = (
            customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
            .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
            .select("c_custkey", "r_name")
        )
        orders = orders.join(market, orders.o_custkey == market.c_custkey, "left").select(
            "o_orderkey", "o_custkey", "r_name"
        )
        marketplace = F.col("r_name")

    rev = lines.join(part, lines.l_partkey == part.p_partkey, "inner")
    customer_id = F.lit(None).cast("string")
    if wanted & _NEEDS_ORDERS:
        # A LEFT join on the orders key adds columns only; without the
        # customer columns it is left out, which spares the statistics a
        # shuffle of the line stream by order key on large tables.
        rev = rev.join(orders, rev.l_orderkey == orders.o_orderkey, "left")
        customer_id = F.col("o_custkey").cast("string")

    body = F.lit(None).cast("string")
    if wanted & _NEEDS_DOCUMENTS:
        # Lines go round all documents; the number of documents is a scalar
        # subquery. Spark picks the join by size.
        documents = _table(spark, sf_dir, "documents")
        n_documents = documents.select(F.count(F.lit(1))).scalar()
        asked = {"review_body": F.col("text"), BODY_LENGTH_COL: F.length("text").alias("_length")}
        docs = documents.select("doc_id", *(c for name, c in asked.items() if name in wanted))
        rev = rev.join(docs, ((rev.l_orderkey + rev.l_linenumber) % n_documents) == docs.doc_id, "left")
        if "review_body" in wanted:
            body = F.col("text")

    quantity = F.col("l_quantity").cast("int")
    title = F.col("p_name")
    exprs = {
        "marketplace": marketplace,
        "customer_id": customer_id,
        "review_id": F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")),
        "product_id": F.col("l_partkey").cast("string"),
        "product_parent": F.col("l_partkey").cast("string"),
        "product_title": title,
        "star_rating": ((F.col("l_linenumber") - 1) % 5 + 1).cast("int"),
        "helpful_votes": F.least(quantity, F.col("p_size")).cast("int"),
        "total_votes": quantity,
        "vine": F.lit("N"),
        "verified_purchase": F.col("l_returnflag"),
        "review_headline": title,
        "review_body": body,
        "review_date": F.col("l_shipdate").cast("date"),
        "year": F.year("l_shipdate").cast("int"),
        CATEGORY_COL: F.col(CATEGORY_COL),
    }
    out = []
    for field in list(REVIEW_SCHEMA.fields) + [None]:
        name = CATEGORY_COL if field is None else field.name
        expr = exprs[name] if name in wanted else F.lit(None).cast(field.dataType)
        out.append(expr.alias(name))
    if BODY_LENGTH_COL in wanted:
        out.append(F.col("_length").alias(BODY_LENGTH_COL))
    return rev.select(*out)
