"""Customers who bought in both categories (stage 1) and their purchases.

Inputs are review frames of one category each (``books``, ``music``). Only
``customer_id`` and ``product_id`` are read, so the scan is pruned to two
columns. NULL customers never match (equi joins); a NULL product is kept by
``distinct`` and so appears in the pairs, but no count includes it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.blockjoin import HOT_ROWS, grid_join, hot_keys
from revlens.sources.schemas import CATEGORY_COL


def _distinct_purchases(reviews: DataFrame) -> DataFrame:
    return reviews.select("customer_id", "product_id").distinct()


def common_customer_pairs(books: DataFrame, music: DataFrame, hot: int = HOT_ROWS) -> DataFrame:
    """Q12: one row per (book, music) pair of a customer found in both.

    Distinct (customer, product) per side, then an inner equi join on the
    customer. The output is the per-customer product grid by definition; a
    customer of more than ``hot`` products on a side is dealt to a grid of tasks
    by hashes of its products (``blockjoin``).
    """
    b, m = _distinct_purchases(books), _distinct_purchases(music)
    return grid_join(b, m, "customer_id", "product_id", "product_id", hot).select(
        F.col("l_customer_id").alias("customer_id_books"),
        F.col("l_product_id").alias("product_id_books"),
        F.col("r_customer_id").alias("customer_id_music"),
        F.col("r_product_id").alias("product_id_music"),
    )


def _num_products(reviews: DataFrame, name: str) -> DataFrame:
    # count_distinct skips NULL products; planned as a (customer, product)
    # de-duplication followed by a per-customer count, both with partial
    # aggregation, so a hot customer never lands in one task unreduced.
    return reviews.groupBy("customer_id").agg(F.count_distinct("product_id").alias(name))


def qualified_common_customers(
    books: DataFrame, music: DataFrame, more_than_books: int = 4, more_than_music: int = 5
) -> DataFrame:
    """Q13: common customers with strictly more than the given product counts.

    Counted per side before joining: a common customer's pairs are its
    distinct books times its distinct music, so each side's distinct count is
    what the grid would give, without building the grid. Both sides come out
    of their aggregation hash-partitioned by customer, so the join adds no
    exchange.
    """
    nb = _num_products(books, "num_books_products")
    nm = _num_products(music, "num_music_products")
    joined = nb.join(nm, "customer_id", "inner")
    return joined.where(
        (F.col("num_books_products") > int(more_than_books)) & (F.col("num_music_products") > int(more_than_music))
    ).select(F.col("customer_id").alias("customer_id_books"), "num_books_products", "num_music_products")


def qualified_common_customers_from_pairs(
    pairs: DataFrame, more_than_books: int = 4, more_than_music: int = 5
) -> DataFrame:
    """Q13 computed from the staged pairs (the stage-1 hand-off form)."""
    grouped = pairs.groupBy("customer_id_books").agg(
        F.count_distinct("product_id_books").alias("num_books_products"),
        F.count_distinct("product_id_music").alias("num_music_products"),
    )
    return grouped.where(
        (F.col("num_books_products") > int(more_than_books)) & (F.col("num_music_products") > int(more_than_music))
    )


#: Salts of a join on a key that may be hot; fixed, so plans are alike at every size.
SALTS = 16


def salted_join(rows: DataFrame, per_key: DataFrame, key: str, by: str, how: str) -> DataFrame:
    """Join ``rows`` with a table of one row per key, a hot key's rows spread by a hash of ``by``.

    An aggregate lies directly on its exchange, where adaptive execution does
    not split a skewed join; so the one-row side is repeated over ``SALTS``.
    """
    # Never NULL, and known to be: else the join would filter ``rows`` by it, and plans that could share an exchange differ.
    salt = F.coalesce(F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"), F.lit(0))
    spread = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", salt).join(spread, [key, "_salt"], how).drop("_salt")


def purchases_of_common_customers(reviews: DataFrame, books: str, music: str) -> DataFrame:
    """:func:`customer_purchases` of a unified review frame's two categories, which is read once.

    The distinct purchases are dealt once; the customers found in both
    categories are counted from the same exchange.
    """
    side = F.col(CATEGORY_COL)
    rows = reviews.where(side.isin(books, music)).select("customer_id", "product_id", (side == books).alias("_book")).distinct()
    # Sums depend on the distinct step, so it stays in both plans and one exchange serves them.
    both = rows.groupBy("customer_id").agg(F.sum(F.col("_book").cast("int")).alias("_books"), F.count(F.lit(1)).alias("_n"))
    both = both.where((F.col("_books") > 0) & (F.col("_books") < F.col("_n")))
    return salted_join(rows, both.select("customer_id"), "customer_id", "product_id", "left_semi").select("customer_id", "product_id")


def customer_purchases(books: DataFrame, music: DataFrame) -> DataFrame:
    """Q14: distinct (customer, product) per category for common customers, unioned.

    Equal to splitting the Q12 grid back into halves, but linear: each side's
    distinct purchases are semi-joined with the other side's customers. The
    union keeps duplicates, so a product id bought in both categories by one
    customer appears twice.
    """
    b = _distinct_purchases(books)
    m = _distinct_purchases(music)
    # The customer sets are their own per-customer aggregates (already
    # partitioned by customer for the semi joins), not projections of the
    # distinct purchases: a consumer that needs non-NULL products (the
    # self-join of Q15) gets that filter pushed into the purchases, and the
    # customer sets, which must keep NULL-product rows, would otherwise make
    # each side's distinct purchases run twice.
    books_half = salted_join(b, music.select("customer_id").distinct(), "customer_id", "product_id", "left_semi")
    music_half = salted_join(m, books.select("customer_id").distinct(), "customer_id", "product_id", "left_semi")
    return books_half.union(music_half)


def customer_purchases_from_pairs(pairs: DataFrame) -> DataFrame:
    """Q14 from the staged pairs: split into halves, distinct each, union."""
    books_half = pairs.select(
        F.col("customer_id_books").alias("customer_id"), F.col("product_id_books").alias("product_id")
    ).distinct()
    music_half = pairs.select(
        F.col("customer_id_music").alias("customer_id"), F.col("product_id_music").alias("product_id")
    ).distinct()
    return books_half.union(music_half)


#: Products in one block of a customer's side of the factorised grid.
GRID_BLOCK = 1024


def _side_blocks(rows: DataFrame, size: int) -> DataFrame:
    """(customer_id, block, n_rows, n_products, products) of one side's distinct purchases.

    A customer's products lie in blocks of about ``size`` by hash; only customers
    with more than ``size`` of them have several. A NULL product is a row without
    a product.
    """
    many = hot_keys(rows, "customer_id", size).select("customer_id", F.ceil(F.col("_rows") / size).cast("int").alias("_g"))
    dealt = rows.where(F.col("customer_id").isNotNull()).join(F.broadcast(many), "customer_id", "left")
    block = F.pmod(F.xxhash64("product_id"), F.coalesce("_g", F.lit(1))).cast("int")
    return dealt.groupBy("customer_id", block.alias("block")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("product_id").alias("n_products"),
        F.collect_list(F.struct("product_id")).alias("products"),
    )


@dataclass
class FactorisedPairs:
    """Q12's pairs as (customer, book block, music block): two tables of blocks, multiplied out on request only.

    A common customer's pairs are its distinct books times its distinct music.
    ``books`` and ``music`` hold each side's distinct purchases in blocks
    (customer_id, block, n_rows, n_products, products), of common customers
    only. Counts, distinct counts and projections are taken from the blocks, so
    they are linear in the purchases; only :meth:`expand` makes the grid.
    """

    books: DataFrame
    music: DataFrame

    @staticmethod
    def of(books: DataFrame, music: DataFrame, size: int = GRID_BLOCK) -> "FactorisedPairs":
        b, m = _distinct_purchases(books), _distinct_purchases(music)
        own = salted_join(b, music.select("customer_id").distinct(), "customer_id", "product_id", "left_semi")
        other = salted_join(m, books.select("customer_id").distinct(), "customer_id", "product_id", "left_semi")
        return FactorisedPairs(_side_blocks(own, size), _side_blocks(other, size))

    def _sums(self, value: str, books: str, music: str) -> DataFrame:
        b = self.books.groupBy("customer_id").agg(F.sum(value).alias(books))
        m = self.music.groupBy("customer_id").agg(F.sum(value).alias(music))
        return b.join(m, "customer_id")

    def counts(self) -> DataFrame:
        """Pairs of each customer: rows of one side times rows of the other."""
        sums = self._sums("n_rows", "_b", "_m")
        return sums.select("customer_id", (F.col("_b") * F.col("_m")).alias("n_pairs"))

    def qualified(self, more_than_books: int = 4, more_than_music: int = 5) -> DataFrame:
        """Q13: distinct products per side, which the grid repeats but does not add to."""
        sums = self._sums("n_products", "num_books_products", "num_music_products")
        enough = (F.col("num_books_products") > int(more_than_books)) & (F.col("num_music_products") > int(more_than_music))
        return sums.where(enough).select(F.col("customer_id").alias("customer_id_books"), "num_books_products", "num_music_products")

    def project(self, side: str) -> DataFrame:
        """Distinct (customer_id, product_id) of the pairs' ``books`` or ``music`` half."""
        blocks = {"books": self.books, "music": self.music}[side]
        return blocks.select("customer_id", F.inline("products"))

    def purchases(self) -> DataFrame:
        """Q14: both projections, duplicates between them kept."""
        return self.project("books").union(self.project("music"))

    def blocks(self) -> DataFrame:
        """The relation itself: one row per (customer, book block, music block) with both products' arrays."""
        b = self.books.select("customer_id", F.col("block").alias("book_block"), F.col("products").alias("books"))
        m = self.music.select("customer_id", F.col("block").alias("music_block"), F.col("products").alias("music"))
        met = grid_join(b, m, "customer_id", "book_block", "music_block", hot=64)
        return met.select(F.col("l_customer_id").alias("customer_id"), F.col("l_book_block").alias("book_block"), F.col("r_music_block").alias("music_block"), F.col("l_books").alias("books"), F.col("r_music").alias("music"))

    def expand(self) -> DataFrame:
        """Q12: the grid, each block pair multiplied out where it lies."""
        rows = self.blocks().select("customer_id", F.explode("books").alias("book"), "music")
        rows = rows.select("customer_id", "book", F.explode("music").alias("tune"))
        return rows.select(
            F.col("customer_id").alias("customer_id_books"),
            F.col("book.product_id").alias("product_id_books"),
            F.col("customer_id").alias("customer_id_music"),
            F.col("tune.product_id").alias("product_id_music"),
        )
