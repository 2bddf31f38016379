"""

Every review query reads the whole driver tables under ``sf_dir`` through the
review view (``revlens.sources.driver_view``), whose two categories take up two
of three line items, and runs one operator of the engine.
The oracle SQL builds the same view in DuckDB and states each result in the
plainest SQL, often in the literal form the operator avoids (for example the
per-customer product grid), so it checks the rewrite as well as the value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revlens.operators import complement, customers, neighbours, stats, triples
from revlens.operators.addressable import AddressableTriples
from revlens.plans.session import checkpoint_dir
from revlens.plans.training_set import build_training_set
from revlens.sources.driver_view import REVIEW_COLUMNS, driver_reviews
from revlens.sources.handoff import Workspace
from revlens.sources.readers import read_reviews, split_categories, union_reviews
from revlens.sources.schemas import BODY_LENGTH_COL, BOOKS, MUSIC, PARTITION_COL
from revlens.sources.sinks import write_parquet

# The training-data operators are an optional subpackage. Only its absence is
# accepted here; any other import error is a fault and is raised.
try:
    import corpus_pipeline
    from revlens.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "revlens.llm", "revlens.llm.queries"):
        raise
    corpus_pipeline = llm = None

FLAGSHIP_SF_DIR = "/root/testdata/sf0.001"

# Columns each family of queries reads from the review view.
_COUNT_COLS = ("review_id", "star_rating")
_MARKET_COUNT_COLS = ("marketplace", "review_id", "star_rating")
_HELPFUL_COLS = ("star_rating", "helpful_votes", "total_votes")
_LENGTH_COLS = ("star_rating", "helpful_votes", "total_votes", BODY_LENGTH_COL)
_CUSTOMER_COLS = ("customer_id", "product_id")


def _reviews(spark: SparkSession, sf_dir: str, cols) -> DataFrame:
    return driver_reviews(spark, sf_dir, cols)


def _sides(spark: SparkSession, sf_dir: str):
    return split_categories(_reviews(spark, sf_dir, _CUSTOMER_COLS))


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.purchases_of_common_customers(_reviews(spark, sf_dir, _CUSTOMER_COLS), BOOKS, MUSIC)


def _staged_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purchases, written once: the self-join counts, deals and joins them without deriving them again."""
    return Workspace(spark, "purchases").stage(_purchases(spark, sf_dir), "purchases")


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbour_edges(_staged_purchases(spark, sf_dir))


def _staged_groups(spark: SparkSession, sf_dir: str, work: Workspace) -> DataFrame:
    """Neighbour pairs, grouped by customer, as a stage of ``work``; products are multiplied out once, for the write."""
    with Workspace(spark, "purchases") as own:
        purchases = own.stage(_purchases(spark, sf_dir), "purchases")
        return work.stage([neighbours.neighbour_groups(e) for e in neighbours.edge_group_passes(purchases, work=own)], "pairs")


def _lists(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    edges = neighbours.edge_groups(_staged_purchases(spark, sf_dir), limit=None)
    return neighbours.neighbour_lists(edges, ordered=ordered)


def _finished(build: Callable[[Workspace], DataFrame], spark: SparkSession, name: str) -> DataFrame:
    """A result written as the one stage that is left; the stages it was built from are removed, also on failure."""
    out = Workspace(spark, f"{name}-result")
    with Workspace(spark, name) as work:
        return out.stage(build(work), "result")


#: Elements of one block of a neighbour list, and triples of a registered slice.
LIST_BLOCK, SLICE = 100, 100_000


def _list_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q16 in blocks of at most ``LIST_BLOCK`` elements."""
    build = lambda work: neighbours.list_blocks_of_groups(_staged_groups(spark, sf_dir, work), work, LIST_BLOCK)
    return _finished(build, spark, "list-blocks")


def _triple_slice(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Q17/Q18: the ``SLICE`` triples from the middle of the bag on, by their numbers."""

    def build(work: Workspace) -> DataFrame:
        bag = AddressableTriples(_staged_groups(spark, sf_dir, work), mode, work)
        return bag.slice(bag.total // 2, bag.total // 2 + SLICE)

    return _finished(build, spark, f"slice-{mode}")


def _triple_digests(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Q17/Q18: per (user, positive) the count and digest of its negatives, without building them."""
    return complement.triple_digests_from_groups(_staged_groups(spark, sf_dir, Workspace(spark, "pairs")), mode)


def _factorised(spark: SparkSession, sf_dir: str) -> customers.FactorisedPairs:
    """Q12 as blocks of products per customer and side, written once."""
    pairs = customers.FactorisedPairs.of(*_sides(spark, sf_dir), size=GRID_BLOCK)
    work = Workspace(spark, "grid")
    return customers.FactorisedPairs(work.stage(pairs.books, "books"), work.stage(pairs.music, "music"))


#: Products of one block of the factorised pair grid.
GRID_BLOCK = 8


def _rating_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.rating_counts_by_marketplace(_reviews(spark, sf_dir, _MARKET_COUNT_COLS))


def _unsorted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.rating_counts(_reviews(spark, sf_dir, _MARKET_COUNT_COLS))


def _work_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder; whoever runs many queries empties that folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/revlens-{name}-{uuid.uuid4().hex}"


def _written_reviews(spark: SparkSession, sf_dir: str, columns, root: str) -> None:
    """The job's input layout: review files in one folder per category, from one pass over the view."""
    reviews = driver_reviews(spark, sf_dir, columns).withColumnRenamed("productCategory", PARTITION_COL)
    write_parquet(reviews, root, by=PARTITION_COL)


def _share_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 as a reader of category files runs it: declared schema, category tag, union."""
    root = _work_folder(spark, "category-files")
    _written_reviews(spark, sf_dir, _COUNT_COLS, root)
    halves = [read_reviews(spark, f"{root}/{PARTITION_COL}={c}", c) for c in (BOOKS, MUSIC)]
    return stats.reviews_share_by_category(union_reviews(*halves))


def _triple_counts(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Q17/Q18 factorised: positives, exclusions and the user total from one written table of pairs.

    The product self-join runs once, for the write; a lost executor later does not run it again.
    """
    return triples.user_triple_counts_from_groups(_staged_groups(spark, sf_dir, Workspace(spark, "pairs")), mode)


def _training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q19 end to end: stages 1-3 through parquet, read back from stage 3.

    Review files per category are written first (the job's input layout), with
    every review column but the body, which the job never reads; all hand-offs
    are the linear ones, and stage 3 writes the exact factorised triples.
    """
    base = _work_folder(spark, "training-set")
    columns = [c for c in REVIEW_COLUMNS if c != "review_body"]
    _written_reviews(spark, sf_dir, columns, f"{base}/reviews")
    folders = [f"{base}/reviews/{PARTITION_COL}={c}" for c in (BOOKS, MUSIC)]
    built = build_training_set(spark, *folders, f"{base}/out")
    return spark.read.parquet(built.paths["triple_counts"])


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # Q1
        "reviews_share_by_category": lambda s, d: stats.reviews_share_by_category(_reviews(s, d, _COUNT_COLS)),
        # Q1 through the declared-schema readers (S1, P4, U1)
        "reviews_share_from_category_files": _share_from_files,
        # Q2
        "rating_share_by_category": lambda s, d: stats.rating_share_by_category(_reviews(s, d, _COUNT_COLS)),
        # Q3
        "rating_counts_by_marketplace": _rating_counts,
        # Q4
        "five_star_share_by_marketplace": lambda s, d: stats.five_star_share_by_marketplace(_unsorted_counts(s, d)),
        # Q5
        "one_star_share_by_marketplace": lambda s, d: stats.one_star_share_by_marketplace(_unsorted_counts(s, d)),
        # Q6
        "rating_mix_by_marketplace": lambda s, d: stats.rating_mix_by_marketplace(_unsorted_counts(s, d)),
        # Q7
        "helpful_share_by_rating": lambda s, d: stats.helpful_share_by_rating(_reviews(s, d, _HELPFUL_COLS)),
        # Q8
        "helpful_heatmap": lambda s, d: stats.helpful_heatmap(
            stats.helpful_share_by_rating(_reviews(s, d, _HELPFUL_COLS))
        ),
        # Q9
        "helpful_share_by_marketplace": lambda s, d: stats.helpful_share_by_marketplace(
            _reviews(s, d, ("marketplace",) + _HELPFUL_COLS)
        ),
        # Q10
        "review_length_and_helpfulness": lambda s, d: stats.review_length_and_helpfulness(
            _reviews(s, d, _LENGTH_COLS)
        ),
        # Q11
        "review_length_by_marketplace": lambda s, d: stats.review_length_by_marketplace(
            _reviews(s, d, ("marketplace", "star_rating", BODY_LENGTH_COL))
        ),
        # Q12
        "common_customer_pairs": lambda s, d: customers.common_customer_pairs(*_sides(s, d)),
        # Q13
        "qualified_common_customers": lambda s, d: customers.qualified_common_customers(*_sides(s, d), 4, 5),
        # Q12 factorised; Q13 and Q14 taken from it without expanding it
        "common_customer_pair_counts": lambda s, d: _factorised(s, d).counts(),
        "qualified_from_factorised_pairs": lambda s, d: _factorised(s, d).qualified(4, 5),
        "purchases_from_factorised_pairs": lambda s, d: _factorised(s, d).purchases(),
        "common_customer_pairs_expanded": lambda s, d: _factorised(s, d).expand(),
        # Q14
        "customer_purchases": _purchases,
        # Q15
        "neighbour_edges": _edges,
        # Q16
        "neighbour_lists": lambda s, d: _lists(s, d, ordered=True),
        # Q16, long form
        "neighbour_pairs": lambda s, d: neighbours.neighbour_pairs(neighbours.edge_groups(_staged_purchases(s, d))),
        # Q15 + Q16, heavy products by cells of the matrix product: as it decides itself, and with every product heavy
        "neighbour_pairs_by_cells": lambda s, d: neighbours.shared_product_counts(_staged_purchases(s, d)),
        "neighbour_pairs_all_by_cells": lambda s, d: neighbours.shared_product_counts(_staged_purchases(s, d), heavy=0),
        # Q16 in blocks
        "neighbour_list_blocks": _list_blocks,
        # Q17, factorised
        "user_triple_counts_as_written": lambda s, d: _triple_counts(s, d, "as_written"),
        # Q18, factorised
        "user_triple_counts_documented": lambda s, d: _triple_counts(s, d, "documented"),
        # Q17, Q18: aggregates over the negatives, and triples by their numbers
        "user_triple_digests_as_written": lambda s, d: _triple_digests(s, d, "as_written"),
        "user_triple_digests_documented": lambda s, d: _triple_digests(s, d, "documented"),
        "user_triple_slice_as_written": lambda s, d: _triple_slice(s, d, "as_written"),
        "user_triple_slice_documented": lambda s, d: _triple_slice(s, d, "documented"),
        # Q19
        "build_training_set": _training_set,
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: reviews per (category, star) with their share (sf0.001)."""
    return stats.rating_share_by_category(_reviews(spark, FLAGSHIP_SF_DIR, _COUNT_COLS))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm is None:
        return _queries()
    return {**_queries(), **llm.queries(), "pipeline": corpus_pipeline.run}


# --------------------------------------------------------------------------
# DuckDB oracle
# --------------------------------------------------------------------------

REVIEWS_SQL = """
n_documents AS MATERIALIZED (SELECT count(*) AS n FROM documents),
reviews AS (
  SELECT
    r.r_name AS marketplace,
    CAST(o.o_custkey AS VARCHAR) AS customer_id,
    CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS review_id,
    CAST(l.l_partkey AS VARCHAR) AS product_id,
    CAST((l.l_linenumber - 1) % 5 + 1 AS INTEGER) AS star_rating,
    CAST(least(CAST(l.l_quantity AS INTEGER), p.p_size) AS INTEGER) AS helpful_votes,
    CAST(l.l_quantity AS INTEGER) AS total_votes,
    d.text AS review_body,
    CASE WHEN p.p_type IN ('ECONOMY', 'STANDARD') THEN 'Books' ELSE 'Music' END AS productCategory
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  CROSS JOIN n_documents nd
  LEFT JOIN documents d ON d.doc_id = (l.l_orderkey + l.l_linenumber) % nd.n
  WHERE p.p_type IN ('ECONOMY', 'STANDARD', 'PROMO', 'SMALL')
)"""

_MARKET_COUNTS = """
counts AS (
  SELECT marketplace, productCategory, star_rating, count(review_id) AS n_reviews
  FROM reviews GROUP BY marketplace, productCategory, star_rating
)"""

_HELPFUL = "sum(helpful_votes) / nullif(sum(total_votes), 0) * 100"

_PAIRS = """
b AS (SELECT DISTINCT customer_id AS customer_id_books, product_id AS product_id_books
      FROM reviews WHERE productCategory = 'Books'),
m AS (SELECT DISTINCT customer_id AS customer_id_music, product_id AS product_id_music
      FROM reviews WHERE productCategory = 'Music'),
pairs AS (SELECT * FROM b JOIN m ON b.customer_id_books = m.customer_id_music)"""

_PURCHASES = (
    _PAIRS
    + """,
purchases AS (
  (SELECT DISTINCT customer_id_books AS customer_id, product_id_books AS product_id FROM pairs)
  UNION ALL
  (SELECT DISTINCT customer_id_music AS customer_id, product_id_music AS product_id FROM pairs)
)"""
)

_EDGES = (
    _PURCHASES
    + """,
edges AS (
  SELECT a.customer_id, a.product_id,
         x.customer_id AS neighbour_customer_id, x.product_id AS neighbour_product_id
  FROM purchases a JOIN purchases x
    ON a.product_id = x.product_id AND a.customer_id <> x.customer_id
)"""
)


def _triple_counts_sql(documented: bool) -> str:
    excluded = (
        """,
excluded AS (
  SELECT e.customer_id AS user_id, count(DISTINCT e.neighbour_customer_id) AS n_excluded
  FROM edges e
  WHERE e.neighbour_customer_id <> e.customer_id
    AND e.neighbour_customer_id IN (SELECT customer_id FROM users)
  GROUP BY e.customer_id
)"""
        if documented
        else ""
    )
    n_negative = "(nu.n - 1 - coalesce(x.n_excluded, 0))" if documented else "(nu.n - 1)"
    join_excluded = "LEFT JOIN excluded x ON x.user_id = p.user_id" if documented else ""
    return f"""
WITH {REVIEWS_SQL}, {_EDGES},
users AS (SELECT DISTINCT customer_id FROM edges),
nu AS (SELECT count(*) AS n FROM users),
pos AS (
  SELECT customer_id AS user_id, neighbour_customer_id AS positive_user_id, count(*) AS n_positive
  FROM edges GROUP BY customer_id, neighbour_customer_id
){excluded}
SELECT p.user_id, p.positive_user_id, p.n_positive,
       CAST({n_negative} AS BIGINT) AS n_negative,
       CAST(p.n_positive * {n_negative} AS BIGINT) AS n_triples
FROM pos p CROSS JOIN nu {join_excluded}
"""


_USERS = """
users AS (SELECT DISTINCT customer_id FROM edges),
linked AS (SELECT DISTINCT customer_id, neighbour_customer_id FROM edges),
pos AS (
  SELECT customer_id AS user_id, neighbour_customer_id AS positive_user_id, count(*) AS n_positive
  FROM edges GROUP BY customer_id, neighbour_customer_id
)"""


def _negatives_sql(documented: bool, among: str) -> str:
    """All (user, negative) pairs of the users in ``among``, built out."""
    unlinked = "WHERE NOT EXISTS (SELECT 1 FROM linked k WHERE k.customer_id = u.user_id AND k.neighbour_customer_id = o.customer_id)"
    return f"""
  SELECT u.user_id, o.customer_id AS negative_user_id
  FROM (SELECT DISTINCT user_id FROM {among}) u JOIN users o ON o.customer_id <> u.user_id
  {unlinked if documented else ''}"""


def _triple_digests_sql(documented: bool) -> str:
    return f"""
WITH {REVIEWS_SQL}, {_EDGES}, {_USERS},
negatives AS ({_negatives_sql(documented, 'pos')}),
per_user AS (
  SELECT user_id, count(*) AS n, sum(CAST('0x' || substr(md5(negative_user_id), 1, 8) AS BIGINT)) AS digest
  FROM negatives GROUP BY user_id
)
SELECT p.user_id, p.positive_user_id, p.n_positive,
       CAST(coalesce(u.n, 0) AS BIGINT) AS n_negative, CAST(coalesce(u.digest, 0) AS BIGINT) AS negatives_digest
FROM pos p LEFT JOIN per_user u USING (user_id)
"""


def _triple_slice_sql(documented: bool) -> str:
    """The same numbering in plain SQL: triples before a row by a window, the slice's negatives built out and numbered."""
    own = "(SELECT count(*) FROM linked k WHERE k.customer_id = p.user_id)" if documented else "0"
    return f"""
WITH {REVIEWS_SQL}, {_EDGES}, {_USERS},
counted AS (SELECT p.*, (SELECT count(*) FROM users) - 1 - {own} AS n_negative FROM pos p),
numbered AS (
  SELECT *, sum(n_positive * n_negative) OVER (ORDER BY user_id, positive_user_id) - n_positive * n_negative AS first FROM counted
),
bounds AS MATERIALIZED (SELECT max(first + n_positive * n_negative) // 2 AS lo, max(first + n_positive * n_negative) // 2 + {SLICE} AS hi FROM numbered),
touched AS (SELECT numbered.* FROM numbered, bounds WHERE first < hi AND first + n_positive * n_negative > lo),
negatives AS ({_negatives_sql(documented, 'touched')}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY negative_user_id) - 1 AS k FROM negatives),
occurrences AS (SELECT user_id, positive_user_id, first, n_negative, unnest(generate_series(0, n_positive - 1)) AS nth FROM touched),
built AS (
  SELECT CAST(first + nth * n_negative + k AS BIGINT) AS ordinal, user_id, positive_user_id, negative_user_id
  FROM occurrences JOIN ranked USING (user_id)
)
SELECT built.* FROM built, bounds WHERE ordinal >= lo AND ordinal < hi
"""


def _list_blocks_sql() -> str:
    return f"""
WITH {REVIEWS_SQL}, {_EDGES},
lists AS (
  SELECT customer_id, list(neighbour_customer_id ORDER BY neighbour_customer_id) AS ids FROM edges GROUP BY customer_id
),
cut AS (SELECT *, unnest(generate_series(0, (len(ids) - 1) // {LIST_BLOCK})) AS block_no FROM lists)
SELECT customer_id, CAST(block_no AS BIGINT) AS block_no, CAST(block_no * {LIST_BLOCK} AS BIGINT) AS "first",
       ids[block_no * {LIST_BLOCK} + 1 : (block_no + 1) * {LIST_BLOCK}] AS neighbouring_user_ids
FROM cut
"""


def _oracle() -> dict[str, str]:
    w = f"WITH {REVIEWS_SQL}"
    pairs = f"""{w}, {_PAIRS}
SELECT customer_id_books, product_id_books, customer_id_music, product_id_music FROM pairs"""
    qualified = f"""{w}, {_PAIRS}
SELECT customer_id_books,
       count(DISTINCT product_id_books) AS num_books_products,
       count(DISTINCT product_id_music) AS num_music_products
FROM pairs GROUP BY customer_id_books
HAVING count(DISTINCT product_id_books) > 4 AND count(DISTINCT product_id_music) > 5"""
    shared = f"""{w}, {_EDGES}
SELECT customer_id, neighbour_customer_id, count(*) AS n_shared
FROM edges GROUP BY customer_id, neighbour_customer_id"""
    return {
        "common_customer_pair_counts": f"""{w}, {_PAIRS}
SELECT customer_id_books AS customer_id, count(*) AS n_pairs FROM pairs GROUP BY customer_id_books""",
        "common_customer_pairs_expanded": pairs,
        "qualified_from_factorised_pairs": qualified,
        "purchases_from_factorised_pairs": f"""{w}, {_PURCHASES}
SELECT customer_id, product_id FROM purchases""",
        "neighbour_pairs_by_cells": shared,
        "neighbour_pairs_all_by_cells": shared,
        "reviews_share_by_category": f"""{w}
SELECT productCategory, count(review_id) AS n_reviews,
       count(review_id) / sum(count(review_id)) OVER () * 100 AS reviews_percent
FROM reviews GROUP BY productCategory""",
        "reviews_share_from_category_files": f"""{w}
SELECT productCategory, count(review_id) AS n_reviews,
       count(review_id) / sum(count(review_id)) OVER () * 100 AS reviews_percent
FROM reviews GROUP BY productCategory""",
        "rating_share_by_category": f"""{w}
SELECT productCategory, star_rating, count(review_id) AS n_reviews,
       count(review_id) / sum(count(review_id)) OVER (PARTITION BY productCategory) * 100 AS reviews_perc
FROM reviews GROUP BY productCategory, star_rating
ORDER BY productCategory, star_rating""",
        "rating_counts_by_marketplace": f"""{w}, {_MARKET_COUNTS}
SELECT * FROM counts ORDER BY marketplace, productCategory, star_rating DESC""",
        "five_star_share_by_marketplace": f"""{w}, {_MARKET_COUNTS}
SELECT marketplace, productCategory, star_rating, n_reviews,
       n_reviews / sum(n_reviews) OVER (PARTITION BY productCategory) * 100 AS "percent"
FROM counts WHERE star_rating = 5
ORDER BY productCategory, "percent" DESC""",
        "one_star_share_by_marketplace": f"""{w}, {_MARKET_COUNTS}
SELECT marketplace, productCategory, star_rating, n_reviews,
       n_reviews / sum(n_reviews) OVER (PARTITION BY productCategory) * 100 AS "percent"
FROM counts WHERE star_rating = 1
ORDER BY productCategory, "percent" DESC""",
        "rating_mix_by_marketplace": f"""{w}, {_MARKET_COUNTS}
SELECT marketplace, productCategory, star_rating, n_reviews,
       round(n_reviews / sum(n_reviews) OVER (PARTITION BY marketplace, productCategory) * 100, 2)
         AS total_percent
FROM counts ORDER BY marketplace, productCategory, total_percent DESC""",
        "helpful_share_by_rating": f"""{w}
SELECT productCategory, star_rating, round(round({_HELPFUL}, 2)) AS helpful_percent
FROM reviews GROUP BY productCategory, star_rating ORDER BY productCategory, star_rating""",
        "helpful_heatmap": f"""{w},
h AS (SELECT productCategory, star_rating, round(round({_HELPFUL}, 2)) AS helpful_percent
      FROM reviews GROUP BY productCategory, star_rating)
SELECT star_rating,
       max(CASE WHEN productCategory = 'Books' THEN helpful_percent END) AS Books,
       max(CASE WHEN productCategory = 'Music' THEN helpful_percent END) AS Music
FROM h GROUP BY star_rating ORDER BY star_rating""",
        "helpful_share_by_marketplace": f"""{w}
SELECT marketplace, productCategory, star_rating, round(round({_HELPFUL}, 2)) AS helpful_percent
FROM reviews GROUP BY marketplace, productCategory, star_rating
ORDER BY productCategory, star_rating""",
        "review_length_and_helpfulness": f"""{w}
SELECT productCategory, star_rating, avg(length(review_body)) AS avg_review_length,
       round({_HELPFUL}, 2) AS helpful_percent
FROM reviews GROUP BY productCategory, star_rating ORDER BY productCategory, star_rating""",
        "review_length_by_marketplace": f"""{w}
SELECT marketplace, productCategory, star_rating, avg(length(review_body)) AS avg_review_length
FROM reviews GROUP BY marketplace, productCategory, star_rating
ORDER BY marketplace, productCategory, star_rating DESC""",
        "common_customer_pairs": pairs,
        "qualified_common_customers": qualified,
        "customer_purchases": f"""{w}, {_PURCHASES}
SELECT customer_id, product_id FROM purchases""",
        "neighbour_edges": f"""{w}, {_EDGES}
SELECT customer_id, product_id, neighbour_customer_id, neighbour_product_id FROM edges""",
        "neighbour_lists": f"""{w}, {_EDGES}
SELECT customer_id, list(neighbour_customer_id ORDER BY neighbour_customer_id) AS neighbouring_user_ids
FROM edges GROUP BY customer_id""",
        "neighbour_pairs": shared,
        "neighbour_list_blocks": _list_blocks_sql(),
        "user_triple_digests_as_written": _triple_digests_sql(False),
        "user_triple_digests_documented": _triple_digests_sql(True),
        "user_triple_slice_as_written": _triple_slice_sql(False),
        "user_triple_slice_documented": _triple_slice_sql(True),
        "user_triple_counts_as_written": _triple_counts_sql(False),
        "user_triple_counts_documented": _triple_counts_sql(True),
        "build_training_set": _triple_counts_sql(True),
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the keys of ``queries()`` that SQL can express (same column names)."""
    if llm is None:
        return _oracle()
    own = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**_oracle(), **llm.oracle_sql(), **own}
