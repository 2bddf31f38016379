"""revlens: product-review analytics and recommender training sets on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from the
DataFrame API, so Catalyst prunes columns, pushes filters to the parquet scan
and plans the shuffles; adaptive query execution re-plans joins and skew at run
time. Only :mod:`revlens.plans.training_set` writes data, and
:func:`~revlens.operators.report.materialised_report` checkpoints its summary.
"""

from revlens.operators.customers import (
    common_customer_pairs,
    customer_purchases,
    customer_purchases_from_pairs,
    qualified_common_customers,
    qualified_common_customers_from_pairs,
)
from revlens.operators.neighbours import neighbour_edges, neighbour_lists, neighbour_pairs
from revlens.operators.report import materialised_report, review_report, review_summary
from revlens.operators.stats import (
    five_star_share_by_marketplace,
    helpful_heatmap,
    helpful_share_by_marketplace,
    helpful_share_by_rating,
    one_star_share_by_marketplace,
    rating_counts_by_marketplace,
    rating_mix_by_marketplace,
    rating_share_by_category,
    review_length_and_helpfulness,
    review_length_by_marketplace,
    reviews_share_by_category,
    star_share_by_marketplace,
)
from revlens.operators.triples import (
    user_triple_counts,
    user_triple_counts_from_edges,
    user_triple_counts_from_pairs,
    user_triples,
    user_triples_from_pairs,
)

__all__ = [
    "common_customer_pairs",
    "customer_purchases",
    "customer_purchases_from_pairs",
    "five_star_share_by_marketplace",
    "helpful_heatmap",
    "helpful_share_by_marketplace",
    "helpful_share_by_rating",
    "materialised_report",
    "neighbour_edges",
    "neighbour_lists",
    "neighbour_pairs",
    "one_star_share_by_marketplace",
    "qualified_common_customers",
    "qualified_common_customers_from_pairs",
    "rating_counts_by_marketplace",
    "rating_mix_by_marketplace",
    "rating_share_by_category",
    "review_length_and_helpfulness",
    "review_length_by_marketplace",
    "review_report",
    "review_summary",
    "reviews_share_by_category",
    "star_share_by_marketplace",
    "user_triple_counts",
    "user_triple_counts_from_edges",
    "user_triple_counts_from_pairs",
    "user_triples",
    "user_triples_from_pairs",
]
