"""Grouped review statistics: counts, shares, helpfulness and length.

Each function takes the unified review frame (or the output of another
statistic) and returns a lazy, sorted DataFrame. Aggregations run partial on
the map side, so only one row per group and task is shuffled; the share
windows then run over the aggregated groups, never over reviews.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.measures import helpful_percent, percent_of_total, review_length, share_percent
from revlens.sources.schemas import BOOKS, CATEGORY_COL, MUSIC

CAT = CATEGORY_COL
N = "n_reviews"


def _count_reviews(reviews: DataFrame, *keys: str) -> DataFrame:
    # count(review_id) skips NULL review ids, unlike count(*).
    return reviews.groupBy(*keys).agg(F.count("review_id").alias(N))


def reviews_share_by_category(reviews: DataFrame) -> DataFrame:
    """Q1: reviews per category and their percent of all reviews."""
    counts = _count_reviews(reviews, CAT)
    return counts.select(CAT, N, percent_of_total(counts, N).alias("reviews_percent"))


def rating_share_by_category(reviews: DataFrame) -> DataFrame:
    """Q2: reviews per (category, star) and percent inside the category."""
    counts = _count_reviews(reviews, CAT, "star_rating")
    return counts.select(
        CAT, "star_rating", N, share_percent(N, [CAT]).alias("reviews_perc")
    ).orderBy(CAT, "star_rating")


def rating_counts(reviews: DataFrame) -> DataFrame:
    """The counts of Q3, unsorted: what Q4-Q6 start from."""
    return reviews.groupBy("marketplace", CAT, "star_rating").agg(F.count("review_id").alias(N))


def rating_counts_by_marketplace(reviews: DataFrame) -> DataFrame:
    """Q3: reviews per (marketplace, category, star)."""
    return rating_counts(reviews).orderBy("marketplace", CAT, F.desc("star_rating"))


def star_share_by_marketplace(rating_counts: DataFrame, star: int) -> DataFrame:
    """Each marketplace's percent of one star value's reviews per category.

    The star filter runs before the share window, so the percent is over that
    star's reviews only; on a lazy plan it reaches the review scan.
    """
    only = rating_counts.where(F.col("star_rating") == star)
    return only.select(
        "marketplace", CAT, "star_rating", N, share_percent(N, [CAT]).alias("percent")
    ).orderBy(CAT, F.desc("percent"))


def five_star_share_by_marketplace(rating_counts: DataFrame) -> DataFrame:
    """Q4: ``star_share_by_marketplace`` for 5 stars."""
    return star_share_by_marketplace(rating_counts, 5)


def one_star_share_by_marketplace(rating_counts: DataFrame) -> DataFrame:
    """Q5: ``star_share_by_marketplace`` for 1 star."""
    return star_share_by_marketplace(rating_counts, 1)


def rating_mix_by_marketplace(rating_counts: DataFrame) -> DataFrame:
    """Q6: share of each star inside (marketplace, category), rounded to 2."""
    pct = F.round(share_percent(N, ["marketplace", CAT]), 2)
    return rating_counts.select("marketplace", CAT, "star_rating", N, pct.alias("total_percent")).orderBy(
        "marketplace", CAT, F.desc("total_percent")
    )


def helpful_share_by_rating(reviews: DataFrame) -> DataFrame:
    """Q7: helpful percent per (category, star), rounded to 2 and then to 0."""
    pct = F.round(F.round(helpful_percent(), 2))
    return reviews.groupBy(CAT, "star_rating").agg(pct.alias("helpful_percent")).orderBy(CAT, "star_rating")


def helpful_heatmap(helpful_by_rating: DataFrame, categories: tuple[str, ...] = (BOOKS, MUSIC)) -> DataFrame:
    """Q8: Q7 reshaped to one row per star and one column per category.

    The category values are given, so the pivot needs no extra job to find them.
    """
    return (
        helpful_by_rating.groupBy("star_rating")
        .pivot(CAT, list(categories))
        .agg(F.first("helpful_percent"))
        .orderBy("star_rating")
    )


def helpful_share_by_marketplace(reviews: DataFrame) -> DataFrame:
    """Q9: Q7's measure per (marketplace, category, star)."""
    pct = F.round(F.round(helpful_percent(), 2))
    return (
        reviews.groupBy("marketplace", CAT, "star_rating")
        .agg(pct.alias("helpful_percent"))
        .orderBy(CAT, "star_rating")
    )


def review_length_and_helpfulness(reviews: DataFrame) -> DataFrame:
    """Q10: average body length and helpful percent rounded once to 2."""
    return (
        reviews.groupBy(CAT, "star_rating")
        .agg(
            F.avg(review_length(reviews)).alias("avg_review_length"),
            F.round(helpful_percent(), 2).alias("helpful_percent"),
        )
        .orderBy(CAT, "star_rating")
    )


def review_length_by_marketplace(reviews: DataFrame) -> DataFrame:
    """Q11: average body length per (marketplace, category, star)."""
    return (
        reviews.groupBy("marketplace", CAT, "star_rating")
        .agg(F.avg(review_length(reviews)).alias("avg_review_length"))
        .orderBy("marketplace", CAT, F.desc("star_rating"))
    )
