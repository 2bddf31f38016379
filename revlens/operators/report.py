"""All review statistics (Q1-Q11) from one pass over the reviews.

Every statistic is a count, a ratio of integer sums or an average of integer
lengths over (marketplace, category, star) or a coarser grouping. So one
aggregation at that grain, with counts and integer sums kept separately,
holds everything: coarser groups add the partial sums, and the ratios and
averages are taken last, exactly as the direct queries take them. The reviews
are scanned once and never cached; the summary has at most
marketplaces x categories x stars rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.measures import percent_of_total, review_length, share_percent
from revlens.operators import stats
from revlens.sources.schemas import CATEGORY_COL

CAT = CATEGORY_COL
N = stats.N


def review_summary(reviews: DataFrame) -> DataFrame:
    """Counts and integer sums per (marketplace, category, star)."""
    return reviews.groupBy("marketplace", CAT, "star_rating").agg(
        F.count("review_id").alias(N),
        F.sum("helpful_votes").alias("sum_helpful_votes"),
        F.sum("total_votes").alias("sum_total_votes"),
        F.sum(review_length(reviews)).alias("sum_review_length"),
        F.count(review_length(reviews)).alias("n_review_length"),
    )


def _helpful() -> Column:
    return F.try_divide(F.sum("sum_helpful_votes"), F.sum("sum_total_votes")) * 100


def _avg_length() -> Column:
    # avg() of integer lengths is their sum over their count
    return F.try_divide(F.sum("sum_review_length").cast("double"), F.sum("n_review_length"))


def review_report(summary: DataFrame) -> dict[str, DataFrame]:
    """Q1-Q11 from :func:`review_summary`, with the same columns and order."""
    counts = summary.groupBy("marketplace", CAT, "star_rating").agg(F.sum(N).alias(N))
    by_cat = summary.groupBy(CAT).agg(F.sum(N).alias(N))
    by_cat_star = summary.groupBy(CAT, "star_rating").agg(F.sum(N).alias(N))
    rating_counts = counts.orderBy("marketplace", CAT, F.desc("star_rating"))
    helpful_by_rating = (
        summary.groupBy(CAT, "star_rating")
        .agg(F.round(F.round(_helpful(), 2)).alias("helpful_percent"))
        .orderBy(CAT, "star_rating")
    )
    return {
        "reviews_share_by_category": by_cat.select(CAT, N, percent_of_total(by_cat, N).alias("reviews_percent")),
        "rating_share_by_category": by_cat_star.select(
            CAT, "star_rating", N, share_percent(N, [CAT]).alias("reviews_perc")
        ).orderBy(CAT, "star_rating"),
        "rating_counts_by_marketplace": rating_counts,
        "five_star_share_by_marketplace": stats.five_star_share_by_marketplace(counts),
        "one_star_share_by_marketplace": stats.one_star_share_by_marketplace(counts),
        "rating_mix_by_marketplace": stats.rating_mix_by_marketplace(counts),
        "helpful_share_by_rating": helpful_by_rating,
        "helpful_heatmap": stats.helpful_heatmap(helpful_by_rating),
        "helpful_share_by_marketplace": summary.groupBy("marketplace", CAT, "star_rating")
        .agg(F.round(F.round(_helpful(), 2)).alias("helpful_percent"))
        .orderBy(CAT, "star_rating"),
        "review_length_and_helpfulness": summary.groupBy(CAT, "star_rating")
        .agg(_avg_length().alias("avg_review_length"), F.round(_helpful(), 2).alias("helpful_percent"))
        .orderBy(CAT, "star_rating"),
        "review_length_by_marketplace": summary.groupBy("marketplace", CAT, "star_rating")
        .agg(_avg_length().alias("avg_review_length"))
        .orderBy("marketplace", CAT, F.desc("star_rating")),
    }


def materialised_report(reviews: DataFrame) -> dict[str, DataFrame]:
    """:func:`review_report` over a summary computed once and checkpointed.

    The summary is written to the shared checkpoint folder named by
    ``spark.checkpoint.dir`` (a reliable checkpoint, so a lost executor does
    not send the eleven results back to the reviews), then every statistic
    reads that small table.
    """
    return review_report(review_summary(reviews).checkpoint(eager=True))
