"""Column expressions shared by the review statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.sources.schemas import BODY_LENGTH_COL


def share_percent(value: str, partition_by: Sequence[str]) -> Column:
    """``value`` as a percent of its total inside each ``partition_by`` group.

    Meant for already-aggregated frames, whose size is the number of groups.
    """
    total = F.sum(value).over(Window.partitionBy(*partition_by))
    # a group whose counted values are all NULL sums to 0: NULL, not an error
    return F.try_divide(F.col(value), total) * 100


def percent_of_total(aggregated: DataFrame, value: str) -> Column:
    """``value`` as a percent of its sum over all rows of ``aggregated``.

    The total is a scalar subquery over the aggregated rows, so no row moves to
    a single partition; it reads the aggregate's output, so adaptive execution
    reuses the aggregate's exchange instead of scanning the input again.
    """
    total = aggregated.select(F.sum(value)).scalar()
    return F.try_divide(F.col(value), total) * 100


def helpful_percent() -> Column:
    """Ratio of summed votes (not an average of ratios) times 100.

    ``try_divide`` gives NULL for a group whose votes sum to 0 instead of
    failing under ANSI mode.
    """
    return F.try_divide(F.sum("helpful_votes"), F.sum("total_votes")) * 100


def review_length(reviews: DataFrame) -> Column:
    """Character length of the review body (code points; NULL body stays NULL).

    A frame that brings the length as a column of its own needs no body.
    """
    return F.col(BODY_LENGTH_COL) if BODY_LENGTH_COL in reviews.columns else F.length("review_body")
