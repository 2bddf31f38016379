"""Scans, schemas, the driver-table review view and the parquet sink."""

from revlens.sources.driver_view import driver_reviews
from revlens.sources.readers import (
    read_neighbour_lists,
    read_pairs,
    read_partitioned_reviews,
    read_reviews,
    split_categories,
    union_reviews,
)
from revlens.sources.sinks import write_parquet

__all__ = [
    "driver_reviews",
    "read_neighbour_lists",
    "read_pairs",
    "read_partitioned_reviews",
    "read_reviews",
    "split_categories",
    "union_reviews",
    "write_parquet",
]
