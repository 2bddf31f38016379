"""Parquet sink with an optional bounded file count."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Has an execution remove its shuffle files when it ends; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Columns of neighbours, in order within their customer: their differences take less than their numbers in a dictionary.
IN_ORDER = ("neighbours.list.element", "neighbour_customer_id", "positive_user_id")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is executed inside the block leaves no shuffle files behind; a frame that is executed again is dealt again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def write_parquet(
    df: DataFrame, path: str, num_files: int | None = None, mode: str = "overwrite", by: str | None = None, last: bool = True
) -> None:
    """Write ``df`` as parquet, with a folder for each value of the column ``by`` where it is named.

    A write that is not the ``last`` of those into its folder leaves no ``_SUCCESS`` mark.

    With ``num_files`` the output is cut to that many files by a round-robin
    ``repartition``: unlike ``coalesce`` it keeps the full width of the stage
    that computes ``df`` and adds one cheap exchange. Without it the file count
    follows the final stage, whose partitions adaptive execution already sizes.
    Files are compressed with zstd, their pages are of version 2: numbers and texts
    are kept as differences where they are too many for a dictionary, and always in
    the columns ``IN_ORDER``. The shuffle files of the write are removed at its end.
    """
    if num_files is not None:
        df = df.repartition(int(num_files))
    writer = df.write.mode(mode).option("compression", "zstd").option("parquet.writer.version", "v2")
    writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(last).lower())
    writer = writer.options(**{f"parquet.enable.dictionary#{column}": "false" for column in IN_ORDER})
    with shuffles_removed(df.sparkSession):
        (writer.partitionBy(by) if by else writer).parquet(path)
