"""Shared helpers of the operators: reading, work folders, bounded training rows."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder of the cluster.

    ``spark.checkpoint.dir`` is used where it is set, and the session's
    warehouse folder where not; both are shared by driver and executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/revlens-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "zstd", by: str | None = None) -> DataFrame:
    """Write ``df`` to a new shared folder and read it back: lineage ends here. ``by`` names a column with a folder for each value."""
    spark = df.sparkSession
    path = work_path(spark, name)
    writer = df.write.option("compression", compression)
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def first_by_hash(ids: DataFrame, column: str, n: int) -> DataFrame:
    """At most ``n`` rows, those with the smallest hash of ``column``: the same rows on every run."""
    return ids.orderBy(F.xxhash64(column), column).limit(n)


_BLOCK = 1 << 18


def bitmap(rows: DataFrame, size: int) -> np.ndarray:
    """The numbers in the one column of ``rows`` (0 to ``size`` - 1) as bits of 64-bit words.

    The result has ``size / 8`` bytes whatever the number of rows, and reaches
    the driver in blocks that the executors have put together.
    """

    def fill(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            bit = np.unique(batch.column(0).to_numpy())
            for block, own in zip(*_by_block(bit), strict=True):
                held.setdefault(block, np.zeros(_BLOCK, bool))[own] = True
        for block, own in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())], ["block", "bits"])

    (name,) = rows.columns
    rows = rows.where(F.col(name).isNotNull()).select(F.col(name).cast("long").alias("bit"))
    out = np.zeros(max(size, _BLOCK) // 64, np.uint64)
    for block, bits in rows.repartition((F.col("bit") / _BLOCK).cast("long")).mapInArrow(fill, "block long, bits binary").collect():
        out[block * _BLOCK // 64 : (block + 1) * _BLOCK // 64] = np.frombuffer(bits, np.uint64)
    return out


def _by_block(bit: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Blocks of sorted numbers, and the numbers' places in them."""
    block = bit // _BLOCK
    names, begins = np.unique(block, return_index=True)
    return names.tolist(), np.split(bit % _BLOCK, begins[1:])
