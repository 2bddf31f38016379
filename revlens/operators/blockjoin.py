"""Equi joins whose hot keys are dealt to a grid of tasks (fragment and replicate).

A key that holds many rows on both sides makes rows x rows pairs, and a plain
shuffle join makes them all in one task. Here the rows of each side are counted
per key first (map-side sums). A key with more than ``hot`` rows on a side gets
as many fragments there as ``hot`` goes into its rows: a row of the left side
lies in one row block of the grid (by a hash of ``by_left``) and is repeated for
every column block, a row of the right side the other way round. Each cell of the
grid joins at most about ``hot`` rows of either side, whatever the key holds, so
the work is spread by the counts alone: it depends neither on adaptive skew
handling nor on how many map tasks the input had. All other keys have a grid of
one cell and are joined as they would be without it.

The table of hot keys is broadcast, so finding a row's fragments takes no shuffle.
Its size is bounded: where more than ``MAX_HOT_KEYS`` keys could pass ``hot``,
the limit rises to the rows divided by ``MAX_HOT_KEYS``, which no more keys than
that can pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one side that one cell takes, by default.
HOT_ROWS = 4096
#: Keys that are broadcast with their number of fragments, at most.
MAX_HOT_KEYS = 1_000_000


def hot_keys(rows: DataFrame, key: str, hot: int = HOT_ROWS) -> DataFrame:
    """(key, _rows, _limit) of the keys with more than ``_limit`` rows: ``hot``, or more where the bound asks for it."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = F.coalesce(counts.select(F.sum("_rows")).scalar(), F.lit(0).cast("long"))
    limit = F.greatest(F.lit(int(hot)).cast("double"), total / MAX_HOT_KEYS)
    return counts.withColumn("_limit", limit).where(F.col("_rows") > F.col("_limit"))


def _fragments(rows: DataFrame, key: str, hot: int, name: str) -> DataFrame:
    return hot_keys(rows, key, hot).select(key, F.ceil(F.col("_rows") / F.greatest("_limit", F.lit(1.0))).cast("int").alias(name))


def _block(by: str, fragments: Column) -> Column:
    return F.pmod(F.xxhash64(F.col(by)), fragments).cast("int")


def _upto(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def _known(rows: DataFrame, key: str, grid: DataFrame) -> DataFrame:
    return rows.where(F.col(key).isNotNull()).join(F.broadcast(grid), key, "left")


def grid_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    by_left: str,
    by_right: str,
    hot: int = HOT_ROWS,
    residual: Column | None = None,
) -> DataFrame:
    """Inner join of ``left`` and ``right`` on ``key``; columns come out as ``l_<name>`` and ``r_<name>``.

    ``residual`` is a further condition over those names, evaluated inside the
    join. ``by_left`` and ``by_right`` are the columns whose hash deals a hot
    key's rows to fragments; they should tell the rows of one key apart. NULL
    keys never match. A frame joined with itself goes to :func:`grid_self_join`.
    """
    if left is right and by_left == by_right:
        return grid_self_join(left, key, by_left, hot, residual)
    grid = _fragments(left, key, hot, "_gr").join(_fragments(right, key, hot, "_gc"), key, "full")
    one = F.lit(1)
    gr, gc = F.coalesce("_gr", one), F.coalesce("_gc", one)
    lefts = _known(left, key, grid).select(
        *(F.col(c).alias(f"l_{c}") for c in left.columns), _block(by_left, gr).alias("_lr"), _upto(gc).alias("_lc")
    )
    rights = _known(right, key, grid).select(
        *(F.col(c).alias(f"r_{c}") for c in right.columns), _block(by_right, gc).alias("_rc"), _upto(gr).alias("_rr")
    )
    on = (F.col(f"l_{key}") == F.col(f"r_{key}")) & (F.col("_lr") == F.col("_rr")) & (F.col("_lc") == F.col("_rc"))
    if residual is not None:
        on = on & residual
    return lefts.join(rights, on, "inner").drop("_lr", "_lc", "_rr", "_rc")


def grid_self_join(rows: DataFrame, key: str, by: str, hot: int = HOT_ROWS, residual: Column | None = None) -> DataFrame:
    """:func:`grid_join` of a frame with itself, from one shuffle.

    A cell stands for an unordered pair of fragments, so a row goes to the same
    cells on either side: both sides are one plan, whose exchange is read twice.
    Two rows meet in the cell of their own two fragments only. The join is never
    broadcast: Spark sizes ``rows`` by compressed files and takes one row out for
    one row in, so rows that are made many in a task look small enough for it.
    """
    grid = _fragments(rows, key, hot, "_g")
    g = F.coalesce("_g", F.lit(1))
    dealt = _known(rows, key, grid).select(*rows.columns, _block(by, g).alias("_own"), _upto(g).alias("_other"))
    low, high = F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high")
    dealt = dealt.select(*rows.columns, "_own", low, high)
    # Renamed after the join only: two aliases of one plan share its exchange.
    named = lambda side: {c: F.col(f"{side}.{c}") for c in dealt.columns}
    l, r = named("l"), named("r")
    on = (l[key] == r[key]) & (l["_low"] == r["_low"]) & (l["_high"] == r["_high"])
    on = on & (F.least(l["_own"], r["_own"]) == l["_low"]) & (F.greatest(l["_own"], r["_own"]) == l["_high"])
    met = dealt.alias("l").join(dealt.alias("r").hint("merge"), on, "inner")
    met = met.select(*(l[c].alias(f"l_{c}") for c in rows.columns), *(r[c].alias(f"r_{c}") for c in rows.columns))
    return met if residual is None else met.where(residual)
