"""Customers linked by a shared product (stage 2)."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from revlens.operators.blockjoin import HOT_ROWS, MAX_HOT_KEYS, grid_self_join, hot_keys
from revlens.operators.customers import salted_join
from revlens.operators.prefix import running_totals
from revlens.sources.handoff import Workspace
from revlens.sources.sinks import shuffles_removed


def neighbour_edges(purchases: DataFrame, hot: int = HOT_ROWS) -> DataFrame:
    """Q15: every (customer, neighbour) pair that shares a product.

    A self equi join on the product with the residual ``customer !=
    neighbour``. NULL products never match. The output is the one-mode
    projection of the customer-product graph, so a product bought by k
    customers yields k*(k-1) rows. A product of more than ``hot`` purchases is
    dealt to a grid of tasks by hashes of its customers (``blockjoin``), from one
    shuffle that both sides read.
    """
    rows = purchases.select("customer_id", "product_id")
    other = F.col("l_customer_id") != F.col("r_customer_id")
    return grid_self_join(rows, "product_id", "customer_id", hot, residual=other).select(
        F.col("l_customer_id").alias("customer_id"),
        F.col("l_product_id").alias("product_id"),
        F.col("r_customer_id").alias("neighbour_customer_id"),
        F.col("r_product_id").alias("neighbour_product_id"),
    )


def neighbour_lists(edges: DataFrame, ordered: bool = False) -> DataFrame:
    """Q16: each customer's neighbours, once per shared product.

    ``edges`` come one by one (:func:`neighbour_edges`) or in groups
    (:func:`edge_groups` with ``limit=None``), which are shuffled as arrays.
    ``collect_list`` keeps multiplicity and drops NULLs; customers without a
    neighbour are absent. List order is not defined unless ``ordered``, which
    sorts each list (used for comparisons).
    """
    if "neighbours" in edges.columns:
        nbrs = _plain(edges)
        nbrs = F.sort_array(nbrs) if ordered else nbrs
        return edges.select("customer_id", nbrs.alias("neighbouring_user_ids"))
    nbrs = F.collect_list("neighbour_customer_id")
    if ordered:
        nbrs = F.sort_array(nbrs)
    return edges.groupBy("customer_id").agg(nbrs.alias("neighbouring_user_ids"))


def neighbour_pairs(edges: DataFrame) -> DataFrame:
    """Q16 in long form: one row per (customer, neighbour) with ``n_shared``.

    The same multiset as :func:`neighbour_lists` (a neighbour occurs
    ``n_shared`` times in the list), but no row grows with a customer's
    degree: a customer linked to a third of all customers is spread over many
    rows and tasks instead of one array. Single edges are aggregated partially on
    the map side; groups of edges are counted where they lie.
    """
    if "neighbours" in edges.columns:
        runs = _runs(edges.withColumn("neighbours", F.sort_array("neighbours")))
        each = runs.select("customer_id", "neighbours", "_starts", F.posexplode("_starts").alias("_k", "_b"))
        n = F.coalesce(F.get("_starts", F.col("_k") + 1), F.size("neighbours")) - F.col("_b")
        kind = edges.schema["customer_id"].dataType
        return each.select("customer_id", F.get("neighbours", F.col("_b")).cast(kind).alias("neighbour_customer_id"), n.cast("long").alias("n_shared"))
    return edges.groupBy("customer_id", "neighbour_customer_id").agg(F.count(F.lit(1)).alias("n_shared"))


#: Strips of customers are ``BLOCKS`` x ``BLOCKS``; customers in one array; edges of one group.
BLOCKS, ARRAY, GROUP = 32, 2048, 1 << 20
#: Edges that one pass shuffles, of 4 bytes each where ids are integers; a quarter of them where they are texts.
PASS = 1 << 30


def _number_type(ids: DataFrame) -> str | None:
    """The integer type that holds every id of ``ids`` and gives back its very text, if there is one."""
    if ids.schema["customer_id"].dataType != StringType():
        return None
    c = F.col("customer_id")
    fits = lambda t: F.min(F.coalesce(c.try_cast(t).cast("string") == c, F.lit(False)))
    with shuffles_removed(ids.sparkSession):
        small, large = ids.agg(fits("int"), fits("bigint")).first()
    return "int" if small else "bigint" if large else None


def _plain(groups: DataFrame) -> Column:
    """The neighbours of ``groups`` as ids of the customers' own type."""
    return F.col("neighbours").cast(ArrayType(groups.schema["customer_id"].dataType))


def _runs(groups: DataFrame) -> DataFrame:
    """``groups`` of sorted neighbours, one at least, with ``_starts``: the positions where another neighbour begins."""
    # Behind the last position there is nothing to differ from: NULL, which filters out.
    return groups.withColumn("_starts", F.expr("concat(array(0), filter(sequence(1, size(neighbours)), i -> get(neighbours, i) <> get(neighbours, i - 1)))"))


def edge_groups(purchases: DataFrame, blocks: int = BLOCKS, heavy: int | None = None, limit: int | None = GROUP) -> DataFrame:
    """Q15 in groups: one row per customer with ``neighbours``, an element for each of its edges.

    Nothing is shuffled pair by pair. A product's buyers are one array, and each
    buyer's strip of customers (``blocks`` x ``blocks`` of them, by hash) gets that
    array, so an edge travels as one id. Ids that are all plain integers travel as
    such and stay so in ``neighbours``; the other operators here turn them back. A
    heavy product, one of more than ``heavy`` purchases (16 a block by default),
    sends a strip its buyers there and all its buyers, in arrays of about ``ARRAY``
    ids: k buyers travel as k ids a strip at most, not as k x k. They are multiplied
    out in the strip, with no further shuffle.

    A customer of more than ``limit`` edges has ``parts`` rows, with its neighbours
    dealt by hash, so that no row or task grows with a customer's degree; the
    number of such customers is bounded by the edges divided by ``limit``. NULL
    customers and products have no edges.
    """
    (groups,) = edge_group_passes(purchases, blocks, heavy, limit, passes=1)
    return groups


def edge_group_passes(
    purchases: DataFrame, blocks: int = BLOCKS, heavy: int | None = None, limit: int | None = GROUP, passes: int | None = None,
    work: Workspace | None = None,
) -> list[DataFrame]:
    """:func:`edge_groups` cut by strips into frames that are written one after the other (``handoff.write_stage``).

    Together they hold each group once. The edges are many times the purchases, and
    a write removes its shuffle files, so no more than about ``PASS`` edges lie on
    disk as such at a time; ``passes`` is taken from their number where it is not given.
    With ``work`` the products' arrays are written as its stage ``buyers`` and read by
    every pass; without it each pass collects them anew.
    """
    heavy = 16 * blocks if heavy is None else heavy
    spark = purchases.sparkSession
    rows = purchases.select("customer_id", "product_id").where(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull())
    kind, number = rows.schema["customer_id"].dataType, _number_type(rows)
    if number:
        rows = rows.withColumn("customer_id", F.col("customer_id").try_cast(number))
    at = ["_strip", "_part", "_parts"]
    n = F.col("_n")
    sizes = rows.groupBy("product_id").agg(F.count(F.lit(1)).alias("_n")).agg(F.sum(n).alias("rows"), F.max(n).alias("most"), F.sum(n.cast("double") * n).alias("edges"))
    with shuffles_removed(spark):
        size = sizes.first()
    if passes is None:
        passes = min(max(1, math.ceil((size["edges"] or 0) / (PASS if number else PASS // 4))), blocks * blocks)
    many = hot_keys(rows, "product_id", heavy).select("product_id", "_rows", F.ceil(F.col("_rows") / ARRAY).cast("int").alias("_g"))
    # What the data does not have is left out of the plan.
    some = (size["most"] or 0) > max(heavy, (size["rows"] or 0) / MAX_HOT_KEYS)
    light = rows.join(F.broadcast(many), "product_id", "left_anti") if some else rows
    # Dealt to a fixed number of tasks: each buyer's row grows by its product's array there, and adaptive execution, which
    # merges partitions by what they read, would leave a few tasks to write it all.
    light = light.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "product_id")
    light = light.groupBy("product_id").agg(F.collect_list("customer_id").alias("_right")).where(F.size("_right") > 1)
    light = light if work is None else work.stage(light, "buyers")
    light = light.select(F.explode("_right").alias("customer_id"), "_right")
    dealt = rows.join(F.broadcast(many), "product_id")
    hot = None
    if limit is not None:
        sizes = light.select("customer_id", F.size("_right").cast("long").alias("_n"))
        sizes = sizes.unionByName(dealt.select("customer_id", F.col("_rows").alias("_n"))) if some else sizes
        hot = sizes.groupBy("customer_id").agg(F.sum("_n").alias("_n")).where(F.col("_n") > limit)
        hot = hot.select("customer_id", F.ceil(F.col("_n") / limit).cast("int").alias("_hot"))
        with shuffles_removed(spark):
            hot = None if hot.isEmpty() else hot

    def parted(frame: DataFrame, turn: int) -> DataFrame:
        strip = F.pmod(F.xxhash64("customer_id"), F.lit(blocks * blocks)).cast("int")
        frame = frame if passes == 1 else frame.where(strip % passes == turn)
        if hot is None:
            return frame.select("*", strip.alias("_strip"), F.lit(1).alias("_parts"), F.lit(0).alias("_part"))
        found = frame.join(F.broadcast(hot), "customer_id", "left").select(*frame.columns, strip.alias("_strip"), F.coalesce("_hot", F.lit(1)).alias("_parts"))
        return found.select("*", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))

    def own(right: str) -> Column:
        mine = F.filter(right, lambda x: F.pmod(F.xxhash64(x), F.col("_parts")) == F.col("_part"))
        return (F.col(right) if hot is None else F.when(F.col("_parts") == 1, F.col(right)).otherwise(mine)).alias("_right")

    def groups(turn: int) -> DataFrame:
        met = parted(light, turn).select(*at, F.array("customer_id").alias("_left"), own("_right"))
        if some:
            lefts = parted(dealt, turn).groupBy("product_id", *at).agg(F.collect_list("customer_id").alias("_left"))
            sub = F.pmod(F.xxhash64("customer_id", F.lit(1)), F.col("_g")).cast("int").alias("_sub")
            rights = dealt.groupBy("product_id", sub).agg(F.collect_list("customer_id").alias("_all")).drop("_sub")
            met = met.unionByName(salted_join(lefts, rights, "product_id", "_strip", "inner").select(*at, "_left", own("_all")))
        # One exchange serves the lists as well: a constant is dropped from their keys, and must not be one of its keys.
        met = met.repartition("_strip") if hot is None else met.repartition("_strip", "_part")
        met = met.select(*at, F.explode("_left").alias("customer_id"), "_right")
        held = met.groupBy(*at, "customer_id").agg(F.flatten(F.collect_list("_right")).alias("neighbours"))
        held = held.withColumn("neighbours", F.array_remove("neighbours", F.col("customer_id"))).where(F.size("neighbours") > 0)
        return held.select(F.col("customer_id").cast(kind).alias("customer_id"), F.col("_parts").alias("parts"), "neighbours")

    return [groups(turn) for turn in range(passes)]


def shared_product_counts(purchases: DataFrame, blocks: int = BLOCKS, heavy: int | None = None) -> DataFrame:
    """:func:`neighbour_pairs` of :func:`edge_groups`, without shuffling any product's pairs.

    The pairs are the customer-by-customer product of the purchase matrix with
    itself, cut into ``blocks`` x ``blocks`` strips of rows. Every product sends a
    strip arrays of its buyers, the strip multiplies them out and counts its
    customers' pairs where they are.
    """
    return neighbour_pairs(edge_groups(purchases, blocks, heavy))


def neighbour_groups(edges: DataFrame) -> DataFrame:
    """:func:`neighbour_pairs` with a row per group instead of one per pair: customer_id, parts, neighbours, n_shared.

    ``neighbours`` are distinct ids, in the order and type that ``edges``
    (:func:`edge_groups`) have them in once sorted, plain integers where all ids are
    such, and ``n_shared`` their counts. Customers of one part, all but a few,
    have their whole list in one row, so what is summed over a customer's
    neighbours takes no shuffle (:func:`per_customer`).
    """
    runs = _runs(edges.withColumn("neighbours", F.sort_array("neighbours")))
    ends = "concat(slice(_starts, 2, size(_starts)), array(size(neighbours)))"
    return runs.select(
        "customer_id", "parts",
        F.array_distinct("neighbours").alias("neighbours"),
        F.expr(f"zip_with(_starts, {ends}, (b, e) -> cast(e - b as bigint))").alias("n_shared"),
    )


def groups_of_pairs(pairs: DataFrame, limit: int = GROUP) -> DataFrame:
    """:func:`neighbour_groups` of pairs in long form; a customer of more than ``limit`` pairs comes in parts."""
    rows = pairs.where(F.col("customer_id").isNotNull() & F.col("neighbour_customer_id").isNotNull())
    hot = hot_keys(rows, "customer_id", limit).select("customer_id", F.ceil(F.col("_rows") / F.col("_limit")).cast("int").alias("_hot"))
    rows = rows.join(F.broadcast(hot), "customer_id", "left").withColumn("parts", F.coalesce("_hot", F.lit(1)))
    part = F.pmod(F.xxhash64("neighbour_customer_id"), F.col("parts")).alias("_part")
    held = rows.groupBy("customer_id", "parts", part).agg(F.sort_array(F.collect_list(F.struct("neighbour_customer_id", "n_shared"))).alias("_held"))
    return held.select("customer_id", "parts", F.col("_held.neighbour_customer_id").alias("neighbours"), F.col("_held.n_shared").alias("n_shared"))


def pairs_of_groups(groups: DataFrame, *further: str) -> DataFrame:
    """The long form of :func:`neighbour_groups`, with the columns ``further`` of its rows."""
    kind = groups.schema["customer_id"].dataType
    each = groups.select("customer_id", "n_shared", *further, F.posexplode("neighbours").alias("_k", "_neighbour"))
    return each.select("customer_id", F.col("_neighbour").cast(kind).alias("neighbour_customer_id"), F.get("n_shared", F.col("_k")).alias("n_shared"), *further)


def per_customer(groups: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """``groups`` with, for each measure of a row, its sum over all rows of the row's customer.

    A customer of one part has it in its row. The few others' sums are
    broadcast, so the lists are not shuffled.
    """
    own = groups.select("*", *(measures[n].cast("long").alias(f"_own_{n}") for n in measures))
    several = own.where(F.col("parts") > 1).groupBy("customer_id").agg(*(F.sum(f"_own_{n}").alias(f"_all_{n}") for n in measures))
    joined = own.join(F.broadcast(several), "customer_id", "left")
    return joined.select(*groups.columns, *(F.coalesce(f"_all_{n}", f"_own_{n}").alias(n) for n in measures))


def neighbour_list_blocks(pairs: DataFrame, work: Workspace, size: int = 1024, partitions: int | None = None) -> DataFrame:
    """Q16 in blocks: each customer's sorted list, cut every ``size`` elements.

    One row per (customer, block): ``block_no`` from 0, ``first`` (the list
    position of its first element) and ``neighbouring_user_ids``, at most ``size``
    ids in code-point order, a neighbour once per shared product. Concatenated by
    ``block_no`` they are the customer's sorted list. ``pairs`` is the long form
    (:func:`neighbour_pairs`). A neighbour's position is the running total of the
    ``n_shared`` before it (``prefix.running_totals``, whose stage ``work`` owns),
    so no task and no row holds a whole customer.
    """
    rows = pairs.where(F.col("customer_id").isNotNull() & F.col("neighbour_customer_id").isNotNull())
    at = running_totals(rows, ["customer_id"], ["neighbour_customer_id"], "n_shared", "position", work, partitions)
    last = F.col("position") + F.col("n_shared") - 1
    pieces = at.withColumn("block_no", F.explode(F.sequence(F.floor(F.col("position") / size), F.floor(last / size))))
    begin = F.greatest(F.col("position"), F.col("block_no") * size)
    n = F.least(last, F.col("block_no") * size + (size - 1)) - begin + 1
    pieces = pieces.select("customer_id", "block_no", F.struct(begin.alias("at"), "neighbour_customer_id", n.cast("int").alias("n")).alias("piece"))
    blocks = pieces.groupBy("customer_id", "block_no").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    ids = F.flatten(F.transform("pieces", lambda p: F.array_repeat(p["neighbour_customer_id"], p["n"])))
    return blocks.select("customer_id", "block_no", (F.col("block_no") * size).alias("first"), ids.alias("neighbouring_user_ids"))


def list_blocks_of_groups(groups: DataFrame, work: Workspace, size: int = 1024) -> DataFrame:
    """:func:`neighbour_list_blocks` of :func:`neighbour_groups`, without dealing the pairs.

    A list that lies in one row is cut there; only customers of several parts
    have their pairs numbered. ``groups`` is read twice: a written stage.
    """
    whole = groups.where(F.col("parts") == 1)
    ids = F.flatten(F.zip_with("neighbours", "n_shared", lambda x, n: F.array_repeat(x, n.cast("int"))))
    listed = whole.select("customer_id", F.sort_array(ids.cast(ArrayType(groups.schema["customer_id"].dataType))).alias("_ids"))
    cut = listed.select("customer_id", "_ids", F.explode(F.expr(f"sequence(0L, cast((size(_ids) - 1) div {size} as bigint))")).alias("block_no"))
    first = F.col("block_no") * size
    cut = cut.select("customer_id", "block_no", first.alias("first"), F.slice("_ids", (first + 1).cast("int"), size).alias("neighbouring_user_ids"))
    parted = pairs_of_groups(groups.where(F.col("parts") > 1))
    return cut.unionByName(neighbour_list_blocks(parted, work, size))


def lists_from_blocks(blocks: DataFrame) -> DataFrame:
    """:func:`neighbour_lists`, sorted, from their blocks: one array per customer again."""
    joined = F.sort_array(F.collect_list(F.struct("block_no", "neighbouring_user_ids")))
    ids = F.flatten(F.transform(joined, lambda b: b["neighbouring_user_ids"]))
    return blocks.groupBy("customer_id").agg(ids.alias("neighbouring_user_ids"))
