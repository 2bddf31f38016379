"""(user, positive, negative) triples from neighbour lists (stage 3).

Each function also has a ``_from_pairs`` form that reads the long form of the
lists, (customer, neighbour, n_shared) rows, with the same results.

Users are the customers that have a list row. A positive is an element of the
user's list (with multiplicity). A negative is another user:

* ``documented``: any other user that is not in the user's list (the intent
  stated for the stage);
* ``as_written``: any other user. The stage's membership test compares two
  lists, so it never removes a row; this mode keeps that result.

The triple bag has (positives of u) x (negatives of u) rows per user, which is
quadratic in the number of users. :func:`user_triple_counts` gives the same bag
in factorised form (one row per user and positive, with the number of
negatives), which is linear in the edges and exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.operators.customers import salted_join
from revlens.operators.neighbours import neighbour_pairs, pairs_of_groups, per_customer

MODES = ("documented", "as_written")


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")


def _users(lists: DataFrame) -> DataFrame:
    # A NULL id never satisfies the "other user" comparison, so it is neither
    # a user nor a negative.
    return lists.where(F.col("customer_id").isNotNull()).select(F.col("customer_id").alias("user_id"))


def _positives(lists: DataFrame) -> DataFrame:
    """One (user, positive) row per list element, multiplicity kept."""
    return lists.where(F.col("customer_id").isNotNull()).select(
        F.col("customer_id").alias("user_id"), F.explode("neighbouring_user_ids").alias("positive_user_id")
    )


def _expand(positives: DataFrame, users: DataFrame, linked: DataFrame, mode: str) -> DataFrame:
    """Attach every negative of its user to each positive row.

    Negatives are built on the user table alone (user x other user, minus the
    user's distinct neighbours ``linked`` by an anti join on ids), then joined
    to the positives on the user, so no list is carried through a join.
    """
    others = users.select(F.col("user_id").alias("negative_user_id"))
    negatives = users.join(others, F.col("user_id") != F.col("negative_user_id"), "inner")
    if mode == "documented":
        negatives = negatives.join(linked, ["user_id", "negative_user_id"], "left_anti")
    return positives.join(negatives, "user_id", "inner").select("user_id", "positive_user_id", "negative_user_id")


def user_triples(lists: DataFrame, mode: str = "documented") -> DataFrame:
    """Q17/Q18: the full triple bag (``user_id``, ``positive_user_id``, ``negative_user_id``).

    The output is quadratic by definition; see :func:`user_triple_counts` for
    the linear form.
    """
    _check_mode(mode)
    pos = _positives(lists)
    linked = pos.select("user_id", F.col("positive_user_id").alias("negative_user_id")).distinct()
    return _expand(pos, _users(lists), linked, mode)


def _pairs_as_users(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.col("customer_id").alias("user_id"),
        F.col("neighbour_customer_id").alias("positive_user_id"),
        F.col("n_shared").alias("n_positive"),
    )


def user_triples_from_pairs(pairs: DataFrame, mode: str = "documented") -> DataFrame:
    """:func:`user_triples` from the long form of the lists (``neighbour_pairs``)."""
    _check_mode(mode)
    pos = _pairs_as_users(pairs)
    expanded = pos.select(
        "user_id", F.explode(F.array_repeat("positive_user_id", F.col("n_positive").cast("int"))).alias("positive_user_id")
    )
    users = pos.select("user_id").distinct()
    linked = pos.select("user_id", F.col("positive_user_id").alias("negative_user_id"))
    return _expand(expanded, users, linked, mode)


def _positive_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("user_id", "positive_user_id").agg(F.count(F.lit(1)).alias("n_positive"))


def _factorised_counts(pos: DataFrame, n_users: Column, excluded: DataFrame | None) -> DataFrame:
    """Counts per (user, positive) from the positive counts, the user total,
    and (documented mode) the number of neighbours each user excludes."""
    n_negative = n_users - F.lit(1)
    if excluded is not None:
        pos = salted_join(pos, excluded, "user_id", "positive_user_id", "left")
        n_negative = n_negative - F.coalesce(F.col("n_excluded"), F.lit(0))
    n_negative = n_negative.cast("long")
    return pos.select(
        "user_id",
        "positive_user_id",
        "n_positive",
        n_negative.alias("n_negative"),
        (F.col("n_positive") * n_negative).alias("n_triples"),
    )


def user_triple_counts(lists: DataFrame, mode: str = "documented") -> DataFrame:
    """Q17/Q18 factorised: one row per (user, positive) with exact counts.

    ``n_positive`` is how often the positive occurs in the user's list,
    ``n_negative`` how many negatives the user has, ``n_triples`` their
    product: the number of triples with this user and positive. The user total
    is a scalar subquery over the list rows (one number). A user excludes its
    distinct neighbours that are other users: those are the (user, positive)
    rows themselves, semi-joined with the users, so the lists are exploded and
    aggregated once. The work is linear in the list elements.
    """
    _check_mode(mode)
    pos = _positive_counts(_positives(lists))
    n_users = _users(lists).select(F.count(F.lit(1))).scalar()
    excluded = None
    if mode == "documented":
        users = _users(lists).select(F.col("user_id").alias("positive_user_id"))
        excluded = (
            pos.where(F.col("user_id") != F.col("positive_user_id"))
            .join(users, "positive_user_id", "left_semi")
            .groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n_excluded"))
        )
    return _factorised_counts(pos, n_users, excluded)


def user_triple_counts_from_pairs(pairs: DataFrame, mode: str = "documented") -> DataFrame:
    """:func:`user_triple_counts` from the long form of the lists (``neighbour_pairs``).

    Pairs come from symmetric edges that never link a customer to itself, so
    the users are the pair customers and a user excludes all its neighbours:
    one pair row each.
    """
    _check_mode(mode)
    pos = _pairs_as_users(pairs)
    per_user = pos.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_excluded"))
    # The optimizer plans this count as the distinct pair customers, which
    # drops the per-user aggregate. Forcing reuse of the per-user exchange
    # instead was measured to cost more task time (96 s against 57 s at sf0.1).
    n_users = per_user.select(F.count(F.lit(1))).scalar()
    return _factorised_counts(pos, n_users, per_user if mode == "documented" else None)


def user_triple_counts_from_groups(groups: DataFrame, mode: str = "documented") -> DataFrame:
    """:func:`user_triple_counts` from the grouped pairs (``neighbour_groups``), read from a written stage.

    A user's exclusions are the length of its own row, so no pair is shuffled.
    """
    _check_mode(mode)
    n_users = groups.select("customer_id").distinct().select(F.count(F.lit(1))).scalar()
    n_negative = n_users - F.lit(1)
    if mode == "documented":
        groups = per_customer(groups, {"n_excluded": F.size("neighbours")})
        n_negative = n_negative - F.col("n_excluded")
    pairs = pairs_of_groups(groups.withColumn("n_negative", n_negative.cast("long")), "n_negative")
    return pairs.select(
        F.col("customer_id").alias("user_id"), F.col("neighbour_customer_id").alias("positive_user_id"), F.col("n_shared").alias("n_positive"),
        "n_negative", (F.col("n_shared") * F.col("n_negative")).alias("n_triples"),
    )


def user_triple_counts_from_counted_pairs(pairs: DataFrame, mode: str = "documented") -> DataFrame:
    """:func:`user_triple_counts_from_pairs` where each pair brings ``n_neighbours`` of its customer.

    It is NULL for the few customers that came in parts; only those are counted and broadcast.
    """
    _check_mode(mode)
    pos = pairs.select(
        F.col("customer_id").alias("user_id"), F.col("neighbour_customer_id").alias("positive_user_id"), F.col("n_shared").alias("n_positive"), "n_neighbours"
    )
    n_users = pos.select("user_id").distinct().select(F.count(F.lit(1))).scalar()
    if mode == "as_written":
        return _factorised_counts(pos, n_users, None)
    several = pos.where(F.col("n_neighbours").isNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("_several"))
    pos = pos.join(F.broadcast(several), "user_id", "left")
    return _factorised_counts(pos, n_users - F.coalesce("n_neighbours", "_several"), None)


def user_triple_counts_from_edges(edges: DataFrame, mode: str = "documented") -> DataFrame:
    """:func:`user_triple_counts` of ``neighbour_lists(edges)``, without the lists.

    The (user, neighbour) pairs are aggregated on the map side
    (:func:`~revlens.operators.neighbours.neighbour_pairs`) instead of being
    collected into lists and exploded again.
    """
    return user_triple_counts_from_pairs(neighbour_pairs(edges), mode)
