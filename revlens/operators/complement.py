"""Aggregates over each user's negatives, by inclusion and exclusion.

A negative of a user is any other user (``as_written``), or any other user that
is not a neighbour (``documented``). There are about users x users of them, but
a sum over them is the sum over all users, less the user's own value, less the
values of its neighbours. That needs the users once and each neighbour pair once,
and no (user, negative) pair. It holds for every sum-like aggregate: counts,
sums, sums of products and of hashes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.operators.customers import salted_join
from revlens.operators.neighbours import pairs_of_groups, per_customer
from revlens.operators.triples import MODES


def id_hash(user: str | Column = "user_id") -> Column:
    """A 32-bit hash of an id as a bigint: the first eight hexadecimal digits of its MD5.

    Sums of it are exact for up to 2**31 users.
    """
    return F.conv(F.substring(F.md5((F.col(user) if isinstance(user, str) else user).cast("binary")), 1, 8), 16, 10).cast("long")


def complement_sums(
    pairs: DataFrame, measures: Mapping[str, Column], mode: str = "documented", users: DataFrame | None = None
) -> DataFrame:
    """One row per user: for each measure its sum over the user's negatives.

    ``pairs`` is the long form of the neighbour lists (``neighbour_pairs``).
    ``measures`` are integer columns over a user's own row: ``user_id`` and
    whatever else ``users`` (one row per user) brings; NULL counts as 0. Without
    ``users`` they are the pairs' customers. Neighbours that are no users are
    nobody's negatives; a user that neighbours itself is excluded once.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if users is None:
        users = pairs.select(F.col("customer_id").alias("user_id")).distinct()
    names = list(measures)
    values = users.where(F.col("user_id").isNotNull()).select(
        "user_id", *(F.coalesce(measures[n].cast("long"), F.lit(0).cast("long")).alias(n) for n in names)
    )
    totals = {n: values.select(F.sum(n)).scalar() for n in names}
    rest = {n: totals[n] - F.col(n) for n in names}
    if mode == "as_written":
        return values.select("user_id", *(rest[n].alias(n) for n in names))
    linked = pairs.where(F.col("customer_id") != F.col("neighbour_customer_id"))
    linked = linked.select("customer_id", "neighbour_customer_id").distinct()
    # A hot neighbour's rows are spread by a hash of the user; sums start on the map side.
    of = values.select(F.col("user_id").alias("neighbour_customer_id"), *(F.col(n).alias(f"_x_{n}") for n in names))
    met = salted_join(linked, of, "neighbour_customer_id", "customer_id", "inner")
    excluded = met.groupBy(F.col("customer_id").alias("user_id")).agg(*(F.sum(f"_x_{n}").alias(f"_x_{n}") for n in names))
    joined = values.join(excluded, "user_id", "left")
    return joined.select("user_id", *((rest[n] - F.coalesce(F.col(f"_x_{n}"), F.lit(0))).alias(n) for n in names))


def triple_digests(pairs: DataFrame, mode: str = "documented") -> DataFrame:
    """One row per (user, positive) of the triple bag, with its negatives' count and digest.

    ``n_positive`` is how often the positive occurs, ``n_negative`` how many
    negatives go with each occurrence, ``negatives_digest`` the sum of their
    :func:`id_hash`. Two bags of triples with equal rows here agree on every
    (user, positive) and, but for a collision of sums, on its set of negatives.
    """
    per_user = complement_sums(pairs, {"n_negative": F.lit(1), "negatives_digest": id_hash()}, mode)
    positives = pairs.select(
        F.col("customer_id").alias("user_id"),
        F.col("neighbour_customer_id").alias("positive_user_id"),
        F.col("n_shared").alias("n_positive"),
    )
    return salted_join(positives, per_user, "user_id", "positive_user_id", "inner").select(
        "user_id", "positive_user_id", "n_positive", "n_negative", "negatives_digest"
    )


def group_digests(groups: DataFrame, mode: str = "documented") -> DataFrame:
    """``n_negative`` and ``negatives_digest`` on the rows of the grouped pairs (``neighbour_groups``, a written stage).

    :func:`complement_sums` of pairs that are symmetric, as neighbours are: every
    neighbour is a user and excluded, so its values are taken from its id where it
    stands in the list, and no pair is shuffled.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    users = groups.select(F.col("customer_id").alias("user_id")).distinct()
    n = users.select(F.count(F.lit(1))).scalar() - 1
    digest = F.coalesce(users.select(F.sum(id_hash())).scalar(), F.lit(0).cast("long")) - id_hash("customer_id")
    if mode == "documented":
        kind = groups.schema["customer_id"].dataType
        listed = F.aggregate("neighbours", F.lit(0).cast("long"), lambda total, x: total + id_hash(x.cast(kind)))
        groups = per_customer(groups, {"_n": F.size("neighbours"), "_digest": listed})
        n, digest = n - F.col("_n"), digest - F.col("_digest")
    return groups.select("customer_id", "parts", "neighbours", "n_shared", n.cast("long").alias("n_negative"), digest.cast("long").alias("negatives_digest"))


def triple_digests_from_groups(groups: DataFrame, mode: str = "documented") -> DataFrame:
    """:func:`triple_digests` from the grouped pairs."""
    pairs = pairs_of_groups(group_digests(groups, mode), "n_negative", "negatives_digest")
    names = {"customer_id": "user_id", "neighbour_customer_id": "positive_user_id", "n_shared": "n_positive"}
    return pairs.withColumnsRenamed(names)
