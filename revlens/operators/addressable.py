"""Triples by their number: any range of the bag, without building the rest.

The triple bag is ordered by (user, positive, occurrence of the positive,
negative), ids in code-point order, and numbered from 0. The bag itself is
quadratic; its address tables are linear in the neighbour pairs:

* ``ranks``: the users, numbered in order;
* ``index``: each user with the number of its first triple (a running total of
  the triples before it).

Both are linear in the users. ``slice`` picks the users that a range touches and
numbers only their pairs and exclusions:

* each of their (user, positive) gets the number of its first triple;
* ``gaps`` are a user's exclusions, sorted by rank, turned inside out. Between
  the i-th exclusion and the next lies a run of negatives whose rank is their
  number among the user's negatives plus i + 1: rank and select on sorted
  exclusions.

The range is split by occurrence, meets the gaps it crosses and the negatives
are counted out there. Its work is the range, the touched users' pairs and one
scan of the lists. No row holds more than ``CHUNK`` numbers at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.blockjoin import grid_join
from revlens.operators.customers import salted_join
from revlens.operators.neighbours import groups_of_pairs, pairs_of_groups
from revlens.operators.prefix import running_totals
from revlens.operators.triples import MODES
from revlens.sources.handoff import Workspace

#: Consecutive negatives that one row counts out.
CHUNK = 1 << 16


class AddressableTriples:
    """The triple bag of ``pairs`` under one mode, addressed by number.

    ``pairs`` come in long form (``neighbour_pairs``) or grouped
    (``neighbour_groups``), which must be a written stage. Building writes the
    address tables as stages of ``work``, and a slice the pairs it touches;
    slices are lazy and read them, so ``work`` must stay open while slices are used.
    Numbers are 64-bit; a bag of more than 2**63 triples fails with an arithmetic
    overflow.
    """

    def __init__(self, pairs: DataFrame, mode: str, work: Workspace):
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
        self.mode = mode
        self.spark = pairs.sparkSession
        self.work = work
        self.groups = pairs if "neighbours" in pairs.columns else work.stage(groups_of_pairs(pairs), "groups")
        users = self.groups.select(F.col("customer_id").alias("user_id")).distinct().withColumn("_one", F.lit(1).cast("long"))
        self.ranks = work.stage(running_totals(users, [], ["user_id"], "_one", "rank", work).select("user_id", "rank"), "ranks")
        self.index = work.stage(self._index(work), "index")
        self.total: int = self.index.agg(F.coalesce(F.max(F.col("first") + F.col("n_triples")), F.lit(0).cast("long"))).first()[0]

    def _index(self, work: Workspace) -> DataFrame:
        listed = F.aggregate("n_shared", F.lit(0).cast("long"), lambda total, n: total + n)
        sums = self.groups.select(F.col("customer_id").alias("user_id"), F.size("neighbours").cast("long").alias("_own"), listed.alias("n_positives"))
        sums = sums.groupBy("user_id").agg(F.sum("_own").alias("_own"), F.sum("n_positives").alias("n_positives"))
        own = F.col("_own") if self.mode == "documented" else F.lit(0)
        n = self.ranks.select(F.count(F.lit(1))).scalar() - 1 - own
        rows = sums.select("user_id", "n_positives", n.cast("long").alias("n_negative"))
        rows = rows.withColumn("n_triples", F.col("n_positives") * F.col("n_negative"))
        return running_totals(rows, [], ["user_id"], "n_triples", "first", work)

    def _touched(self, lo: int, hi: int, name: str) -> DataFrame:
        """(user_id, positive_user_id, first, n_negative, n_triples) of the users with triples from ``lo`` to ``hi`` - 1, as a stage."""
        users = self.index.where((F.col("first") < hi) & (F.col("first") + F.col("n_triples") > lo)).select("user_id", F.col("first").alias("_first"), "n_negative")
        bounds = users.agg(F.min("user_id"), F.max("user_id")).first()
        # Users are numbered in order, so the touched ones lie between two ids: only their lists leave the scan.
        groups = self.groups.where(F.col("customer_id").between(*(F.lit(b) for b in bounds)))
        pairs = pairs_of_groups(groups.select("customer_id", "neighbours", "n_shared")).select(
            F.col("customer_id").alias("user_id"), F.col("neighbour_customer_id").alias("positive_user_id"), F.col("n_shared").alias("_n")
        )
        pairs = salted_join(pairs, users, "user_id", "positive_user_id", "inner").withColumn("n_triples", F.col("_n") * F.col("n_negative"))
        within = running_totals(pairs, ["user_id"], ["positive_user_id"], "n_triples", name, self.work)
        placed = within.select("user_id", "positive_user_id", (F.col("_first") + F.col(name)).alias("first"), "n_negative", "n_triples")
        return self.work.stage(placed, f"{name}-placed")

    def _gaps(self, placed: DataFrame, name: str) -> DataFrame:
        """(user_id, lo, hi, shift): the user's negatives number ``lo`` to ``hi`` - 1 have that number plus ``shift`` as rank."""
        own = self.ranks.join(placed.select("user_id").distinct(), "user_id", "left_semi").select("user_id", F.col("rank").alias("excluded"))
        if self.mode == "documented":
            of = self.ranks.select(F.col("user_id").alias("positive_user_id"), F.col("rank").alias("excluded"))
            linked = salted_join(placed.select("user_id", "positive_user_id"), of, "positive_user_id", "user_id", "inner")
            own = own.unionByName(linked.select("user_id", "excluded")).distinct()
        own = own.withColumn("_one", F.lit(1).cast("long"))
        at = running_totals(own, ["user_id"], ["excluded"], "_one", name, self.work).select("user_id", "excluded", F.col(name).alias("at"))
        last = self.ranks.select(F.count(F.lit(1))).scalar()
        ahead = at.select("user_id", (F.col("at") - 1).alias("at"), F.col("excluded").alias("next"))
        # Behind the i-th exclusion e: numbers e - i to next - i - 2, ranks e + 1 to next - 1.
        behind = at.join(ahead, ["user_id", "at"], "left").select(
            "user_id",
            (F.col("excluded") - F.col("at")).alias("lo"),
            (F.coalesce("next", last) - F.col("at") - 1).alias("hi"),
            (F.col("at") + 1).alias("shift"),
        )
        zero = F.lit(0).cast("long")
        front = at.where(F.col("at") == 0).select("user_id", zero.alias("lo"), F.col("excluded").alias("hi"), zero.alias("shift"))
        return behind.unionByName(front).where(F.col("lo") < F.col("hi"))

    def slice(self, start: int, stop: int) -> DataFrame:
        """Triples number ``start`` to ``stop`` - 1: ordinal, user_id, positive_user_id, negative_user_id."""
        if not 0 <= start <= stop:
            raise ValueError("a range runs from 0 <= start to stop >= start")
        name = f"slice-{uuid.uuid4().hex}"
        placed = self._touched(int(start), int(stop), name)
        lo, hi = F.lit(int(start)).cast("long"), F.lit(int(stop)).cast("long")
        n = F.col("n_negative")
        touched = placed.where((F.col("first") < hi) & (F.col("first") + F.col("n_triples") > lo) & (n > 0)).select(
            "user_id", "positive_user_id", "first", n,
            F.greatest(lo - F.col("first"), F.lit(0).cast("long")).alias("_from"),
            F.least(hi - F.col("first"), F.col("n_triples")).alias("_upto"),
        )
        each = touched.withColumn("_nth", F.explode(F.expr("sequence(_from div n_negative, (_upto - 1) div n_negative)")))
        each = each.select(
            "user_id", "positive_user_id",
            (F.col("first") + F.col("_nth") * n).alias("origin"),
            F.greatest(F.col("_from") - F.col("_nth") * n, F.lit(0).cast("long")).alias("a"),
            F.least(F.col("_upto") - F.col("_nth") * n, n).alias("b"),
        )
        own = self._gaps(placed, f"{name}-at")
        crossing = (F.col("r_lo") < F.col("l_b")) & (F.col("l_a") < F.col("r_hi"))
        met = grid_join(each, own, "user_id", "origin", "lo", residual=crossing).select(
            F.col("l_user_id").alias("user_id"), F.col("l_positive_user_id").alias("positive_user_id"),
            F.col("l_origin").alias("origin"), F.col("r_shift").alias("shift"),
            F.greatest("l_a", "r_lo").alias("a"), F.least("l_b", "r_hi").alias("b"),
        )
        chunks = met.withColumn("_chunk", F.explode(F.expr(f"sequence(a, b - 1, {CHUNK}L)")))
        numbered = chunks.withColumn("_k", F.explode(F.expr(f"sequence(_chunk, least(_chunk + {CHUNK - 1}, b - 1))")))
        numbered = numbered.select(
            (F.col("origin") + F.col("_k")).alias("ordinal"), "user_id", "positive_user_id", (F.col("_k") + F.col("shift")).alias("rank")
        )
        named = self.ranks.select(F.col("user_id").alias("negative_user_id"), "rank")
        return numbered.join(named, "rank").select("ordinal", "user_id", "positive_user_id", "negative_user_id")
